"""Monthly tag activity with zero fill.

The reference loops over the chosen tags, and per tag filters, counts,
right-joins a date spine and fills 0. Here the whole series is one grouped
aggregation: grouping the *unfiltered* activity by month gives exactly the
spine (every month with activity of any tag), and a conditional count per
chosen tag is 0 where the tag is absent. No join, no cartesian product, one
scan and one shuffle of pre-aggregated rows; the long form explodes the counts of
a listed tag. Tags may also come as a table (of T1, say): then the distinct months,
collected into one array, are exploded per tag row and the counts joined to that.
Tags are told apart by their exact text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import month_key
from ..operators.aggregates import count_by, pivot_counts


def with_date(activity: DataFrame) -> DataFrame:
    return activity.withColumn("Date", month_key("Year", "Month"))


def tag_list(activity: DataFrame) -> DataFrame:
    """The distinct tags of a topic (the choices offered to the user)."""
    return activity.select("TagName").distinct()


def date_spine(activity: DataFrame) -> DataFrame:
    """The distinct year-months seen for any tag, in order."""
    return with_date(activity).select("Date").distinct().orderBy("Date")


def _tags(tags: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(tags))


def series_wide(activity: DataFrame, tags: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """T4: Date plus one zero-filled count column per chosen tag."""
    dated = with_date(activity)
    wide = pivot_counts(dated, [*keys, "Date"], "TagName", _tags(tags))
    return wide.orderBy(*keys, "Date")


def series_long(activity: DataFrame, tags: Sequence[str] | DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """T3 for several tags: (Date, TagName, Count), zero-filled. ``tags``: a list, or a table with TagName."""
    dated = with_date(activity)
    if isinstance(tags, DataFrame):
        return _series_of_table(dated, tags.select("TagName").distinct(), keys).orderBy(*keys, "TagName", "Date")
    chosen = _tags(tags)
    if not chosen:
        return dated.select(*keys, "Date", F.lit(None).cast("string").alias("TagName"),
                            F.lit(0).cast("bigint").alias("Count")).limit(0)
    counts = F.array(*(F.struct(F.lit(t).alias("TagName"), F.count(F.when(F.col("TagName") == t, F.lit(1))).alias("Count"))
                       for t in chosen))
    long = dated.groupBy(*keys, "Date").agg(counts.alias("counts")).select(*keys, "Date", F.inline("counts"))
    return long.orderBy(*keys, "TagName", "Date")


def _series_of_table(dated: DataFrame, tags: DataFrame, keys: Sequence[str]) -> DataFrame:
    spine_keys = [*keys, "Date"]
    counts = count_by(dated.join(tags, "TagName", "left_semi"), [*spine_keys, "TagName"], "Count")
    # one row: the months (per topic) that occur, a number that does not grow with the rows
    months = dated.select(*spine_keys).distinct().agg(F.collect_list(F.struct(*spine_keys)).alias("months"))
    spine = tags.withColumn("months", months.scalar()).select("TagName", F.inline("months")).alias("s")
    c = counts.alias("c")
    same = F.col("s.TagName") == F.col("c.TagName")
    for k in spine_keys:
        same = same & F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}"))
    return spine.join(c, same, "left").select(*(F.col(f"s.{k}") for k in spine_keys), "s.TagName",
                                              F.coalesce("c.Count", F.lit(0)).alias("Count"))


def series_one(activity: DataFrame, tag: str) -> DataFrame:
    """T3 for one tag: (Date, Count), zero-filled over the spine."""
    return series_long(activity, [tag]).select("Date", "Count")


def topics_series(activity: DataFrame, tags: Sequence[str], topic_col: str = "Topic") -> DataFrame:
    """T5: the long series for several topics at once; each topic keeps its
    own spine (the months seen in that topic)."""
    return series_long(activity, tags, keys=[topic_col])
