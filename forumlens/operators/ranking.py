"""Ranking: first row per group, all ties per group, group maxima, top-k.

Skew note. A window needs a whole group in one task, so a key that holds a
third of all rows would land in one task. Two rules keep that from happening:

* ``top_per_group`` filters ``row_number``/``rank`` to ``<= n`` directly over
  the window. Catalyst then inserts a partial ``WindowGroupLimit`` *before*
  the shuffle, so each map task forwards at most ``n`` rows (``n`` plus ties
  for ``rank``) per group; a hot group arrives pre-cut.
* Per-group values that every row needs (``with_group_agg``) and the rows
  tied at a group's maximum (``rows_at_group_max``) are computed by
  ``groupBy`` (partial + final aggregation, combined map-side) and joined
  back, never by an unbounded window. AQE splits a hot key on the join side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ColumnLike, _c

TIES = ("first", "all")


def desc(c: ColumnLike) -> Column:
    """Descending, missing last (the SQL convention where NULL is smallest)."""
    return _c(c).desc_nulls_last()


def asc(c: ColumnLike) -> Column:
    """Ascending, missing first (the SQL convention where NULL is smallest)."""
    return _c(c).asc_nulls_first()


def _order(order: Sequence[ColumnLike]) -> list[Column]:
    return [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]


def _total(df: DataFrame, order: Sequence[ColumnLike]) -> list[Column]:
    """``order`` made total up to equal rows: whatever ties on it goes by all columns, as they stand."""
    names = [c.lower() for c in df.columns]
    rest = [F.col(f"`{f.name}`").asc_nulls_first() for f in df.schema.fields
            if names.count(f.name.lower()) == 1 and not _unordered(f.dataType)]
    return [*_order(order), *rest]


def _unordered(kind: T.DataType) -> bool:
    return any(t in kind.simpleString() for t in ("map<", "variant"))


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike],
                  n: int = 1, ties: str = "first",
                  tiebreak: Sequence[ColumnLike] = ()) -> DataFrame:
    """Keep the first ``n`` rows of each group under ``order``.

    ``ties="first"`` keeps exactly ``n`` rows per group, choosing among rows
    tied on ``order`` by ``tiebreak`` and then by all columns in turn, so the
    result never depends on chance; ``ties="all"`` ignores ``tiebreak`` and keeps every row that
    ties with the ``n``-th. A missing key forms its own group.
    """
    if ties not in TIES:
        raise ValueError(f"ties must be one of {TIES}")
    full = _total(df, [*order, *tiebreak]) if ties == "first" else _order(order)
    w = Window.partitionBy(*keys).orderBy(*full)
    fn = F.row_number() if ties == "first" else F.rank()
    return df.withColumn("_rank", fn.over(w)).where(F.col("_rank") <= n).drop("_rank")


def rows_at_group_max(df: DataFrame, keys: Sequence[str], value: str,
                      keep_missing: bool = False) -> DataFrame:
    """Every row whose ``value`` equals the maximum of its group (all ties).

    ``keep_missing=False`` is the pandas rule: a missing value never equals
    the maximum, so all-missing groups vanish. ``keep_missing=True`` is the
    RANK rule (missing last): a group whose values are all missing keeps
    all its rows.

    Written as an aggregate of the maximum (combined map-side) joined back on
    (keys, value) rather than a window: a hot group with many tied rows is
    spread over the join's partitions, and AQE splits a skewed one.
    """
    if not keys:
        raise ValueError("rows_at_group_max needs at least one key")
    summary = df.groupBy(*keys).agg(F.max(value).alias("_max"))
    s_ = summary.alias("_g")
    d = df.alias("_d")
    cond = None
    for k in keys:
        part = F.col(f"_d.{k}").eqNullSafe(F.col(f"_g.{k}"))
        cond = part if cond is None else cond & part
    v, m = F.col(f"_d.{value}"), F.col("_g._max")
    cond = cond & (v.eqNullSafe(m) if keep_missing else v == m)
    return d.join(s_, cond, "inner").select("_d.*")


def with_group_agg(df: DataFrame, keys: Sequence[str], agg: Column, name: str) -> DataFrame:
    """Attach a per-group aggregate to every row of the group.

    Aggregated with ``groupBy`` and joined back on the keys (missing keys
    match each other, as in a window partition).
    """
    if not keys:
        raise ValueError("with_group_agg needs at least one key")
    summary = df.groupBy(*keys).agg(agg.alias(name))
    s = summary.alias("_g")
    d = df.alias("_d")
    cond = None
    for k in keys:
        part = F.col(f"_d.{k}").eqNullSafe(F.col(f"_g.{k}"))
        cond = part if cond is None else cond & part
    return d.join(s, cond, "inner").select("_d.*", F.col(f"_g.{name}"))


def with_group_max(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """Per-group maximum of ``value`` beside each row (``transform('max')``)."""
    return with_group_agg(df, keys, F.max(value), name or f"max_{value}")


def top_k(df: DataFrame, k: int, order: Sequence[ColumnLike]) -> DataFrame:
    """First ``k`` rows under ``order``, ties by all columns in turn; planned as TakeOrderedAndProject, so
    each task keeps only ``k`` rows and the driver merges ``k`` x tasks."""
    return df.orderBy(*_total(df, order)).limit(k)


def delivered_positions(df: DataFrame, name: str = "position") -> DataFrame:
    """Number rows 1..N in the order in which ``df`` delivers them: partition by partition, each
    from its first row to its last, which for a sorted frame is the sort order.

    The rows are written once to the shared folder with their place, so every later step sees the
    same order; one row per partition gives the offsets.
    """
    from ..session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, "delivered")
    at = "_at"
    while at in df.columns:
        at += "_"
    # the id holds the partition in the upper bits and the row's place in it in the lower 33
    df.withColumn(at, F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    part = F.shiftright(at, 33)
    counts = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    # one row per partition: bounded by the partition count, not by the data
    return stored.alias("_d").join(F.broadcast(offsets), part == F.col("_part")).select(
        *(F.col(f"_d.`{c}`") for c in df.columns),
        (F.col("_before") + F.col(f"_d.{at}").bitwiseAND((1 << 33) - 1) + 1).alias(name))


def with_position(df: DataFrame, order: Sequence[ColumnLike], name: str = "position") -> DataFrame:
    """Number rows 1..N in ``order`` without funnelling them through one task.

    Range partitioning puts the rows in ordered, disjoint partitions; each
    partition numbers its own rows, and a per-partition count (one row per
    partition) gives the offsets. Rows tied on ``order`` get some order.

    The partition-tagged rows are written once to the shared checkpoint
    folder and both branches (numbering, counting) read those files: a
    recomputed range partitioning, after an executor loss or without
    exchange reuse, could sample other bounds and the branches would
    disagree.
    """
    from ..session import scratch_path
    cols = _order(order)
    spark = df.sparkSession
    path = scratch_path(spark, "positions")
    df.repartitionByRange(*cols).withColumn("_pid", F.spark_partition_id()).write.parquet(path)
    parted = spark.read.parquet(path)
    local = parted.withColumn("_local", F.row_number().over(
        Window.partitionBy("_pid").orderBy(*cols)))
    counts = parted.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    # offsets holds one row per partition: its size is bounded by the
    # partition count, not by the data.
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_offset") + F.col("_local"))
            .drop("_pid", "_local", "_offset"))
