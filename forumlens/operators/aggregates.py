"""Grouped and conditional aggregation.

Every helper is a single ``groupBy().agg()`` so Spark plans a partial
aggregation before the shuffle: a hot key is combined map-side and reaches
the reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ColumnLike, _c


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove rows with a missing grouping key (base R ``aggregate`` and
    pandas ``groupby`` drop them; SQL and Spark keep a NULL group)."""
    cond = None
    for k in keys:
        part = F.col(k).isNotNull()
        cond = part if cond is None else cond & part
    return df.where(cond) if cond is not None else df


def grouped_sum(df: DataFrame, keys: Sequence[str], value: str, name: str,
                empty_sum=None, drop_nulls: bool = False) -> DataFrame:
    """Sum per group. An all-missing group sums to NULL (SQL) unless
    ``empty_sum`` is given (pandas gives 0)."""
    src = drop_null_keys(df, keys) if drop_nulls else df
    total = F.sum(value)
    if empty_sum is not None:
        total = F.coalesce(total, F.lit(empty_sum))
    return src.groupBy(*keys).agg(total.alias(name))


def count_by(df: DataFrame, keys: Sequence[ColumnLike], name: str = "Count",
             drop_nulls: bool = False) -> DataFrame:
    """Row count per (possibly multi-column) key."""
    str_keys = [k for k in keys if isinstance(k, str)]
    src = drop_null_keys(df, str_keys) if drop_nulls else df
    return src.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def frequency_table(df: DataFrame, col: str, name: str = "Freq") -> DataFrame:
    """Value -> number of occurrences (R ``table``); missing values dropped."""
    return count_by(df.where(F.col(col).isNotNull()), [col], name)


def having_between(df: DataFrame, keys: Sequence[str], low: int, high: int,
                   name: str = "n") -> DataFrame:
    """Groups whose row count lies in [low, high] (HAVING ... BETWEEN)."""
    return count_by(df, keys, name).where(F.col(name).between(low, high))


def rows_in_groups_sized(df: DataFrame, keys: Sequence[str], low: int, high: int,
                         order: Sequence[ColumnLike]) -> DataFrame:
    """The rows of every group whose row count lies in [low, high].

    Only ``high + 1`` rows per group are needed to decide, so each group is
    cut to that many rows by a ``row_number`` filter, which Catalyst turns
    into a partial ``WindowGroupLimit`` before the shuffle: a hot group
    ships at most ``high + 1`` rows per map task instead of all of them.
    The cut groups are then collected (at most ``high + 1`` items each, on
    the window's partitioning, no further shuffle), sized and unpacked.
    """
    from pyspark.sql import Window
    cap = high + 1
    w = Window.partitionBy(*keys).orderBy(*order)
    capped = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap).drop("_rn")
    rest = [c for c in capped.columns if c not in keys]
    grouped = capped.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("_rows"))
    kept = grouped.where(F.size("_rows").between(low, high))
    return kept.select(*keys, F.explode("_rows").alias("_r")).select(*keys, "_r.*")


def conditional_counts(df: DataFrame, keys: Sequence[str], class_col: ColumnLike,
                       classes: dict[str, str]) -> DataFrame:
    """One pass, one count column per class: ``{out_name: class_value}``.

    The hand-written pivot ``MAX(CASE WHEN cls = v THEN total ELSE 0 END)``
    over a (key, class) count equals ``count(CASE WHEN cls = v THEN 1 END)``
    over the raw rows; the frame is read once and shuffled once.
    """
    cls = _c(class_col)
    aggs = [F.count(F.when(cls == v, F.lit(1))).alias(out) for out, v in classes.items()]
    return df.groupBy(*keys).agg(*aggs)


def pivot_counts(df: DataFrame, keys: Sequence[ColumnLike], pivot_col: str,
                 values: Sequence[str]) -> DataFrame:
    """Wide counts: one column per listed pivot value, 0 where absent.

    A column is named as its value; where that name is taken (whatever its case, by a
    key too), ``_2``, ``_3`` ... follows it.

    Every key seen in ``df`` appears, whatever its pivot value, so the key
    set doubles as the zero-fill spine. The value list is explicit, as
    Spark's ``pivot`` needs for a plan without a distinct pre-pass.
    """
    uniq = list(dict.fromkeys(values))
    if not uniq:
        return df.select(*keys).distinct()
    counts = [F.count(F.when(F.col(pivot_col) == v, F.lit(1))) for v in uniq]
    grouped = df.groupBy(*keys).agg(F.array(*counts).alias("_counts"))
    names = free_names(uniq, grouped.columns)
    return grouped.select(*(F.col(f"`{c}`") for c in grouped.columns[:-1]),
                          *(F.col("_counts")[i].alias(n) for i, n in enumerate(names)))


def free_names(wanted: Sequence[str], taken: Sequence[str]) -> list[str]:
    """The wanted names, each with a number behind it where it would stand twice, whatever its case."""
    seen, out = {c.lower() for c in taken}, []
    for name in wanted:
        free, n = name, 1
        while free.lower() in seen:
            n += 1
            free = f"{name}_{n}"
        seen.add(free.lower())
        out.append(free)
    return out


def max_of_group_counts(df: DataFrame, inner_keys: Sequence[str], outer_keys: Sequence[str],
                        name: str) -> DataFrame:
    """Two-level aggregation: count per inner key, then max per outer key."""
    counts = count_by(df, inner_keys, "_n")
    return counts.groupBy(*outer_keys).agg(F.max("_n").alias(name))


def agg_expr(kind: str, value: str) -> Column:
    """Aggregate passed by name, as the reference passes ``sum``/``max``/``length``."""
    return {"sum": F.sum, "max": F.max, "min": F.min,
            "count": lambda c: F.count(F.lit(1)), "length": lambda c: F.count(F.lit(1))}[kind](value)
