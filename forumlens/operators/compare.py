"""Comparison of two results, as bags of rows or in the order in which they are delivered.

The difference is one grouped sum: rows of one frame weigh +1, of the other -1, and what does
not add up to 0 is missing or extra, as often as the sum says. Each side is read once and
shuffled once, pre-added per task. Missing values equal each other, as do NaNs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ColumnLike
from .ranking import delivered_positions, with_position


def _align(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    if sorted(c.lower() for c in a.columns) != sorted(c.lower() for c in b.columns):
        raise ValueError(f"column sets differ: {a.columns} vs {b.columns}")
    cols = sorted(a.columns, key=str.lower)
    return a.select(*cols), b.select(*cols)


def _check_total(df: DataFrame, order: Sequence[ColumnLike]) -> None:
    """Raise if two different rows tie on ``order``."""
    if all(isinstance(o, str) for o in order):
        tied = not df.distinct().groupBy(*order).count().where("count > 1").isEmpty()
    else:       # the same positions whichever way ties are broken
        up = with_position(df, [*order, *(F.col(f"`{c}`").asc_nulls_first() for c in df.columns)], "_position")
        down = with_position(df, [*order, *(F.col(f"`{c}`").desc_nulls_last() for c in df.columns)], "_position")
        tied = not frames_diff(up, down).isEmpty()
    if tied:
        raise ValueError("the order is not total: different rows tie, so their positions are not defined")


def frames_diff(a: DataFrame, b: DataFrame, ordered: bool = False,
                order: Sequence[ColumnLike] | None = None) -> DataFrame:
    """Rows of ``a`` missing from ``b`` (``side='missing'``) and rows of ``b``
    not in ``a`` (``side='extra'``), with multiplicity.

    ``ordered=True`` compares rows with the positions at which the frames deliver
    them (column ``_position``), so the same rows in another order differ. ``order`` states what both
    were sorted by; if different rows tie on it, their order is chance and that raises.
    """
    if ordered:
        if order:
            _check_total(a, order)
            _check_total(b, order)
        a, b = delivered_positions(a, "_position"), delivered_positions(b, "_position")
    a, b = _align(a, b)
    if "side" in (c.lower() for c in a.columns):
        raise ValueError("a column named side would clash with the result's")
    columns = a.columns
    weight = "_weight"
    while weight in columns:
        weight += "_"
    both = a.withColumn(weight, F.lit(1)).unionByName(b.withColumn(weight, F.lit(-1)))
    left = both.groupBy(*(F.col(f"`{c}`") for c in columns)).agg(F.sum(weight).alias(weight)).where(F.col(weight) != 0)
    side = F.when(F.col(weight) > 0, "missing").otherwise("extra")
    times = F.abs(F.col(weight)).cast("int")
    return left.withColumn("side", F.explode(F.array_repeat(side, times))).select(*(F.col(f"`{c}`") for c in columns), "side")


def frames_equal(a: DataFrame, b: DataFrame, ordered: bool = False,
                 order: Sequence[ColumnLike] | None = None) -> bool:
    """True when both results hold the same rows (and, if ordered, the same
    rows at the same positions)."""
    return frames_diff(a, b, ordered, order).isEmpty()
