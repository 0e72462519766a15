"""SQL surface: make frames visible under table names, run SQL text, preview."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import ColumnLike
from ..operators.ranking import top_k


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    """Each frame becomes a temp view of the given name (no data moves)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """SQL text to a lazy frame; same Catalyst plan as the DataFrame form."""
    return spark.sql(text)


def preview(df: DataFrame, n: int = 10, order: Sequence[ColumnLike] | None = None) -> DataFrame:
    """The first ``n`` rows; with ``order`` the choice is deterministic.

    Use ``preview(df).show(truncate=False)`` for unabridged strings.
    """
    return top_k(df, n, order) if order else df.limit(n)
