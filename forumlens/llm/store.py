"""Tables between jobs, written in the folder the cluster names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir`` (an own folder only in local runs)."""
    return scratch_path(spark, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: what was computed survives lost executors, and a table
    used by several later steps is computed once.
    """
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
