"""Frames side by side, frames below each other, and one frame taken apart by class."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .ranking import delivered_positions


def zip_frames(left: DataFrame, right: DataFrame, position: str | None = None) -> DataFrame:
    """Row i of ``left`` beside row i of ``right``, in the order in which they are delivered.

    Both frames are numbered where their rows lie (per-partition offsets) and joined on
    the number; no task sees more than its part. Unequal lengths and common column names raise.
    ``position`` names a column for the number, from 1.
    """
    clash = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if clash or (position and position.lower() in {c.lower() for c in [*left.columns, *right.columns]}):
        raise ValueError(f"column names on both sides: {sorted(clash) or position}")
    number = position or "_position"
    while not position and number in [*left.columns, *right.columns]:
        number += "_"
    a, b = delivered_positions(left, number), delivered_positions(right, number)
    sizes = a.count(), b.count()
    if sizes[0] != sizes[1]:
        raise ValueError(f"frames of different lengths: {sizes[0]} and {sizes[1]} rows")
    out = a.join(b, number)
    return out if position else out.drop(number)


def bind_rows(frames: Sequence[DataFrame] | Mapping[str, DataFrame], name: str | None = None,
              missing_columns: bool = False) -> DataFrame:
    """Frames of one shape below each other, columns by name; with a mapping and ``name``, a column
    that tells which frame a row came from. Other columns raise unless ``missing_columns``."""
    if not frames:
        raise ValueError("bind_rows needs at least one frame")
    parts = list(frames.values()) if isinstance(frames, Mapping) else list(frames)
    if name is not None:
        labels = list(frames) if isinstance(frames, Mapping) else [str(i) for i in range(len(parts))]
        if any(name.lower() == c.lower() for p in parts for c in p.columns):
            raise ValueError(f"a column named {name} is there already")
        parts = [p.withColumn(name, F.lit(label)) for p, label in zip(parts, labels)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing_columns), parts)


def split_frames(df: DataFrame, by: str, classes: Sequence | None = None) -> dict:
    """One frame per value of ``by`` (without that column), all from one pass over ``df``.

    The rows are written once, a folder per class, and each frame reads its own folder only.
    ``classes`` lists the wanted values; without it those that occur, missing last. A class without rows is an empty frame.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "classes")
    df.write.partitionBy(by).parquet(path)
    schema = T.StructType([f for f in df.schema.fields if f.name != by] + [T.StructField(by, df.schema[by].dataType)])
    stored = spark.read.schema(schema).parquet(path)
    if classes is None:
        found = [r[0] for r in stored.select(by).distinct().collect()]
        classes = sorted((v for v in found if v is not None), key=lambda v: (str(type(v)), v)) + ([None] if None in found else [])
    return {v: stored.where(F.col(by).eqNullSafe(F.lit(v))).drop(by) for v in classes}
