"""Joins with declared rules for missing keys and unmatched rows.

Plain equi-joins stay plain ``DataFrame.join`` calls so that Catalyst and AQE
choose broadcast or sort-merge from measured sizes. The helpers here only add
what the reference's dialects disagree on (whether a missing key matches a
missing key, whether unmatched rows survive). Nothing is broadcast by hint.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_KEYS = ("sql", "match")


def key_condition(on: Sequence[tuple[str, str]], left_alias: str, right_alias: str,
                  null_keys: str = "sql") -> Column:
    """AND of key equalities. ``null_keys="match"`` uses ``<=>`` so that a
    missing key matches a missing key (R ``merge``, dplyr, pandas)."""
    if null_keys not in NULL_KEYS:
        raise ValueError(f"null_keys must be one of {NULL_KEYS}")
    if not on:
        raise ValueError("a join needs at least one pair of keys")
    cond = None
    for lc, rc in on:
        a, b = F.col(f"{left_alias}.{lc}"), F.col(f"{right_alias}.{rc}")
        part = a.eqNullSafe(b) if null_keys == "match" else a == b
        cond = part if cond is None else cond & part
    return cond


def join_on(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
            how: str = "inner", null_keys: str = "sql",
            left_alias: str = "l", right_alias: str = "r") -> DataFrame:
    """Equi-join on (left column, right column) pairs; both sides stay
    addressable as ``<alias>.<column>``, which also makes self joins safe."""
    l, r = left.alias(left_alias), right.alias(right_alias)
    return l.join(r, key_condition(on, left_alias, right_alias, null_keys), how)


def lookup(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
           keep_unmatched: bool = False, **kw) -> DataFrame:
    """Foreign-key lookup; unmatched left rows are dropped or kept with
    missing right columns. Both sides stay addressable by alias; with many missing or hot keys
    :func:`left_outer` spreads better."""
    return join_on(left, right, on, "left" if keep_unmatched else "inner", **kw)


def _right_names(left: Sequence[str], right: Sequence[str], suffix: str) -> list[str]:
    """Names for the right columns that clash with no other column, whatever their case."""
    taken, out = {c.lower() for c in left}, []
    for c in right:
        while c.lower() in taken:
            c += suffix
        taken.add(c.lower())
        out.append(c)
    return out


def left_outer(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], suffix: str = "_right") -> DataFrame:
    """Every row of ``left`` with its partners, or with missing values; each column name once.

    Rows with a missing key have no partner: they bypass the join, so they do not meet in one
    task. The rest is a left outer join, whose left side Spark splits where a key is hot.
    Right columns whose names are taken get ``suffix``.
    """
    if not on:
        raise ValueError("a join needs at least one pair of keys")
    names = _right_names(left.columns, right.columns, suffix)
    kinds = dict(zip(names, (f.dataType for f in right.schema.fields)))
    whole = reduce(and_, (F.col(f"`{a}`").isNotNull() for a, _ in on))
    joined = join_on(left.where(whole), right, on, "left", left_alias="_ll", right_alias="_lr").select(
        *(F.col(f"_ll.`{c}`") for c in left.columns), *(F.col(f"_lr.`{c}`").alias(n) for c, n in zip(right.columns, names)))
    alone = left.where(~whole).select(*(F.col(f"`{c}`") for c in left.columns),
                                      *(F.lit(None).cast(kinds[n]).alias(n) for n in names))
    return joined.unionByName(alone)


def full_outer(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None,
               out_key: str | None = None, suffix: str = "_right") -> DataFrame:
    """Full outer join on one key with the two key columns merged into one; each column name once.

    Spark cannot split a hot key of a full outer join. This is a left outer join, which it can,
    and an anti join of the right rows against the distinct left keys. Missing keys bypass both.
    """
    right_key = right_key or key
    out_key = out_key or key
    rest_l = [c for c in left.columns if c != key]
    rest_r = [c for c in right.columns if c != right_key]
    names = _right_names([out_key, *rest_l], rest_r, suffix)
    if out_key.lower() in {c.lower() for c in rest_l}:
        raise ValueError(f"a column named {out_key} is there already")
    r = right.select(F.col(f"`{right_key}`").alias("_key"), *(F.col(f"`{c}`").alias(n) for c, n in zip(rest_r, names)))
    l = left.select(F.col(f"`{key}`").alias(out_key), *(F.col(f"`{c}`") for c in rest_l))
    with_left = left_outer(l, r, [(out_key, "_key")]).drop("_key")
    keys = left.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("_left_key")).distinct()
    known = r.where(F.col("_key").isNotNull()).join(keys, F.col("_key") == F.col("_left_key"), "left_anti")
    only_right = known.unionByName(r.where(F.col("_key").isNull()))
    return with_left.unionByName(only_right.select(
        F.col("_key").alias(out_key), *(F.lit(None).cast(left.schema[c].dataType).alias(c) for c in rest_l),
        *(F.col(f"`{n}`") for n in names)))


def semi_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of ``left`` with at least one partner; never multiplies rows."""
    return join_on(left, right, on, "left_semi", left_alias="_sl", right_alias="_sr")


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows of ``left`` without a partner."""
    return join_on(left, right, on, "left_anti", left_alias="_al", right_alias="_ar")


def spine(df: DataFrame, values: Sequence, name: str) -> DataFrame:
    """Every row of ``df`` repeated once per value of a driver-side list.

    This is the tags x dates spine: written as an ``explode`` of a literal
    array, it is a generator inside one task, not a cartesian join.
    """
    arr = F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")
    return df.withColumn(name, F.explode(arr))
