"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens raised to one exponent, then
normalised. The exponent is bisected (in several sections at a time, each round
one small aggregation over the sources) until the weights reach a target entropy
or the most repeated source meets a repetition limit. The weights are realised
as block permutations under a token budget: a source gives whole epochs, each in
a new pseudo-random order, and a last epoch cut where its budget ends.

The order of an epoch is (block, order_key): a seeded hash deals the documents to
about sqrt(n) blocks and orders each block. So a cut needs the blocks' token
sums and the inside of one block, about sqrt(n) rows each, for any source size.

Defined results: a null source is a source of its own; null text has no tokens.
A document without tokens costs nothing and follows its block. A cut keeps the
documents before the first one that does not fit, so a source stays below its
budget by less than one document. Rows repeated in the input are documents of
their own with equal places. An empty table gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quality import words
from .store import written

SECTIONS, ROUNDS = 16, 8           # exponents per round; 16^8 steps in all
MAX_EXPONENT = 8.0
ENTROPY_SHARE, MAX_REPEATS, SEED = 0.95, 4.0, 20

PLACE = ("epoch", "block", "order_key")


def count_tokens(text: Column) -> Column:
    return F.size(words(F.coalesce(text, F.lit("")))).cast("long")


def _bisect(sources: DataFrame, value, target: float) -> float:
    """The smallest exponent in [0, MAX_EXPONENT] whose ``value`` is at most ``target``.

    ``value(a)`` is an aggregate over the sources that falls as ``a`` grows.
    """
    low, high = 0.0, MAX_EXPONENT
    for _ in range(ROUNDS):
        points = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        row = sources.agg(*(value(a).alias(f"v{i}") for i, a in enumerate(points))).first()
        if row[0] is None or row[0] <= target + 1e-12:
            return points[0]
        at = next((i for i, v in enumerate(row) if v <= target), SECTIONS)
        low, high = points[at - 1], points[at]
    return high


def _entropy(share: Column):
    """Entropy of the weights share^a / sum: ln Z - a * sum(share^a ln share) / Z."""
    def value(a: float) -> Column:
        z = F.sum(F.pow(share, F.lit(a)))
        return F.log(z) - a * F.sum(F.pow(share, F.lit(a)) * F.log(share)) / z
    return value


def plan(stats: DataFrame, budget: float | str | None = None, entropy_share: float | None = ENTROPY_SHARE,
         max_repeats: float | None = MAX_REPEATS) -> DataFrame:
    """Per source: share, weight, budget, whole epochs and the tokens of the last one.

    ``stats`` has source, docs, tokens. ``budget`` is in tokens: None takes as many
    as there are; ``"cover"`` as many as let every document appear at least once.
    The target entropy is ``entropy_share`` of the largest possible one.
    """
    total, n, least, most = stats.where("tokens > 0").agg(
        F.sum("tokens"), F.count("*"), F.min("tokens"), F.max("tokens")).first()
    total = total or 0
    share = F.col("tokens") / F.lit(float(total or 1))
    some = stats.where("tokens > 0")
    exponent = 0.0
    if n and entropy_share is not None:
        # flatter than proportional only: the weights' entropy rises to the target, or stays at exponent 1
        exponent = min(1.0, _bisect(some, _entropy(share), entropy_share * math.log(n)))
    if n and max_repeats is not None:
        flattest, fullest = least / total, most / total

        def repeats(a: float) -> Column:
            z = F.sum(F.pow(share, F.lit(a)))
            if budget == "cover":
                return F.max(F.lit((flattest / fullest) ** (a - 1)))
            return F.lit((budget or total) / total * flattest ** (a - 1)) / z
        exponent = max(exponent, _bisect(some, repeats, max_repeats))
    z = some.agg(F.sum(F.pow(share, F.lit(exponent)))).first()[0] or 1.0
    if budget == "cover":
        budget = total * (most / total) ** (1 - exponent) * z if n else 0
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(exponent)) / z).otherwise(0.0)
    # the added 1e-9 keeps a source whose budget is a whole number of epochs from losing one to rounding
    epochs = F.col("budget") / F.col("tokens") + 1e-9
    return (stats.withColumn("share", share).withColumn("exponent", F.lit(exponent)).withColumn("weight", weight)
            .withColumn("budget", F.round(weight * F.lit(float(total if budget is None else budget))).cast("long"))
            .withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(epochs)).otherwise(F.lit(0)).cast("int"))
            .withColumn("rest", F.greatest(F.lit(0), F.col("budget") - F.col("epochs") * F.col("tokens")))
            .withColumn("blocks", F.ceil(F.sqrt("docs")).cast("long")))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
        seed: int = SEED, **targets) -> DataFrame:
    """One row per drawn document: key, source, tokens, epoch, block, order_key."""
    pool = written(docs.select(F.col(key).alias("__key"), F.col(source).alias("__source"),
                               count_tokens(F.col(text)).alias("__tokens")), "mix-pool")
    stats = written(pool.groupBy(F.col("__source").alias("source")).agg(
        F.count("*").alias("docs"), F.sum("__tokens").alias("tokens")), "mix-sources")
    quotas = written(plan(stats, **targets), "mix-plan")
    dealt = (pool.join(quotas.select(F.col("source").alias("s"), "epochs", "rest", "blocks"),
                       F.col("__source").eqNullSafe(F.col("s"))).drop("s"))

    def placed(rows: DataFrame) -> DataFrame:
        order = F.xxhash64(F.lit(seed), "epoch", "__key")
        return rows.withColumn("order_key", order).withColumn(
            "block", F.pmod(F.xxhash64(F.lit(seed + 1), "epoch", "__key"), F.col("blocks")))

    whole = placed(dealt.where("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1))))
    last = placed(dealt.withColumn("epoch", F.col("epochs")))
    sums = last.groupBy("__source", "block").agg(F.sum("__tokens").alias("in_block"))
    up_to = Window.partitionBy("__source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("__source").alias("s"), F.col("block").alias("b"), "in_block",
                       F.coalesce(F.sum("in_block").over(up_to), F.lit(0)).alias("before"))
    last = last.join(sums, F.col("__source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))).where(
        F.col("before") <= F.col("rest"))
    inside = F.col("before") + F.col("in_block") <= F.col("rest")
    so_far = Window.partitionBy("__source", "block").orderBy("order_key", "__key").rowsBetween(
        Window.unboundedPreceding, 0)
    cut = (last.where(~inside).withColumn("run", F.sum("__tokens").over(so_far))
           .where(F.col("before") + F.col("run") <= F.col("rest")))
    columns = [F.col("__key").alias(key), F.col("__source").alias(source), F.col("__tokens").alias("tokens"), *PLACE]
    return whole.select(columns).unionByName(last.where(inside).select(columns)).unionByName(cut.select(columns))


def draw(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` mixed: every row as often as :func:`mix` draws its document, columns as before."""
    drawn = mix(docs, key, **options).select(F.col(key).alias("__drawn"), "epoch").distinct()
    return docs.join(drawn, docs[key].eqNullSafe(F.col("__drawn"))).select(*(docs[c] for c in docs.columns))


def op3_temperature_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix(docs)
