"""The corpus pipeline: documents through five stages, each written and reread.

Every stage works on all that the one before kept. The first four return the columns of
the documents; the last returns token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from forumlens.llm import bpe, linedup, mixing, parity, quality
from forumlens.llm.store import written

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules reject go, and the failing lines of the others."""
    return quality.clean_documents(docs)


def line_dedup(spark, docs, sf_dir):
    """Common blocks go from the later document of each aligned pair. A document that loses more than
    half of its lines is a copy of others but for a rest, and goes, as one that is left empty does."""
    left = linedup.dedup_lines(docs, measures=True)
    rest = (2 * F.col("n_removed") <= F.col("n_lines")) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return left.where(rest).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """Of each group of near duplicates the document with the smallest id stays."""
    groups = parity.near_duplicates(docs)
    others = groups.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark, docs, sf_dir):
    """Small sources are repeated, up to twice as often as the largest; every document appears."""
    return mixing.draw(docs, budget="cover", max_repeats=2.0)


def encode(spark, docs, sf_dir):
    """Token ids of every drawn document."""
    encoded = bpe.encode(docs, VOCABULARY, ("doc_id", "source"), decode=False)
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("mix_sources", mix_sources), ("encode", encode)]

# Hashes, patience alignment, components and merges by rank are beyond SQL; tests/llm holds quality
# rules, line dedup, near duplicates and the mix against plain versions, the encoding against the
# tokenizers library, the whole pipeline against planted cases.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
