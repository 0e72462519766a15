"""Language identification by prediction with partial matching (PPM).

One context tree per language holds, for every byte context of up to
:data:`ORDER` bytes, how often each byte followed. A byte unseen in the longest
known context costs the escape of that context and is then coded in the next
shorter one, down to 1/256 (method C escapes: ``distinct / (total + distinct)``;
no exclusion). The statistics are frozen after training, so a text's code length
under each language is an exact sum; the shortest wins.

Training takes a bounded sample: per language whole texts in the order of a hash
of the id, at most ``sample_docs`` of them and about ``sample_bytes`` together.
Scoring reads every byte of every text.

Defined results: text that is null or has no letter gives ``und`` with score 0,
as does everything if no labelled text exists. Equal code lengths go to the
first language in byte order. Rows repeat as in the input.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrowtext import row_groups, utf8

ORDER = 3
SAMPLE_DOCS = 1000        # up to 1000, Spark cuts the groups before the shuffle
SAMPLE_BYTES = 1 << 20
MOST_NODES = 1 << 15      # contexts kept per length, the most frequent first
CHUNK = 1 << 20           # bytes scored at a time


def training_sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(lang, text): the bounded sample. ``docs`` has doc_id, text and lang."""
    by = Window.partitionBy("lang").orderBy("order", "doc_id")
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn(
        "order", F.xxhash64("doc_id"))
    # ids and lengths only: the limit applies before the shuffle, texts never meet by language
    first = (labelled.select("lang", "order", "doc_id", F.octet_length("text").alias("bytes"))
             .withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= sample_docs))
    before = F.coalesce(F.sum("bytes").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = (first.withColumn("before", before).where(F.col("before") < sample_bytes)
            .groupBy("lang").agg(F.max("order").alias("last")))
    # one row per language, as the columns of the trees that the driver keeps
    return labelled.join(F.broadcast(last), "lang").where(F.col("order") <= F.col("last")).select("lang", "text")


def _grams(lang_texts: pd.DataFrame) -> pd.DataFrame:
    """Counts of byte strings of 1 to ORDER + 1 bytes in one language's sample."""
    out = []
    for k in range(1, ORDER + 2):
        keys = []
        for text in lang_texts["text"]:
            raw = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
            if len(raw) >= k:
                key = np.zeros(len(raw) - k + 1, np.int64)
                for j in range(k):
                    key = key << 8 | raw[j:len(raw) - k + 1 + j]
                keys.append(key)
        if keys:
            gram, n = np.unique(np.concatenate(keys), return_counts=True)
            out.append(pd.DataFrame({"k": k, "gram": gram, "n": n}))
    grams = pd.concat(out) if out else pd.DataFrame({"k": [], "gram": [], "n": []})
    return grams.assign(lang=lang_texts["lang"].iloc[0])[["lang", "k", "gram", "n"]]


class Trees:
    """The frozen context trees of all languages, merged into lookup arrays.

    ``nodes[k]`` are the byte strings of length k known to any language;
    ``step[k][node * 256 + byte]`` leads to a string one byte longer, the last
    index standing for unknown. ``cost[k][node]`` is the code length in bits of
    the string's last byte after the others, per language, escapes included;
    ``escape[k][node]`` what leaving the context costs.
    """

    def __init__(self, grams: pd.DataFrame, most_nodes: int = MOST_NODES):
        self.langs = sorted(grams["lang"].unique(), key=lambda x: x.encode())
        n_langs = len(self.langs)
        column = {x: i for i, x in enumerate(self.langs)}
        self.nodes, self.step, self.cost, self.escape = [], [], [], []
        counts = []
        for k in range(1, ORDER + 2):
            part = grams[grams["k"] == k]
            gram, at = np.unique(part["gram"].to_numpy(np.int64), return_inverse=True)
            table = np.zeros((len(gram), n_langs))
            table[at, part["lang"].map(column).to_numpy(int)] = part["n"].to_numpy(float)
            if k > 1:  # a string needs its context among the nodes
                known = np.isin(gram >> 8, self.nodes[-1])
                gram, table = gram[known], table[known]
            if 1 < k <= ORDER and len(gram) > most_nodes:
                top = np.sort(np.argsort(-table.sum(1), kind="stable")[:most_nodes])
                gram, table = gram[top], table[top]
            self.nodes.append(gram)
            counts.append(table)
        for k in range(1, ORDER + 2):
            gram, table = self.nodes[k - 1], counts[k - 1]
            if k == 1:
                context = np.zeros(len(gram), np.int64)
                n_contexts = 1
            else:
                context = np.searchsorted(self.nodes[k - 2], gram >> 8)
                n_contexts = len(self.nodes[k - 2])
            total, distinct = np.zeros((n_contexts, n_langs)), np.zeros((n_contexts, n_langs))
            np.add.at(total, context, table)
            np.add.at(distinct, context, table > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
                seen = -np.log2(table / (total + distinct)[context])
            shorter = 8.0 if k == 1 else self._shorter(gram & ((1 << 8 * (k - 1)) - 1), k - 1)
            cost = np.where(table > 0, seen, escape[context] + shorter)
            self.cost.append(np.vstack([cost, np.zeros((1, n_langs))]))
            self.escape.append(np.vstack([escape, np.zeros((1, n_langs))]))
            step = np.full((n_contexts + 1) * 256, len(gram), np.int32)
            step[context * 256 + (gram & 255)] = np.arange(len(gram))
            self.step.append(step)

    def _shorter(self, gram: np.ndarray, k: int) -> np.ndarray:
        """Costs of strings of k bytes, known or not, from the finished tables."""
        if k == 1:
            at = np.searchsorted(self.nodes[0], gram)
            at[at == len(self.nodes[0])] = 0
            known = self.nodes[0][at] == gram
            return np.where(known[:, None], self.cost[0][at], self.escape[0][0] + 8.0)
        at = np.searchsorted(self.nodes[k - 1], gram)
        at[at == len(self.nodes[k - 1])] = 0
        known = self.nodes[k - 1][at] == gram
        out = np.empty((len(gram), len(self.langs)))
        out[known] = self.cost[k - 1][at[known]]
        rest = gram[~known]
        if len(rest):
            context = np.searchsorted(self.nodes[k - 2], rest >> 8)
            context[context == len(self.nodes[k - 2])] = 0
            there = self.nodes[k - 2][context] == rest >> 8
            out[~known] = (np.where(there[:, None], self.escape[k - 1][context], 0.0)
                           + self._shorter(rest & ((1 << 8 * (k - 1)) - 1), k - 1))
        return out

    def code_lengths(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each row under each language. ``raw[offsets[i]:offsets[i+1]]`` is row i."""
        n, rows = len(raw), len(offsets) - 1
        total = np.zeros((rows, len(self.langs)))
        if not n:
            return total
        first = np.zeros(n, bool)
        filled = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[filled] = True
        row = np.repeat(np.arange(rows), np.diff(offsets))
        byte = raw.astype(np.int32)
        after: list[np.ndarray] = [np.zeros(n, np.int32)]     # context node of each byte, by length
        node = [self.step[0][byte]]
        for k in range(2, ORDER + 2):
            unknown = len(self.nodes[k - 2])
            before = np.empty(n, np.int32)
            before[0] = unknown
            before[1:] = node[-1][:-1]
            before[first] = unknown
            after.append(before)
            node.append(self.step[k - 1][before * 256 + byte])
        at = np.arange(n)
        for k in range(ORDER + 1, 0, -1):
            here = node[k - 1][at]
            hit = here < len(self.nodes[k - 1])
            miss = at[~hit]
            for which, table, idx in ((at[hit], self.cost[k - 1], here[hit]),
                                      (miss, self.escape[k - 1], after[k - 1][miss])):
                if len(which):
                    of = row[which]
                    for lang in range(len(self.langs)):
                        total[:, lang] += np.bincount(of, table[:, lang][idx], rows)
            at = miss
        total += np.bincount(row[at], minlength=rows)[:, None] * 8.0
        return total


def train(sample: DataFrame) -> Trees | None:
    """Trees from a bounded sample (lang, text); its string counts come to the driver.

    They are at most ORDER + 1 counts per sampled byte, and MOST_NODES contexts
    per length are kept.
    """
    grams = sample.groupBy("lang").applyInPandas(_grams, "lang string, k int, gram long, n long").toPandas()
    return Trees(grams) if len(grams) else None


def predict(docs: DataFrame, trees: Trees | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with lang_pred and score, the winner's share of 2^-bits."""
    schema = docs.select(*keep).schema
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    source = docs.select(*keep, F.col("text").alias("__text"), has_letter.alias("__letter"))
    if trees is None:
        return source.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def score(batches):
        model = shared.value
        names = np.array([*model.langs, "und"], object)
        for batch in batches:
            raw, offsets = utf8(batch.column("__text"))
            bits = np.zeros((len(offsets) - 1, len(model.langs)))
            for a, b in row_groups(offsets, CHUNK):
                bits[a:b] = model.code_lengths(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            letter = np.asarray(batch.column("__letter").to_numpy(zero_copy_only=False), bool)
            best = bits.argmin(1) if len(bits) else np.zeros(0, int)
            gap = bits - bits.min(1, keepdims=True)
            share = 1 / np.exp2(-np.minimum(gap, 1000)).sum(1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(names[np.where(letter, best, len(model.langs))], pa.string()),
                 pa.array(np.where(letter, share, 0.0))], names=[*keep, "lang_pred", "score"])

    return source.mapInArrow(score, schema.add("lang_pred", "string").add("score", "double"))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").withColumn(
        "held_out", F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    trees = train(training_sample(docs.where(~F.col("held_out"))))
    return predict(docs, trees, ("doc_id", "held_out"))
