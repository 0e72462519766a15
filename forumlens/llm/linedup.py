"""Line dedup by pairwise alignment.

A later document loses what its alignment with any earlier document takes. Only
documents that hold a common run can take anything: neighbouring lines that are just
long enough to go (``min_lines`` worded lines, or fewer that have the characters).
Each run is first looked up in the document with the smallest id that holds it, so
there are at most as many pairs as a document has runs, however many documents share
one. An alignment may pass over a run it shares, where lines repeat or change their
order; runs that still stand then are looked up in the next holders, ever more at a
time, until they are gone or no earlier holder is left. The result is that of aligning
all pairs. A pair is aligned by patience diff: lines unique in both texts and in
the same order are fixed, the gaps between them are aligned likewise, and equal
neighbours join. From the later document, aligned common blocks go that are long
enough, judged on the input.

Defined results: lines are split at \\n and compared without surrounding white
space, by 64-bit hash; blank lines pair up inside blocks but add no length. Null
text has no lines and stays null. Where rows with one id have different texts, the one with
the smallest 64-bit hash stands for the id; the others are not aligned and stay whole. Equal
rows lose the same lines. Extra columns stay, whatever they are called, but for n_lines and n_removed
where ``measures`` asks for these.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import written

MIN_BLOCK_LINES = 3
MIN_BLOCK_CHARS = 200
MORE_HOLDERS = 4          # times as many holders of a standing run in each further round
BLANKS = " \t\n\x0b\x0c\r"


def _fixed_points(a: list, b: list, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Lines unique in both ranges, as the longest run in the same order."""
    def once(x, lo, hi):
        at: dict = {}
        for i in range(lo, hi):
            at[x[i]] = -1 if x[i] in at else i
        return at

    in_a, in_b = once(a, a0, a1), once(b, b0, b1)
    both = [(i, in_b[x]) for x, i in in_a.items() if i >= 0 and in_b.get(x, -1) >= 0]
    both.sort()
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(both)
    for n, (_, j) in enumerate(both):
        at = bisect_left(tops, j)
        if at:
            back[n] = piles[at - 1]
        if at == len(tops):
            tops.append(j)
            piles.append(n)
        else:
            tops[at], piles[at] = j, n
    out, n = [], piles[-1] if piles else -1
    while n >= 0:
        out.append(both[n])
        n = back[n]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned positions of equal lines, rising in both."""
    pairs: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        last = (a0, b0)
        fixed = _fixed_points(a, b, a0, a1, b0, b1)
        for i, j in fixed:
            work.append((*_span(last[0], i), *_span(last[1], j)))
            pairs.append((i, j))
            last = (i + 1, j + 1)
        if fixed:
            work.append((last[0], a1, last[1], b1))
    return sorted(pairs)


def _span(lo: int, hi: int) -> tuple[int, int]:
    return lo, max(lo, hi)


def blocks_to_remove(pairs: list[tuple[int, int]], chars: list[int], min_lines: int, min_chars: int) -> list[int]:
    """Lines of the later text inside aligned blocks (neighbours in both) that are long enough."""
    out: list[int] = []
    block: list[int] = []

    def close():
        worded = [j for j in block if chars[j]]
        if worded and (len(worded) >= min_lines or sum(chars[j] for j in worded) >= min_chars):
            out.extend(block)

    last = None
    for i, j in pairs:
        if last is not None and (i, j) != (last[0] + 1, last[1] + 1):
            close()
            block = []
        block.append(j)
        last = (i, j)
    close()
    return out


def _mixed(key: np.ndarray, more: np.ndarray) -> np.ndarray:
    key = (key ^ more.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return key ^ (key >> np.uint64(29))


def runs(hashes: np.ndarray, chars: np.ndarray, row: np.ndarray, min_lines: int,
         min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of lines just long enough to go: first and last position, and a key of their content.

    ``row`` numbers the texts, which lie one behind another. Every line of a block that is
    long enough is in such a run of the block: a worded line in a run from word to word, a blank
    one at the block's edge in a run that it begins or ends.
    """
    at = np.flatnonzero(chars > 0)
    own, text = hashes[at].astype(np.uint64), row[at]
    total = np.r_[0, np.cumsum(chars[at], dtype=np.int64)]
    apart = np.diff(at, prepend=-1, append=len(row)) - 1            # blank lines before each, and behind the last
    border = np.diff(text, prepend=-1, append=-1) != 0
    start, end = np.searchsorted(row, text, "left"), np.searchsorted(row, text, "right")
    before = np.where(border[:-1], at - start, apart[:-1])
    behind = np.where(border[1:], end - 1 - at, apart[1:])
    low, high, keys = [], [], []
    key = _mixed(own, np.zeros(len(own), np.uint64))
    for n in range(1, max(1, min_lines) + 1):
        a = np.arange(len(at) - n + 1)
        b = a + n - 1
        if n > 1:
            key = _mixed(_mixed(key[:len(a)], apart[b]), own[b])
        good = text[a] == text[b] if len(a) else np.zeros(0, bool)
        if n < min_lines:
            good &= total[b + 1] - total[a] >= min_chars
        a, b, k = a[good], b[good], key[:len(good)][good]
        for blanks, side in ((before[a], 1), (behind[b], 2)):
            which = np.repeat(np.arange(len(a)), blanks)
            count = np.arange(len(which)) - np.repeat(np.cumsum(blanks) - blanks, blanks) + 1
            low.append(at[a][which] - (count if side == 1 else 0))
            high.append(at[b][which] + (count if side == 2 else 0))
            keys.append(_mixed(k[which], 4 * count + side))
        low.append(at[a])
        high.append(at[b])
        keys.append(k)
        if not len(at):
            break
    return np.concatenate(low), np.concatenate(high), np.concatenate(keys).view(np.int64)


def _distinct(row: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((run, row))
    row, run = row[order], run[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (run[1:] != run[:-1])][:len(row)]
    return row[new], run[new]


def _flat(batch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The lists of a column one behind another, and the row of each value."""
    column = batch.column(name)
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)


def _held_runs(lines: DataFrame, min_lines: int, min_chars: int) -> DataFrame:
    """(doc, run): the keys of each document's runs."""
    def keys(batches):
        for batch in batches:
            hashes, row = _flat(batch, "hashes")
            low, _, key = runs(hashes, _flat(batch, "chars")[0], row, min_lines, min_chars)
            rows, key = _distinct(row[low], key)
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(rows)), pa.array(key)], names=["doc", "run"])

    return lines.mapInArrow(keys, lines.select("doc").schema.add("run", T.LongType()))


def _standing(open_: DataFrame, lines: DataFrame, removed: DataFrame, min_lines: int, min_chars: int) -> DataFrame:
    """The (doc, run) of ``open_`` of which some line is not in ``removed``."""
    asked = (open_.groupBy("doc").agg(F.collect_list("run").alias("asked")).join(lines, "doc").join(removed, "doc", "left")
             .withColumn("removed", F.coalesce("removed", F.array().cast("array<int>"))))

    def keys(batches):
        for batch in batches:
            hashes, row = _flat(batch, "hashes")
            low, high, key = runs(hashes, _flat(batch, "chars")[0], row, min_lines, min_chars)
            gone, gone_row = _flat(batch, "removed")
            stays = np.ones(len(row), np.int64)
            stays[np.searchsorted(row, gone_row) + gone] = 0
            left = np.r_[0, np.cumsum(stays)]
            some = left[high + 1] > left[low]
            rows, key = _distinct(row[low[some]], key[some])
            run, run_row = _flat(batch, "asked")
            # a run that both have stands twice in a row
            rows, key = np.r_[rows, run_row], np.r_[key, run]
            order = np.lexsort((key, rows))
            rows, key = rows[order], key[order]
            both = np.flatnonzero((rows[1:] == rows[:-1]) & (key[1:] == key[:-1]))
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(rows[both])), pa.array(key[both])],
                                             names=["doc", "run"])

    return asked.mapInArrow(keys, open_.select("doc", "run").schema)


def _aligned(pairs: DataFrame, lines: DataFrame, min_lines: int, min_chars: int) -> DataFrame:
    """(doc, gone): the lines that each pair's later document loses."""
    both = (pairs.join(lines.select(F.col("doc").alias("first"), F.col("hashes").alias("a")), "first")
            .join(lines.select("doc", F.col("hashes").alias("b"), "chars"), "doc").select("doc", "a", "b", "chars"))

    def align(batches):
        for batch in batches:
            ids, out = [], []
            for i, (a, b, chars) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "b", "chars")))):
                gone = blocks_to_remove(patience(a, b), chars, min_lines, min_chars)
                if gone:
                    ids.append(i)
                    out.append(gone)
            if ids:
                yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(ids)),
                                                  pa.array(out, pa.list_(pa.int32()))], names=["doc", "gone"])

    return both.mapInArrow(align, lines.select("doc").schema.add("gone", T.ArrayType(T.IntegerType())))


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_lines: int = MIN_BLOCK_LINES,
                  min_chars: int = MIN_BLOCK_CHARS) -> DataFrame:
    """(doc, same, removed): the positions of the lines that go, for documents that lose any; ``same`` is the hash of the
    text that they belong to."""
    trimmed = F.transform(F.split(F.col(text), "\n", -1), lambda s: F.trim(s, F.lit(BLANKS)))
    lines = (docs.where(F.col(text).isNotNull() & F.col(key).isNotNull())
             .select(F.col(key).alias("doc"), F.xxhash64(F.col(text)).alias("same"), trimmed.alias("__lines"))
             .select("doc", "same", F.transform("__lines", lambda s: F.xxhash64(s)).alias("hashes"),
                     F.transform("__lines", lambda s: F.length(s)).alias("chars")))
    lines = written(lines.groupBy("doc").agg(F.min(F.struct("same", "hashes", "chars")).alias("l")).select("doc", "l.*"), "line-hashes")
    held = _held_runs(lines, min_lines, min_chars)
    several = held.groupBy("run").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1")
    holders = written(held.join(several.select("run", "first"), "run"), "line-holders")
    open_, asked = holders.where("doc > first").select("doc", "run", "first"), None
    pairs, gone, share = open_.select("doc", "first").distinct(), None, 1
    while True:
        pairs = written(pairs, "line-pairs")
        found = written(_aligned(pairs, lines, min_lines, min_chars), "line-gone")
        gone = found if gone is None else gone.unionByName(found)
        removed = gone.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("removed"))
        tried = open_.groupBy("run").agg(F.max("first").alias("upto"))
        asked = pairs if asked is None else asked.unionByName(pairs)
        left = written(_standing(open_.select("doc", "run").distinct(), lines, removed, min_lines, min_chars), "line-open")
        share *= MORE_HOLDERS
        nth = Window.partitionBy("run").orderBy("first")
        further = (holders.select("run", F.col("doc").alias("first")).join(left.select("run").distinct(), "run", "left_semi")
                   .join(tried, "run").where("first > upto").select("run", "first")
                   .withColumn("n", F.row_number().over(nth)).where(F.col("n") <= share).drop("n"))
        open_ = written(left.join(further, "run").where("doc > first").select("doc", "run", "first"), "line-further")
        if open_.isEmpty():
            return removed.join(lines.select("doc", "same"), "doc")
        pairs = open_.select("doc", "first").distinct().join(asked, ["doc", "first"], "left_anti")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", measures: bool = False,
                **limits) -> DataFrame:
    """``docs`` with the aligned common blocks gone from ``text``; ``measures`` adds n_lines and n_removed."""
    gone = written(removed_lines(docs, key, text, **limits), "line-removed")
    rows = docs.select(F.struct(*docs.columns).alias("row")).withColumn("id", F.col("row")[key]).withColumn(
        "text", F.col("row")[text]).withColumn("hash", F.xxhash64("text"))
    # texts move once, whatever the number of documents that lose lines: one plan at all sizes
    both = rows.join(gone.hint("merge"), (F.col("id") == F.col("doc")) & (F.col("hash") == F.col("same")), "left")
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "removed")
    left = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(
        F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    out = both.select("row", left.alias("left"), F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("lines"),
                      F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("gone"))
    own = [F.col("left").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns
           if not (measures and c in ("n_lines", "n_removed"))]
    return out.select(*own, *([F.col("lines").alias("n_lines"), F.col("gone").alias("n_removed")] if measures else []))


def op10_line_alignment(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs, measures=True).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
