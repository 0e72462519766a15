"""Substring dedup over words with a compressed FM-index per shard.

Texts are dealt to shards so that equal windows of words meet (:mod:`dealing`). A
shard keeps its texts as an FM-index: the Burrows-Wheeler transform over word
numbers, as a wavelet tree whose bits are packed with a count per 64. The texts are
then streamed against it from right to left: one backward step extends the match of
each text by a word, and a match that has reached the window drops its last word by
taking the wider interval of suffixes that share one word less. So every window's
match costs one step of two ranks per level, many texts at a time, and an interval as
long as the window holds all places where the window starts. The smallest document in
the interval decides.

A word goes if a window over it also starts in a document with a smaller id; windows
are judged on the input.

Defined results: null and wordless texts have no words; texts shorter than the window
lose nothing. Rows with the same id never remove from each other. Words are compared
by 64-bit hash. A document without id removes nothing and loses nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowtext import utf8
from .dealing import covered, repeated_windows
from .hashing import words
from .suffix import _RangeMin, suffix_order

MIN_WORDS = 50
KEY_WORDS = 16
NO_DOC = np.iinfo(np.int64).max


class PackedBits:
    """A bit sequence in 64-bit words with the count of ones before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words).astype(np.int32))[:-1]].astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class WaveletTree:
    """Ranks of symbols in a sequence: a level of packed bits per bit of the alphabet, zeros first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            self.levels.append(PackedBits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        lo = np.zeros(len(at), np.int64)
        for i, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = (symbol >> (self.bits - 1 - i) & 1).astype(bool)
            a, b = level.rank(lo), level.rank(at)
            lo = np.where(one, zeros + a, lo - a)
            at = np.where(one, zeros + b, at - b)
        return at - lo


class FMIndex:
    """Backward search over a text of symbols 1 and up; 0 ends each part of it."""

    def __init__(self, text: np.ndarray, window: int):
        sa = suffix_order(text, window + 1)
        self.sa, self.window = sa, window
        self.smaller = np.r_[0, np.cumsum(np.bincount(text))]
        self.tree = WaveletTree(text[sa - 1], max(1, int(text.max()).bit_length()))
        # suffixes that share one word less than a window are neighbours: the first and last of each such group
        apart = ~_share(text, sa, window - 1)
        start = np.flatnonzero(np.r_[True, apart])
        group = np.cumsum(np.r_[False, apart])
        self.wider = start[group], np.r_[start[1:], len(sa)][group]

    def extend(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the matches with one symbol more at the left."""
        both = self.tree.rank(np.r_[symbol, symbol], np.r_[lo, hi])
        base = self.smaller[symbol]
        return base + both[:len(lo)], base + both[len(lo):]

    def shorten(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of matches of window length without their last symbol."""
        return self.wider[0][lo], self.wider[1][lo]

    def match(self, text: np.ndarray, ends: np.ndarray, size: np.ndarray):
        """Stream texts from their ends: yields (text, start, lo, hi) where a match reaches the window.

        ``ends`` are positions behind each text in ``text``, ``size`` their lengths. A match
        that breaks off starts again behind the break.
        """
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.sa), np.int64)
        have = np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        for step in range(int(size.max(initial=0))):
            live = live[size[live] > step]
            full = live[have[live] == self.window]
            lo[full], hi[full] = self.shorten(lo[full])
            have[full] -= 1
            at = ends[live] - 1 - step
            lo[live], hi[live] = self.extend(lo[live], hi[live], text[at])
            have[live] += 1
            lost = live[lo[live] >= hi[live]]
            lo[lost], hi[lost], have[lost] = 0, len(self.sa), 0
            found = live[have[live] == self.window]
            if len(found):
                yield found, ends[found] - 1 - step, lo[found], hi[found]


def _share(text: np.ndarray, sa: np.ndarray, depth: int) -> np.ndarray:
    """Whether neighbours in the suffix order share ``depth`` symbols (the end marks are unequal)."""
    padded = np.r_[text, np.zeros(depth + 1, text.dtype)]
    live = np.arange(len(sa) - 1)
    for j in range(depth):
        x, y = padded[sa[live] + j], padded[sa[live + 1] + j]
        live = live[(x == y) & (x > 0)]
        if not len(live):
            break
    out = np.zeros(len(sa) - 1, bool)
    out[live] = True
    return out


def earliest(symbols: np.ndarray, bounds: np.ndarray, times: np.ndarray, first: np.ndarray, window: int = MIN_WORDS):
    """Per context, runs of window starts with the smallest document that holds each window."""
    n = len(bounds) - 1
    mark = np.arange(n) + bounds[1:]
    size = np.diff(bounds)
    text = np.zeros(len(symbols) + n, np.int64)
    keep = np.ones(len(text), bool)
    keep[mark] = False
    text[keep] = np.unique(symbols, return_inverse=True)[1] + 1
    index = FMIndex(text, window)
    owner = np.repeat(np.arange(n), size + 1)
    least = _RangeMin(first[owner[index.sa]])
    value = np.full(len(text), NO_DOC)
    for _, at, lo, hi in index.match(text, mark, size):
        value[at] = least(lo, hi - 1)
    starts, values = [], []
    for b, s in zip(mark, size):
        v = value[b - s:b - window + 1]
        at = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
        starts.append(at)
        values.append(v[at])
    return starts, values


def remove_earlier(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = MIN_WORDS) -> DataFrame:
    """``key``, kept (words joined by a blank), n_words, n_removed of every document."""
    source = docs.select(F.col(key).alias("doc"), F.col(text).alias("__text"))
    ranges = repeated_windows(
        source.where(F.col("doc").isNotNull()), "words", window, min(KEY_WORDS, window),
        lambda *a: earliest(*a, window=window), F.min("first"), F.col("first"), lambda value, doc: value < doc)
    schema = docs.select(F.col(key)).schema.add("kept", "string")
    for c in ("n_words", "n_removed"):
        schema = schema.add(c, "long")

    def cut(batches):
        for batch in batches:
            raw, offsets = utf8(batch.column("__text"))
            kept, total, removed = [], [], []
            for i in range(batch.num_rows):
                data = raw[offsets[i]:offsets[i + 1]]
                _, starts, ends, _ = words(data, np.array([0, len(data)]))
                spans = batch.column("ranges")[i].values
                gone = np.zeros(len(starts) + 1, np.int32)
                if spans is not None:
                    a, b = covered(spans, window)
                    np.add.at(gone, a, 1)
                    np.add.at(gone, b, -1)
                stay = np.cumsum(gone[:-1]) == 0
                kept.append(_join(data, starts[stay], ends[stay]))
                total.append(len(starts))
                removed.append(int(len(starts) - stay.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(total, pa.int64()), pa.array(removed, pa.int64())], names=schema.names)

    return source.join(ranges, source["doc"] == ranges["of"], "left").select("doc", "__text", "ranges").mapInArrow(
        cut, schema)


def _join(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words [start, end) with a blank between."""
    if not len(starts):
        return b""
    step = np.zeros(len(data) + 1, np.int8)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    inside = np.cumsum(step[:-1]) > 0
    inside[ends[:-1]] = True          # the first character behind a word, white space, becomes the blank
    out = data.copy()
    out[ends[:-1]] = 32
    return out[inside].tobytes()


def op4_fm_index_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_earlier(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
