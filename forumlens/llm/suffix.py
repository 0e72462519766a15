"""Exact substring dedup by external induced suffix sorting.

Texts are dealt to shards so that equal windows meet (:mod:`dealing`). A shard sorts
the suffixes of its texts by induction: the suffixes that start a rise after a fall
(S* suffixes) are ordered first, through a shorter string of the names of the parts
between them, recursively; all others follow from them in two scans. Each scan is a
priority queue keyed by (first byte, order of the inducer): a suffix taken from the
queue inserts the suffix one place to its left, as a tuple of position and common
prefix with its predecessor. Since inducers come in rising order, the queue is one
run per byte, appended at the end and read once from the start; runs beyond the
memory bound go to disk. Common prefixes are carried along: the induced one is one
more than the least common prefix between the two inducers. They are capped at the
window, the most that is asked for.

A window that starts at two places anywhere is repeated, and all bytes under
repeated windows go, judged on the input.

Defined results: null is empty text; texts shorter than the window lose nothing;
overlapping places count, also in one text; equal rows repeat each other. Rows with
a null id are told apart by their texts. Cuts may split a multi-byte character: results are bytes.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowtext import utf8
from .dealing import covered, repeated_windows

MIN_BYTES = 200
KEY_BYTES = 48
QUEUE_BYTES = 256 << 20     # of a queue in memory; what is more goes to disk
BASE = 1 << 12              # shorter strings of names are sorted directly
NAMES = 1 << 10             # and those with more names than this


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a text over a large alphabet, right to ``depth`` symbols."""
    return _doubled(text, depth)


class RunQueue:
    """One run of tuples per key, appended at the end, taken whole from the start."""

    def __init__(self, keys: int, bound: int = QUEUE_BYTES):
        self.runs: list[list] = [[] for _ in range(keys)]
        self.bound, self.held = bound, 0
        self.file = None

    def push(self, key: int, rows: np.ndarray) -> None:
        if self.held + rows.nbytes > self.bound:
            if self.file is None:
                handle, path = tempfile.mkstemp(prefix="runs-")
                os.unlink(path)          # goes with the worker, however that ends
                self.file = os.fdopen(handle, "w+b")
            self.file.seek(0, 2)
            self.runs[key].append((self.file.tell(), rows.shape))
            self.file.write(rows.tobytes())
        else:
            self.runs[key].append(rows)
            self.held += rows.nbytes

    def take(self, key: int) -> np.ndarray:
        """All tuples of a key, in the order they came; the run is then empty."""
        parts, self.runs[key] = self.runs[key], []
        out = []
        for p in parts:
            if isinstance(p, tuple):
                self.file.seek(p[0])
                p = np.frombuffer(self.file.read(int(np.prod(p[1])) * 8), np.int64).reshape(p[1])
            else:
                self.held -= p.nbytes
            out.append(p)
        return np.concatenate(out) if out else np.zeros((0, 2), np.int64)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last suffix counts as larger."""
    n = len(text)
    rising = np.zeros(n, bool)
    rising[:-1] = text[:-1] < text[1:]
    differs = np.r_[text[:-1] != text[1:], True]
    end = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]     # end of the run of equal symbols
    return rising[end]


def _run_lengths(text: np.ndarray) -> np.ndarray:
    n = len(text)
    differs = np.r_[text[:-1] != text[1:], True]
    return np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1] - np.arange(n) + 1


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of the suffixes at ``a`` and ``b``, up to ``cap``, comparing several symbols at a time."""
    bits = int(text.max() + 1).bit_length()
    per = 63 // bits
    padded = np.r_[text + 1, np.zeros(per + cap, np.int64)]      # 0: behind the end, where nothing is common
    block = np.zeros(len(padded) - per, np.int64)
    for j in range(per):
        block = block << bits | padded[j:len(block) + j]
    out = np.zeros(len(a), np.int64)
    live, at = np.arange(len(a)), 0
    while len(live) and at < cap:
        x, y = block[np.minimum(a[live] + at, len(text))], block[np.minimum(b[live] + at, len(text))]
        same = x == y
        part = np.flatnonzero(~same)
        for j in range(1, per):
            part = part[x[part] >> bits * (per - j) == y[part] >> bits * (per - j)]
            if not len(part):
                break
            out[live[part]] += 1
        out[live[same]] += per
        live = live[same]
        at += per
    # two different suffixes differ where the shorter one ends
    return np.minimum(out, cap)


class _RangeMin:
    def __init__(self, values: np.ndarray):
        self.table = [values]
        span = 1
        while span * 2 <= len(values):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-span], last[span:]))
            span *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """min(values[a:b + 1]), for arrays a <= b."""
        level = np.frexp((b - a + 1).astype(float))[1] - 1
        out = np.empty(len(a), self.table[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.table[k][a[at]], self.table[k][b[at] - (1 << int(k)) + 1])
        return out


def _doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a short or name-rich string, right to ``depth`` symbols."""
    n = len(names)
    rank = np.unique(names, return_inverse=True)[1].astype(np.int64)
    span = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:n - span] = rank[span:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
        rank = np.empty(n, np.int64)
        rank[order] = new
        span *= 2
        if span >= min(n, depth) or new[-1] == n - 1:
            return order


def _names(text: np.ndarray, rising: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each part from one S* place to the next, the number of smaller parts."""
    symbol = text.astype(np.uint64) * np.uint64(2) + rising + np.uint64(1)
    bits = int(symbol.max()).bit_length()
    per_key = 64 // bits
    n = len(text)
    length = np.r_[starts[1:], n - 1] - starts + 1
    padded = np.r_[symbol, np.zeros(per_key, np.uint64)]
    rank = np.zeros(len(starts), np.int64)
    live, done = np.arange(len(starts)), 0
    while len(live):
        key = np.zeros(len(live), np.uint64)
        for j in range(per_key):
            inside = done + j < length[live]
            at = np.minimum(starts[live] + done + j, n)
            key = (key << np.uint64(bits)) | np.where(inside, padded[at], np.uint64(0))
        order = np.lexsort((key, rank[live]))
        group, key = rank[live][order], key[order]
        new_group = np.r_[True, group[1:] != group[:-1]]
        new = new_group | np.r_[True, key[1:] != key[:-1]]
        at = np.arange(len(live))
        inside_group = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(new_group, at, 0))
        live = live[order]
        rank[live] = group + inside_group
        size = np.diff(np.r_[np.flatnonzero(new), len(live)])
        done += per_key
        live = live[np.repeat(size > 1, size) & (length[live] > done)]
    return rank


def _scan(text, rising, seeds, seed_common, runs, cap, down: bool):
    """One inducing scan. Positions by first symbol, in scan order, with common prefixes.

    Up: from S* suffixes (``seeds`` in order) to all falling ones; ``down``: from the
    falling ones (largest first) to all rising ones.
    """
    sigma = int(text.max()) + 1
    queue = RunQueue(sigma)
    since = np.full(sigma, cap, np.int64)       # least common prefix since the key's last inducer
    found: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    bounds = np.searchsorted(text[seeds] if not down else -text[seeds], [c if not down else -c for c in range(sigma)],
                             "left")
    stops = np.searchsorted(text[seeds] if not down else -text[seeds], [c if not down else -c for c in range(sigma)],
                            "right")

    def induce(batch: np.ndarray) -> None:
        """Insert the left neighbours of a batch of (position, common prefix with the one before)."""
        at, common = batch[:, 0], batch[:, 1]
        left = at - 1
        # up, a falling neighbour is induced by any taken suffix; down, a rising one
        ok = np.flatnonzero((left >= 0) & (rising[np.maximum(left, 0)] == down))
        if len(ok):
            symbol = text[left[ok]]
            order = np.argsort(symbol, kind="stable")
            ok, symbol = ok[order], symbol[order]
            first = np.r_[True, symbol[1:] != symbol[:-1]]
            least = _RangeMin(common)
            before = np.empty(len(ok), np.int64)
            inner = np.flatnonzero(~first)
            before[inner] = least(ok[inner - 1] + 1, ok[inner])
            heads = np.flatnonzero(first)
            before[heads] = np.minimum(since[symbol[heads]], least(np.zeros(len(heads), np.int64), ok[heads]))
            before = np.minimum(before + 1, cap)
            rows = np.stack([left[ok], before], 1)
            ends = np.r_[heads[1:], len(ok)]
            for a, b in zip(heads, ends):
                if not queue.runs[symbol[a]] and not found[symbol[a]]:
                    rows[a, 1] = 0           # the first of its symbol has no predecessor there
                queue.push(int(symbol[a]), rows[a:b])
            tail = ok[ends - 1] + 1
            rest = np.full(len(heads), cap, np.int64)
            more = tail < len(common)
            if more.any():
                rest[more] = least(tail[more], np.full(int(more.sum()), len(common) - 1))
            np.minimum(since, common.min(), out=since)
            since[symbol[heads]] = rest
        elif len(common):
            np.minimum(since, common.min(), out=since)

    order = range(sigma - 1, -1, -1) if down else range(sigma)
    for c in order:
        last = None
        while queue.runs[c]:
            batch = queue.take(c)
            found[c].append(batch)
            last = batch[-1, 0]
            induce(batch)
        if bounds[c] < stops[c]:
            batch = np.stack([seeds[bounds[c]:stops[c]], seed_common[bounds[c]:stops[c]]], 1)
            batch[0, 1] = 0 if last is None else min(runs[last], runs[batch[0, 0]], cap)
            induce(batch)
    queue.close()
    return [np.concatenate(f) if f else np.zeros((0, 2), np.int64) for f in found]


def suffix_array(text: np.ndarray, cap: int, prefixes: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order (right to ``cap`` symbols) and each one's common prefix with the one before, up to ``cap``.

    Without ``prefixes`` only the order counts, as in the recursion.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = text.astype(np.int64)
    rising, runs = _types(text), _run_lengths(text)
    star = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    if len(star):
        names = _names(text, rising, star)
        distinct = np.unique(names)
        if len(distinct) == len(star):
            order = np.argsort(names, kind="stable")
        elif len(star) > BASE and len(distinct) <= NAMES:
            order = suffix_array(np.searchsorted(distinct, names), cap, False)[0]
        else:
            order = _doubled(names, cap)
        seeds = star[order]
        common = np.zeros(len(seeds), np.int64)
        if prefixes:
            common[1:] = _common(text, seeds[:-1], seeds[1:], cap)
    else:
        seeds, common = star, np.zeros(0, np.int64)
    # The end of the text is smaller than all: it induces the last suffix, which falls.
    falling = _scan_up(text, rising, seeds, common, runs, cap)
    flat = np.concatenate([f[::-1] for f in falling[::-1]]) if falling else np.zeros((0, 2), np.int64)
    # Going down, the common prefix belongs to the pair with the one taken before.
    down_common = np.r_[0, flat[:-1, 1]] if len(flat) else flat[:, 1]
    rose = _scan(text, rising, flat[:, 0], down_common, runs, cap, True)
    sa, lcp = [], []
    for f, r in zip(falling, rose):
        r = r[::-1]
        r_common = np.r_[0, r[:-1, 1]] if len(r) else r[:, 1]
        if len(f) and len(r):
            r_common[0] = min(runs[f[-1, 0]], runs[r[0, 0]], cap)
        sa += [f[:, 0], r[:, 0]]
        lcp += [f[:, 1], r_common]
    return np.concatenate(sa), np.concatenate(lcp)


def _scan_up(text, rising, seeds, common, runs, cap):
    """The upward scan on the text with an end mark, which is its smallest S* suffix."""
    marked = np.r_[text + 1, 0]
    types = np.r_[rising, True]
    runs = np.r_[runs, 1]
    n = len(text)
    out = _scan(marked, types, np.r_[n, seeds], np.r_[0, common], runs, cap, False)
    return out[1:]


def repeated(symbols: np.ndarray, bounds: np.ndarray, times: np.ndarray, first: np.ndarray, window: int = MIN_BYTES):
    """Per context, runs of window starts with the number of places (2 for more) of each window.

    ``times`` counts the places of each context, ``bounds`` delimit the contexts.
    """
    n = len(bounds) - 1
    mark = np.arange(n) + bounds[1:]              # an end mark behind each context
    text = np.zeros(len(symbols) + n, np.int64)
    keep = np.ones(len(text), bool)
    keep[mark] = False
    text[keep] = symbols.astype(np.int64) + 1
    owner = np.repeat(np.arange(n), np.diff(bounds) + 1)
    left = np.repeat(mark, np.diff(bounds) + 1) - np.arange(len(text))
    sa, lcp = suffix_array(text, window)
    whole = left[sa] >= window
    new = np.r_[True, lcp[1:] < window] | ~whole
    group = np.cumsum(new) - 1
    count = np.bincount(group[whole], times[owner[sa[whole]]], group[-1] + 1 if len(group) else 0)
    value = np.zeros(len(text), np.int64)
    value[sa] = np.where(whole, np.minimum(count[group], 2), 0)
    starts, values = [], []
    for a, b in zip(np.r_[0, mark[:-1] + 1], mark):
        v = value[a:b - window + 1]
        at = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
        starts.append(at)
        values.append(v[at])
    return starts, values


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = MIN_BYTES) -> DataFrame:
    """``key``, kept (binary), n_bytes, n_removed, n_spans of every document."""
    unnamed = F.xxhash64(F.col(text)).bitwiseOR(F.lit(-1 << 63))     # a negative number
    source = docs.select(F.coalesce(F.col(key), unnamed).alias("doc"), F.col(key).alias("__key"),
                         F.col(text).alias("__text"))
    ranges = repeated_windows(
        source.select("doc", "__text"), "bytes", window, min(KEY_BYTES, window), lambda *a: repeated(*a, window=window),
        F.sum("times"), F.col("total"), lambda value, doc: value >= 2)
    schema = docs.select(F.col(key)).schema.add("kept", "binary")
    for c in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(c, "long")

    def cut(batches):
        for batch in batches:
            raw, offsets = utf8(batch.column("__text"))
            rows = []
            for i in range(batch.num_rows):
                data = raw[offsets[i]:offsets[i + 1]]
                spans = batch.column("ranges")[i].values
                if spans is None:
                    rows.append((data.tobytes(), len(data), 0, 0))
                    continue
                a, b = covered(spans, window)
                step = np.zeros(len(data) + 1, np.int32)
                np.add.at(step, a, 1)
                np.add.at(step, b, -1)
                rows.append((data[np.cumsum(step[:-1]) == 0].tobytes(), len(data), int((b - a).sum()), len(a)))
            kept, size, removed, spans = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("__key"), pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (size, removed, spans))],
                names=schema.names)

    return source.join(ranges, source["doc"] == ranges["of"], "left").select("__key", "__text", "ranges").mapInArrow(
        cut, schema)


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                       F.sha2("kept", 256).alias("kept_sha256"))
