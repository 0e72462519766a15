"""Deals the places of a corpus to shards so that equal windows meet.

A window is a run of W symbols (bytes or words) of one text. In each window the
run of k symbols with the least hash is its anchor: it depends on the window's
content only, so equal windows have equal anchors at equal distances. Neighbouring
windows mostly share their anchor, so a text of n symbols has about 2n / (W - k)
anchors. The windows of one anchor form its context: one stretch of text, and each
window belongs to one context.

* Anchors whose hash occurs once in the corpus can't hold a repeated window: counted
  before any text moves.
* Equal contexts are one context with its number of places and its smallest document.
* A context that is alone under its anchor needs no comparison.
* The other contexts' texts are fetched, once per distinct context, and go by anchor
  to the shards, where an index finds which windows occur where.
* Anchors with very many contexts (a passage in a large share of all texts, each time
  between other text) would land in one shard. Their contexts are cut, at fixed distances from
  the anchor, into parts of a few windows; what all windows of a part have in common, nearly a
  whole window, is the part's anchor, and equal parts are one. Parts go the way of contexts;
  only where very many parts still meet are windows counted one by one, before
  the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrowtext import row_groups, utf8
from .hashing import BYTE_CODES, mix, prefix_sums, span_hash, words
from .store import written

PART = (1 << 24) - (1 << 16)     # symbols of one text looked at together
CHUNK = 1 << 20            # bytes of text looked at together
SHARD_SYMBOLS = 1 << 20    # symbols indexed together, whole anchors each
HOT_CONTEXTS = 256         # more contexts under an anchor are dealt in parts, more parts window by window
PART_WINDOWS = 16          # windows of a part

INDEXED = "h long, c long, starts array<int>, values array<long>"


def symbols_of(kind: str, raw: np.ndarray, offsets: np.ndarray):
    """Symbols (uint8 or uint64), their hash codes, and row bounds in symbols."""
    if kind == "bytes":
        return raw, BYTE_CODES[raw], offsets
    hashes, _, _, bounds = words(raw, offsets)
    return hashes, hashes, bounds


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i + w]) for every i, by doubling."""
    out, have = x, 1
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(out) - (w - have)], out[w - have:]) if have < w else out


def contexts(codes: np.ndarray, bounds: np.ndarray, window: int, k: int):
    """(row, first window, windows, anchor hash, context hash) of every context of some rows."""
    n = len(codes) - window + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    sums = prefix_sums(codes)
    at = np.arange(len(codes) - k + 1)
    grams = mix(span_hash(sums, at, at + k))
    place = np.uint64((1 << 24) - 1)
    least = sliding_least((grams & ~place) | at.astype(np.uint64), window - k + 1)
    anchor = (least & place).astype(np.int64)
    row = np.searchsorted(bounds, np.arange(n), "right") - 1
    inside = np.arange(n) + window <= bounds[row + 1]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    lo = np.flatnonzero(first)
    valid = np.cumsum(inside)
    # the windows of a context are neighbours: as many as valid ones up to the next context
    size = np.diff(np.r_[valid[lo] - 1, valid[-1] if len(valid) else 0])
    whole = mix(span_hash(sums, lo, lo + size + window - 1) + mix((anchor[lo] - lo).astype(np.uint64) << np.uint64(32)
                                                                  | size.astype(np.uint64)))
    return row[lo], lo - bounds[row[lo]], size, grams[anchor[lo]], whole


def places(docs: DataFrame, kind: str, window: int, k: int) -> DataFrame:
    """(doc, start, n, h, c) of every context of ``docs`` (doc, __text)."""
    def run(batches):
        for batch in batches:
            ids = batch.column("doc")
            raw, offsets = utf8(batch.column("__text"))
            for a, b in row_groups(offsets, CHUNK):
                _, codes, bounds = symbols_of(kind, raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                # a text longer than the anchor's place field is cut into overlapping parts
                for lo in range(0, max(len(codes), 1), PART):
                    part = bounds if len(codes) <= PART else np.array([0, min(PART + window - 1, len(codes) - lo)])
                    row, start, n, h, c = contexts(codes[lo:lo + part[-1]], part, window, k)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(row + a)), pa.array(start + lo, pa.int64()), pa.array(n, pa.int32()),
                         pa.array(h.view(np.int64)), pa.array(c.view(np.int64))], names=["doc", "start", "n", "h", "c"])

    return docs.mapInArrow(run, "doc long, start long, n int, h long, c long")


def _parts(sums: np.ndarray, window: int, k: int, h: np.uint64, start: int, n: int):
    """(first window, windows, anchor hash, content hash) of the parts of the context of ``n`` windows from ``start``.

    A window's place to the left of the anchor depends on its content only, and so do its part and what
    the part's windows have in common.
    """
    width = min(PART_WINDOWS, window)
    at = np.arange(start, start + window - k + 1)
    far = int(np.argmax(mix(span_hash(sums, at, at + k)) == h))       # the anchor lies so far behind the first window
    extent = far - np.arange(n)
    part = extent // width
    first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    size = np.diff(np.r_[first, n])
    low = start + far - part[first] * width
    anchor = mix(span_hash(sums, low, low + window - width + 1) ^ mix(part[first].astype(np.uint64) + h))
    whole = mix(span_hash(sums, start + first, start + first + size + window - 1) + mix(
        extent[first].astype(np.uint64) << np.uint64(32) | size.astype(np.uint64)))
    return first, size, anchor, whole


def _fetch(docs: DataFrame, wanted: DataFrame, kind: str, window: int, k: int) -> DataFrame:
    """The symbols of the wanted contexts (doc, wants), cut from the texts; of hot ones their parts."""
    def run(batches):
        for batch in batches:
            raw, offsets = utf8(batch.column("__text"))
            wants = batch.column("wants")
            flat, ends = wants.flatten(), np.asarray(wants.offsets)
            field = {c: np.asarray(flat.field(c)) for c in ("h", "c", "start", "n", "times", "first", "hot")}
            for a, b in row_groups(offsets, CHUNK):
                symbols, codes, bounds = symbols_of(kind, raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                lo, hi = ends[a] - ends[0], ends[b] - ends[0]
                row = np.repeat(np.arange(b - a), np.diff(ends[a:b + 1]))
                begin = bounds[row] + field["start"][lo:hi]
                sums = prefix_sums(codes) if field["hot"][lo:hi].any() else None
                pieces, parts = [], []
                for i, s, n in zip(range(lo, hi), begin, field["n"][lo:hi]):
                    if field["hot"][i]:
                        cut = _parts(sums, window, k, field["h"][i:i + 1].view(np.uint64)[0], int(s), int(n))
                        parts.append([{"i": f, "ph": x, "pc": y, "piece": symbols[s + f:s + f + m + window - 1].tobytes()}
                                      for f, m, x, y in zip(*(c.tolist() for c in (*cut[:2], *(
                                          v.view(np.int64) for v in cut[2:]))))])
                        pieces.append(None)
                    else:
                        parts.append(None)
                        pieces.append(symbols[s:s + n + window - 1].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(field[x][lo:hi]) for x in ("h", "c", "times", "first")), pa.array(pieces, pa.binary()),
                     pa.array(parts, pa.list_(pa.struct([("i", pa.int32()), ("ph", pa.int64()), ("pc", pa.int64()), (
                         "piece", pa.binary())])))], names=["h", "c", "times", "first", "piece", "parts"])

    return docs.join(wanted, docs["doc"] == wanted["of"]).select("__text", "wants").mapInArrow(
        run, "h long, c long, times long, first long, piece binary, "
             "parts array<struct<i: int, ph: long, pc: long, piece: binary>>")


def _each_window(rows: DataFrame, kind: str, window: int) -> DataFrame:
    """(h, c, times, first, i, w): the hash of each window of the contexts' symbols."""
    def run(batches):
        for batch in batches:
            raw, offsets = utf8(batch.column("piece"))
            codes = BYTE_CODES[raw] if kind == "bytes" else np.frombuffer(raw.tobytes(), np.uint64)
            bounds = offsets if kind == "bytes" else offsets // 8
            size = np.diff(bounds) - window + 1
            row = np.repeat(np.arange(len(size)), size)
            i = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            at = bounds[row] + i
            w = mix(span_hash(prefix_sums(codes), at, at + window))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x).take(pa.array(row)) for x in ("h", "c", "times", "first")), pa.array(i, pa.int32()),
                 pa.array(w.view(np.int64))], names=["h", "c", "times", "first", "i", "w"])

    return rows.select("h", "c", "times", "first", "piece").mapInArrow(
        run, "h long, c long, times long, first long, i int, w long")


def _shards(rows: DataFrame, kind: str, index: Callable) -> DataFrame:
    """Run ``index`` over the contexts, whole anchors and a bounded number of symbols at a time."""
    width = 1 if kind == "bytes" else 8

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[pa.RecordBatch] = []
        size = 0

        def out(table: pa.Table):
            piece, at = utf8(table.column("piece"))
            symbols = piece if width == 1 else np.frombuffer(piece.tobytes(), np.uint64)
            starts, values = index(symbols, at // width, np.asarray(table.column("times")),
                                   np.asarray(table.column("first")))
            return pa.RecordBatch.from_arrays(
                [*(table.column(c).combine_chunks() for c in ("h", "c")), pa.array(starts, pa.list_(pa.int32())),
                 pa.array(values, pa.list_(pa.int64()))], names=["h", "c", "starts", "values"])

        for batch in batches:
            held.append(batch)
            size += batch.column("piece").nbytes // width
            if size < SHARD_SYMBOLS:
                continue
            table = pa.Table.from_batches(held)
            h = np.asarray(table.column("h"))
            cut = int(np.searchsorted(h, h[-1]))         # the last anchor may go on
            if cut:
                ends = np.r_[np.flatnonzero(h[1:cut] != h[:cut - 1]) + 1, cut]
                yield from _cuts(table.slice(0, cut), ends, width, out)
                held = table.slice(cut).to_batches()
                size = sum(b.column("piece").nbytes for b in held) // width
        if held:
            table = pa.Table.from_batches(held)
            h = np.asarray(table.column("h"))
            if len(h):
                yield from _cuts(table, np.r_[np.flatnonzero(h[1:] != h[:-1]) + 1, len(h)], width, out)

    return rows.repartition("h").sortWithinPartitions("h").mapInArrow(run, INDEXED)


def _cuts(table: pa.Table, ends: np.ndarray, width: int, out: Callable):
    """``out`` of slices that end where an anchor ends, about SHARD_SYMBOLS each."""
    size = np.cumsum(np.r_[0, np.asarray(pc.binary_length(table.column("piece"))).astype(np.int64) // width])
    a = 0
    for i, b in enumerate(ends):
        if i == len(ends) - 1 or size[ends[i + 1]] - size[a] > SHARD_SYMBOLS:
            yield out(table.slice(a, b - a))
            a = b


def repeated_windows(docs: DataFrame, kind: str, window: int, k: int, index: Callable, gather: Callable,
                     alone: Column, hit: Callable) -> DataFrame:
    """(of, ranges): per document the ranges [a, b) of window starts that are hits.

    ``docs`` has doc (not null) and __text. ``index(symbols, bounds, times, first)`` gives, per context,
    starts and values of runs of windows; ``gather`` is the same as an aggregate over
    the columns times and first, and ``alone`` for a whole anchor (columns total, first).
    ``hit(value, doc)`` decides.
    """
    all_places = written(places(docs, kind, window, k), f"{kind}-places")
    anchors = all_places.groupBy("h").agg(F.count("*").alias("total"), F.min("c").alias("c0"), F.max("c").alias("c1"),
                                          F.min("doc").alias("first")).where("total > 1")
    shared = written(all_places.join(anchors.select("h", (F.col("c0") != F.col("c1")).alias("contested"),
                                                    alone.alias("value")), "h"), f"{kind}-shared")
    contested = shared.where("contested")
    distinct = contested.groupBy("h", "c").agg(F.count("*").alias("times"), F.min("doc").alias("first"), F.min(
        F.struct("doc", "start", "n")).alias("at"))
    distinct = written(distinct, f"{kind}-contexts")
    sizes = distinct.groupBy("h").agg((F.count("*") > HOT_CONTEXTS).alias("hot"))
    wanted = distinct.join(sizes, "h").groupBy(F.col("at.doc").alias("of")).agg(F.collect_list(F.struct(
        "h", "c", "at.start", "at.n", "times", "first", "hot")).alias("wants"))
    fetched = written(_fetch(docs, wanted, kind, window, k), f"{kind}-fetched")
    indexed = _shards(fetched.where("piece IS NOT NULL").drop("parts"), kind, index)
    by_part = _hot(fetched.where("parts IS NOT NULL"), kind, window, index, gather)
    indexed = written(indexed.union(by_part), f"{kind}-indexed")
    runs = contested.join(indexed, ["h", "c"]).select("doc", "start", "n", "starts", "values").union(
        shared.where("NOT contested").select("doc", "start", "n", F.array(F.lit(0)), F.array("value")))
    last = F.size("starts") - 1
    ranges = F.filter(F.transform(F.sequence(F.lit(0), last), lambda i: F.when(
        hit(F.get("values", i), F.col("doc")), F.struct(
            (F.col("start") + F.get("starts", i)).alias("a"),
            (F.col("start") + F.coalesce(F.get("starts", i + 1), F.col("n"))).alias("b")))), lambda r: r.isNotNull())
    found = runs.select("doc", ranges.alias("r")).where(F.size("r") > 0)
    return written(found.groupBy(F.col("doc").alias("of")).agg(F.flatten(F.collect_list("r")).alias("ranges")),
                   f"{kind}-ranges")


def _hot(rows: DataFrame, kind: str, window: int, index: Callable, gather: Callable) -> DataFrame:
    """(h, c, starts, values) of hot contexts, by their parts."""
    parts = rows.select("h", "c", "times", "first", F.inline("parts"))
    distinct = parts.groupBy(F.col("ph").alias("h"), F.col("pc").alias("c")).agg(
        F.sum("times").alias("times"), F.min("first").alias("first"), F.min("piece").alias("piece"))
    distinct = written(distinct, f"{kind}-parts")
    sizes = distinct.groupBy("h").agg(F.count("*").alias("size"), F.max("c").alias("c"), gather.alias("value"))
    alone = sizes.where("size = 1").select("h", "c", F.array(F.lit(0)).alias("starts"), F.array("value").alias("values"))
    met = distinct.join(sizes.where("size > 1").select("h", (F.col("size") > HOT_CONTEXTS).alias("hot")), "h")
    indexed = _shards(met.where("NOT hot").drop("hot"), kind, index)
    single = written(_each_window(met.where("hot"), kind, window), f"{kind}-windows")
    value = single.groupBy("w").agg(F.count("*").alias("places"), gather.alias("value"), F.min(F.struct("h", "c", "i")).alias("at"))
    value = written(value, f"{kind}-counted")
    # a window that one part has needs no join
    found = value.where("places = 1").select("at.h", "at.c", "at.i", "value").union(
        single.join(value.where("places > 1").select("w", "value"), "w").select("h", "c", "i", "value"))
    by_window = found.groupBy("h", "c").agg(F.array_sort(F.collect_list(F.struct("i", "value"))).alias("v")).select(
        "h", "c", F.col("v.i").alias("starts"), F.col("v.value").alias("values"))
    values = alone.union(indexed).union(by_window)
    placed = parts.select("h", "c", "i", "ph", "pc").join(
        values.select(F.col("h").alias("ph"), F.col("c").alias("pc"), "starts", "values"), ["ph", "pc"])
    runs = F.array_sort(F.collect_list(F.struct("i", F.transform("starts", lambda s: s + F.col("i")).alias("starts"), "values")))
    return placed.groupBy("h", "c").agg(runs.alias("v")).select(
        "h", "c", F.flatten("v.starts").alias("starts"), F.flatten("v.values").alias("values"))


def covered(ranges: pa.StructArray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint rising spans covered by the windows that start in ``ranges`` of one text."""
    a = np.asarray(ranges.field("a"))
    if not len(a):
        return a, a
    order = np.argsort(a, kind="stable")
    a = a[order]
    b = np.maximum.accumulate(np.asarray(ranges.field("b"))[order] + window - 1)
    first = np.r_[True, a[1:] > b[:-1]]
    return a[first], b[np.r_[np.flatnonzero(first)[1:] - 1, len(b) - 1]]
