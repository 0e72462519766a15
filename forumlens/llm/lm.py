"""Language model scores from sharded Elias-Fano n-gram tries.

The model has orders 1 to ``order``, two or three. An order-k probability is ``a + b * (probability of the next lower
order)`` with the Witten-Bell weights ``a = c(h w) / (c(h) + T(h))`` and ``b = T(h) / (c(h) +
T(h))``, where T(h) counts the distinct words after context h; order 1 is
``(c(w) + 1) / (N + V + 1)``. Nothing is pruned, so the model grows with the corpus.

1. Texts become batches: records of distinct word hashes and, per token, a number into
   them; written once, so a batch is the same for all later steps.
2. Each batch asks each shard for the n-grams it holds, every distinct one once and with its
   count in training texts. Shards are dealt by the hash of the context; contexts that many
   different words follow (and the empty one) are dealt by context and word, and their totals are summed first.
3. A shard adds up the counts and compiles its trie. A level is one monotone sequence: the numbers of
   a node's children, relative to the node, behind those of the node before; pointers to the first child are
   monotone too. Both are Elias-Fano coded, probabilities are quantised to steps of 1/4096 of a decimal order,
   and the whole is mapped into memory from a file. It answers all batches: pointers give a
   context's range, and within it the successor of the wanted number is found.
4. A batch puts the answers to its tokens and adds up each text in its order.

Memory: a batch holds BATCH_BYTES of text (a longer text stands alone, tokenised
CHUNK_BYTES at a time), a shard the n-grams of about SHARD_TOKENS tokens. A context is found to be heavy if
at least HEAVY words follow it in some batches, and dealt by word if these add up to a quarter of a shard.

Defined results. Null and empty texts hold the end token alone. Words are told apart by 64-bit
hashes. Repeated rows are scored, and counted, as often as they stand; a null id trains. Extra columns are not carried.
Without training texts every token has probability 1 (the formula with N = V = 0).
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowtext import row_groups, utf8
from .hashing import SPACE, mix, words
from .store import written

ORDER = 2                         # of the registered query
BATCH_BYTES = 12 << 20
CHUNK_BYTES = 2 << 20
SHARD_TOKENS = 2 << 20
HEAVY = 16
STEPS = 4096                      # quantisation: steps a decimal order
NONE = 65535                      # code of an n-gram or context that was not seen
START, END = np.uint64(0), np.uint64(1)     # in place of word hashes
_EMPTY = np.uint64(0x5851F42D4C957F2D)      # the empty context
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_SELECT = np.zeros((256, 8), np.uint8)
for _i in range(256):
    for _k, _bit in enumerate(b for b in range(8) if _i >> b & 1):
        _SELECT[_i, _k] = _bit


# ------------------------------------------------------------------ Elias-Fano
class EliasFano:
    """A rising sequence of n integers below a bound, about 2 + log2(bound / n) bits each.

    The low bits stand packed; the high bits in unary: element i with high part h sets bit h + i.
    """

    def __init__(self, head: np.ndarray, buffer, at: int):
        self.n, self.low_bits, n_low, n_high = (int(x) for x in head)
        self.low = np.frombuffer(buffer, np.uint8, n_low, at)
        self.high = np.frombuffer(buffer, np.uint64, n_high, at + n_low)
        self.ones = np.frombuffer(buffer, np.uint32, n_high + 1, at + n_low + 8 * n_high)   # set bits before each word
        self.zeros = np.arange(n_high + 1, dtype=np.int64) * 64 - self.ones

    @staticmethod
    def parts(values: np.ndarray, bound: int) -> tuple[np.ndarray, list[np.ndarray]]:
        values = np.asarray(values, np.uint64)
        n = len(values)
        bits = min(56, max(0, (bound // max(1, n)).bit_length() - 1))
        low = np.zeros(0, np.uint8)
        if bits and n:
            low = np.concatenate([
                np.packbits((values[a:a + (1 << 16), None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8).ravel(),
                            bitorder="little") for a in range(0, n, 1 << 16)])
        low = np.r_[low, np.zeros(8 + -len(low) % 8, np.uint8)]          # room to load eight bytes anywhere
        size = n + (bound >> bits) + 2
        high = np.zeros((size + 63) // 64 * 64, np.uint8)
        high[(values >> np.uint64(bits)).astype(np.int64) + np.arange(n)] = 1
        words_ = np.packbits(high, bitorder="little").view(np.uint64)
        ones = np.r_[0, np.cumsum(high.reshape(-1, 64).sum(1, dtype=np.int64))].astype(np.uint32)
        ones = np.r_[ones, np.zeros(len(ones) % 2, np.uint32)]           # eight-byte alignment of what follows
        return np.array([n, bits, len(low), len(words_)], np.int64), [low, words_, ones]

    @staticmethod
    def _in_word(words_: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Place of the k-th set bit of each word."""
        bytes_ = words_.view(np.uint8).reshape(-1, 8)
        upto = np.cumsum(_POP[bytes_], 1, dtype=np.uint8)
        byte = (upto <= k[:, None]).sum(1)
        row = np.arange(len(k))
        before = np.where(byte > 0, upto[row, byte - 1], 0)
        return byte * 8 + _SELECT[bytes_[row, byte], k - before]

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        load = np.ascontiguousarray(self.low[(bit >> 3)[:, None] + np.arange(8)]).view(np.uint64).ravel()
        return load >> (bit & 7).astype(np.uint64) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The elements at the places ``i``."""
        if not len(i):
            return np.zeros(0, np.uint64)
        word = np.searchsorted(self.ones[:len(self.high) + 1], i, "right") - 1
        place = word * 64 + self._in_word(self.high[word], i - self.ones[word])
        return (place - i).astype(np.uint64) << np.uint64(self.low_bits) | self._lows(i)

    def _below(self, h: np.ndarray) -> np.ndarray:
        """How many elements have a high part below h."""
        out = np.zeros(len(h), np.int64)
        some = np.flatnonzero(h > 0)
        if len(some):
            k = h[some] - 1
            word = np.searchsorted(self.zeros, k, "right") - 1
            out[some] = word * 64 + self._in_word(~self.high[word], k - self.zeros[word]) - k
        return out

    def successor(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Per query the first place in [low, high) with an element of at least x (``high``: none)."""
        h = (x >> np.uint64(self.low_bits)).astype(np.int64)
        a = np.clip(self._below(h), low, high)
        b = np.clip(self._below(h + 1), low, high)
        rest = x & np.uint64((1 << self.low_bits) - 1)
        live = np.flatnonzero(a < b)
        while len(live):
            middle = (a[live] + b[live]) >> 1
            less = self._lows(middle) < rest[live]
            a[live[less]] = middle[less] + 1
            b[live[~less]] = middle[~less]
            live = live[a[live] < b[live]]
        return a

    def find(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of x in [low, high), -1 if it is not there."""
        at = self.successor(x, low, high)
        out = np.full(len(x), -1, np.int64)
        there = np.flatnonzero(at < high)
        there = there[self.get(at[there]) == x[there]]
        out[there] = at[there]
        return out


def quantised(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.minimum(np.rint(-STEPS * np.log10(p)), NONE - 1).astype(np.uint16)


_VALUE = np.append(10.0 ** (-np.arange(NONE) / STEPS), 0.0)


# ------------------------------------------------------------------ the trie of a shard
def _groups(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of runs of equal neighbours."""
    start = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return start, np.diff(np.r_[start, len(codes)])


class Trie:
    """Levels of words, word pairs and word triples with their weights, over mapped bytes."""

    @staticmethod
    def compile(vocabulary: np.ndarray, one, two, three, totals: dict[int, tuple[int, int]]) -> bytes:
        """``vocabulary`` rises; ``one``, ``two`` and ``three`` are distinct n-grams, rising: columns of
        word numbers, then counts (0: asked for, not seen). ``totals``: context hash to (c, T) of contexts
        that several shards share."""
        m = max(1, len(vocabulary))
        context2, c2, b2 = Trie._contexts(two[0], two[2], vocabulary[two[0]], totals, lambda h: context_hash(h))
        pair = three[0] * m + three[1]
        context3, c3, b3 = Trie._contexts(pair, three[3], None, totals,
                                          lambda at: context_hash(vocabulary[at // m], vocabulary[at % m]))
        seen1, seen2, seen3 = one[1] > 0, two[2] > 0, three[3] > 0
        # level 1: words that start any n-gram here
        first = np.unique(np.concatenate([one[0][seen1], context2, context3 // m]))
        count = np.zeros(len(first), np.int64)
        count[np.searchsorted(first, one[0][seen1])] = one[1][seen1]
        weight1 = np.full(len(first), NONE, np.uint16)
        weight1[np.searchsorted(first, context2)] = b2
        # level 2: pairs that were seen, and contexts of triples
        seen_pair = two[0][seen2] * m + two[1][seen2]
        second = np.unique(np.concatenate([seen_pair, context3]))
        parent2 = np.searchsorted(first, second // m)
        share2 = np.full(len(second), NONE, np.uint16)
        share2[np.searchsorted(second, seen_pair)] = quantised(two[2][seen2] / c2[seen2])
        weight2 = np.full(len(second), NONE, np.uint16)
        weight2[np.searchsorted(second, context3)] = b3
        # level 3: triples that were seen
        parent3 = np.searchsorted(second, pair[seen3])
        share3 = quantised(three[3][seen3] / c3[seen3])
        sequences = [
            (vocabulary, (1 << 64) - 1), (first, m),
            (parent2 * m + second % m, len(first) * m), (np.searchsorted(parent2, np.arange(len(first) + 1)), len(second) + 1),
            (parent3 * m + three[2][seen3], len(second) * m), (np.searchsorted(parent3, np.arange(len(second) + 1)), len(parent3) + 1)]
        heads, body = [], []
        for values, bound in sequences:
            head, parts = EliasFano.parts(values, bound)
            heads.append(head)
            body += parts
        body += [count] + [np.r_[x, np.zeros(-len(x) % 4, np.uint16)] for x in (weight1, share2, weight2, share3)]
        heads.append(np.array([len(first), len(second), len(parent3), 0], np.int64))
        return np.concatenate(heads).tobytes() + b"".join(x.tobytes() for x in body)

    @staticmethod
    def _contexts(code, count, hashes, totals, hash_of):
        """Contexts that were seen, c + T per n-gram, and the contexts' weights as codes."""
        start, size = _groups(code)
        context = code[start]
        seen = np.add.reduceat(count, start) if len(start) else np.zeros(0, np.int64)
        types = np.add.reduceat((count > 0).astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
        if totals and len(start):
            key = hash_of(hashes[start] if hashes is not None else context)
            keys = np.sort(np.fromiter(totals, np.uint64, len(totals)))
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            for i in np.flatnonzero(keys[at] == key):
                seen[i], types[i] = totals[int(key[i])]
        both = seen + types
        known = types > 0
        weight = quantised(types[known] / both[known])
        return context[known], np.repeat(both, size), weight

    def __init__(self, buffer):
        heads = np.frombuffer(buffer, np.int64, 28).reshape(7, 4)
        at, sequences = 28 * 8, []
        for head in heads[:6]:
            s = EliasFano(head, buffer, at)
            at += len(s.low) + 8 * len(s.high) + 4 * (len(s.ones) + len(s.ones) % 2)
            sequences.append(s)
        self.vocabulary, self.first, self.second, self.to_second, self.third, self.to_third = sequences
        n1, n2, n3 = (int(x) for x in heads[6][:3])
        self.count = np.frombuffer(buffer, np.int64, n1, at)
        at += 8 * n1
        tables = []
        for n in (n1, n2, n2, n3):
            tables.append(np.frombuffer(buffer, np.uint16, n, at))
            at += 2 * (n + -n % 4)
        self.weight1, self.share2, self.weight2, self.share3 = tables
        self.m = max(1, self.vocabulary.n)

    @classmethod
    def mapped(cls, blob: bytes) -> Trie:
        """From a file of this worker that is mapped into memory; only the map keeps it."""
        path = os.path.join(tempfile.gettempdir(), f"trie-{uuid.uuid4().hex}")
        with open(path, "wb") as f:
            f.write(blob)
        with open(path, "rb") as f:
            view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        os.unlink(path)
        return cls(view)

    def words(self, hashes: np.ndarray) -> np.ndarray:
        return self.vocabulary.find(hashes, np.zeros(len(hashes), np.int64), np.full(len(hashes), self.vocabulary.n))

    def _start(self, word: np.ndarray) -> np.ndarray:
        return self.first.find(word.astype(np.uint64), np.zeros(len(word), np.int64), np.full(len(word), self.first.n))

    def _child(self, level: EliasFano, pointers: EliasFano, node: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = np.full(len(node), -1, np.int64)
        some = np.flatnonzero(node >= 0)
        at = node[some]
        low, high = pointers.get(at).astype(np.int64), pointers.get(at + 1).astype(np.int64)
        out[some] = level.find((at * self.m + word[some]).astype(np.uint64), low, high)
        return out

    @staticmethod
    def _code(table: np.ndarray, at: np.ndarray, none: int = NONE) -> np.ndarray:
        return np.where(at >= 0, table[np.maximum(at, 0)], none) if len(table) else np.full(len(at), none, table.dtype)

    def counts(self, word: np.ndarray) -> np.ndarray:
        return (self._code(self.count, self._start(word), 0),)

    def pairs(self, context: np.ndarray, word: np.ndarray):
        """Codes of a and b of word pairs."""
        node = self._start(context)
        return self._code(self.share2, self._child(self.second, self.to_second, node, word)), self._code(self.weight1, node)

    def triples(self, before: np.ndarray, context: np.ndarray, word: np.ndarray):
        node = self._child(self.second, self.to_second, self._start(before), context)
        return self._code(self.share3, self._child(self.third, self.to_third, node, word)), self._code(self.weight2, node)


def context_hash(*hashes: np.ndarray) -> np.ndarray:
    """Hash of a context of one or two words."""
    out = np.full(len(hashes[0]), len(hashes), np.uint64)
    for h in hashes:
        out = mix(out ^ h)
    return out


# ------------------------------------------------------------------ batches
def token_hashes(raw: np.ndarray, offsets: np.ndarray, chunk: int = CHUNK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of each text with the end behind it, and bounds per text."""
    hashes, size = [], np.zeros(len(offsets) - 1, np.int64)
    for a, b in row_groups(offsets, chunk):
        at, upto = int(offsets[a]), int(offsets[b])
        if upto - at <= chunk or b - a > 1:
            h, _, _, bounds = words(raw[at:upto], offsets[a:b + 1] - at, lower=True)
            size[a:b] = np.diff(bounds)
            hashes.append(np.insert(h, bounds[1:], END))
            continue
        while at < upto:            # one long text: cut where words end
            to = min(at + chunk, upto)
            while to < upto and not SPACE[raw[to]]:
                blank = np.flatnonzero(SPACE[raw[to:to + chunk]])
                to = to + int(blank[0]) if len(blank) else min(to + chunk, upto)
            h = words(raw[at:to], np.array([0, to - at]), lower=True)[0]
            hashes.append(h)
            size[a] += len(h)
            at = to
        hashes.append(np.array([END]))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.r_[0, np.cumsum(size + 1)]


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of small non-negative integers, byte plane by byte plane, compressed."""
    out = [np.array([len(columns), len(columns[0])], np.int64).tobytes()]
    for c in columns:
        planes = np.ascontiguousarray(c, "<i8").view(np.uint8).reshape(-1, 8)
        used = int(planes.any(0).nonzero()[0].max(initial=-1)) + 1
        out += [bytes([used]), planes[:, :used].T.tobytes()]
    data = b"".join(out)
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    data = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True)
    n_columns, n = np.frombuffer(data, np.int64, 2)
    at, out = 16, []
    for _ in range(n_columns):
        used = data[at]
        full = np.zeros((n, 8), np.uint8)
        full[:, :used] = np.frombuffer(data, np.uint8, n * used, at + 1).reshape(used, n).T
        out.append(full.view("<i8").ravel())
        at += 1 + n * used
    return out


def _packed_hashes(rising: np.ndarray) -> bytes:
    """Rising 64-bit hashes as gaps."""
    return _packed(np.diff(rising, prepend=np.uint64(0)).view(np.int64))


def _unpacked_hashes(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(blob)[0].view(np.uint64), dtype=np.uint64)


class Batch:
    """The n-grams of a batch: distinct ones of each order, where the tokens have them, their shards."""

    def __init__(self, vocabulary: np.ndarray, token: np.ndarray, bounds: np.ndarray, order: int):
        """``vocabulary`` starts with START and END; ``token`` numbers it; ``bounds`` per text."""
        self.vocabulary, self.token = vocabulary, token
        m, n = len(vocabulary), len(token)
        first = np.zeros(n + 1, bool)
        first[bounds] = True
        before1, before2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
        before1[1:] = np.where(first[1:n], 0, token[:-1])
        before2[1:] = np.where(first[1:n], 0, before1[:-1])
        pairs, at2 = np.unique(before1 * m + token, return_inverse=True)
        self.grams = [(np.arange(m, dtype=np.int64),), (pairs // m, pairs % m)]     # distinct n-grams, column by column
        self.at = [token, at2]                                                      # the n-gram at each token
        if order == 3:
            contexts, at_context = np.unique(before2 * m + before1, return_inverse=True)
            triples, at3 = np.unique(at_context * m + token, return_inverse=True)
            self.grams.append((contexts[triples // m] // m, contexts[triples // m] % m, triples % m))
            self.at.append(at3)

    def counts(self, train: np.ndarray) -> list[np.ndarray]:
        """How often each distinct n-gram stands where ``train`` holds (per token)."""
        return [np.bincount(at[train], minlength=len(which[0])) for at, which in zip(self.at, self.grams)]

    def heavy(self, least: int = HEAVY) -> tuple[np.ndarray, np.ndarray]:
        """Contexts that at least ``least`` words follow here, and how many."""
        keys, n = np.unique(np.concatenate([context_hash(*(self.vocabulary[c] for c in g[:-1])) for g in self.grams[1:]]),
                            return_counts=True)
        return keys[n >= least], n[n >= least]

    def shards(self, shards: int, heavy: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For pairs and triples: the shard of each distinct one, and whether shards share its context."""
        out = []
        for columns in self.grams[1:]:
            context = context_hash(*(self.vocabulary[c] for c in columns[:-1]))
            shared = np.zeros(len(context), bool)
            if len(heavy):
                at = np.minimum(np.searchsorted(heavy, context), len(heavy) - 1)
                shared = heavy[at] == context
            key = np.where(shared, mix(context + self.vocabulary[columns[-1]]), mix(context))
            out.append(((key % np.uint64(shards)).astype(np.int64), shared))
        return out

    @classmethod
    def read(cls, row: dict, order: int) -> tuple[Batch, np.ndarray, np.ndarray]:
        """The batch of a written record, its text bounds and its training tokens."""
        token, = _unpacked(row["tokens"])
        size = np.array(row["lengths"], np.int64)
        bounds = np.r_[0, np.cumsum(size)]
        return cls(_unpacked_hashes(row["words"]), token, bounds, order), bounds, np.repeat(np.array(row["train"], bool), size)


def batches(docs: DataFrame, train: Column, keep: tuple[str, ...], order: int = ORDER) -> DataFrame:
    """Step 1: ``batch``, the kept columns, word hashes and their training counts, tokens, text lengths and heavy
    contexts."""
    kept = T.ArrayType(docs.select(*keep).schema)
    schema = T.StructType([T.StructField("batch", T.LongType()), T.StructField("rows", kept)] + [
        T.StructField(n, t) for n, t in (("words", T.BinaryType()), ("counts", T.BinaryType()), ("tokens", T.BinaryType()), ("lengths", T.ArrayType(T.LongType())),
                                         ("train", T.ArrayType(T.BooleanType())), ("n_tokens", T.LongType()),
                                         ("heavy", T.ArrayType(T.LongType())), ("followers", T.ArrayType(T.LongType())))])

    def run(parts):
        number = TaskContext.get().partitionId() << 32
        for part in parts:
            raw, offsets = utf8(part.column("__text"))
            for a, b in row_groups(offsets, BATCH_BYTES):
                hashes, bounds = token_hashes(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], CHUNK_BYTES)
                distinct, token = np.unique(np.r_[START, END, hashes], return_inverse=True)
                token = token[2:]
                keys, followers = Batch(distinct, token, bounds, order).heavy(HEAVY)
                rows = part.slice(a, b - a)
                train = np.repeat(np.asarray(rows.column("__train").to_numpy(zero_copy_only=False), bool), np.diff(bounds))
                count = np.bincount(token[train], minlength=len(distinct))
                one = pa.array([0, b - a], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()),
                     pa.ListArray.from_arrays(one, pa.StructArray.from_arrays([rows.column(c) for c in keep], list(keep))),
                     *(pa.array([x], pa.binary()) for x in (_packed_hashes(distinct), _packed(count), _packed(token))),
                     pa.array([np.diff(bounds).tolist()], pa.list_(pa.int64())), pa.ListArray.from_arrays(one, rows.column("__train")),
                     pa.array([len(token)], pa.int64()), pa.array([keys.view(np.int64).tolist()], pa.list_(pa.int64())),
                     pa.array([followers.tolist()], pa.list_(pa.int64()))], names=schema.names)
                number += 1

    source = docs.select(*keep, F.col("text").alias("__text"), F.coalesce(train, F.lit(True)).alias("__train"))
    return written(source.mapInArrow(run, schema), "lm-batches")


# ------------------------------------------------------------------ shards
def _request(batch: int, vocabulary: np.ndarray, found: list, shards: int):
    """Rows (batch, shard, words, grams): per order the numbers of an n-gram's words among ``words``, and the counts.
    ``found`` has (columns, counts, shard of each) per order."""
    chosen = []
    for columns, count, shard in found:
        at = np.argsort(shard, kind="stable")
        chosen.append(([c[at] for c in columns], count[at], np.searchsorted(shard[at], np.arange(shards + 1))))
    for s in np.unique(np.concatenate([np.flatnonzero(np.diff(at)) for _, _, at in chosen])).tolist():
        grams = [([c[at[s]:at[s + 1]] for c in columns], count[at[s]:at[s + 1]]) for columns, count, at in chosen]
        used = np.unique(np.concatenate([c for columns, _ in grams for c in columns]))
        packed = [_packed(*_gaps([np.searchsorted(used, c) for c in columns]), count) for columns, count in grams]
        yield pa.RecordBatch.from_arrays(
            [pa.array([batch], pa.int64()), pa.array([s], pa.int32()), pa.array([_packed_hashes(vocabulary[used])], pa.binary()),
             pa.array([packed], pa.list_(pa.binary()))], names=["batch", "shard", "words", "grams"])


REQUEST = "batch long, shard int, words binary, grams array<binary>"
ANSWER = "batch long, shard int, order int, replies array<binary>, n long, v long"


def _word_shard(vocabulary: np.ndarray, shards: int) -> np.ndarray:
    return (mix(_EMPTY + vocabulary) % np.uint64(shards)).astype(np.int64)


def _word_requests(table: DataFrame, shards: int) -> DataFrame:
    """Step 2 for words: the empty context is shared by all shards."""
    def run(parts):
        for part in parts:
            for row in part.to_pylist():
                vocabulary, (count,) = _unpacked_hashes(row["words"]), _unpacked(row["counts"])
                yield from _request(row["batch"], vocabulary, [((np.arange(len(vocabulary)),), count, _word_shard(vocabulary, shards))], shards)

    return table.select("batch", "words", "counts").mapInArrow(run, REQUEST)


def _requests(table: DataFrame, shards: int, heavy: np.ndarray, order: int, shared_only: bool = False) -> DataFrame:
    """Step 2 for pairs and triples; ``shared_only``: those whose context several shards share."""
    def run(parts):
        for part in parts:
            for row in part.to_pylist():
                batch, _, train = Batch.read(row, order)
                found = [(c, n, *s) for c, n, s in zip(batch.grams[1:], batch.counts(train)[1:], batch.shards(shards, heavy))]
                if shared_only:
                    found = [([x[shared] for x in c], n[shared], s[shared], shared) for c, n, s, shared in found]
                yield from _request(row["batch"], batch.vocabulary, [f[:3] for f in found], shards)

    return table.select("batch", "words", "tokens", "lengths", "train").mapInArrow(run, REQUEST)


def _gaps(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The first column, which rises, as gaps."""
    return [np.diff(columns[0], prepend=0), *columns[1:]]


class Shard:
    """The requests to one shard: distinct n-grams with summed counts, and which of them each request names."""

    def __init__(self, table: pa.Table):
        rows = table.to_pylist()
        rows.sort(key=lambda r: r["batch"])
        self.shard = rows[0]["shard"]
        self.batches = [r["batch"] for r in rows]
        held = [_unpacked_hashes(r["words"]) for r in rows]
        self.vocabulary, number = np.unique(np.concatenate(held), return_inverse=True)
        start = np.r_[0, np.cumsum([len(h) for h in held])]
        m = len(self.vocabulary)
        self.grams, self.at, self.bounds = [], [], []
        for which in range(len(rows[0]["grams"])):
            parts = [_unpacked(r["grams"][which]) for r in rows]
            n = len(parts[0]) - 1   # words of an n-gram
            self.bounds.append(np.r_[0, np.cumsum([len(p[0]) for p in parts])])
            columns = [np.concatenate([number[start[i]:start[i + 1]][np.cumsum(p[0]) if j == 0 else p[j]] for i, p in enumerate(parts)])
                       for j in range(n)]
            count = np.concatenate([p[-1] for p in parts])
            del parts
            code, at = np.unique(columns[0] if n == 1 else columns[-2] * m + columns[-1], return_inverse=True)
            if n == 3:              # pairs of the last two words, then triples: the codes stay small
                pairs = code
                code, at = np.unique(columns[0] * len(pairs) + at, return_inverse=True)
                pair = pairs[code % len(pairs)] if len(pairs) else code
                distinct = [code // max(1, len(pairs)), pair // m, pair % m]
            else:
                distinct = [code] if n == 1 else [code // m, code % m]
            self.at.append(at)
            self.grams.append([*distinct, np.bincount(at, count, len(code)).astype(np.int64)])

    def shared_totals(self):
        """(context, c, T) of this shard's part of contexts that several shards share."""
        v = self.vocabulary
        key = np.concatenate([context_hash(*(v[c] for c in g[:-2])) for g in self.grams])
        count = np.concatenate([g[-1] for g in self.grams])
        of, at = np.unique(key, return_inverse=True)
        return of, np.bincount(at, count, len(of)).astype(np.int64), np.bincount(at, count > 0, len(of)).astype(np.int64)

    def answers(self, totals: dict) -> pa.Table:
        """ANSWER rows: per request the counts of its words, or the codes of its pairs and triples."""
        n = len(self.grams[0]) - 1
        none = [np.zeros(0, np.int64)] * 4
        trie = Trie.mapped(Trie.compile(self.vocabulary, *([none[:2]] * (n - 1) + self.grams + [none] * 3)[:3], totals))
        v = trie.words(self.vocabulary)
        asks = (trie.counts, trie.pairs, trie.triples)[n - 1:]
        per_order = [[column[at] for column in ask(*(v[c] for c in g[:-1]))] for ask, g, at in zip(asks, self.grams, self.at)]
        replies = [[_packed(*(column[b[i]:b[i + 1]] for column in columns)) for columns, b in zip(per_order, self.bounds)]
                   for i in range(len(self.batches))]
        # what the shard adds to N and V, once
        own = [(int(self.grams[0][-1].sum()), int((self.grams[0][-1] > 0).sum()))] + [(0, 0)] * (len(replies) - 1)
        return pa.table({"batch": pa.array(self.batches, pa.int64()), "shard": pa.array([self.shard] * len(replies), pa.int32()),
                         "order": pa.array([n] * len(replies), pa.int32()), "replies": pa.array(replies, pa.list_(pa.binary())),
                         "n": pa.array([x for x, _ in own], pa.int64()), "v": pa.array([x for _, x in own], pa.int64())})


class Model:
    """Totals of the training tokens and how n-grams are dealt to shards."""

    def __init__(self, table: DataFrame, order: int = ORDER):
        self.table, self.order = table, order
        tokens = table.agg(F.sum("n_tokens")).first()[0] or 0
        self.shards = max(1, -(-tokens // SHARD_TOKENS))
        # at most four a shard, as their followers add up to the tokens of the shards at most
        found = (table.select(F.explode(F.arrays_zip("heavy", "followers")).alias("x")).groupBy("x.heavy").agg(
            F.sum("x.followers").alias("n")).where(F.col("n") >= SHARD_TOKENS // 4).select("heavy").collect())
        heavy = self.heavy = np.sort(np.array([r[0] for r in found], np.int64).view(np.uint64))
        self.words = written(_word_requests(table, self.shards).groupBy("shard").applyInArrow(
            lambda part: Shard(part).answers({}), ANSWER), "lm-words")
        self.n, self.v = (x or 0 for x in self.words.agg(F.sum("n"), F.sum("v")).first())
        self.totals: dict = {}
        if len(heavy):
            def add(part: pa.Table) -> pa.Table:
                of, count, types = Shard(part).shared_totals()
                return pa.table({"context": of.view(np.int64), "c": count, "t": types})

            sums = (_requests(table, self.shards, heavy, order, True).groupBy("shard").applyInArrow(add, "context long, c long, t long")
                    .groupBy("context").agg(F.sum("c").alias("c"), F.sum("t").alias("t")).collect())
            self.totals = {int(np.int64(r["context"]).view(np.uint64)): (r["c"], r["t"]) for r in sums}

    def answers(self) -> DataFrame:
        """Step 3: each shard's answers to each batch."""
        shared = self.table.sparkSession.sparkContext.broadcast(self.totals)
        requests = _requests(self.table, self.shards, self.heavy, self.order)
        return self.words.unionByName(requests.groupBy("shard").applyInArrow(lambda part: Shard(part).answers(shared.value), ANSWER))

    def scores(self, keep: T.StructType) -> DataFrame:
        """Step 4: the kept columns with n_tokens, n_known, train_tokens, base_score and score."""
        shards, heavy, n, v, order = self.shards, self.heavy, self.n, self.v, self.order
        schema = T.StructType([*keep.fields, *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")),
                               *(T.StructField(c, T.DoubleType()) for c in ("base_score", "score"))])

        def put(record: pa.Table, answers: pa.Table) -> pa.Table:
            batch, bounds, _ = Batch.read(record.select(["words", "tokens", "lengths", "train"]).to_pylist()[0], order)
            replies = sorted(answers.to_pylist(), key=lambda r: (r["order"], r["shard"]))
            found = []
            for k, shard in enumerate([_word_shard(batch.vocabulary, shards), *(s for s, _ in batch.shards(shards, heavy))]):
                at = np.argsort(shard, kind="stable")
                columns = [np.concatenate(c) for c in zip(*(_unpacked(r["replies"][max(0, k - 1)]) for r in replies
                                                            if (r["order"] == 1) == (k == 0)))]
                placed = [np.empty(len(at), np.int64) for _ in columns]
                for to, column in zip(placed, columns):
                    to[at] = column
                found.append(placed)
            count = found[0][0]
            p = (count[batch.token] + 1) / (n + v + 1)
            lower = p
            for at, (a, b) in zip(batch.at[1:], found[1:]):
                lower = _VALUE[a[at]] + np.where(b[at] == NONE, 1.0, _VALUE[b[at]]) * lower
            start = bounds[:-1]
            rows = record.column("rows").combine_chunks()
            rows = (rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows).flatten()
            return pa.Table.from_arrays(
                [*(rows.field(c) for c in keep.names), pa.array(np.diff(bounds)),
                 pa.array(np.add.reduceat((count[batch.token] > 0).astype(np.int64), start)),
                 pa.array(np.full(len(start), n, np.int64)), pa.array(np.add.reduceat(np.log10(p), start)),
                 pa.array(np.add.reduceat(np.log10(lower), start))], names=schema.names)

        records = self.table.select("batch", "rows", "words", "tokens", "lengths", "train")
        return records.groupBy("batch").cogroup(self.answers().groupBy("batch")).applyInArrow(put, schema)


def score(docs: DataFrame, train: Column, keep: tuple[str, ...] = ("doc_id",), order: int = ORDER) -> DataFrame:
    """Scores of all texts under a model of those where ``train`` holds (null: it does)."""
    return Model(batches(docs, train, keep, order), order).scores(docs.select(*keep).schema)


def op12_elias_fano_trie(spark, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").withColumn("held_out", held)
    return score(docs, ~F.col("held_out"), ("doc_id", "held_out"))
