"""BPE encoding and decoding with a minimal acyclic transducer as the lexicon.

The words that the corpus uses most are encoded once and compiled into a minimal
acyclic transducer: words share their prefixes and suffixes, ids sit on the
arcs. Each worker maps its bytes into memory and walks it for every distinct
word of a batch; a word it does not hold is merged by the ranks, exactly.

A vocabulary file of the ``tokenizers`` library with word ends is read here: its
normaliser (NFC, white space to blanks, lower case), its splitting pattern, its
byte alphabet, its special tokens, which are found in the raw text first. As
that file names no decoder, decoding joins the tokens with a blank.

Defined results: null and empty texts give no tokens and an empty decoding.
Rows repeat as in the input; extra columns are not carried. Without any
frequent word the lexicon is empty and every word is merged.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import re
import tempfile
import unicodedata
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowtext import row_groups, utf8
from .store import written

LEXICON_WORDS = 30_000     # bound of the broadcast lexicon
LEAST_COUNT = 3
BUCKETS = 64               # of word counts, per doubling
BATCH_BYTES = 2 << 20      # encoded at a time; a longer text stands alone
# White space in the pattern's sense; str.split() takes four more characters for it.
WHITE = "\t-\r\x20\x85\xa0  -     　"
_MORE = re.compile("[\x1c-\x1f]")
_SPACES = re.compile(f"[{WHITE}]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


# Code points that the pattern engine takes for letters or digits, but the ``tokenizers``
# library, whose Unicode tables are older, does not (first and last of each range).
NO_LETTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686),
    (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x16FF4, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA),
    (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F),
    (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F))
# Capitals that the library lowers, but str.lower() does not (first, last, first small letter).
MORE_CAPITALS = (
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B),
    (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB))
_NO_LETTER = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in NO_LETTERS) + "]")
_CAPITAL = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b, _ in MORE_CAPITALS) + "]")
_SMALL = {c: small + c - a for a, b, small in MORE_CAPITALS for c in range(a, b + 1)}


def numbered(items: list[str]) -> tuple[np.ndarray, list[str]]:
    """For each item its number among the distinct ones, and these. Whole strings count, NULs too."""
    coded = pa.array(items, pa.large_string()).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


class Lists(NamedTuple):
    """Lists of integers end to end: list i is ``flat[bounds[i]:bounds[i + 1]]``."""

    flat: np.ndarray
    bounds: np.ndarray

    def take(self, index: np.ndarray) -> Lists:
        """The lists at ``index``, in that order."""
        start, size = self.bounds[index], np.diff(self.bounds)[index]
        bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        return Lists(self.flat[np.repeat(start - bounds[:-1], size) + np.arange(bounds[-1])], bounds)

    def joined(self, groups: np.ndarray) -> Lists:
        """Neighbouring lists put together: group i is lists ``groups[i]`` to ``groups[i + 1]``."""
        return Lists(self.flat, self.bounds[groups])

    def list(self, i: int) -> list[int]:
        return self.flat[self.bounds[i]:self.bounds[i + 1]].tolist()


class Vocabulary:
    """Tokens, merge ranks, pattern and special tokens of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(pattern, regex.V0)
        alphabet = byte_alphabet()
        self.byte_ids = np.array([self.ids.get(c, -1) for c in alphabet])
        self.end_ids = np.array([self.ids.get(c + self.end, -1) for c in alphabet])
        self.size, self.no_rank = max(self.ids.values()) + 1, len(merges)
        pairs = np.array([self.ids[x] * self.size + self.ids[y] for x, y in merges], np.int64)
        self.merged = np.array([self.ids[x + y] for x, y in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pair_keys, self.pair_ranks = pairs[order], order
        self.find_special = re.compile("(" + "|".join(
            re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def pieces(self, chunk: str) -> list[str]:
        """The words of a run without white space, normalised."""
        chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        if chunk.isascii():
            return self.pattern.findall(chunk)
        if _CAPITAL.search(chunk):
            chunk = chunk.translate(_SMALL)
        if not _NO_LETTER.search(chunk):
            return self.pattern.findall(chunk)
        # read as a private character, which is no letter either, and cut from the text itself
        stand_in = _NO_LETTER.sub("\ue000", chunk)
        return [chunk[m.start():m.end()] for m in self.pattern.finditer(stand_in)]

    def merge(self, pieces: list[str]) -> Lists:
        """Ids of many words at once: in each the pair of lowest rank goes, leftmost first, until none is left."""
        raw = [p.encode() for p in pieces]
        bounds = np.cumsum([0, *map(len, raw)])
        if not bounds[-1]:
            return Lists(np.zeros(0, np.int64), bounds)
        symbol = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        filled = np.diff(bounds) > 0
        last = bounds[1:][filled] - 1
        symbol[last] = self.end_ids[np.frombuffer(b"".join(raw), np.uint8)[last]]
        word = np.repeat(np.arange(len(raw)), np.diff(bounds))
        done_word, done_symbol = [], []
        while len(symbol):
            rank = np.full(len(symbol), self.no_rank)
            pair = word[1:] == word[:-1]
            rank[:-1][pair] = self._ranks(symbol[:-1][pair], symbol[1:][pair])
            first = np.flatnonzero(np.r_[True, ~pair])
            best = np.minimum.reduceat(rank, first)
            best = np.repeat(best, np.diff(np.r_[first, len(symbol)]))
            live = best < self.no_rank
            if not live.all():  # words without a pair left are done
                done_word.append(word[~live])
                done_symbol.append(symbol[~live])
                symbol, word, rank, best = symbol[live], word[live], rank[live], best[live]
                if not len(symbol):
                    break
            take = rank == best
            run = np.flatnonzero(take & np.r_[False, take[:-1]])
            for i in run:  # overlapping equal pairs, as in "aaa": the left one goes first
                take[i] &= not take[i - 1]
            at = np.flatnonzero(take)
            symbol[at] = self.merged[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, word = symbol[keep], word[keep]
        words, symbols = np.concatenate(done_word), np.concatenate(done_symbol)
        order = np.argsort(words, kind="stable")
        known = symbols[order] >= 0
        words, symbols = words[order][known], symbols[order][known]
        return Lists(symbols, np.searchsorted(words, np.arange(len(raw) + 1)))

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], self.no_rank)

    def __reduce__(self):
        raise TypeError("a vocabulary is read where it is used")


class Transducer:
    """Minimal acyclic transducer from words (bytes) to id lists.

    Built from sorted words: states that no later word can change are merged with
    an equal state, so suffixes are shared. A word's outputs are pushed towards
    the start, as far as all words through an arc agree.

    The compiled bytes are int32 arrays behind their lengths: per state the first
    arc and the final output; per arc label, target, output; the output lists.
    """

    @staticmethod
    def compile(lexicon: dict[bytes, list[int]]) -> bytes:
        outputs: dict[tuple[int, ...], int] = {}
        lists: list[tuple[int, ...]] = []
        register: dict[tuple, int] = {}
        states: list[tuple] = []

        def output(ids) -> int:
            ids = tuple(ids)
            if ids not in outputs:
                outputs[ids] = len(lists)
                lists.append(ids)
            return outputs[ids]

        def freeze(node) -> int:
            key = (node["final"], tuple(node["arcs"]))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            return register[key]

        def common(a, b):
            n = 0
            while n < len(a) and n < len(b) and a[n] == b[n]:
                n += 1
            return a[:n]

        # path[i]: the open state after i bytes; its "out" is what the arc into it carries so far
        path = [{"arcs": [], "final": None, "out": ()}]
        previous = b""
        for word in sorted(lexicon):
            shared = len(os.path.commonprefix([previous, word]))
            Transducer._close(path, previous, shared, freeze, output)
            rest = tuple(lexicon[word])
            for i in range(1, shared + 1):
                keep = common(path[i]["out"], rest)
                late = path[i]["out"][len(keep):]
                if late:  # what not all words through this arc share moves on
                    node = path[i]
                    node["arcs"] = [(label, to, output(late + lists[o])) for label, to, o in node["arcs"]]
                    if node["final"] is not None:
                        node["final"] = output(late + lists[node["final"]])
                    if i < len(path) - 1:
                        path[i + 1]["out"] = late + path[i + 1]["out"]
                path[i]["out"] = keep
                rest = rest[len(keep):]
            for i in range(shared, len(word)):
                path.append({"arcs": [], "final": None, "out": rest if i == shared else ()})
            path[-1]["final"] = output(() if len(word) > shared else rest)
            previous = word
        Transducer._close(path, previous, 0, freeze, output)
        start = freeze(path[0])

        flat = np.array([x for ids in lists for x in ids], np.int32)
        bounds = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        first = np.cumsum([0, *(len(arcs) for _, arcs in states)]).astype(np.int32)
        final = np.array([-1 if f is None else f for f, _ in states], np.int32)
        arcs = np.array([a for _, arcs in states for a in arcs], np.int32).reshape(-1, 3)
        parts = [first, final, arcs.ravel(), bounds, flat]
        return np.array([start, *map(len, parts)], np.int32).tobytes() + b"".join(p.tobytes() for p in parts)

    @staticmethod
    def _close(path, word, depth, freeze, output) -> None:
        """Freeze the states of ``word`` deeper than ``depth``."""
        while len(path) > depth + 1:
            node = path.pop()
            path[-1]["arcs"].append((word[len(path) - 1], freeze(node), output(node["out"])))

    def __init__(self, blob):
        head = np.frombuffer(blob, np.int32, 6)
        self.start = int(head[0])
        at, parts = 24, []
        for n in head[1:]:
            parts.append(np.frombuffer(blob, np.int32, int(n), at))
            at += 4 * int(n)
        self.first, self.final, arcs, self.bounds, self.flat = parts
        self.to, self.out = arcs[1::3], arcs[2::3]
        state = np.repeat(np.arange(len(self.first) - 1, dtype=np.int64), np.diff(self.first))
        self.arc_keys = state * 256 + arcs[0::3]      # rising: states in order, labels in order

    @classmethod
    def mapped(cls, blob: bytes) -> Transducer:
        """From a file of this worker that is mapped into memory."""
        path = os.path.join(tempfile.gettempdir(), f"lexicon-{hashlib.sha256(blob).hexdigest()[:16]}-{os.getpid()}")
        with open(path, "wb") as f:
            f.write(blob)
        with open(path, "rb") as f:
            view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        os.unlink(path)
        return cls(view)

    def walk(self, pieces: list[bytes]) -> tuple[np.ndarray, Lists]:
        """Which of many words the lexicon holds, and the ids of those; all words advance together."""
        size = np.array([len(p) for p in pieces], np.int64)
        start = np.cumsum(size) - size
        raw = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        state = np.full(len(pieces), self.start, np.int64)
        alive = np.ones(len(pieces), bool)
        words, outs = [], []
        for depth in range(int(size.max(initial=0))):
            at = np.flatnonzero(alive & (size > depth))
            if not len(at):
                break
            key = state[at] * 256 + raw[start[at] + depth]
            arc = np.searchsorted(self.arc_keys, key)
            arc[arc == len(self.arc_keys)] = 0
            found = self.arc_keys[arc] == key if len(self.arc_keys) else np.zeros(len(at), bool)
            alive[at[~found]] = False
            at, arc = at[found], arc[found]
            state[at] = self.to[arc]
            words.append(at)
            outs.append(self.out[arc])
        alive &= self.final[state] >= 0
        words.append(np.flatnonzero(alive))
        outs.append(self.final[state[alive]])
        words, outs = np.concatenate(words), np.concatenate(outs)
        order = np.argsort(words, kind="stable")
        order = order[alive[words[order]]]
        words, parts = words[order], Lists(self.flat, self.bounds).take(outs[order])
        held = np.flatnonzero(alive)
        return alive, parts.joined(np.searchsorted(words, np.r_[held, len(pieces)]))


class Encoder:
    """Encodes batches of texts; each distinct run of characters of a batch once."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Transducer | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.names = np.empty(max(vocabulary.tokens) + 1, object)
        self.names[list(vocabulary.tokens)] = list(vocabulary.tokens.values())

    def pieces(self, pieces: list[str]) -> Lists:
        """Ids of distinct words: from the lexicon, merged where it lacks them."""
        if not self.lexicon:
            return self.vocabulary.merge(pieces)
        held, known = self.lexicon.walk([p.encode() for p in pieces])
        merged = self.vocabulary.merge([p for p, h in zip(pieces, held) if not h])
        both = Lists(np.concatenate([known.flat, merged.flat]).astype(np.int64),
                     np.concatenate([known.bounds, known.bounds[-1] + merged.bounds[1:]]))
        place = np.empty(len(pieces), np.int64)
        place[held] = np.arange(held.sum())
        place[~held] = np.arange((~held).sum()) + held.sum()
        return both.take(place)

    def encode(self, texts: list[str | None], decode: bool = True) -> tuple[Lists, list[str] | None]:
        """Ids of each text, and its decoding."""
        chunks: list[str] = []
        size = [0]
        for text in texts:
            if text:
                chunks += self._chunks(text)
            size.append(len(chunks))
        code, distinct = numbered(chunks)
        words: list[str] = []
        per_chunk = [0]
        for chunk in distinct:
            words += self.vocabulary.pieces(chunk) if chunk[0] != " " else [chunk]
            per_chunk.append(len(words))
        word_code, words = numbered(words)
        special = {i: self.vocabulary.special[w[1:]] for i, w in enumerate(words) if w[0] == " "}
        ids = self.pieces(["" if i in special else w for i, w in enumerate(words)])
        if special:
            at = np.arange(len(words))
            more = np.array(list(special.values()), np.int64)
            ids = Lists(np.r_[ids.flat, more], np.r_[ids.bounds, ids.bounds[-1] + 1 + np.arange(len(more))])
            at[list(special)] = len(words) + np.arange(len(more))
            ids = ids.take(at)
        per_chunk_ids = ids.take(word_code).joined(np.array(per_chunk))
        decoded = None
        if decode:
            some = np.diff(per_chunk_ids.bounds) > 0
            names = self.names[per_chunk_ids.flat].tolist()
            bounds = per_chunk_ids.bounds.tolist()
            text_of = np.array([" ".join(names[a:b]) for a, b in zip(bounds, bounds[1:])] + [""], object)
            decoded = [" ".join(text_of[c[some[c]]].tolist()) for c in (
                code[a:b] for a, b in zip(size, size[1:]))]
        return per_chunk_ids.take(code).joined(np.array(size)), decoded

    def _chunks(self, text: str) -> list[str]:
        """Runs between white space; a special token is a run marked by a leading blank."""
        special = self.vocabulary.find_special
        if not special or not special.search(text):
            return runs(text)
        out: list[str] = []
        for part in special.split(text):
            out += [" " + part] if part in self.vocabulary.special else runs(part)
        return out


def runs(text: str) -> list[str]:
    """Runs of characters between white space."""
    if _MORE.search(text):
        return [x for x in _SPACES.split(text) if x]
    return text.split()


def frequent_words(docs: DataFrame, vocabulary_path: str, most: int = LEXICON_WORDS,
                   least: int = LEAST_COUNT) -> list[str]:
    """The words used most over all documents, at most ``most`` of them.

    Runs between white space are counted per batch before the shuffle; the words
    inside the frequent runs are what the lexicon holds. Counts are told apart in buckets, 64 a doubling:
    a bucket that would exceed ``most`` stays out as a whole.
    """
    def count(batches):
        for batch in batches:
            column = batch.column("text").cast(pa.large_string())
            _, offsets = utf8(column)
            for a, b in row_groups(offsets, BATCH_BYTES):
                found = pc.value_counts(pc.utf8_split_whitespace(column.slice(a, b - a)).flatten())
                yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], names=["word", "n"])

    counts = docs.select("text").mapInArrow(count, "word string, n long").where("word != ''").groupBy("word").agg(F.sum("n").alias("n"))
    counts = written(counts.where(F.col("n") >= least).withColumn("bucket", F.floor(F.log2("n") * BUCKETS).cast("int")), "bpe-words")
    # a few thousand buckets at most; the words of the highest ones, as many as fit, come to the driver
    sizes = counts.groupBy("bucket").count().orderBy(F.desc("bucket")).collect()
    total = np.cumsum([r["count"] for r in sizes])
    within = [r["bucket"] for r, n in zip(sizes, total) if n <= most]
    top = counts.where(F.col("bucket") >= within[-1]).select("word") if within else counts.where("false").select("word")
    vocabulary = Vocabulary(vocabulary_path)
    return sorted({p for r in top.collect() for p in vocabulary.pieces(r["word"])})


def encode(docs: DataFrame, vocabulary_path: str, keep: tuple[str, ...] = ("doc_id",), most: int = LEXICON_WORDS,
           decode: bool = True) -> DataFrame:
    """``keep`` columns with ``ids`` (array of int) and, with ``decode``, ``decoded``.

    ``vocabulary_path`` is read on every worker and must be there on all nodes.
    """
    words = frequent_words(docs, vocabulary_path, most)
    ids = Vocabulary(vocabulary_path).merge(words)
    lexicon = {w.encode(): ids.list(i) for i, w in enumerate(words)}
    blob = docs.sparkSession.sparkContext.broadcast(Transducer.compile(lexicon))

    def run(batches):
        encoder = Encoder(Vocabulary(vocabulary_path), Transducer.mapped(blob.value))
        for batch in batches:
            _, offsets = utf8(batch.column("__text"))
            for a, b in row_groups(offsets, BATCH_BYTES):
                part = batch.slice(a, b - a)
                ids, decoded = encoder.encode(part.column("__text").to_pylist(), decode)
                columns = [*(part.column(c) for c in keep),
                           pa.ListArray.from_arrays(pa.array(ids.bounds, pa.int32()), pa.array(ids.flat, pa.int32()))]
                if decode:
                    columns.append(pa.array(decoded, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids", "decoded"][:len(columns)])

    schema = docs.select(*keep).schema.add("ids", T.ArrayType(T.IntegerType()))
    if decode:
        schema = schema.add("decoded", "string")
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """n_tokens and SHA-256 of ids and decoding, beside the other columns."""
    keep = [c for c in encoded.columns if c not in ("ids", "decoded")]

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            flat = np.asarray(ids.flatten()).astype("<u4")
            bounds = np.cumsum([0, *np.diff(np.asarray(ids.offsets))])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(np.diff(bounds), pa.int64()),
                 pa.array([hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(bounds, bounds[1:])],
                          pa.string()), batch.column("decoded_sha256")],
                names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = encoded.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string").add(
        "decoded_sha256", "string")
    return encoded.select(*keep, "ids", F.sha2("decoded", 256).alias("decoded_sha256")).mapInArrow(run, schema)


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(encode(docs, public_tokenizers.path("word_bpe_49k.json")))
