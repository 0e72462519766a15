"""Language model scores against a plain model in dictionaries, and the coding of its trie."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from forumlens.llm import lm

SMALL = "/root/testdata/sf0.001"


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*brute.WORD.findall(lowered), None]


def plain(rows, held, most):
    """{row number: (n_tokens, n_known, N, base, score)} with exact probabilities."""
    count, follow = Counter(), {2: defaultdict(Counter), 3: defaultdict(Counter)}
    texts = [tokens(t) for _, t in rows]
    for (key, _), line in zip(rows, texts):
        if not held(key):
            count.update(line)
            padded = ["<", "<", *line]
            for i in range(2, len(padded)):
                follow[2][padded[i - 1]][padded[i]] += 1
                follow[3][padded[i - 2], padded[i - 1]][padded[i]] += 1
    n, v = sum(count.values()), len(count)
    out = []
    for line in texts:
        padded = ["<", "<", *line]
        base = total = 0.0
        for i in range(2, len(padded)):
            p = (count[padded[i]] + 1) / (n + v + 1)
            base += math.log10(p)
            for order, context in ((2, padded[i - 1]), (3, (padded[i - 2], padded[i - 1])))[:most - 1]:
                seen = follow[order].get(context)
                if seen:
                    c = sum(seen.values())
                    p = (seen[padded[i]] + len(seen) * p) / (c + len(seen))
            total += math.log10(p)
        out.append((len(line), sum(count[w] > 0 for w in line), n, base, total))
    return out


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def check(got, rows, order):
    want = defaultdict(list)
    for (key, text), w in zip(rows, plain(rows, held, order)):
        want[key].append(w)
    have = defaultdict(list)
    for x in got:
        assert x["held_out"] == held(x["doc_id"])
        have[x["doc_id"]].append(tuple(x[k] for k in ("n_tokens", "n_known", "train_tokens", "base_score", "score")))
    assert {k: len(v) for k, v in have.items()} == {k: len(v) for k, v in want.items()}
    for key in want:
        for h, w in zip(sorted(have[key]), sorted(want[key])):
            assert h[:3] == w[:3]
            assert h[3] == pytest.approx(w[3], rel=1e-12, abs=1e-12)
            assert abs(h[4] - w[4]) <= 2e-4 * w[0], (key, h, w)


def test_elias_fano():
    r = np.random.default_rng(1)
    for n, bound in ((0, 5), (1, 1), (1, 2 ** 64 - 1), (5, 7), (1000, 1000), (1000, 10 ** 12), (40000, 2 ** 64 - 1)):
        values = np.sort(r.integers(0, bound, size=n, dtype=np.uint64))           # may repeat
        head, parts = lm.EliasFano.parts(values, bound)
        coded = lm.EliasFano(head, b"".join(p.tobytes() for p in parts), 0)
        assert (coded.get(np.arange(n)) == values).all()
        asked = np.r_[values, r.integers(0, bound, size=500, dtype=np.uint64), values[:100] + np.uint64(1)]
        low, high = np.zeros(len(asked), np.int64), np.full(len(asked), n)
        assert (coded.successor(asked, low, high) == np.searchsorted(values, asked)).all()
        a, b = sorted(r.integers(0, n + 1, 2))
        inside = coded.successor(asked, np.full(len(asked), a), np.full(len(asked), b))
        assert (inside == np.clip(np.searchsorted(values, asked), a, b)).all()


def test_packing():
    r = np.random.default_rng(2)
    for n in (0, 1, 300):
        columns = [r.integers(0, top, n) for top in (1, 200, 70000, 1 << 40)]
        assert all((a == b).all() for a, b in zip(columns, lm._unpacked(lm._packed(*columns))))


def test_long_texts_are_cut_between_words():
    r = random.Random(3)
    texts = [" ".join("x" * r.randint(1, 9) for _ in range(400)), "", "y" * 500 + " z", " \n\t" * 200, "end"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) for t in texts])]
    whole, bounds = lm.token_hashes(raw, offsets)
    for chunk in (7, 64, 1000):
        cut, cut_bounds = lm.token_hashes(raw, offsets, chunk)
        assert (cut == whole).all() and (cut_bounds == bounds).all()
    assert np.diff(bounds).tolist() == [401, 1, 3, 1, 2]


@pytest.mark.parametrize("small, order", [(False, 3), (True, 3), (True, 2)])
def test_scores_against_plain(spark, monkeypatch, small, order):
    """Also with many batches, many shards and contexts that shards share."""
    if small:
        monkeypatch.setattr(lm, "SHARD_TOKENS", 900)
        monkeypatch.setattr(lm, "BATCH_BYTES", 6000)
        monkeypatch.setattr(lm, "CHUNK_BYTES", 500)
        monkeypatch.setattr(lm, "HEAVY", 2)
    rows = brute.corpus(5, 60) + [(900 + i, "the same two words " + "the same " * (i % 5) + f"W{i}x") for i in range(400)]
    table = brute.frame(spark, rows)
    from pyspark.sql import functions as F
    flag = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    table = table.withColumn("held_out", flag)
    got = lm.score(table, ~F.col("held_out"), ("doc_id", "held_out"), order)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = [(x["doc_id"], x["text"]) for x in table.select("doc_id", "text").collect()]
    check(got.collect(), rows, order)
    if small:
        model = lm.Model(lm.batches(table, ~F.col("held_out"), ("doc_id",), order), order)
        assert model.shards > 5 and len(model.heavy) >= 1 and model.totals


def test_small_example(spark):
    from pyspark.sql import functions as F
    learnt = "a b a c a b d b a c c a"
    rows = [(0, learnt), (1, "a")] + [(10 + i, f"a b {w}") for i, w in enumerate([*sorted(set(learnt.split())), "unseen"])]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("t", F.col("doc_id") < 2)
    got = {x["doc_id"]: x for x in lm.score(table, F.col("t"), order=3).collect()}
    want = plain([r if r[0] < 2 else (2, r[1]) for r in rows], lambda k: k == 2, 3)
    for r, w in zip(rows, want):
        assert got[r[0]]["score"] == pytest.approx(w[4], abs=1e-3)


def test_nothing_to_learn_from(spark):
    from pyspark.sql import functions as F
    table = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = lm.score(table, F.lit(False)).orderBy("doc_id").collect()
    assert [tuple(x) for x in got] == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert lm.score(table.where("false"), F.lit(True)).count() == 0


def test_registered_query(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(x) for x in table.collect()]
    got = lm.op12_elias_fano_trie(spark, SMALL).collect()
    check(got, rows, lm.ORDER)
    out = [x for x in got if x["held_out"]]
    assert sum(x["score"] for x in out) > sum(x["base_score"] for x in out)      # contexts help on texts it did not learn from
