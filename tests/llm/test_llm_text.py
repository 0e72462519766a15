"""The text operators against plain versions, with nulls, blanks, ties, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from forumlens.llm import bpe, fmindex, langid, linedup, mixing, parity, quality, suffix

ROWS = brute.corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return brute.frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.SCHEMA)


def rows_of(df, *columns) -> Counter:
    return Counter(tuple(r) for r in df.select(*columns).collect())


def expected(by_id: dict) -> Counter:
    return Counter((i, *by_id[i]) for i, _ in ROWS)


def test_suffix_dedup(docs, empty):
    got = suffix.remove_repeats(docs).withColumn("sha", F.sha2("kept", 256))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "sha")
    assert rows_of(got.where("doc_id IS NOT NULL"), *columns) == expected(brute.repeats(
        [*ROWS, (None, "a text without id " * 30), (None, "another one")]))
    # documents without id keep apart: one repeats itself, the other does not
    long = ("a text without id " * 30).encode()
    assert rows_of(got.where("doc_id IS NULL"), "n_bytes", "n_removed", "n_spans") == Counter(
        {(len(long), len(long), 1): 1, (11, 0, 0): 1})
    assert suffix.remove_repeats(empty).count() == 0


def test_suffix_dedup_without_texts(spark):
    for rows in ([(1, None)], [(1, ""), (2, "")], [(1, "b" * 199), (2, "b" * 199)]):
        got = suffix.remove_repeats(brute.frame(spark, rows, False))
        assert {r["n_removed"] for r in got.collect()} == {0}


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array(seed):
    r = np.random.default_rng(seed)
    text = r.integers(1, [3, 2, 9, 200, 4, 2][seed], 6000)
    cap = 40
    sa, lcp = suffix.suffix_array(text, cap)
    t = text.tolist()
    assert sorted(sa.tolist()) == list(range(len(t)))
    keys = [t[i:i + cap] for i in sa]
    for x, y, common in zip(keys, keys[1:], lcp[1:]):
        n = next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        assert x[:cap] <= y[:cap] and n == common


def test_substring_dedup(docs, empty):
    got = fmindex.remove_earlier(docs).withColumn("sha", F.sha2("kept", 256))
    assert rows_of(got.where("doc_id IS NOT NULL"), "doc_id", "n_words", "n_removed", "sha") == expected(brute.earlier(ROWS))
    assert rows_of(got.where("doc_id IS NULL"), "n_words", "n_removed") == Counter({(120, 0): 1, (2, 0): 1})
    assert fmindex.remove_earlier(empty).count() == 0


def test_hot_anchor_goes_window_by_window(spark, monkeypatch):
    """A passage between other text in more documents than an anchor may have contexts."""
    from forumlens.llm import dealing

    monkeypatch.setattr(dealing, "HOT_CONTEXTS", 4)
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(i, f"begin{i} {i}a {i}b {passage} end{i} {i}c {i}d") for i in range(30)]
    frame = brute.frame(spark, rows, False)
    got = fmindex.remove_earlier(frame).withColumn("sha", F.sha2("kept", 256))
    want = brute.earlier(rows)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "sha") == Counter((i, *want[i]) for i, _ in rows)
    want = brute.repeats(rows)
    got = suffix.remove_repeats(frame).withColumn("sha", F.sha2("kept", 256))
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == Counter((i, *want[i]) for i, _ in rows)


def test_hot_contexts_are_dealt_in_parts(spark, monkeypatch):
    """Of a passage in many documents only the windows at its ends are counted one by one, however long it is."""
    from forumlens.llm import dealing

    tables = {}

    def kept(df, name):
        tables[name] = written(df, name)
        return tables[name]

    written = dealing.written
    monkeypatch.setattr(dealing, "written", kept)
    monkeypatch.setattr(dealing, "HOT_CONTEXTS", 8)
    passage = " ".join(f"p{i * 7919 % 1000}" for i in range(120))
    rows = [(i, " ".join(f"{i * j % 613}b{i}" for j in range(60)) + f" {passage} " + " ".join(
        f"e{i}{i * j % 411}" for j in range(60))) for i in range(40)]
    rows += [(100 + i, "a" * (400 + i) + f"{i % 3} " + "ab" * 150 + f" {i} " * 30) for i in range(30)]
    want = brute.repeats(rows)
    got = suffix.remove_repeats(brute.frame(spark, rows, False)).withColumn("sha", F.sha2("kept", 256))
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "sha") == Counter((i, *want[i]) for i, _ in rows)
    in_parts = tables["bytes-fetched"].where("parts IS NOT NULL").select(F.explode("parts")).count()
    assert in_parts and 0 < tables["bytes-windows"].count() < 4 * in_parts
    want = brute.earlier(rows)
    got = fmindex.remove_earlier(brute.frame(spark, rows, False)).withColumn("sha", F.sha2("kept", 256))
    assert rows_of(got, "doc_id", "n_words", "n_removed", "sha") == Counter((i, *want[i]) for i, _ in rows)


def test_fm_index_intervals():
    r = np.random.default_rng(3)
    text = np.r_[r.integers(1, 4, 400), 0]
    index = fmindex.FMIndex(text, 6)
    for _ in range(100):
        query = r.integers(1, 4, r.integers(1, 6))
        lo, hi = np.array([0]), np.array([len(text)])
        for symbol in query[::-1]:
            lo, hi = index.extend(lo, hi, np.array([symbol]))
        places = [a for a in range(400) if text[a:a + len(query)].tolist() == query.tolist()]
        assert sorted(index.sa[lo[0]:hi[0]].tolist() if hi[0] > lo[0] else []) == places


def test_parity_join(docs, empty):
    want = brute.near(ROWS)
    got = parity.near_duplicates(docs)
    assert rows_of(got.where("doc_id IS NOT NULL"), "doc_id", "n_shingles", "component_id") == expected(want)
    assert got.where("doc_id IS NULL").count() == 2
    assert parity.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_parity_join_near_the_threshold(spark, seed):
    """Copies with as many changed words as lie around the similarity, in sets of all bands."""
    import random

    r = random.Random(seed)
    rows = []
    for size in (6, 9, 20, 40, 70, 130, 260, 520):
        base = [f"w{r.randrange(10 ** 6)}" for _ in range(size)]
        for share in (0.0, 0.01, 0.02, 0.03, 0.04, 0.06):
            copy = [f"n{r.randrange(10 ** 6)}" if r.random() < share else w for w in base]
            if r.random() < 0.3:
                copy = copy[:int(len(copy) * r.uniform(0.7, 1))]
            rows.append((len(rows), " ".join(copy)))
    want = brute.near(rows)
    got = parity.near_duplicates(brute.frame(spark, rows, False))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == Counter((i, *want[i]) for i, _ in rows)


@pytest.mark.parametrize("seed", range(3))
def test_parity_join_in_a_large_group_of_unlike_copies(spark, seed):
    """Copies of one text around the similarity, far from its hub but some near each other."""
    import random

    r = random.Random(seed)

    def edited(words, times):
        words = list(words)
        for _ in range(times):
            words[r.randrange(len(words))] = r.choice((f"n{r.randrange(10 ** 6)}", f"c{r.randrange(12)}"))
        return words[r.choice((0, 0, 0, r.randrange(8))):]

    base = [f"w{i}" for i in range(r.choice((60, 110, 140)))]
    texts = [edited(base, r.randrange(9)) for _ in range(90)]
    texts += [edited(r.choice(texts), r.randrange(4)) for _ in range(60)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    r.shuffle(rows)
    want = brute.near(rows)
    assert 3 < len({c for _, c in want.values()}) < 140
    got = parity.near_duplicates(brute.frame(spark, rows, False))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == Counter((i, *want[i]) for i, _ in rows)


def unlike_copies(seed):
    """Copies of one text around the similarity, with ids."""
    import random

    r = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(80):
        words = list(r.choice(texts)) if texts and r.random() < 0.4 else list(base)
        for _ in range(r.randrange(8)):
            words[r.randrange(len(words))] = r.choice((f"n{r.randrange(10 ** 6)}", f"c{r.randrange(9)}"))
        texts.append(words)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_parity_join_in_a_group_beyond_one_task(spark, monkeypatch):
    monkeypatch.setattr(parity, "HUB_DOCS", 4)
    rows = unlike_copies(5)
    want = brute.near(rows)
    assert 3 < len({c for _, c in want.values()}) < 70
    got = parity.near_duplicates(brute.frame(spark, rows, False))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == Counter((i, *want[i]) for i, _ in rows)


def test_members_of_a_hub_are_linked_in_one_task(spark):
    """Links of a group that a task holds are settled there: no pair is left to compare, at most one link a member."""
    rows = unlike_copies(6)
    names: dict = {}
    sets = {i: sorted(names.setdefault(x, len(names)) for x in brute.shingles(t)) for i, t in rows}
    frame = spark.createDataFrame(list(sets.items()), "doc long, shingles array<long>")
    members = spark.createDataFrame([(0, i, i) for i in sets if i], "hub long, doc long, component long")
    links, unlike = parity._delta_pairs(members, frame)
    assert unlike.count() == 0
    links = [(r["x"], r["y"]) for r in links.collect()]
    assert len(links) < len(rows)

    def component(edges):
        top = {i: i for i in sets}
        for _ in sets:
            for a, b in edges:
                top[a] = top[b] = min(top[a], top[b])
        return top

    exact = [(a, b) for a in sets for b in sets if a < b and 100 * len(set(sets[a]) & set(sets[b])) >= 75 * len(set(sets[a]) | set(sets[b]))]
    assert component(links) == component(exact)


def test_parity_join_writes_no_texts(spark, monkeypatch):
    """Copies are told by their class; also for an id with rows in two batches and for copies of other ids."""
    tables = {}

    def kept(df, name):
        tables[name] = df.columns
        return written(df, name)

    written = parity.written
    monkeypatch.setattr(parity, "written", kept)
    rows = [(i % 20, " ".join(f"w{i % 20 % 7}x{j}" for j in range(80))) for i in range(60)] + [(None, "w0x0 " * 9)]
    want = brute.near(rows[:-1])
    got = parity.near_duplicates(brute.frame(spark, rows, False))
    assert rows_of(got.where("doc_id IS NOT NULL"), "doc_id", "n_shingles", "component_id") == Counter(
        (i, *want[i]) for i, _ in rows[:-1])
    assert tables and not any("__text" in columns for columns in tables.values())


def _mix_plan(tokens: dict, entropy_share: float, max_repeats: float) -> tuple[float, dict]:
    """Exponent and token budget per source, by plain bisection."""
    import math

    total, some = sum(tokens.values()), [t for t in tokens.values() if t]
    share = [t / total for t in some]

    def weights(a):
        z = sum(s ** a for s in share)
        return [s ** a / z for s in share]

    def least(value, target, high):
        low = 0.0
        if value(low) <= target:
            return low
        for _ in range(100):
            middle = (low + high) / 2
            low, high = (low, middle) if value(middle) <= target else (middle, high)
        return high

    flat = min(1.0, least(lambda a: -sum(w * math.log(w) for w in weights(a)), entropy_share * math.log(len(share)), 8.0))
    few = least(lambda a: max(w / s for w, s in zip(weights(a), share)), max_repeats, 1.0)
    a = max(flat, few)
    z = sum(s ** a for s in share)
    return a, {k: (t / total) ** a / z * total if t else 0.0 for k, t in tokens.items()}


@pytest.mark.parametrize("max_repeats", (1.5, 4.0))
def test_mixing_against_a_plain_version(spark, max_repeats):
    """Exponent and budgets by plain bisection; every epoch and the cut of the last one in plain order."""
    import random
    from collections import defaultdict

    r = random.Random(5)
    rows = [(i, r.choice("aaaaaaaabbbc") if i % 50 else None, " ".join(["w"] * r.choice((0, 1, 2, 5, 40)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    drawn = mixing.mix(docs, max_repeats=max_repeats).collect()
    tokens, members = defaultdict(int), defaultdict(list)
    for i, source, text in rows:
        tokens[source] += len(text.split())
        members[source].append((i, len(text.split())))
    stats = spark.createDataFrame([(s, len(members[s]), tokens[s]) for s in tokens], "source string, docs long, tokens long")
    plan = {p["source"]: p for p in mixing.plan(stats, max_repeats=max_repeats).collect()}
    exponent, budgets = _mix_plan(tokens, mixing.ENTROPY_SHARE, max_repeats)
    for s, p in plan.items():
        assert abs(p["exponent"] - exponent) < 1e-6 and abs(p["budget"] - budgets[s]) <= 1
    ids = spark.range(400).select("id", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("epoch")).select(
        "id", "epoch", F.xxhash64(F.lit(mixing.SEED + 1), "epoch", "id").alias("deal"),
        F.xxhash64(F.lit(mixing.SEED), "epoch", "id").alias("order")).collect()
    place = {(h["id"], h["epoch"]): (h["deal"], h["order"]) for h in ids}
    want = Counter()
    for s, docs_of in members.items():
        blocks = next(b for b in range(1, 400) if b * b >= len(docs_of))
        whole, rest = divmod(plan[s]["budget"], tokens[s])
        for epoch in range(whole + 1):
            order = sorted((place[i, epoch][0] % blocks, place[i, epoch][1], i, n) for i, n in docs_of)
            spent = 0
            for block, key, i, n in order:
                spent += n
                if epoch == whole and spent > rest:
                    break
                want[i, s, n, epoch, block, key] += 1
    assert Counter((d["doc_id"], d["source"], d["tokens"], d["epoch"], d["block"], d["order_key"]) for d in drawn) == want


def test_sketches_bound_the_difference():
    r = np.random.default_rng(0)
    for size in (64, 100, 500, 2000):
        a = r.integers(0, 1 << 62, size).astype(np.uint64)
        b = np.r_[a[size // 10:], r.integers(0, 1 << 62, size // 12).astype(np.uint64)]
        for lanes in (size // 2, size, 2 * size):
            x, y = (dict(zip(*map(np.ndarray.tolist, parity.sketch(np.unique(s), lanes)))) for s in (a, b))
            differing = sum(x.get(lane) != y.get(lane) for lane in {*x, *y})
            assert differing <= len(np.setxor1d(a, b))


def test_quality_measures(docs, empty):
    got = quality.judge(docs)
    names = [f"quality.{m}" for m in quality.MEASURES[:6]]
    want = Counter((i, *brute.quality_base(t)) for i, t in ROWS)
    assert rows_of(got.where("doc_id IS NOT NULL"), "doc_id", *names) == want
    assert quality.judge(empty).count() == 0
    kept = quality.clean_documents(docs, replace_text=False)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids and not ids & {i for i, t in ROWS if brute.quality_base(t)[5]}


def test_quality_lines(spark):
    r = np.random.default_rng(2)
    words = ["".join(r.choice(list("aeinorst"), 6)) for _ in range(400)]
    prose = "\n".join(" ".join(words[i:i + 12]) + "." for i in range(0, 240, 12))
    rows = [(1, prose), (2, "Home\nLogin\n" + prose), (3, "\n".join([
        "Home | About | Contact | News and more"] + [" ".join(words[i:i + 3]) for i in range(0, 300, 3)]))]
    got = {r["doc_id"]: r["quality"] for r in quality.judge(brute.frame(spark, rows, False).drop("quality")).collect()}
    assert got[1]["kept"] and got[1]["clean_text"] == prose
    assert got[2]["kept"] and got[2]["clean_text"] == prose
    assert not got[3]["kept"]


def test_language_id(spark, empty):
    import random

    r = random.Random(5)
    words = {"de": "der die das und ist nicht ein Haus weil schön wäre gehen Straße".split(),
             "en": "the a and is not house because nice would go street with this".split(),
             "fr": "le la les et est pas une maison parce que belle serait aller".split()}
    rows, lang_of = [], {}
    for i in range(240):
        lang = ["de", "en", "fr"][i % 3]
        lang_of[i] = lang
        rows.append((i, " ".join(r.choices(words[lang], k=25)), lang))
    rows += [(1000, None, "de"), (1001, "", "en"), (1002, "123 456 !!", "fr"), (None, "der die das", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn(
        "held_out", F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False)))
    trees = langid.train(langid.training_sample(docs.where("NOT held_out")))
    got = {r["doc_id"]: r for r in langid.predict(docs, trees, ("doc_id", "held_out")).collect()}
    right = [got[i]["lang_pred"] == lang_of[i] for i in range(240) if got[i]["held_out"]]
    assert len(right) > 40 and np.mean(right) > 0.95
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[None]["lang_pred"] == "de"
    assert all(0 <= x["score"] <= 1 for x in got.values())
    none = langid.train(langid.training_sample(empty))
    assert none is None and langid.predict(docs, none).select("lang_pred").distinct().collect() == [("und",)]


def test_code_lengths_sum_over_the_bytes(spark):
    """The vectorised code length equals the byte-by-byte definition."""
    import pandas as pd

    sample = pd.DataFrame({"lang": ["x"] * 3, "text": ["abracadabra", "abba abbey", "cab"]})
    trees = langid.Trees(langid._grams(sample))
    counts: dict = {}
    for text in sample["text"]:
        for k in range(langid.ORDER + 1):
            for a in range(len(text) - k):
                context = counts.setdefault(text[a:a + k], {})
                context[text[a + k]] = context.get(text[a + k], 0) + 1
    for text in ("abracab", "zebra", "a", "bbbb cadence"):
        bits = 0.0
        for i, c in enumerate(text):
            for k in range(min(i, langid.ORDER), -1, -1):
                seen = counts.get(text[i - k:i])
                if seen is None:
                    continue
                whole = sum(seen.values()) + len(seen)
                if c in seen:
                    bits -= np.log2(seen[c] / whole)
                    break
                bits -= np.log2(len(seen) / whole)
            else:
                bits += 8
        raw = np.frombuffer(text.encode(), np.uint8)
        assert trees.code_lengths(raw, np.array([0, len(raw)]))[0, 0] == pytest.approx(bits)


def test_bpe_equals_the_tokenizers_library(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    got = bpe.digests(bpe.encode(docs, path))
    want = Counter()
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
              brute.sha(library.decode(ids, skip_special_tokens=False)))] += 1
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert rows_of(got.where("doc_id IS NOT NULL"), *columns) == want
    assert bpe.encode(empty, path).count() == 0


def test_bpe_odd_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    vocabulary = bpe.Vocabulary(path)
    special = next(iter(vocabulary.special), "")
    texts = ["It's WE'LL you'd", f"a{special}b {special}", "ΣΑΣ İstanbul é ﬁ", "aaaaaaaaaa" * 30, "x\x1cy\x1dz\x85q r​s",
             "1234567890", "\U0001F468‍\U0001F469 日本語", "!!!...???", "﻿bom \x00 nul", "a" * 5000, "", "  "]
    words = vocabulary.pieces("the aaaa word wording words 日本語")
    ids = vocabulary.merge(words)
    lexicon = bpe.Transducer(bpe.Transducer.compile({w.encode(): ids.list(i) for i, w in enumerate(words)}))
    for held in (None, lexicon):
        got, decoded = bpe.Encoder(vocabulary, held).encode(texts)
        for i, t in enumerate(texts):
            want = library.encode(t, add_special_tokens=False).ids
            assert got.list(i) == want, t
            assert decoded[i] == library.decode(want, skip_special_tokens=False), t


def bpe_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    return path, library


def test_bpe_words_that_share_their_start_up_to_a_nul():
    import itertools

    path, library = bpe_library()
    vocabulary = bpe.Vocabulary(path)
    for texts in itertools.permutations(["hello\x00world", "hello there", "hello", "hello\x00\x00z"]):
        got, decoded = bpe.Encoder(vocabulary, None).encode(list(texts))
        for i, t in enumerate(texts):
            want = library.encode(t, add_special_tokens=False).ids
            assert got.list(i) == want and decoded[i] == library.decode(want, skip_special_tokens=False)


def test_bpe_all_characters():
    """Every code point between letters, between digits and alone, in one batch each."""
    path, library = bpe_library()
    encoder = bpe.Encoder(bpe.Vocabulary(path), None)
    points = [chr(c) for a, b in ((0, 0x3200), (0xA000, 0xAC00), (0xD7A0, 0xD800), (0xE000, 0xE010), (0xF900, 0x1F800), (0x2A6D0, 0x2A700),
                                  (0x2B730, 0x2B830), (0x2CE90, 0x2CEB8), (0x323A0, 0x33490), (0x3CFF0, 0x3D010), (0x10FFF0, 0x110000))
              for c in range(a, b)]
    for shape in ("a%sA", "%s", "1%s1"):
        texts = [shape % c for c in points]
        want = library.encode_batch(texts, add_special_tokens=False)
        got, _ = encoder.encode(texts, False)
        assert [t for i, t in enumerate(texts) if got.list(i) != want[i].ids] == []


def test_transducer_round_trip():
    import random

    r = random.Random(2)
    words = {"".join(r.choice("abc") for _ in range(r.randint(1, 8))).encode(): [r.randrange(9) for _ in range(r.randint(0, 4))]
             for _ in range(400)}
    machine = bpe.Transducer(bpe.Transducer.compile(words))
    asked = [*words, b"abcabcabcabc", b"", b"zzz"]
    held, ids = machine.walk(asked)
    assert held.tolist() == [w in words for w in asked]
    assert [ids.list(i) for i in range(len(words))] == list(words.values())


def ends_and_anchors(a, b):
    """What patience diff surely aligns first: the common start and end, then lines unique in both rests."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    ends = [(i, i) for i in range(head)] + [(len(a) - i, len(b) - i) for i in range(1, tail + 1)]
    return ends, [(head + i, head + y.index(v)) for i, v in enumerate(x) if x.count(v) == 1 and y.count(v) == 1]


def test_patience_alignment():
    import random

    r = random.Random(4)
    for _ in range(300):
        a = [r.randrange(r.choice([3, 8, 30])) for _ in range(r.randint(0, 25))]
        b = [r.randrange(30) if r.random() < 0.3 else x for x in a][r.randint(0, 3):] + [r.randrange(30)]
        pairs = linedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        ends, once = ends_and_anchors(a, b)
        assert set(ends) <= set(pairs)
        if once and all(p[1] < q[1] for p, q in zip(once, once[1:])):   # all fixed points in one order
            assert set(once) <= set(pairs)


def test_line_dedup(docs, empty, spark):
    block = [f"A shared line number {i} that says a good deal of the same." for i in range(5)]
    own = {i: [f"Document {i} alone has this line, which is number {j}." for j in range(4)] for i in range(1, 6)}
    rows = [(1, "\n".join(own[1] + block)), (2, "\n".join(own[2][:2] + block + own[2][2:])),
            (3, "\n".join(own[3] + block[:2])), (4, "\n".join(own[4] + ["  " + block[0], block[4]])), (5, "\n".join(own[5])),
            (6, None), (7, ""), (8, "\n".join(block)), (8, "\n".join(block))]
    got = linedup.dedup_lines(brute.frame(spark, rows, False), measures=True)
    texts = rows_of(got, "doc_id", "text", "n_removed")
    assert texts == Counter([
        (1, rows[0][1], 0), (2, "\n".join(own[2]), 5), (3, rows[2][1], 0), (4, rows[3][1], 0), (5, rows[4][1], 0),
        (6, None, 0), (7, "", 0), (8, "", 5), (8, "", 5)])
    assert linedup.dedup_lines(empty).count() == 0
    same = linedup.dedup_lines(docs)
    assert same.columns == docs.columns and same.count() == docs.count()


def line_corpus():
    import random

    rows = []
    block = [f"shared {i} of a block" for i in range(3)]
    for i, x in enumerate(block):                     # each line alone in an early document
        rows.append((i + 1, f"own {i}\n{x}\nalso own {i}"))
    rows += [(4, "\n".join(["b"] + block)), (5, "\n".join(block + ["c"]))]
    # the first holder has the same run behind a longer one, where it is passed over; the second has it alone
    long, run = [f"long {i}" for i in range(6)], [f"run {i}" for i in range(3)]
    rows += [(11, "\n".join(run + long)), (12, "\n".join(["d"] + run)), (13, "\n".join(long + ["e"] + run))]
    for seed, kinds in ((1, 6), (2, 12), (3, 30)):    # repeated lines, blanks, changed order
        r = random.Random(seed)
        names = [f"{seed} {i} " + "x" * r.choice([1, 1, 1, 120, 220]) for i in range(kinds)]
        for i in range(40):
            own = [" " if r.random() < 0.25 else r.choice(names) if r.random() < 0.9 else f"{seed} own {i} {j}"
                   for j in range(r.randint(1, 24))]
            rows.append((100 * seed + i, "\n".join(own)))
    return rows


@pytest.mark.parametrize("limits", [{}, {"min_lines": 1, "min_chars": 1}, {"min_lines": 5, "min_chars": 130}])
def test_line_dedup_against_all_pairs(spark, limits):
    """Blocks go whichever earlier document holds them, also if other documents hold their lines first."""
    rows = line_corpus()
    want = brute.line_dedup(rows, **limits)
    if not limits:
        assert want[5][0] == 3 and want[13][0] == 9
    got = linedup.dedup_lines(brute.frame(spark, rows, False), measures=True, **limits)
    assert {x["doc_id"]: (x["n_removed"], x["text"]) for x in got.collect()} == want


def test_line_dedup_of_the_small_corpus(spark):
    rows = list(dict(brute.corpus(3)).items())
    got = linedup.dedup_lines(brute.frame(spark, rows, False), measures=True)
    assert {x["doc_id"]: (x["n_removed"], x["text"]) for x in got.collect()} == brute.line_dedup(rows)


def test_mixing(docs, empty, spark):
    r = np.random.default_rng(1)
    sizes = {"a": 400, "b": 60, "c": 9, None: 3}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((i, "w " * int(r.integers(1, 9)), source))
            i += 1
    table = spark.createDataFrame([*rows, (i, None, "a"), (i + 1, "", "z")], "doc_id long, text string, source string")
    got = mixing.mix(table, max_repeats=3.0, entropy_share=0.9).toPandas()
    tokens = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in sizes}
    stats = spark.createDataFrame([(s, n, tokens[s]) for s, n in sizes.items()], "source string, docs long, tokens long")
    plan = {p["source"]: p for p in mixing.plan(stats, max_repeats=3.0, entropy_share=0.9).collect()}
    assert sum(p["weight"] for p in plan.values()) == pytest.approx(1)
    for s, p in plan.items():
        drawn = got[got["source"].isna()] if s is None else got[got["source"] == s]
        assert p["budget"] - 9 < drawn["tokens"].sum() <= p["budget"]
        assert p["budget"] <= 3.0 * tokens[s] + 1
        per_doc = drawn[drawn["tokens"] > 0]["doc_id"].value_counts()
        assert per_doc.max() - (per_doc.min() if len(per_doc) == sizes[s] else 0) <= 1
    assert mixing.mix(empty).count() == 0 and mixing.draw(empty).count() == 0
    covered = mixing.draw(table, budget="cover", max_repeats=2.0)
    assert covered.columns == table.columns and {x["doc_id"] for x in covered.collect()} >= {x[0] for x in rows}
    assert mixing.draw(docs).columns == docs.columns


def test_mixing_exponent_meets_its_targets(spark):
    stats = spark.createDataFrame([("a", 10, 1000), ("b", 10, 100), ("c", 10, 10)], "source string, docs long, tokens long")
    rows = mixing.plan(stats, entropy_share=0.8, max_repeats=None).collect()
    w = np.array([x["weight"] for x in rows])
    assert -(w * np.log(w)).sum() == pytest.approx(0.8 * np.log(3), rel=1e-4)
    rows = mixing.plan(stats, entropy_share=None, max_repeats=4.0).collect()
    assert max(x["budget"] / x["tokens"] for x in rows) == pytest.approx(4.0, rel=0.02)


def test_quality_keeps_prose_of_other_scripts(spark):
    """Lines of six words that end as their script ends sentences are prose."""
    import itertools

    def text(letters, end):
        forms = itertools.permutations(letters, 4)
        return "\n".join(" ".join("".join(next(forms)) for _ in range(6)) + end for _ in range(40))

    cases = {"latin": text("abcdefgh", "."), "devanagari": text("कखगघचछजझ", "।"), "arabic": text("ابتثجحخد", "؟"),
             "chinese": text("天地玄黄宇宙洪荒", "。"), "none": text("abcdefgh", "")}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(cases.values())], "doc_id long, text string")
    got = {x["doc_id"]: x["quality"]["kept"] for x in quality.judge(docs).collect()}
    assert list(got[i] for i in range(5)) == [True, True, True, True, False]


def test_line_dedup_of_ids_with_two_texts_and_of_clashing_columns(spark):
    import random

    r = random.Random(11)
    prose = lambda n: "\n".join(" ".join("".join(r.choice("aeinorst") for _ in range(7)) for _ in range(9)) for _ in range(n))
    shared, other = prose(5), prose(5)
    rows = [(1, shared, "k", 5, "d", "h"), (2, shared + "\ntail of it", "k", 6, "d", "h"), (2, other, "k", 7, "d", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __kept string, n_lines int, __doc string, hash string")
    got = linedup.dedup_lines(docs)
    assert got.columns == docs.columns
    kept = {x["n_lines"]: x for x in got.collect()}
    assert kept[5]["text"] == shared and kept[7]["text"] == other       # text of the same id is never mixed up
    assert kept[6]["text"] in ("tail of it", shared + "\ntail of it")   # one text stands for the id
    assert all((x["__kept"], x["__doc"], x["hash"]) == ("k", "d", "h") for x in kept.values())
    counted = {x["text"]: (x["n_lines"], x["n_removed"]) for x in linedup.dedup_lines(docs, measures=True).collect()}
    assert counted[other] == (5, 0) and counted[shared] == (5, 0)
