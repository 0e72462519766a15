"""Graph search, web archives, the SQL twins and the pipeline."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from forumlens.llm import ann, graph, oracle, registry, warc

SMALL = "/root/testdata/sf0.001"


def exact(vectors: dict, queries, k: int) -> dict:
    ids = np.array(sorted(vectors))
    table = np.array([vectors[i] for i in ids], float)
    out = {}
    for q in queries:
        score = table @ np.array(vectors[q], float)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), score[j]) for j in order]
    return out


def test_graph_search_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_VECTORS", 700)
    r = np.random.default_rng(0)
    centres = r.normal(size=(12, 24))
    vectors = {i: (centres[i % 12] + 0.6 * r.normal(size=24)).astype(np.float32) * float(r.uniform(0.5, 2)) for i in range(2000)}
    for i in range(100, 160):
        vectors[i] = vectors[100]                 # equal vectors
    rows = [(i, [float(x) for x in v]) for i, v in vectors.items()]
    bad = [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (5060, [None] + [1.0] * 23),
           (5080, [float("inf")] * 24), (5100, [1.0] * 3), (5120, []), rows[40], (None, rows[41][1])]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got: dict = {}
    for x in ann.nearest(table, lambda key: key % 20 == 0, 20).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    want = exact(vectors, range(0, 2000, 20), 20)
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in [f[1] for f in found]
        for _, v, s in found:
            assert s == pytest.approx(float(np.dot(vectors[v].astype(float), vectors[q].astype(float))), rel=1e-12)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        hits += len({f[1] for f in found} & {v for v, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_graph_search_on_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], schema)
    got = ann.nearest(few, lambda key: key % 20 == 0, 20).orderBy("rank").collect()
    assert [(x["vec_id"], x["score"]) for x in got] == [(1, 0.5), (2, -1.0)]
    assert ann.nearest(spark.createDataFrame([], schema), lambda key: key % 20 == 0, 20).count() == 0
    assert ann.nearest(few.where("vec_id = 0"), lambda key: key % 20 == 0, 20).count() == 0


def test_graph_search_outlives_one_long_row(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0]), (3, [1.0, 1.0, 1.0])],
                                "vec_id long, embedding array<float>")
    got = ann.nearest(few, lambda key: key % 20 == 0, 20).orderBy("rank").collect()
    assert [(x["vec_id"], x["score"]) for x in got] == [(1, 0.5), (2, -1.0)]


def recall(found, want: dict) -> float:
    got: dict = {}
    for x in found.collect():
        got.setdefault(x["query_id"], set()).add(x["vec_id"])
    return sum(len(got.get(q, set()) & {v for v, _ in w}) for q, w in want.items()) / sum(len(w) for w in want.values())


def test_graph_search_recall_beside_one_very_long_vector(spark):
    r = np.random.default_rng(3)
    vectors = {i: v.astype(np.float32) for i, v in enumerate(r.normal(size=(1500, 16)))}
    vectors[7] = vectors[7] * np.float32(5000)
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()], "vec_id long, embedding array<float>")
    want = exact(vectors, range(0, 1500, 20), 20)
    assert recall(ann.nearest(table, lambda key: key % 20 == 0, 20), want) >= 0.9


@pytest.mark.parametrize("dimensions", [64, 384])
def test_graph_of_a_full_shard_without_clusters(dimensions):
    """Gaussian vectors, as many as a shard has: every node is reached, the beam widens until recall is met."""
    r = np.random.default_rng(5)
    v = r.normal(size=(ann.SHARD_VECTORS, dimensions)).astype(np.float32)
    size = (v.astype(float) ** 2).sum(1)
    graph = ann.build(np.c_[v, np.sqrt(np.maximum(size.max() - size, 0)).astype(np.float32)])
    assert ann._reached(graph).all()
    by_product = ann.Graph(v, graph.edges, graph.start, products=True)
    beam = ann.wide_enough(by_product, 20, ann.SEARCH_BEAM)
    asked = np.arange(3, len(v), 131)
    product = v[asked].astype(float) @ v.T.astype(float)
    true = np.argsort(-product, axis=1)[:, :20]
    found, _ = by_product.search(v[asked], beam)
    assert np.mean([np.isin(t, f).mean() for t, f in zip(true, found)]) >= 0.9


def test_graph_search_keeps_doubles(spark):
    r = np.random.default_rng(6)
    rows = [(i, [1.0 + float(x) * 1e-9 for x in v]) for i, v in enumerate(r.normal(size=(300, 8)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = dict(rows)
    for x in ann.nearest(table, lambda key: key % 100 == 0, 20).collect():
        assert x["score"] == pytest.approx(float(np.dot(vectors[x["query_id"]], vectors[x["vec_id"]])), rel=1e-15)


def test_graph_search_recall_of_the_table(spark):
    """The query as registered, with its own constants."""
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding")
    vectors = {x["vec_id"]: x["embedding"] for x in table.collect()}
    want = exact(vectors, [i for i in vectors if i % 20 == 0], 20)
    assert recall(ann.op6_robust_graph(spark, SMALL), want) >= 0.9


def pages(spark):
    big, other = "<p>" + "x" * 200 + "ä</p>", "<p>" + "y" * 300 + "</p>"
    rows = [(i, f"http://www.site{i % 4}.example.org/a{i}?q=1#f", big if i % 3 else other) for i in range(40)]
    rows += [(50, "https://short.org/", "tiny"), (51, "https://short.org/x", "tiny"), (52, None, None), (53, "", ""),
             (54, "odd url\r\nwith: \"lines\" é", "p" * 99), (55, "odd", "p" * 99), (56, "odd", "p" * 100),
             (57, "odd", "p" * 100), (None, "no id", big), rows[7], rows[7]]
    return spark.createDataFrame([(*x, "e", 1) for x in rows], "page_id long, url string, html string, payload string, key long"), rows


def test_web_archive_round_trip(spark):
    table, rows = pages(spark)
    root, index = warc.write_archive(table)
    keys = table.select(warc.capture_key(warc.surt(F.col("url")), F.col("page_id")).alias("key")).distinct()
    got = warc.read_captures(root, index, keys).collect()
    first: dict = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if i is not None and len(raw) >= 100:
            first[raw] = min(first.get(raw, i), i)
    want = Counter()
    for i, url, html in rows:
        raw = (html or "").encode()
        of = first.get(raw)
        later = i is not None and of is not None and i > of
        want[(i, url or "", len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if later else "response", of if later else None)] += 1
    assert Counter((x["page_id"], x["url"], x["payload_bytes"], x["payload_digest"], x["record_type"], x["refers_to"])
                   for x in got) == want
    by_payload = {(x["page_id"], x["payload"]) for x in got if x["record_type"] == "response"}
    assert (50, "tiny") in by_payload and (52, "") in by_payload
    # a whole url, without the id
    host = warc.read_captures(root, index, spark.createDataFrame([("org,example,site1)/a1?q=1",), ("none)/",)], "key string")).collect()
    assert [x["page_id"] for x in host] == [1]


def test_web_archive_of_no_pages(spark):
    table, _ = pages(spark)
    root, index = warc.write_archive(table.where("false"))
    assert warc.read_captures(root, index, spark.createDataFrame([("a)/ 1",)], "key string")).count() == 0


def test_web_archive_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    table = spark.range(200).select(F.col("id").alias("page_id"), F.lit("http://one.org/").alias("url"),
                                    F.concat(F.lit("page "), F.col("id") % 50, F.repeat(F.lit("z"), 120)).alias("html"))
    root, index = warc.write_archive(table)
    keys = table.select(warc.capture_key(warc.surt(F.col("url")), F.col("page_id")).alias("key"))
    got = warc.read_captures(root, index, keys)
    assert got.count() == 200 and got.select("page_id").distinct().count() == 200
    assert got.where("record_type = 'response'").count() == 50
    assert warc.read_captures(root, index, spark.createDataFrame([("org,one)/",)], "key string")).count() == 200


def test_components(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 160), r.randrange(100, 160)) for _ in range(50)]
    links += [(7, 7), (None, 3)]
    got = {x["node"]: x["component"] for x in graph.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    top: dict = {}

    def find(i):
        while top.setdefault(i, i) != i:
            i = top[i]
        return i

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in top}


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_sql_twins(spark, name):
    got = registry.queries()[name](spark, SMALL)
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.sql(oracle.SQL[name])
    at = [want.columns.index(c) for c in got.columns]
    assert Counter(tuple(r) for r in got.collect()) == Counter(tuple(r[i] for i in at) for r in want.fetchall())


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages(spark, tmp_dir, empty):
    """The pipeline on a table with planted cases, and on an empty one."""
    r = random.Random(8)

    def lines(n):
        return [" ".join("".join(r.choice("aeinorst") for _ in range(r.randint(3, 9))) for _ in range(11)) + "." for _ in range(n)]

    one, block = lines(9), lines(4)
    rows = [] if empty else [
        (1, "\n".join(one)), (2, " ".join(one).replace(one[4][-9:], "changed.")), (3, "bad"), (4, None), (5, ""),
        (6, "\n".join(lines(6) + block)), (7, "\n".join(lines(5) + block)), (8, "\n".join(lines(3) + ["Home | About | Us"] * 40))]
    docs = brute.frame(spark, rows, False).drop("doc", "__text", "quality")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    out = corpus_pipeline.run(spark, tmp_dir)
    assert out.columns == ["doc_id", "source", "n_tokens", "ids"]
    assert {x["doc_id"] for x in out.collect()} == (set() if empty else {1, 6, 7})
    if not empty:   # the later document lost the block that both have
        tokens = {x["doc_id"]: x["n_tokens"] for x in out.collect()}
        assert tokens[7] < 0.7 * tokens[6]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mix_sources", "encode"]


def test_pipeline_quality_stage_drops_failing_lines(spark, tmp_dir):
    r = random.Random(9)
    prose = [" ".join("".join(r.choice("aeinorst") for _ in range(r.randint(3, 9))) for _ in range(11)) + "." for _ in range(9)]
    docs = brute.frame(spark, [(1, "\n".join(["Home", "Login"] + prose)), (2, "bad")], False).drop("quality")
    got = corpus_pipeline.quality_rules(spark, docs, tmp_dir)
    assert got.columns == docs.columns
    assert [(x["doc_id"], x["text"]) for x in got.collect()] == [(1, "\n".join(prose))]
