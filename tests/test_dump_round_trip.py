"""The reference's workflow end to end, on Spark: XML dump -> CSV conversion
(dropping the listed columns) -> typed CSV readers -> the seven questions.
Every answer must equal the one computed on the tables before the trip."""

import datetime
import os
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from forumlens import schemas as S
from forumlens import session
from forumlens.operators.compare import frames_equal
from forumlens.plans import questions as Q
from forumlens.plans import registry
from forumlens.session import scratch_path
from forumlens.sources import files
from forumlens.sources.adapters import ForumData

DROPPED = {"Posts": ["Body"], "Users": ["AboutMe"], "Comments": ["Text"]}


def test_xml_dump_to_csv_to_questions(spark):
    fd = ForumData(spark, SF_SMALL)
    base = scratch_path(spark, "dump-test")
    originals = {"Posts": fd.posts, "Users": fd.users, "Votes": fd.votes,
                 "Comments": fd.comments, "Badges": fd.badges}
    xml_paths, full_schemas = {}, {}
    for name, df in originals.items():
        extra = DROPPED.get(name, [])
        conformed = S.conform(df, S.TABLE_SCHEMAS[name])
        for c in extra:   # columns the converter must remove
            conformed = conformed.withColumn(c, F.lit("<p>dropped & gone</p>"))
        xml_paths[name] = files.write_xml_rows(conformed, f"{base}/xml/{name}",
                                               root_tag=name.lower())
        full_schemas[name] = S.with_fields(S.TABLE_SCHEMAS[name], [(c, "string") for c in extra])
    drop = {name: cols for name, cols in DROPPED.items()}
    out = files.convert_dump(spark, xml_paths, f"{base}/csv", full_schemas, drop)
    back = {name: files.read_commented_csv(spark, path, S.TABLE_SCHEMAS[name])
            for name, path in out.items()}
    for name in DROPPED:
        header = spark.read.option("header", True).csv(out[name]).columns
        assert not set(DROPPED[name]) & set(header), name

    p0, u0, v0, c0, b0 = (originals[n] for n in ("Posts", "Users", "Votes", "Comments", "Badges"))
    p1, u1, v1, c1, b1 = (back[n] for n in ("Posts", "Users", "Votes", "Comments", "Badges"))
    pairs = {
        "q1": (Q.top_authors(p0, u0), Q.top_authors(p1, u1)),
        "q2": (Q.positive_answers(p0), Q.positive_answers(p1)),
        "q3": (Q.top_question_per_year(p0, v0), Q.top_question_per_year(p1, v1)),
        "q4": (Q.accepted_gap(p0, 40), Q.accepted_gap(p1, 40)),
        "q5": (Q.author_comments(p0, c0), Q.author_comments(p1, c1)),
        "q6": (Q.rare_badge_users(u0, b0), Q.rare_badge_users(u1, b1)),
        "q7": (Q.old_votes_only(p0, v0, new_years=("2000", "2001")),
               Q.old_votes_only(p1, v1, new_years=("2000", "2001"))),
    }
    for name, (before, after) in pairs.items():
        assert before.count() > 0, name
        assert frames_equal(before, after), name


def written(folder):
    return {os.path.relpath(f"{at}/{f}", folder): os.path.getsize(f"{at}/{f}")
            for at, _, names in os.walk(folder) for f in names if f.startswith("part-")}


def test_gzipped_dump(spark, tmp_dir, monkeypatch):
    """a tenth of the space or so, in files that many tasks read; the same rows, and the same CSV."""
    monkeypatch.setattr(files, "GZIP_ROWS", 500)
    schema = "Id long, Title string, Body string"
    rows = [(i, None if i % 7 == 0 else f'a <b> & "c" é {i}', "<p>text</p>" * 5) for i in range(4000)]
    df = spark.createDataFrame(rows, schema).coalesce(2)
    plain = files.write_xml_rows(df, f"{tmp_dir}/plain/Posts", root_tag="posts")
    packed = files.write_xml_rows(df, f"{tmp_dir}/packed/Posts", root_tag="posts", gzip=True)
    sizes = written(packed)
    assert len(sizes) >= 8 and all(f.endswith(".xml.gz") for f in sizes)
    assert sum(sizes.values()) < sum(written(plain).values()) / 5
    for path in (plain, packed):
        assert sorted(map(tuple, files.read_xml_rows(spark, path, schema).collect())) == rows
        out = files.convert_dump(spark, {"Posts": path}, f"{path}-csv", {"Posts": df.schema})
        assert all(f.endswith(".csv.gz") for f in written(out["Posts"])) and len(written(out["Posts"])) >= 8
        back = files.read_csv(spark, out["Posts"], "Id long, Title string")
        assert sorted(map(tuple, back.collect())) == [r[:2] for r in rows]


def test_s4_writes_no_more_than_its_files(spark, tmp_dir, monkeypatch):
    """the XML was plain, 15 times the input, and copies of six tables stood beside it for one reading each."""
    at = datetime.datetime(2001, 2, 3, 4, 5, 6)
    n = 3000
    tables = {
        "nation": ([(0, "N")], "n_nationkey int, n_name string"),
        "customer": ([(i, f"Customer#{i}", i % 2, 1.5 * i) for i in range(9)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double"),
        "part": ([(i, f"B{i}", "T", None if i == 3 else i) for i in range(9)],
                 "p_partkey long, p_brand string, p_type string, p_size int"),
        "orders": ([(i, i % 9, "FO"[i % 2], 1e5 * i, None if i % 4 == 0 else at, "1-URGENT") for i in range(n)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(i // 2, i % 5, i % 7, 1 + i % 2 // (1 + i % 3), float(i % 50), "ANR"[i % 3], at) for i in range(2 * n)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_dir}/in/{name}.parquet")
    path = lambda _, name: f"{tmp_dir}/made/{name}"
    monkeypatch.setattr(registry, "scratch_path", path)
    monkeypatch.setattr(session, "scratch_path", path)
    got = registry.REGISTRY["s4_convert_dump"](spark, f"{tmp_dir}/in").collect()
    sizes = written(f"{tmp_dir}/made")
    assert sizes and all(f.endswith((".xml.gz", ".csv.gz")) for f in sizes)
    assert {f.split("/")[2] for f in sizes} == set(S.DUMP_DROP_COLUMNS)

    pairs = {(r[0], r[3]) for r in tables["lineitem"][0]}
    assert 2 * n > len(pairs)
    assert Counter(r["Source"] for r in got) == {"Badges": 9, "PostLinks": n // 2, "Posts": n + len(pairs), "Tags": 9,
                                                 "Users": 9, "Votes": 2 * n, "Comments": 2 * n}
    lines = {r["Line"] for r in got}
    assert {"3|B3 T|-", "20|20|21", "20|1|-|21|2001-02-03T04:05:06.000|0|2|Order 2 1-URGENT|4",
            "Customer#1|334", "1|1.5|Customer#1|-|19"} <= lines
    # a second run in the session reads what other queries have stored by then
    fd = ForumData(spark, f"{tmp_dir}/in")
    assert fd.unstored().badges.inputFiles() != fd.badges.inputFiles() == fd.unstored().badges.inputFiles()
