"""Frames side by side and below each other, ordered comparison, outer joins, tags as a table."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from forumlens.functions import columns as C
from forumlens.operators import aggregates as A
from forumlens.operators import binding as B
from forumlens.operators import joins as J
from forumlens.operators import ranking as R
from forumlens.operators.compare import frames_diff, frames_equal
from forumlens.plans import activity as T


def bag(df):
    return Counter(map(repr, map(tuple, df.collect())))


def test_difference_counts_nulls_nans_and_copies(spark):
    r = random.Random(0)
    values = [None, float("nan"), 0.0, -0.0, 1.5]
    a, b = ([(r.choice(values), r.choice(["x", None])) for _ in range(60)] for _ in range(2))
    key = lambda row: (None if row[0] is None else "nan" if row[0] != row[0] else row[0] + 0.0, row[1])
    df = lambda rows: spark.createDataFrame(rows, "v double, k string").repartition(3)
    want = Counter()
    for side, one, other in (("missing", a, b), ("extra", b, a)):
        for row, n in (Counter(map(key, one)) - Counter(map(key, other))).items():
            want[(*row, side)] += n
    got = Counter((*key((x["v"], x["k"])), x["side"]) for x in frames_diff(df(a), df(b)).collect())
    assert got == want
    assert frames_equal(df(a), df(a[::-1])) and not frames_equal(df(a), df(a + a[:1]))
    plan = frames_diff(df(a), df(b))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_ordered_comparison_sees_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k long, v string").coalesce(1)
    back = a.orderBy(F.desc("k"))
    assert frames_equal(a, back) and not frames_equal(a, back, ordered=True)
    assert not frames_equal(a.orderBy("k"), back, True, [R.asc("k")])
    assert frames_equal(a.orderBy("k"), a.orderBy("v"), True, ["k"])
    big = spark.range(0, 3000).withColumn("k", F.col("id") % 7)
    assert frames_equal(big.orderBy("k", "id"), big.repartition(9).orderBy("k", "id"), True, ["k", "id"])
    for order in (["k"], [R.desc("k")]):       # not total: which row stands where is chance
        with pytest.raises(ValueError):
            frames_diff(big.orderBy("k"), big.orderBy("k"), True, order)
    copies = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    assert frames_equal(copies.orderBy("k"), copies.orderBy("k"), True, [R.asc("k")])


def test_delivered_positions(spark):
    df = spark.range(0, 5000, 1, 13).where("id % 3 > 0").orderBy(F.desc("id"))
    rows = R.delivered_positions(df, "n").collect()
    assert sorted((x["n"], -x["id"]) for x in rows) == [(i + 1, -v) for i, v in enumerate(
        sorted((i for i in range(5000) if i % 3), reverse=True))]


def test_zip_frames(spark):
    left = spark.range(0, 1000, 1, 7).select(F.col("id").alias("a"))
    right = spark.range(0, 1000, 1, 3).select((F.col("id") * 2).alias("b"), F.lit(None).cast("string").alias("c"))
    assert sorted(map(tuple, B.zip_frames(left, right).collect())) == [(i, 2 * i, None) for i in range(1000)]
    assert B.zip_frames(left, right, "row").columns == ["row", "a", "b", "c"]
    with pytest.raises(ValueError):
        B.zip_frames(left, right.limit(999))
    with pytest.raises(ValueError):
        B.zip_frames(left, left)
    assert B.zip_frames(left.where("false"), right.where("false")).count() == 0


def test_bind_rows_and_split_frames(spark):
    df = spark.createDataFrame([(i, c, "é/=%" + str(i)) for i, c in enumerate(["2016", "2017", None, "a/b", "2016", ""])],
                               "id long, Class string, v string")
    parts = B.split_frames(df, "Class")
    assert set(parts) >= {"2016", "2017", "a/b", None} and parts["2016"].columns == ["id", "v"]
    assert sorted(x["id"] for x in parts["2016"].collect()) == [0, 4]
    assert B.split_frames(df, "Class", ["none"])["none"].count() == 0
    whole = B.bind_rows({str(k): p for k, p in parts.items()}, "From")
    assert sorted((x["id"], x["v"]) for x in whole.collect()) == sorted((x["id"], x["v"]) for x in df.collect())
    plan = parts["2017"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Class" in plan or "PartitionFilters: [(Class" in plan
    with pytest.raises(ValueError):
        B.bind_rows([])
    with pytest.raises(Exception):
        B.bind_rows([df, parts["2016"]]).collect()
    assert B.bind_rows([df, parts["2016"]], missing_columns=True).count() == 8


def outer(left, right, keep_right):
    """Rows of a left or full outer join by brute force."""
    out, used = [], set()
    for l in left:
        hits = [i for i, r in enumerate(right) if l[0] is not None and r[0] == l[0]]
        out += [(*l, *right[i]) for i in hits] or [(*l, None, None)]
        used |= set(hits)
    return out + ([(None, None, *r) for i, r in enumerate(right) if i not in used] if keep_right else [])


def test_outer_joins_against_plain(spark):
    r = random.Random(1)
    make = lambda n: [(r.choice([None, None, 1, 1, 1, 2, 3, r.randrange(20)]), r.randrange(5)) for _ in range(n)]
    left, right = make(40), make(25)
    l, q = spark.createDataFrame(left, "k long, v long"), spark.createDataFrame(right, "K2 long, V long")
    got = J.left_outer(l, q, [("k", "K2")])
    assert got.columns == ["k", "v", "K2", "V_right"]
    assert bag(got) == Counter(map(repr, outer(left, right, False)))
    full = J.full_outer(l, q, "k", "K2")
    assert full.columns == ["k", "v", "V_right"]
    want = [(a if a is not None else b, v, w) for a, v, b, w in outer(left, right, True)]
    assert bag(full) == Counter(map(repr, want))
    assert J.full_outer(l, q, "k", "K2", "key").columns == ["key", "v", "V_right"]
    with pytest.raises(ValueError):
        J.full_outer(l, q, "k", "K2", "V")
    two = J.left_outer(l, q, [("k", "K2"), ("v", "V")])
    assert two.count() == sum(max(1, sum(a[0] is not None and a == b for b in right)) for a in left)


def test_tags_that_differ_in_case_and_a_tag_named_date(spark):
    tags = ["cat", "Cat", "Date", "date", "a.b", "none"]
    act = spark.createDataFrame([("cat", 2017, 1), ("Cat", 2017, 1), ("Cat", 2017, 2), ("Date", 2017, 2), ("x", 2018, 3)],
                                "TagName string, Year int, Month int")
    want = {(m, t): 0 for m in ("2017-01", "2017-02", "2018-03") for t in tags}
    want.update({("2017-01", "cat"): 1, ("2017-01", "Cat"): 1, ("2017-02", "Cat"): 1, ("2017-02", "Date"): 1})
    table = spark.createDataFrame([(t,) for t in tags + tags[:2]], "TagName string")
    for given in (tags, table):
        long = T.series_long(act, given)
        assert long.columns == ["Date", "TagName", "Count"]
        assert {(x["Date"], x["TagName"]): x["Count"] for x in long.collect()} == want and long.count() == len(want)
    wide = T.series_wide(act, tags)
    assert wide.columns == ["Date", "cat", "Cat_2", "Date_2", "date_3", "a.b", "none"]
    assert [tuple(x) for x in wide.orderBy("Date").collect()][0] == ("2017-01", 1, 1, 0, 0, 0, 0)
    topics = act.withColumn("Topic", F.when(F.col("Year") == 2018, "late").otherwise("early"))
    long = T.topics_series(topics, T.tag_list(act))
    assert long.count() == 4 * 3 and long.agg(F.sum("Count")).first()[0] == 5
    assert T.series_long(act, table.where("false")).count() == 0


def test_fill_all_types(spark):
    df = spark.createDataFrame([(None,) * 7, (1, "x", 2.5, True, datetime.date(2017, 1, 2), datetime.datetime(2017, 1, 2), [1])],
                               "a long, `b c` string, c double, d boolean, e date, f timestamp, g array<int>")
    df = df.withColumn("c", F.when(F.col("a").isNull(), F.lit(float("nan"))).otherwise(F.col("c")))
    got = sorted(map(tuple, C.fill_all(df).collect()), key=repr)
    day = datetime.date(1970, 1, 1)
    assert got == [(0, "0", 0.0, False, day, datetime.datetime(1970, 1, 1), None),
                   (1, "x", 2.5, True, datetime.date(2017, 1, 2), datetime.datetime(2017, 1, 2), [1])]
    assert C.fill_all(df, day=None, text=None).where("e is null and `b c` is null").count() == 1


def test_ties_never_depend_on_chance(spark):
    rows = [(i % 2, 5, f"t{i:03}") for i in range(400)]
    random.Random(2).shuffle(rows)
    for parts in (1, 5, 16):
        df = spark.createDataFrame(rows, "k long, score long, title string").repartition(parts)
        assert [x["title"] for x in R.top_k(df, 3, [R.desc("score")]).collect()] == ["t000", "t002", "t004"]
        best = R.top_per_group(df, ["k"], [R.desc("score")]).collect()
        assert sorted(x["title"] for x in best) == ["t000", "t001"]


def test_group_maximum_without_keys_raises(spark):
    df = spark.createDataFrame([(1, 2)], "a long, id long")
    for call in (lambda: R.rows_at_group_max(df, [], "id"), lambda: R.with_group_max(df, [], "id")):
        with pytest.raises(ValueError):
            call()
    assert A.free_names(["a", "A", "a_2"], ["x"]) == ["a", "A_2", "a_2_2"]
