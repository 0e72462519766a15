"""Operators on their own, and randomized checks against brute force."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from forumlens.functions import columns as C
from forumlens.operators import aggregates as A
from forumlens.operators import joins as J
from forumlens.operators import ranking as R

SLOW = settings(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

KV = "k long, v long, id long"
rows_kv = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),
                             st.one_of(st.none(), st.integers(-2, 2))), max_size=25)


def _df(spark, data):
    return spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(data)], KV)


@SLOW
@given(rows_kv)
def test_top_per_group_first_matches_brute_force(spark, data):
    got = sorted((tuple(r) for r in R.top_per_group(
        _df(spark, data), ["k"], [R.desc("v")], 1, "first", tiebreak=[R.asc("id")]).collect()),
        key=repr)
    groups = defaultdict(list)
    for i, (k, v) in enumerate(data):
        groups[k].append((k, v, i))
    # desc nulls last, then smallest id
    want = [min(g, key=lambda r: (r[1] is None, -(r[1] or 0), r[2])) for g in groups.values()]
    assert got == sorted(want, key=repr)


@SLOW
@given(rows_kv)
def test_rows_at_group_max_matches_brute_force(spark, data):
    df = _df(spark, data)
    for keep_missing in (False, True):
        got = Counter(tuple(r) for r in R.rows_at_group_max(df, ["k"], "v", keep_missing).collect())
        groups = defaultdict(list)
        for i, (k, v) in enumerate(data):
            groups[k].append((k, v, i))
        want = Counter()
        for g in groups.values():
            vals = [r[1] for r in g if r[1] is not None]
            if vals:
                want.update(r for r in g if r[1] == max(vals))
            elif keep_missing:
                want.update(g)
        assert got == want


@SLOW
@given(rows_kv)
def test_with_group_max_keeps_every_row(spark, data):
    df = _df(spark, data)
    got = {r["id"]: r["m"] for r in R.with_group_max(df, ["k"], "v", "m").collect()}
    groups = defaultdict(list)
    for k, v in data:
        groups[k].append(v)
    want = {i: max([x for x in groups[k] if x is not None], default=None)
            for i, (k, v) in enumerate(data)}
    assert got == want


@SLOW
@given(st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["new", "old", None])), max_size=30))
def test_conditional_counts_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "PostId long, VoteAge string")
    got = {r["PostId"]: (r["NewVotes"], r["OldVotes"]) for r in A.conditional_counts(
        df, ["PostId"], "VoteAge", {"NewVotes": "new", "OldVotes": "old"}).collect()}
    want = {}
    for p, c in data:
        n, o = want.get(p, (0, 0))
        want[p] = (n + (c == "new"), o + (c == "old"))
    assert got == want


def test_full_outer_merges_keys(spark):
    n = spark.createDataFrame([(1, 5), (2, 1)], "PostId long, NewVotes long")
    o = spark.createDataFrame([(2, 3), (3, 4)], "PostId long, OldVotes long")
    got = sorted(tuple(r) for r in J.full_outer(n, o, "PostId").collect())
    assert got == [(1, 5, None), (2, 1, 3), (3, None, 4)]


def test_lookup_keep_unmatched(spark):
    q = spark.createDataFrame([(1, 7), (2, 99), (3, None)], "Id long, Owner long")
    u = spark.createDataFrame([(7, "a")], "Id long, Name string")
    inner = J.lookup(q, u, [("Owner", "Id")]).select("l.Id", "r.Name").collect()
    left = J.lookup(q, u, [("Owner", "Id")], keep_unmatched=True).select("l.Id", "r.Name").collect()
    assert [tuple(r) for r in inner] == [(1, "a")]
    assert sorted(tuple(r) for r in left) == [(1, "a"), (2, None), (3, None)]


def test_spine_and_pivot(spark):
    dates = spark.createDataFrame([("2017-01",), ("2017-02",)], "Date string")
    sp = J.spine(dates, ["a", "b", "a"], "TagName")
    assert sp.count() == 6          # the literal list is used as given
    act = spark.createDataFrame([("2017-01", "a"), ("2017-01", "x"), ("2017-02", "b")],
                                "Date string, TagName string")
    wide = sorted(tuple(r) for r in A.pivot_counts(act, ["Date"], "TagName", ["a", "b", "a"]).collect())
    assert wide == [("2017-01", 1, 0), ("2017-02", 0, 1)]


def test_having_frequency_and_null_keys(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), (None, 4), (None, 5)],
                               "Name string, v long")
    having = sorted((tuple(r) for r in A.having_between(df, ["Name"], 2, 10).collect()), key=repr)
    assert having == [("x", 2), (None, 2)]
    assert sorted(tuple(r) for r in A.frequency_table(df, "Name").collect()) == [("x", 2), ("y", 1)]
    dropped = A.grouped_sum(df, ["Name"], "v", "s", drop_nulls=True).collect()
    assert sorted(tuple(r) for r in dropped) == [("x", 3), ("y", 3)]
    kept = A.grouped_sum(df, ["Name"], "v", "s").collect()
    assert (None, 9) in [tuple(r) for r in kept]


def test_fill_all_is_typed(spark):
    df = spark.createDataFrame([(None, None, None)], "a long, b string, c double")
    assert tuple(C.fill_all(df).collect()[0]) == (0, "0", 0.0)
    assert tuple(C.fill_all(df, text=None).collect()[0]) == (0, None, 0.0)


def test_top_k_total_order(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(20)], "c long, id long")
    got = [tuple(r) for r in R.top_k(df, 4, [R.desc("c"), R.asc("id")]).collect()]
    assert got == [(2, 2), (2, 5), (2, 8), (2, 11)]
    assert R.top_k(df, 100, [R.asc("id")]).count() == 20


def test_join_without_keys_raises(spark):
    import pytest
    with pytest.raises(ValueError):
        J.join_on(spark.range(2), spark.range(2), [])


@SLOW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 50)), max_size=40),
       st.integers(0, 4), st.integers(0, 6))
def test_rows_in_groups_sized_matches_brute_force(spark, data, low, span):
    high = low + span
    df = spark.createDataFrame(data, "Name string, UserId long")
    got = Counter(tuple(r) for r in A.rows_in_groups_sized(df, ["Name"], low, high,
                                                           [R.asc("UserId")]).collect())
    sizes = Counter(n for n, _ in data)
    want = Counter((n, u) for n, u in data if low <= sizes[n] <= high)
    assert got == want
