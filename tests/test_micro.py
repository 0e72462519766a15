"""Hand-made fixtures for the edge cases of FIXTURES.md section 3."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from forumlens import schemas as S
from forumlens.functions import columns as C
from forumlens.operators import ranking as R
from forumlens.plans import activity as T
from forumlens.plans import questions as Q
from forumlens.sources import files

POSTS = ("Id long, PostTypeId int, ParentId long, AcceptedAnswerId long, Score long, "
         "OwnerUserId long, Title string, FavoriteCount long")
USERS = "Id long, DisplayName string, Age int, Location string, Reputation double"
VOTES = "PostId long, VoteTypeId int, CreationDate timestamp"
COMMENTS = "PostId long, UserId long, Score long"
BADGES = "UserId long, Name string, Class int"
ACTIVITY = "TagName string, Year int, Month int"


def q(i, owner, fav, title=None, acc=None):
    return (i, 1, None, acc, 0, owner, title or f"Q{i}", fav)


def a(i, parent, score, owner=None):
    return (i, 2, parent, None, score, owner, None, None)


def users(spark, ids):
    return spark.createDataFrame([(i, f"U{i}", 30, "X", 1.0) for i in ids], USERS)


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---------------------------------------------------------------- Q1
def test_q1_tie_first_takes_smaller_id_and_all_keeps_both(spark):
    posts = spark.createDataFrame([q(2, 7, 5), q(1, 7, 5), q(3, 7, 1)], POSTS)
    u = users(spark, [7])
    first = rows(Q.top_authors(posts, u, ties="first"))
    assert first == [("U7", 30, "X", 11, "Q1", 5)]
    both = sorted(rows(Q.top_authors(posts, u, ties="all")), key=lambda r: r[4])
    assert [r[4] for r in both] == ["Q1", "Q2"]


def test_q1_all_missing_favourites(spark):
    posts = spark.createDataFrame([q(1, 7, None), q(2, 7, None), q(3, 8, 1)], POSTS)
    u = users(spark, [7, 8])
    out = rows(Q.top_authors(posts, u))
    # total NULL sorts last; the best question is the first by Id
    assert out == [("U8", 30, "X", 1, "Q3", 1), ("U7", 30, "X", None, "Q1", None)]
    zero = rows(Q.top_authors(posts, u, empty_sum=0))
    assert ("U7", 30, "X", 0, "Q1", None) in zero
    # the pandas rule (W1): an all-missing group vanishes
    assert rows(R.rows_at_group_max(posts.where("Id < 3"), ["OwnerUserId"], "FavoriteCount")) == []


def test_q1_owner_not_in_users(spark):
    posts = spark.createDataFrame([q(1, 7, 3), q(2, 99, 9)], POSTS)
    u = users(spark, [7])
    assert [r[0] for r in rows(Q.top_authors(posts, u))] == ["U7"]
    kept = rows(Q.top_authors(posts, u, keep_unmatched=True))
    assert kept[0] == (None, None, None, 9, "Q2", 9)
    assert len(kept) == 2


def test_q1_null_owner_is_not_an_author(spark):
    posts = spark.createDataFrame([q(1, None, 50), q(2, 7, 1)], POSTS)
    assert len(rows(Q.top_authors(posts, users(spark, [7])))) == 1


# ---------------------------------------------------------------- Q2
def test_q2_missing_parent_and_tie_break(spark):
    posts = spark.createDataFrame(
        [q(10, 1, 0), q(20, 1, 0), a(11, 10, 5), a(21, 20, 1), a(31, 30, 9), a(32, 30, 9),
         a(12, 10, -1)], POSTS)
    out = rows(Q.positive_answers(posts))
    # parent 30 does not exist; 10 and 20 tie on one answer each: higher Id first
    assert out == [(20, "Q20", 1), (10, "Q10", 1)]


def test_q2_fewer_than_k_rows_no_padding(spark):
    posts = spark.createDataFrame([q(10, 1, 0), a(11, 10, 5)], POSTS)
    assert rows(Q.positive_answers(posts, k=10)) == [(10, "Q10", 1)]


# ---------------------------------------------------------------- Q3
def test_q3_ties_per_year(spark):
    posts = spark.createDataFrame([q(1, 1, 0), q(2, 1, 0), a(3, 1, 0)], POSTS)
    t = dt.datetime(2015, 3, 1)
    votes = spark.createDataFrame([(1, 2, t), (2, 2, t), (3, 2, t), (3, 2, t)], VOTES)
    # post 3 is an answer and does not compete
    assert rows(Q.top_question_per_year(posts, votes)) == [("Q1", "2015", 1)]
    assert sorted(rows(Q.top_question_per_year(posts, votes, ties="all"))) == [
        ("Q1", "2015", 1), ("Q2", "2015", 1)]


# ---------------------------------------------------------------- Q4
def test_q4_boundary_and_dangling_accepted_answer(spark):
    posts = spark.createDataFrame([
        q(1, 1, 0, acc=11), a(11, 1, 0), a(12, 1, 51),      # gap 51: kept
        q(2, 1, 0, acc=21), a(21, 2, 0), a(22, 2, 50),      # gap 50: not > 50
        q(3, 1, 0, acc=999), a(31, 3, 80),                  # accepted id does not exist
    ], POSTS)
    assert rows(Q.accepted_gap(posts, 50)) == [(1, "Q1", 51, 0, 51)]


# ---------------------------------------------------------------- Q5
def test_q5_removed_owner_and_removed_commenters(spark):
    posts = spark.createDataFrame([q(1, None, 0), q(2, 5, 0)], POSTS)
    comments = spark.createDataFrame([(1, None, 3), (1, None, 4), (2, 5, 1), (2, 6, 9)], COMMENTS)
    assert rows(Q.author_comments(posts, comments)) == [("Q2", 1)]
    assert rows(Q.author_comments(posts, comments, null_keys="match")) == [("Q1", 7), ("Q2", 1)]


# ---------------------------------------------------------------- Q6
def test_q6_between_bounds(spark):
    badges = []
    for name, n in [("one", 1), ("two", 2), ("ten", 10), ("eleven", 11)]:
        for _ in range(n):
            badges.append((100 + len(badges), name, 1))
    badges.append((1, "two", 2))          # other class does not count
    b = spark.createDataFrame(badges, BADGES)
    ids = [r[0] for r in b.collect()]
    u = users(spark, sorted(set(ids)))
    got = {r[0] for r in Q.rare_badge_users(u, b).collect()}
    two_ten = {r[0] for r in b.where("Class = 1 AND Name IN ('two', 'ten')").collect()}
    assert got == two_ten and len(got) == 12


# ---------------------------------------------------------------- Q7 and the year rules
def test_year_rules(spark):
    ts = [dt.datetime(y, 6, 1) for y in (2015, 2016, 2017, 2018)] + [None]
    df = spark.createDataFrame([(i, 2, t) for i, t in enumerate(ts)], VOTES)
    y = C.year_text("CreationDate")
    got = [tuple(r) for r in df.select(C.age_class(y), C.age_threshold(y)).collect()]
    assert got == [("old", "old"), ("new", "new"), ("new", "new"), ("old", "new"), ("old", None)]


def test_q7_three_forms_agree(spark):
    posts = spark.createDataFrame([q(1, 1, 0), q(2, 1, 0), q(3, 1, 0), a(4, 1, 0)], POSTS)
    t_old, t_new = dt.datetime(2010, 1, 1), dt.datetime(2016, 1, 1)
    votes = spark.createDataFrame(
        [(1, 2, t_old), (1, 2, t_old), (2, 2, t_old), (2, 2, t_new), (3, 2, t_old),
         (4, 2, t_old), (3, 3, t_new)], VOTES)
    expect = [("Q1", 2), ("Q3", 1)]
    assert rows(Q.old_votes_only(posts, votes)) == expect
    assert rows(Q.old_votes_anti(posts, votes)) == expect
    assert rows(Q.old_votes_full_outer(posts, votes)) == expect


# ---------------------------------------------------------------- activity
def _activity(spark):
    return spark.createDataFrame(
        [("r", 2017, 1), ("r", 2017, 1), ("py", 2017, 2), ("r", 2017, 3), ("py", 2018, 11)],
        ACTIVITY)


def test_series_zero_fill_and_spine(spark):
    act = _activity(spark)
    wide = rows(T.series_wide(act, ["r", "py", "none"]))
    # 2017-02 has no 'r', every tag is 0 where absent; a month with no
    # activity at all (2017-04) is not in the spine
    assert wide == [("2017-01", 2, 0, 0), ("2017-02", 0, 1, 0), ("2017-03", 1, 0, 0),
                    ("2018-11", 0, 1, 0)]
    long = rows(T.series_long(act, ["r"]))
    assert long == [("2017-01", "r", 2), ("2017-02", "r", 0), ("2017-03", "r", 1),
                    ("2018-11", "r", 0)]
    assert rows(T.series_one(act, "py")) == [("2017-01", 0), ("2017-02", 1), ("2017-03", 0),
                                              ("2018-11", 1)]


def test_series_empty_tag_list(spark):
    act = _activity(spark)
    assert T.series_wide(act, []).columns == ["Date"]
    assert T.series_wide(act, []).count() == 4
    long = T.series_long(act, [])
    assert long.count() == 0 and long.columns == ["Date", "TagName", "Count"]


def test_month_key_padding(spark):
    df = spark.createDataFrame([(2017, 3), (2017, 12), (2017, 123), (2017, None), (None, 4)],
                               "Year int, Month int")
    assert [r[0] for r in df.select(C.month_key("Year", "Month")).collect()] == [
        "2017-03", "2017-12", None, None, None]


def test_odd_tag_names(spark):
    act = spark.createDataFrame([("a`b", 2017, 1), ("c.d", 2017, 1)], ACTIVITY)
    long = rows(T.series_long(act, ["a`b", "c.d"]))
    assert long == [("2017-01", "a`b", 1), ("2017-01", "c.d", 1)]


# ---------------------------------------------------------------- sources
def test_commented_csv_keeps_hash_inside_values(spark, tmp_dir):
    path = os.path.join(tmp_dir, "posts.csv.gz")
    with gzip.open(path, "wt") as f:
        f.write("# dump of 2017-10-31\nId,Title\n# another comment\n1,C# lang\n"
                '2,"# quoted start"\n3,"a, b # c"\n')
    df = files.read_commented_csv(spark, path, "Id long, Title string")
    assert rows(df) == [(1, "C# lang"), (2, "# quoted start"), (3, "a, b # c")]


def test_xml_rows_self_closing_entities_absent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "Posts.xml")
    with open(path, "w") as f:
        f.write('<?xml version="1.0" encoding="utf-8"?>\n<posts>\n'
                '  <row Id="1" PostTypeId="1" Title="Tom &amp; Jerry &lt;3" Score="5" '
                'CreationDate="2009-03-11T12:51:01.480" />\n'
                '  <row Id="2" PostTypeId="2" ParentId="1" Score="-2"/>\n</posts>\n')
    df = files.read_xml_rows(spark, path, S.POSTS).select("Id", "PostTypeId", "ParentId",
                                                         "Title", "Score")
    assert rows(df.orderBy("Id")) == [(1, 1, None, "Tom & Jerry <3", 5), (2, 2, 1, None, -2)]
    ts = files.read_xml_rows(spark, path, S.POSTS).where("Id = 1").select("CreationDate").first()[0]
    assert ts == dt.datetime(2009, 3, 11, 12, 51, 1, 480000)


def test_convert_dump_drops_columns(spark, tmp_dir):
    xml = os.path.join(tmp_dir, "Users.xml")
    with open(xml, "w") as f:
        f.write('<users><row Id="1" DisplayName="a" AboutMe="&lt;p&gt;hi" WebsiteUrl="w"/>'
                '<row Id="2" DisplayName="b"/></users>')
    schema = "Id long, DisplayName string, AboutMe string, WebsiteUrl string, ProfileImageUrl string"
    from pyspark.sql import types as Ty
    out = files.convert_dump(spark, {"Users": xml}, os.path.join(tmp_dir, "csv"),
                             {"Users": Ty._parse_datatype_string(schema)})
    back = spark.read.option("header", True).csv(out["Users"])
    assert back.columns == ["Id", "DisplayName"]
    assert sorted(rows(back)) == [("1", "a"), ("2", "b")]


def test_read_topics_adds_topic_column(spark, tmp_dir):
    for topic, body in [("anime", "TagName,Year,Month\nnaruto,2017,1\n"),
                        ("gaming", "TagName,Year,Month\nzelda,2016,12\nzelda,2017,1\n")]:
        with open(os.path.join(tmp_dir, f"{topic}.csv"), "w") as f:
            f.write(body)
    df = files.read_topics(spark, {t: os.path.join(tmp_dir, f"{t}.csv") for t in ("anime", "gaming")})
    assert sorted(rows(df.groupBy("Topic").count())) == [("anime", 1), ("gaming", 2)]
    series = rows(T.topics_series(df, ["zelda"]))
    assert series == [("anime", "2017-01", "zelda", 0), ("gaming", "2016-12", "zelda", 1),
                      ("gaming", "2017-01", "zelda", 1)]


@pytest.mark.parametrize("ordered", [False, True])
def test_frames_diff(spark, ordered):
    from forumlens.operators.compare import frames_diff, frames_equal
    a_df = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y")], "k long, v string")
    b_df = spark.createDataFrame([(2, "y"), (1, "x"), (3, "z")], "v_k long, v string") \
        .withColumnRenamed("v_k", "k")
    order = [R.asc("k"), R.asc("v")]
    d = frames_diff(a_df, b_df, ordered, order if ordered else None)
    sides = sorted((r["side"], r["k"]) for r in d.collect())
    if ordered:
        assert ("missing", 2) in sides and ("extra", 3) in sides
    else:
        assert sides == [("extra", 3), ("missing", 2)]
    assert frames_equal(a_df, a_df.orderBy(F.desc("k")))
    assert frames_equal(a_df, a_df, True, order)
