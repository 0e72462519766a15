"""Properties over the real adapter data (sf0.001)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from forumlens.operators.compare import frames_equal
from forumlens.plans import activity as T
from forumlens.plans import questions as Q
from forumlens.plans.registry import TAGS3, queries
from forumlens.sources.adapters import ForumData


def test_top_k_is_prefix_of_unlimited_and_ordered(spark):
    fd = ForumData(spark, SF_SMALL)
    top = [tuple(r) for r in Q.positive_answers(fd.posts, 10).collect()]
    full = [tuple(r) for r in Q.positive_answers(fd.posts, 10 ** 6).collect()]
    assert top == full[:10]
    counts = [r[2] for r in full]
    assert counts == sorted(counts, reverse=True)


def test_ties_all_contains_ties_first(spark):
    fd = ForumData(spark, SF_SMALL)
    first = Q.top_question_per_year(fd.posts, fd.votes, "first")
    every = Q.top_question_per_year(fd.posts, fd.votes, "all")
    assert first.exceptAll(every).count() == 0
    assert every.select("Year").distinct().count() == first.count()


def test_wide_column_sums_equal_filtered_counts(spark):
    fd = ForumData(spark, SF_SMALL)
    wide = T.series_wide(fd.activity, TAGS3)
    sums = wide.agg(*[F.sum(F.col(f"`{t}`")).alias(t) for t in TAGS3]).collect()[0]
    for t in TAGS3:
        assert sums[t] == fd.activity.where(F.col("TagName") == t).count()


def test_long_and_wide_agree(spark):
    fd = ForumData(spark, SF_SMALL)
    long = T.series_long(fd.activity, TAGS3)
    wide = T.series_wide(fd.activity, TAGS3)
    assert long.count() == wide.count() * len(TAGS3)


def test_anti_and_semi_partition_the_rows(spark):
    fd = ForumData(spark, SF_SMALL)
    votes = fd.votes.select("PostId").distinct()
    q = fd.posts.where("PostTypeId = 1").select(F.col("Id").alias("PostId"))
    semi = votes.join(q, "PostId", "left_semi")
    anti = votes.join(q, "PostId", "left_anti")
    assert semi.count() + anti.count() == votes.count()
    assert semi.join(anti, "PostId").count() == 0


def test_sql_forms_equal_dataframe_forms(spark):
    qs = queries()
    for n in ("q1", "q2", "q3", "q4", "q5", "q6"):
        df_key = [k for k in qs if k.startswith(n + "_") and not k.endswith("sql_form")][0]
        a = qs[df_key](spark, SF_SMALL)
        b = qs[f"{n}_sql_form"](spark, SF_SMALL)
        assert frames_equal(a, b), n
    assert frames_equal(qs["q7_old_votes_conditional"](spark, SF_SMALL),
                        qs["q7_sql_form"](spark, SF_SMALL))


def test_q7_forms_agree_on_whole_frames(spark):
    qs = queries()
    full = qs["j_full_outer"](spark, SF_SMALL)
    cond = qs["a_conditional"](spark, SF_SMALL)
    assert frames_equal(full, cond.select("PostId", "NewVotes", "OldVotes"))
    anti = qs["j_anti"](spark, SF_SMALL)
    only_old = cond.where("NewVotes = 0 AND OldVotes > 0").select("PostId", "OldVotes")
    assert frames_equal(anti, only_old)


def test_same_rows_without_any_broadcast(spark):
    """With size-based broadcasting off the rows are the same."""
    fd = ForumData(spark, SF_SMALL)

    def rows():
        return {k: sorted(map(tuple, v.collect()), key=repr) for k, v in {
            "q1": Q.top_authors(fd.posts, fd.users, 10),
            "q2": Q.positive_answers(fd.posts, 10),
            "q3": Q.top_question_per_year(fd.posts, fd.votes, "all"),
            "q5": Q.author_comments(fd.posts, fd.comments, 10),
        }.items()}

    before = rows()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows() == before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_repeated_question_hides_no_other(spark):
    """Three tied questions of one year, one stored twice: every stored row comes out."""
    posts = spark.createDataFrame([(1, 1, "A"), (2, 1, "B"), (2, 1, "B"), (3, 1, "C")],
                                  "Id long, PostTypeId int, Title string")
    votes = spark.createDataFrame([(i, 2, "2015-03-01") for i in (1, 2, 3)],
                                  "PostId long, VoteTypeId int, CreationDate string").withColumn(
        "CreationDate", F.to_timestamp("CreationDate"))
    got = [r["Title"] for r in Q.top_question_per_year(posts, votes, "all").collect()]
    assert got == ["A", "B", "B", "C"]


def test_row_counts_recorded_in_the_survey(spark):
    """Row counts the design survey recorded for the adapter data (sf0.001)."""
    qs = queries()
    recorded = {"q4_accepted_gap": 10, "q6_rare_badge_users": 13, "t3_series_long": 240,
                "t4_series_wide": 80, "w_residual_group": 224, "q3_ties_all": 105,
                "j_null_safe": 62, "j_full_outer": 1081, "j_anti": 634, "j_left_lookup": 1500,
                "p_between_having": 8, "q3_top_question_per_year": 7, "q1_top_authors": 10,
                "q2_positive_answers": 10, "q5_author_comments": 10,
                "q7_old_votes_conditional": 10}
    for key, n in recorded.items():
        assert qs[key](spark, SF_SMALL).count() == n, key
