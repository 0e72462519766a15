"""

Every query reads the whole adapter tables of one scale-factor folder; the
only LIMITs are those of top-k reports and of the preview operator, where
the limit is the feature. The oracle twin of each key lives in
``oracle_sql.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..operators import aggregates as A
from ..operators import binding as B
from ..operators import joins as J
from ..operators import ranking as R
from ..operators.compare import frames_diff
from ..session import scratch_path
from ..sources import files
from ..sources.adapters import ForumData
from ..sources.catalog import preview, register_views, run_sql
from . import activity as T
from . import questions as Q
from . import sql_forms

# Fixed parameters of the test configuration. The reference's defaults (a gap
# of 50, new years 2016/2017) select nothing in the adapter data, whose
# answer scores lie in -9..40 and whose votes fall in 1995..2001.
TAGS3 = ["Customer#000000001", "Customer#000000002", "Customer#000000003"]
TAGS2 = ["Customer#000000001", "Customer#000000002"]
GAP = 40
NEW_YEARS = ("2000", "2001")
THRESHOLD_YEAR = "2000"
K = 10

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Callable[[ForumData], DataFrame]) -> Callable[[ForumData], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ForumData(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


def _questions(fd):
    return fd.posts.where(F.col("PostTypeId") == S.POST_TYPE_QUESTION)


# ------------------------------------------------------------ questions
@query
def q1_top_authors(fd):
    return Q.top_authors(fd.posts, fd.users, K)


@query
def q1_ties_all(fd):
    return Q.top_authors(fd.posts, fd.users, K, ties="all")


@query
def q1_keep_unmatched(fd):
    return Q.top_authors(fd.posts, fd.users, K, keep_unmatched=True)


@query
def q1_empty_sum_zero(fd):
    return Q.top_authors(fd.posts, fd.users, K, empty_sum=0)


@query
def q1_sql_form(fd):
    register_views(fd.tables("Posts", "Users"))
    return run_sql(fd.spark, sql_forms.q1(K))


@query
def q2_positive_answers(fd):
    return Q.positive_answers(fd.posts, K)


@query
def q2_sql_form(fd):
    register_views(fd.tables("Posts"))
    return run_sql(fd.spark, sql_forms.q2(K))


@query
def q3_top_question_per_year(fd):
    return Q.top_question_per_year(fd.posts, fd.votes)


@query
def q3_ties_all(fd):
    return Q.top_question_per_year(fd.posts, fd.votes, ties="all")


@query
def q3_sql_form(fd):
    register_views(fd.tables("Posts", "Votes"))
    return run_sql(fd.spark, sql_forms.q3())


@query
def q4_accepted_gap(fd):
    return Q.accepted_gap(fd.posts, GAP)


@query
def q4_sql_form(fd):
    register_views(fd.tables("Posts"))
    return run_sql(fd.spark, sql_forms.q4(GAP))


@query
def q5_author_comments(fd):
    return Q.author_comments(fd.posts, fd.comments, K)


@query
def q5_null_keys_match(fd):
    return Q.author_comments(fd.posts, fd.comments, K, null_keys="match")


@query
def q5_sql_form(fd):
    register_views(fd.tables("Posts", "Comments"))
    return run_sql(fd.spark, sql_forms.q5(K))


@query
def q6_rare_badge_users(fd):
    return Q.rare_badge_users(fd.users, fd.badges)


@query
def q6_sql_form(fd):
    register_views(fd.tables("Users", "Badges"))
    return run_sql(fd.spark, sql_forms.q6())


@query
def q7_old_votes_conditional(fd):
    return Q.old_votes_only(fd.posts, fd.votes, K, NEW_YEARS)


@query
def q7_old_votes_anti(fd):
    return Q.old_votes_anti(fd.posts, fd.votes, K, NEW_YEARS)


@query
def q7_old_votes_full_outer(fd):
    return Q.old_votes_full_outer(fd.posts, fd.votes, K, NEW_YEARS)


@query
def q7_threshold_rule(fd):
    return Q.old_votes_only(fd.posts, fd.votes, K, threshold=THRESHOLD_YEAR)


@query
def q7_sql_form(fd):
    register_views(fd.tables("Posts", "Votes"))
    return run_sql(fd.spark, sql_forms.q7(K, NEW_YEARS))


# ------------------------------------------------------------ activity
@query
def t1_tag_list(fd):
    return T.tag_list(fd.activity)


@query
def t2_date_spine(fd):
    return T.date_spine(fd.activity)


@query
def t3_series_long(fd):
    return T.series_long(fd.activity, TAGS3)


@query
def t3_series_tag_table(fd):
    """Every tag of the tag list, as a table, over every month."""
    return T.series_long(fd.activity, T.tag_list(fd.activity))


@query
def t3_series_one(fd):
    return T.series_one(fd.activity, TAGS3[0])


@query
def t4_series_wide(fd):
    return T.series_wide(fd.activity, TAGS3)


@query
def t5_topics_series(fd):
    return T.topics_series(fd.activity, TAGS2)


# ------------------------------------------------------------ sources
@query
def s1_csv_gz_round_trip(fd):
    """Users through gzipped CSV and back; DisplayName holds a '#' mid-line."""
    path = files.write_csv(S.conform(fd.users, S.USERS), scratch_path(fd.spark, "s1"), gzip=True)
    return files.read_commented_csv(fd.spark, path, S.USERS).select(
        "Id", "Reputation", "DisplayName", "Location", "Age")


@query
def s2_plain_csv(fd):
    path = files.write_csv(fd.activity.select("TagName", "Year", "Month"),
                           scratch_path(fd.spark, "s2"), gzip=False)
    return files.read_csv(fd.spark, path, S.ACTIVITY)


@query
def s8_topic_files_series(fd):
    """One activity file set per topic, read back as one frame with a Topic
    column, then the per-topic series in one job."""
    base = scratch_path(fd.spark, "s8")
    files.write_csv(fd.activity.select("TagName", "Year", "Month", "Topic"), base, gzip=False,
                    partition_by=["Topic"])
    # the topics are the folders that were written
    found = fd.spark.read.text(base).select("Topic").distinct().collect()
    topics = files.read_topics(fd.spark, {r[0]: f"{base}/Topic={r[0]}" for r in found})
    return T.topics_series(topics, TAGS2)


_XML_POST_COLS = ["Id", "PostTypeId", "ParentId", "AcceptedAnswerId", "CreationDate", "Score",
                  "OwnerUserId", "Title", "FavoriteCount"]


@query
def s3_xml_round_trip(fd):
    """Posts in the dump's XML shape (self-closing rows, absent attributes)."""
    posts = fd.posts.select(*_XML_POST_COLS)
    path = files.write_xml_rows(posts, scratch_path(fd.spark, "s3"), root_tag="posts")
    return files.read_xml_rows(fd.spark, path, posts.schema)


def _dump_tables(fd) -> dict[str, DataFrame]:
    """The seven tables of a dump, with columns that the conversion must drop."""
    page = F.concat(F.lit("<p>"), F.lit("a & b > c</p>"))
    posts = fd.posts.select(*_XML_POST_COLS)
    return {
        "Badges": fd.badges,
        "PostLinks": posts.where(F.col("AcceptedAnswerId").isNotNull()).select(
            "Id", F.col("Id").alias("PostId"), F.col("AcceptedAnswerId").alias("RelatedPostId")),
        "Posts": posts.withColumn("Body", page).withColumn("Tags", F.lit("<r><sql>")),
        "Tags": A.count_by(fd.activity, ["TagName"], "Count"),
        "Users": fd.users.withColumn("AboutMe", page),
        "Votes": fd.votes.select("PostId", "VoteTypeId", "CreationDate"),
        "Comments": fd.comments.select("PostId", "Score", "UserId").withColumn("Text", page)}


@query
def s4_convert_dump(fd):
    """All seven tables from gzipped XML to CSV without the listed columns; read back, each row as text."""
    spark = fd.spark
    base = scratch_path(spark, "s4")
    tables = _dump_tables(fd.unstored())
    xml = {n: files.write_xml_rows(df, f"{base}/xml/{n}", root_tag=n.lower(), gzip=True) for n, df in tables.items()}
    out = files.convert_dump(spark, xml, f"{base}/csv", {n: df.schema for n, df in tables.items()})
    back = {}
    for name, df in tables.items():
        kept = [c for c in df.columns if c not in S.DUMP_DROP_COLUMNS[name]]
        texts = files.read_csv(spark, out[name], ", ".join(f"{c} string" for c in kept))
        back[name] = texts.select(F.concat_ws("|", *(F.coalesce(c, F.lit("-")) for c in kept)).alias("Line"))
    return B.bind_rows(back, "Source")


@query
def s9_preview(fd):
    return preview(_questions(fd).select("Id", "Title"), K, [R.asc("Id")])


# ------------------------------------------------------------ projections and filters
@query
def p_project_rename_derive(fd):
    return _questions(fd).select(
        F.col("Id").alias("QuestionId"), "Title", F.col("OwnerUserId").alias("AuthorId"),
        C.year_text("CreationDate").alias("Year"))


@query
def p_filter_equal(fd):
    return fd.votes.where(F.col("VoteTypeId") == S.VOTE_TYPE_UP).select("PostId", "VoteTypeId")


@query
def p_filter_conjunction(fd):
    return fd.posts.where((F.col("PostTypeId") == S.POST_TYPE_ANSWER) & (F.col("Score") > 0)) \
        .select("Id", "ParentId", "Score")


@query
def p_filter_derived(fd):
    """Accepted answers beaten by a better one: Difference derived, then filtered."""
    return Q.accepted_gap(fd.posts, 0)


@query
def p_between_having(fd):
    gold = fd.badges.where(F.col("Class") == S.BADGE_CLASS_GOLD)
    return A.having_between(gold, ["Name"], 2, 10, "n")


@query
def j_semi(fd):
    gold = fd.badges.where(F.col("Class") == S.BADGE_CLASS_GOLD)
    names = A.having_between(gold, ["Name"], 2, 10, "n")
    return J.semi_join(gold, names, [("Name", "Name")]).select("UserId", "Name")


@query
def p_null_filter(fd):
    return _questions(fd).where(C.is_missing("FavoriteCount")).select("Id", "Title")


@query
def p_fill_columns(fd):
    return C.fill_columns(_questions(fd).select("Id", "FavoriteCount"), ["FavoriteCount"], 0)


@query
def p_fill_all(fd):
    return C.fill_all(fd.posts, 0, "0")


@query
def p_distinct(fd):
    return fd.badges.select("Name", "Class").distinct()


@query
def p_distinct_by_key(fd):
    """Users holding any class-1 badge, one row per user Id."""
    gold = fd.badges.where(F.col("Class") == S.BADGE_CLASS_GOLD)
    j = J.join_on(fd.users, gold, [("Id", "UserId")], left_alias="u", right_alias="b")
    return j.select("u.Id", "u.DisplayName", "u.Reputation", "u.Age", "u.Location") \
        .dropDuplicates(["Id"])


def _owner_best(fd, ties="first"):
    q = _questions(fd).where(F.col("OwnerUserId").isNotNull()) \
        .select("OwnerUserId", "Id", "Title", "FavoriteCount")
    if ties == "all":
        return R.rows_at_group_max(q, ["OwnerUserId"], "FavoriteCount", keep_missing=True)
    return R.top_per_group(q, ["OwnerUserId"], [R.desc("FavoriteCount")], 1, "first",
                           tiebreak=[R.asc("Id")])


@query
def p_bind_columns_keyed(fd):
    """Per-owner total and best title side by side: a keyed join, since a
    DataFrame has no row positions to bind on."""
    q = _questions(fd).where(F.col("OwnerUserId").isNotNull())
    totals = A.grouped_sum(q, ["OwnerUserId"], "FavoriteCount", "FavoriteTotal")
    best = _owner_best(fd).select("OwnerUserId", F.col("Title").alias("MostFavoriteQuestion"))
    return totals.join(best, "OwnerUserId")


@query
def p_zip_frames(fd):
    """Questions by id beside questions by title, row by row."""
    q = _questions(fd)
    return B.zip_frames(q.select(F.col("Id").alias("ById")).orderBy("ById"),
                        q.select(F.col("Title").alias("ByTitle"), F.col("Id").alias("TitleId")).orderBy("ByTitle", "TitleId"), "position")


# ------------------------------------------------------------ joins
def _positive_counts(fd):
    pos = fd.posts.where((F.col("PostTypeId") == S.POST_TYPE_ANSWER) & (F.col("Score") > 0))
    return A.count_by(pos, ["ParentId"], "PositiveAnswerCount")


@query
def j_inner_preaggregated(fd):
    j = J.join_on(_positive_counts(fd), fd.posts.select("Id", "Title"), [("ParentId", "Id")],
                  left_alias="c", right_alias="p")
    return j.select("p.Id", "p.Title", "c.PositiveAnswerCount")


def _comment_matches(fd, null_keys):
    sums = fd.comments.groupBy("PostId", "UserId").agg(F.sum("Score").alias("CommentsTotalScore"))
    q = _questions(fd).select("Id", "OwnerUserId", "Title")
    j = J.join_on(sums, q, [("PostId", "Id"), ("UserId", "OwnerUserId")], null_keys=null_keys,
                  left_alias="s", right_alias="q")
    return j.select("s.PostId", "q.Title", "s.CommentsTotalScore")


@query
def j_inner_two_keys(fd):
    return _comment_matches(fd, "sql")


@query
def j_null_safe(fd):
    return _comment_matches(fd, "match")


@query
def j_left_lookup(fd):
    j = J.left_outer(_questions(fd).select("Id", "OwnerUserId"), fd.users.select(F.col("Id").alias("UserId"), "DisplayName"),
                     [("OwnerUserId", "UserId")])
    return j.select("Id", "DisplayName")


def _one_tag_counts(fd, tag):
    dated = T.with_date(fd.activity)
    return A.count_by(dated.where(F.col("TagName") == tag), ["Date"], "Count")


@query
def j_right_outer(fd):
    """One tag's monthly counts right-joined to the spine, missing -> 0."""
    spine = T.with_date(fd.activity).select("Date").distinct()
    j = _one_tag_counts(fd, TAGS3[0]).join(spine, "Date", "right")
    return C.fill_columns(j.select("Date", "Count"), ["Count"], 0)


@query
def j_full_outer(fd):
    return Q.new_old_full_outer(fd.votes, NEW_YEARS)


@query
def j_full_outer_rows(fd):
    """Questions and users side by side on the owner: missing owners, owners without a user, users without a question."""
    return J.full_outer(_questions(fd).select("OwnerUserId", "Id", "Title"), fd.users.select("Id", "DisplayName"),
                        "OwnerUserId", "Id", out_key="UserId")


@query
def j_anti(fd):
    return Q.old_without_new(fd.votes, NEW_YEARS)


@query
def j_self(fd):
    """Answers beside their parent question: Posts joined to Posts."""
    j = J.join_on(fd.posts.where(F.col("PostTypeId") == S.POST_TYPE_ANSWER), _questions(fd),
                  [("ParentId", "Id")], left_alias="a", right_alias="q")
    return j.select(F.col("a.Id").alias("AnswerId"), F.col("q.Id").alias("QuestionId"),
                    F.col("q.Title").alias("QuestionTitle"), F.col("a.Score").alias("Score"))


@query
def j_chain(fd):
    """Best answer -> question -> accepted answer, every question with both."""
    return Q.accepted_gap(fd.posts, threshold=-(2 ** 62))


@query
def j_spine_cross(fd):
    """Every chosen tag x every month, then counts: the spine is an explode of
    the literal tag list over the distinct months, not a cartesian join."""
    dated = T.with_date(fd.activity)
    spine = J.spine(dated.select("Date").distinct(), TAGS3, "TagName")
    counts = A.count_by(dated.where(F.col("TagName").isin(TAGS3)), ["Date", "TagName"], "Count")
    j = spine.join(counts, ["Date", "TagName"], "left")
    return C.fill_columns(j, ["Count"], 0)


# ------------------------------------------------------------ aggregation and windows
@query
def a_max(fd):
    ans = fd.posts.where(F.col("PostTypeId") == S.POST_TYPE_ANSWER)
    return ans.groupBy("ParentId").agg(A.agg_expr("max", "Score").alias("MaxScore"))


@query
def a_count_multi_key(fd):
    return Q.up_votes_per_year(fd.votes)


@query
def a_group_by_alias(fd):
    register_views(fd.tables("Votes"))
    return run_sql(fd.spark, """
        SELECT PostId, date_format(CreationDate, 'yyyy') AS Year, COUNT(*) AS Count
        FROM Votes WHERE VoteTypeId = 2 GROUP BY PostId, Year""")


@query
def a_frequency_table(fd):
    gold = fd.badges.where(F.col("Class") == S.BADGE_CLASS_GOLD)
    return A.frequency_table(gold, "Name", "Freq")


@query
def w_first_per_group(fd):
    return _owner_best(fd, "first")


@query
def w_ties_per_group(fd):
    return _owner_best(fd, "all")


@query
def a_two_level(fd):
    """Counts per (post, vote age), then max and sum per post."""
    cls = Q.classified_up_votes(fd.votes, NEW_YEARS)
    per = A.count_by(cls, ["PostId", "VoteAge"], "Total")
    return per.groupBy("PostId").agg(F.max("Total").alias("MaxTotal"),
                                     F.sum("Total").alias("Votes"))


@query
def a_conditional(fd):
    return Q.new_old_counts(fd.votes, NEW_YEARS)


@query
def a_split_by_class(fd):
    """The per-class frames (new and old) stacked: (PostId, VoteAge, Total)."""
    return A.count_by(Q.classified_up_votes(fd.votes, NEW_YEARS), ["PostId", "VoteAge"], "Total")


@query
def a_split_frames(fd):
    """New and old votes as two frames from one pass; per frame the count of each post, bound again."""
    frames = B.split_frames(Q.classified_up_votes(fd.votes, NEW_YEARS), "VoteAge", ["new", "old"])
    return B.bind_rows({f"{age} votes": A.count_by(votes, ["PostId"], "Total") for age, votes in frames.items()}, "Frame")


@query
def a_pivot(fd):
    """Spark's own pivot with explicit values; the spine is every month seen."""
    dated = T.with_date(fd.activity)
    wide = dated.groupBy("Date").pivot("TagName", TAGS3).count()
    return C.fill_columns(wide, TAGS3, 0)


@query
def a_drop_null_keys(fd):
    return A.grouped_sum(fd.comments, ["PostId", "UserId"], "Score", "Total", drop_nulls=True)


@query
def w_group_max(fd):
    q = _questions(fd).select("Id", "OwnerUserId", "FavoriteCount")
    return R.with_group_max(q, ["OwnerUserId"], "FavoriteCount", "MaxFavorite")


@query
def w_residual_group(fd):
    """Max favourites per (owner, title), then the rows at the owner's max."""
    q = _questions(fd).where(F.col("OwnerUserId").isNotNull())
    per_title = q.groupBy("OwnerUserId", "Title").agg(
        F.max("FavoriteCount").alias("MostFavoriteQuestionLikes"))
    return R.rows_at_group_max(per_title, ["OwnerUserId"], "MostFavoriteQuestionLikes")


# ------------------------------------------------------------ sort and top-k
@query
def o_top_k_desc(fd):
    return R.top_k(_questions(fd).select("Id", "FavoriteCount"), K,
                   [R.desc("FavoriteCount"), R.asc("Id")])


@query
def o_top_k_tiebreak(fd):
    return R.top_k(_positive_counts(fd), K, [R.desc("PositiveAnswerCount"), R.desc("ParentId")])


@query
def o_top_k_asc(fd):
    return R.top_k(T.date_spine(fd.activity), K, [R.asc("Date")])


@query
def o_sort_whole(fd):
    """A full distributed sort (range partitioned), no limit."""
    return _positive_counts(fd).orderBy(R.desc("PositiveAnswerCount"), R.desc("ParentId"))


# ------------------------------------------------------------ comparison
@query
def u_frames_equal_diff(fd):
    """Rows that ties='all' adds over ties='first': extra rows of the diff."""
    return frames_diff(_owner_best(fd, "first"), _owner_best(fd, "all"))


@query
def u_positions_by_tie_order(fd):
    """The same ranking with ties broken two ways: rows whose position
    differs (the tie-order mismatch of unordered comparisons, made visible
    by the ordered mode of the comparison)."""
    counts = _positive_counts(fd)
    a = R.with_position(counts, [R.desc("PositiveAnswerCount"), R.desc("ParentId")])
    b = R.with_position(counts, [R.desc("PositiveAnswerCount"), R.asc("ParentId")])
    return frames_diff(a, b)


@query
def u_ordered_diff(fd):
    """The same ranking delivered in two tie orders, compared position by position."""
    counts = _positive_counts(fd)
    return frames_diff(counts.orderBy(R.desc("PositiveAnswerCount"), R.desc("ParentId")),
                       counts.orderBy(R.desc("PositiveAnswerCount"), R.asc("ParentId")), ordered=True)


@query
def u_bind_rows(fd):
    """Questions and users without a question, one below the other, with where they came from."""
    lonely = J.anti_join(fd.users.select("Id"), _questions(fd), [("Id", "OwnerUserId")])
    return B.bind_rows({"question": _questions(fd).select("Id", "Title"), "user": lonely}, "Kind", missing_columns=True)


# ------------------------------------------------------------ scalar functions
@query
def c_year_text(fd):
    return fd.votes.select("PostId", C.year_text("CreationDate").alias("Year"))


@query
def c_year_prefix(fd):
    return fd.votes.select("PostId", C.year_prefix(F.col("CreationDate").cast("string")).alias("Year"))


@query
def c_age_class(fd):
    return Q.classified_up_votes(fd.votes, NEW_YEARS)


@query
def c_age_threshold(fd):
    return Q.classified_up_votes(fd.votes, threshold=THRESHOLD_YEAR)


@query
def c_month_key(fd):
    return fd.activity.select("TagName", C.month_key("Year", "Month").alias("Date"))


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
