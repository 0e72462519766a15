"""The seven questions, DataFrame form.

Canonical semantics are those of the SQL text plus a total tie-break (the
post or user id), so every result is deterministic. Dialect differences of
the reference are parameters: ``ties``, ``null_keys``, ``keep_unmatched``,
``empty_sum``, ``new_years`` / ``threshold``.

Plan shape used by every top-k question: aggregate (partial, map-side),
keep the groups whose key exists with a semi join that carries only keys
and numbers, take the top k (TakeOrderedAndProject: k rows per task), and
only then join wide payload columns (titles, names) to those k rows. No join
is hinted: Spark sizes a limited side in bytes and AQE re-plans from real
sizes, so plans and rows do not depend on a row count measured here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import age_class, age_threshold, year_text
from ..operators.aggregates import conditional_counts, count_by, rows_in_groups_sized
from ..operators.joins import join_on, semi_join
from ..operators.ranking import asc, desc, rows_at_group_max, top_k, top_per_group


def _questions(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("PostTypeId") == S.POST_TYPE_QUESTION)


def _answers(posts: DataFrame) -> DataFrame:
    return posts.where(F.col("PostTypeId") == S.POST_TYPE_ANSWER)


def lookup(rows: DataFrame, dim: DataFrame, on: list[tuple[str, str]], keep_unmatched: bool = False,
           null_keys: str = "sql") -> DataFrame:
    """Payload columns for ``rows``; columns come back as ``_r.*`` and ``_d.*``."""
    return join_on(rows, dim, on, "left" if keep_unmatched else "inner", null_keys,
                   left_alias="_r", right_alias="_d")


# ---------------------------------------------------------------- Q1
def top_authors(posts: DataFrame, users: DataFrame, k: int = 10, ties: str = "first",
                keep_unmatched: bool = False, empty_sum=None) -> DataFrame:
    """Q1: the k question authors with most favourites, and their most liked
    question. With ``ties="all"`` every tied question is a row and the k
    counts rows."""
    if ties not in ("first", "all"):
        raise ValueError("ties must be 'first' or 'all'")
    q = (_questions(posts).where(F.col("OwnerUserId").isNotNull())
         .select("Id", "OwnerUserId", "FavoriteCount", "Title"))
    total = F.sum("FavoriteCount")
    if empty_sum is not None:
        total = F.coalesce(total, F.lit(empty_sum))
    per_owner = q.groupBy("OwnerUserId").agg(total.alias("FavoriteTotal"), F.max("FavoriteCount").alias("MaxFavorite"))
    if not keep_unmatched:
        per_owner = semi_join(per_owner, users, [("OwnerUserId", "Id")])
    owners = top_k(per_owner, k, [desc("FavoriteTotal"), asc("OwnerUserId")])
    # Every question at its owner's maximum, for the k owners only; a
    # missing maximum ties with missing values, as RANK does.
    tied = q.alias("_q").join(owners.alias("_o"), (F.col("_q.OwnerUserId") == F.col("_o.OwnerUserId"))
                              & F.col("_q.FavoriteCount").eqNullSafe(F.col("_o.MaxFavorite")))
    tied = tied.select("_q.OwnerUserId", "_o.FavoriteTotal", "_q.Id", "_q.Title", "_q.FavoriteCount")
    if ties == "first":
        first = F.min(F.struct("Id", "Title")).alias("first")
        rows = tied.groupBy("OwnerUserId", "FavoriteTotal", "FavoriteCount").agg(first).select(
            "OwnerUserId", "FavoriteTotal", "FavoriteCount", "first.Id", "first.Title")
    else:
        rows = top_k(tied, k, [desc("FavoriteTotal"), asc("OwnerUserId"), asc("Id")])
    out = lookup(rows, users.select("Id", "DisplayName", "Age", "Location"), [("OwnerUserId", "Id")], keep_unmatched)
    out = top_k(out, k, [desc("_r.FavoriteTotal"), asc("_r.OwnerUserId"), asc("_r.Id")])
    return out.select(
        F.col("_d.DisplayName").alias("DisplayName"), F.col("_d.Age").alias("Age"),
        F.col("_d.Location").alias("Location"), F.col("_r.FavoriteTotal").alias("FavoriteTotal"),
        F.col("_r.Title").alias("MostFavoriteQuestion"),
        F.col("_r.FavoriteCount").alias("MostFavoriteQuestionLikes"))


# ---------------------------------------------------------------- Q2
def positive_answers(posts: DataFrame, k: int = 10) -> DataFrame:
    """Q2: the k posts with most positively scored answers (ties: higher Id first)."""
    pos = _answers(posts).where(F.col("Score") > 0)
    counts = count_by(pos, ["ParentId"], "PositiveAnswerCount")
    counts = semi_join(counts, posts, [("ParentId", "Id")])
    top = top_k(counts, k, [desc("PositiveAnswerCount"), desc("ParentId")])
    out = lookup(top, posts.select("Id", "Title"), [("ParentId", "Id")])
    out = top_k(out, k, [desc("_r.PositiveAnswerCount"), desc("_r.ParentId")])
    return out.select(F.col("_d.Id").alias("Id"), F.col("_d.Title").alias("Title"),
                      F.col("_r.PositiveAnswerCount").alias("PositiveAnswerCount"))


# ---------------------------------------------------------------- Q3
def up_votes_per_year(votes: DataFrame) -> DataFrame:
    up = votes.where(F.col("VoteTypeId") == S.VOTE_TYPE_UP)
    return count_by(up, ["PostId", year_text("CreationDate").alias("Year")], "Count")


def top_question_per_year(posts: DataFrame, votes: DataFrame, ties: str = "first") -> DataFrame:
    """Q3: per year, the question with most up-votes cast in that year."""
    counts = semi_join(up_votes_per_year(votes), _questions(posts), [("PostId", "Id")])
    q = _questions(posts).select("Id", "Title")
    if ties == "all":
        best = rows_at_group_max(counts, ["Year"], "Count", keep_missing=True)
    else:
        best = top_per_group(counts, ["Year"], [desc("Count")], 1, "first",
                             tiebreak=[asc("PostId")])
    out = lookup(best, q, [("PostId", "Id")]).orderBy(asc("_r.Year"), asc("_r.PostId"))
    return out.select(F.col("_d.Title").alias("Title"), F.col("_r.Year").alias("Year"),
                      F.col("_r.Count").alias("Count"))


# ---------------------------------------------------------------- Q4
def accepted_gap(posts: DataFrame, threshold: int = 50) -> DataFrame:
    """Q4: questions whose best answer beats the accepted one by more than
    ``threshold``. The accepted side is any post with that Id.

    The joins carry ids and scores only; titles are fetched for the rows
    that pass the gap filter, so question titles are not moved through the
    two join shuffles.
    """
    best = _answers(posts).groupBy("ParentId").agg(F.max("Score").alias("MaxScore"))
    q = _questions(posts).select("Id", "AcceptedAnswerId")
    qb = join_on(q, best, [("Id", "ParentId")], left_alias="_q", right_alias="_b").select(
        "_q.Id", "_q.AcceptedAnswerId", "_b.MaxScore")
    acc = join_on(qb, posts.select("Id", "Score"), [("AcceptedAnswerId", "Id")],
                  left_alias="_x", right_alias="_a")
    gaps = acc.select(F.col("_x.Id").alias("Id"), F.col("_x.MaxScore").alias("MaxScore"),
                      F.col("_a.Score").alias("AcceptedScore"),
                      (F.col("_x.MaxScore") - F.col("_a.Score")).alias("Difference")) \
        .where(F.col("Difference") > threshold)
    out = lookup(gaps, _questions(posts).select("Id", "Title"), [("Id", "Id")])
    res = out.select(F.col("_r.Id").alias("Id"), F.col("_d.Title").alias("Title"),
                     F.col("_r.MaxScore").alias("MaxScore"),
                     F.col("_r.AcceptedScore").alias("AcceptedScore"),
                     F.col("_r.Difference").alias("Difference"))
    return res.orderBy(desc("Difference"), asc("Id"))


# ---------------------------------------------------------------- Q5
def author_comments(posts: DataFrame, comments: DataFrame, k: int = 10,
                    null_keys: str = "sql") -> DataFrame:
    """Q5: the k questions whose author earned most comment score under them.

    ``null_keys="match"`` lets a question without owner match the comments
    of removed users (dplyr / data.table behaviour)."""
    sums = comments.groupBy("PostId", "UserId").agg(F.sum("Score").alias("CommentsTotalScore"))
    q = _questions(posts).select("Id", "OwnerUserId", "Title")
    on = [("PostId", "Id"), ("UserId", "OwnerUserId")]
    matched = join_on(sums, q.select("Id", "OwnerUserId"), on, "left_semi", null_keys,
                      left_alias="_s", right_alias="_q")
    top = top_k(matched, k, [desc("CommentsTotalScore"), asc("PostId")])
    out = lookup(top, q, on, null_keys=null_keys)
    out = top_k(out, k, [desc("_r.CommentsTotalScore"), asc("_r.PostId")])
    return out.select(F.col("_d.Title").alias("Title"),
                      F.col("_r.CommentsTotalScore").alias("CommentsTotalScore"))


# ---------------------------------------------------------------- Q6
def rare_badge_users(users: DataFrame, badges: DataFrame, low: int = 2, high: int = 10,
                     badge_class: int = S.BADGE_CLASS_GOLD) -> DataFrame:
    """Q6: users holding a badge of ``badge_class`` whose name was awarded
    ``low``..``high`` times in that class. The qualifying badges come from
    ``rows_in_groups_sized`` (no join back over all badges, a hot badge name
    is cut before the shuffle); a semi join on the unique user Id gives
    each user once, which is what DISTINCT did over the inner join."""
    gold = badges.where(F.col("Class") == badge_class).select("Name", "UserId")
    valuable = rows_in_groups_sized(gold, ["Name"], low, high, [asc("UserId")])
    return semi_join(users, valuable, [("Id", "UserId")]).select(
        "Id", "DisplayName", "Reputation", "Age", "Location")


# ---------------------------------------------------------------- Q7
def classified_up_votes(votes: DataFrame, new_years=("2016", "2017"),
                        threshold: str | None = None) -> DataFrame:
    up = votes.where(F.col("VoteTypeId") == S.VOTE_TYPE_UP)
    year = year_text("CreationDate")
    cls = age_threshold(year, threshold) if threshold is not None else age_class(year, new_years)
    return up.select("PostId", cls.alias("VoteAge"))


def new_old_counts(votes: DataFrame, new_years=("2016", "2017"), threshold=None) -> DataFrame:
    """(PostId, NewVotes, OldVotes) in one conditional aggregation."""
    return conditional_counts(classified_up_votes(votes, new_years, threshold), ["PostId"],
                              "VoteAge", {"NewVotes": "new", "OldVotes": "old"})


def _finish_q7(only_old: DataFrame, posts: DataFrame, k: int) -> DataFrame:
    q = _questions(posts).select("Id", "Title")
    cand = semi_join(only_old, q, [("PostId", "Id")])
    top = top_k(cand, k, [desc("OldVotes"), asc("PostId")])
    out = lookup(top, q, [("PostId", "Id")])
    out = top_k(out, k, [desc("_r.OldVotes"), asc("_r.PostId")])
    return out.select(F.col("_d.Title").alias("Title"), F.col("_r.OldVotes").alias("OldVotes"))


def old_votes_only(posts: DataFrame, votes: DataFrame, k: int = 10, new_years=("2016", "2017"),
                   threshold: str | None = None) -> DataFrame:
    """Q7: the k questions with most old up-votes and no new ones."""
    counts = new_old_counts(votes, new_years, threshold)
    only_old = counts.where((F.col("NewVotes") == 0) & (F.col("OldVotes") > 0))
    return _finish_q7(only_old.select("PostId", "OldVotes"), posts, k)


def old_votes_anti(posts: DataFrame, votes: DataFrame, k: int = 10,
                   new_years=("2016", "2017")) -> DataFrame:
    """Q7 through an anti join: old-vote counts of posts that have no new vote."""
    return _finish_q7(old_without_new(votes, new_years), posts, k)


def old_without_new(votes: DataFrame, new_years=("2016", "2017")) -> DataFrame:
    cls = classified_up_votes(votes, new_years)
    old = count_by(cls.where(F.col("VoteAge") == "old"), ["PostId"], "OldVotes")
    new_posts = cls.where(F.col("VoteAge") == "new").select("PostId")
    return old.join(new_posts, "PostId", "left_anti")


def new_old_full_outer(votes: DataFrame, new_years=("2016", "2017")) -> DataFrame:
    """New and old counts side by side through a full outer join, 0 where absent."""
    cls = classified_up_votes(votes, new_years)
    new = count_by(cls.where(F.col("VoteAge") == "new"), ["PostId"], "NewVotes")
    old = count_by(cls.where(F.col("VoteAge") == "old"), ["PostId"], "OldVotes")
    j = new.alias("_n").join(old.alias("_o"), F.col("_n.PostId") == F.col("_o.PostId"), "full")
    return j.select(F.coalesce("_n.PostId", "_o.PostId").alias("PostId"),
                    F.coalesce("_n.NewVotes", F.lit(0)).alias("NewVotes"),
                    F.coalesce("_o.OldVotes", F.lit(0)).alias("OldVotes"))


def old_votes_full_outer(posts: DataFrame, votes: DataFrame, k: int = 10,
                         new_years=("2016", "2017")) -> DataFrame:
    """Q7 through the full outer join of the new and old frames."""
    fo = new_old_full_outer(votes, new_years)
    return _finish_q7(fo.where(F.col("NewVotes") == 0).select("PostId", "OldVotes"), posts, k)
