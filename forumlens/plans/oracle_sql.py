"""Oracle SQL (DuckDB dialect) for every registered query.

Only the driver's base tables exist in the oracle, so each statement starts
with the adapter views of FIXTURES.md written as CTEs. The SQL is written on
its own from the definitions, not generated from the Spark plans. Sums are
cast to BIGINT (DuckDB widens them to HUGEINT) and every NULL order is
spelled out (DuckDB puts NULLs last in both directions).
"""

from __future__ import annotations

from .registry import GAP, K, NEW_YEARS, TAGS2, TAGS3, THRESHOLD_YEAR

ADAPTERS = """
WITH
users AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS Id, c.c_acctbal AS Reputation,
         c.c_name AS DisplayName, n.n_name AS Location,
         CAST(CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE 18 + c.c_custkey % 60 END AS INTEGER) AS Age
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
questions AS (
  SELECT CAST(o_orderkey * 10 AS BIGINT) AS Id, 1 AS PostTypeId, CAST(NULL AS BIGINT) AS ParentId,
         CAST(CASE WHEN o_orderstatus = 'F' THEN o_orderkey * 10 + 1 END AS BIGINT) AS AcceptedAnswerId,
         o_orderdate AS CreationDate, CAST(0 AS BIGINT) AS Score,
         CAST(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS BIGINT) AS OwnerUserId,
         'Order ' || CAST(o_orderkey AS VARCHAR) || ' ' || o_orderpriority AS Title,
         CAST(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE floor(o_totalprice / 50000) END AS BIGINT) AS FavoriteCount
  FROM orders),
answers AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS Id, 2 AS PostTypeId,
         CAST(l_orderkey * 10 AS BIGINT) AS ParentId, CAST(NULL AS BIGINT) AS AcceptedAnswerId,
         CAST(NULL AS TIMESTAMP) AS CreationDate,
         CAST(floor(max(l_quantity)) AS BIGINT) - 10 AS Score,
         CAST(min(l_suppkey) AS BIGINT) AS OwnerUserId, CAST(NULL AS VARCHAR) AS Title,
         CAST(NULL AS BIGINT) AS FavoriteCount
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
posts AS (SELECT * FROM questions UNION ALL SELECT * FROM answers),
votes AS (
  SELECT CAST(l_orderkey * 10 AS BIGINT) AS PostId,
         CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 3 ELSE 5 END AS VoteTypeId,
         l_shipdate AS CreationDate
  FROM lineitem),
comments AS (
  SELECT CAST(l_orderkey * 10 AS BIGINT) AS PostId, CAST(floor(l_quantity) AS BIGINT) AS Score,
         CAST(CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_suppkey END AS BIGINT) AS UserId
  FROM lineitem),
badges AS (
  SELECT CAST(p_partkey AS BIGINT) AS UserId, p_brand || ' ' || p_type AS Name,
         CAST(p_size % 3 + 1 AS INTEGER) AS Class
  FROM part),
activity AS (
  SELECT c.c_name AS TagName, CAST(year(o.o_orderdate) AS INTEGER) AS Year,
         CAST(month(o.o_orderdate) AS INTEGER) AS Month, o.o_orderstatus AS Topic
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
dated AS (
  SELECT TagName, Topic,
         CAST(Year AS VARCHAR) || '-' || lpad(CAST(Month AS VARCHAR), 2, '0') AS Date
  FROM activity)
"""


def _lst(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _with(body: str) -> str:
    return ADAPTERS + body


def _q1(ties="first", keep_unmatched=False, empty_sum=False) -> str:
    total = "CAST(COALESCE(SUM(FavoriteCount), 0) AS BIGINT)" if empty_sum \
        else "CAST(SUM(FavoriteCount) AS BIGINT)"
    fn = ("ROW_NUMBER() OVER (PARTITION BY OwnerUserId ORDER BY FavoriteCount DESC NULLS LAST, Id)"
          if ties == "first" else
          "RANK() OVER (PARTITION BY OwnerUserId ORDER BY FavoriteCount DESC NULLS LAST)")
    join = "LEFT JOIN" if keep_unmatched else "JOIN"
    return _with(f"""
, q AS (SELECT Id, OwnerUserId, FavoriteCount, Title FROM posts
        WHERE PostTypeId = 1 AND OwnerUserId IS NOT NULL),
per_owner AS (SELECT OwnerUserId, {total} AS FavoriteTotal FROM q GROUP BY OwnerUserId),
ranked AS (SELECT *, {fn} AS rk FROM q)
SELECT u.DisplayName, u.Age, u.Location, p.FavoriteTotal,
       r.Title AS MostFavoriteQuestion, r.FavoriteCount AS MostFavoriteQuestionLikes
FROM per_owner p
JOIN ranked r ON r.OwnerUserId = p.OwnerUserId AND r.rk = 1
{join} users u ON u.Id = p.OwnerUserId
ORDER BY p.FavoriteTotal DESC NULLS LAST, p.OwnerUserId, r.Id
LIMIT {K}""")


Q2 = _with(f"""
, liked AS (SELECT ParentId AS pid, count(*) AS PositiveAnswerCount FROM posts
            WHERE PostTypeId = 2 AND Score > 0 GROUP BY ALL)
SELECT p.Id, p.Title, liked.PositiveAnswerCount
FROM liked, posts p WHERE p.Id = liked.pid
ORDER BY 3 DESC, 1 DESC
LIMIT {K}""")


def _q3(ties="first") -> str:
    rank = ("row_number() OVER (PARTITION BY y.Year ORDER BY y.Count DESC, y.PostId)"
            if ties == "first" else "rank() OVER (PARTITION BY y.Year ORDER BY y.Count DESC)")
    return _with(f"""
, y AS (SELECT PostId, strftime(CreationDate, '%Y') AS Year, count(*) AS Count
        FROM votes WHERE VoteTypeId = 2 GROUP BY ALL)
SELECT q.Title, y.Year, y.Count
FROM y, posts q WHERE q.Id = y.PostId AND q.PostTypeId = 1
QUALIFY {rank} = 1""")


def _q4(threshold) -> str:
    return _with(f"""
, mx AS (SELECT ParentId AS qid, max(Score) AS MaxScore FROM posts WHERE PostTypeId = 2
         GROUP BY ALL)
SELECT q.Id, q.Title, mx.MaxScore, acc.Score AS AcceptedScore, mx.MaxScore - acc.Score AS Difference
FROM posts q, mx, posts acc
WHERE q.PostTypeId = 1 AND mx.qid = q.Id AND acc.Id = q.AcceptedAnswerId
  AND mx.MaxScore - acc.Score > {threshold}""")


def _comment_sums() -> str:
    return """, cs AS (SELECT PostId, UserId, CAST(SUM(Score) AS BIGINT) AS CommentsTotalScore
          FROM comments GROUP BY PostId, UserId)"""


def _q5(null_safe=False) -> str:
    eq = "IS NOT DISTINCT FROM" if null_safe else "="
    return _with(f"""{_comment_sums()}
SELECT p.Title, cs.CommentsTotalScore
FROM cs JOIN posts p ON p.Id = cs.PostId AND p.OwnerUserId {eq} cs.UserId
WHERE p.PostTypeId = 1
ORDER BY cs.CommentsTotalScore DESC, cs.PostId
LIMIT {K}""")


Q6 = _with("""
, gold AS (SELECT UserId, Name FROM badges WHERE Class = 1),
rare AS (SELECT Name FROM gold GROUP BY Name HAVING count(*) BETWEEN 2 AND 10)
SELECT u.Id, u.DisplayName, u.Reputation, u.Age, u.Location FROM users u
WHERE EXISTS (SELECT 1 FROM gold g JOIN rare r ON r.Name = g.Name WHERE g.UserId = u.Id)""")


def _vote_class(threshold=None) -> str:
    if threshold is not None:
        return (f"CASE WHEN strftime(CreationDate, '%Y') >= '{threshold}' THEN 'new' "
                f"WHEN strftime(CreationDate, '%Y') < '{threshold}' THEN 'old' END")
    whens = " ".join(f"WHEN '{y}' THEN 'new'" for y in NEW_YEARS)
    return f"CASE strftime(CreationDate, '%Y') {whens} ELSE 'old' END"


def _classified(threshold=None) -> str:
    return f""", cls AS (SELECT PostId, {_vote_class(threshold)} AS VoteAge
          FROM votes WHERE VoteTypeId = 2)"""


def _q7(threshold=None) -> str:
    return _with(f"""{_classified(threshold)},
per_post AS (SELECT PostId, count(*) FILTER (WHERE VoteAge = 'new') AS n_new,
                    count(*) FILTER (WHERE VoteAge = 'old') AS OldVotes
             FROM cls GROUP BY PostId)
SELECT p.Title, per_post.OldVotes FROM per_post, posts p
WHERE p.Id = per_post.PostId AND p.PostTypeId = 1 AND per_post.n_new = 0 AND per_post.OldVotes > 0
ORDER BY per_post.OldVotes DESC, per_post.PostId
LIMIT {K}""")


def _spine_long(tags, by_topic=False) -> str:
    topic = "Topic, " if by_topic else ""
    topic_on = "AND c.Topic = s.Topic " if by_topic else ""
    tag_rows = ", ".join(f"({_lst([t])})" for t in tags)
    return _with(f"""
, spine AS (SELECT DISTINCT {topic}Date FROM dated),
tags(TagName) AS (VALUES {tag_rows}),
cnt AS (SELECT {topic}Date, TagName, COUNT(*) AS Count FROM dated
        WHERE TagName IN ({_lst(tags)}) GROUP BY {topic}Date, TagName)
SELECT {"s.Topic, " if by_topic else ""}s.Date, t.TagName, COALESCE(c.Count, 0) AS Count
FROM spine s CROSS JOIN tags t
LEFT JOIN cnt c ON c.Date = s.Date {topic_on}AND c.TagName = t.TagName""")


def _series_wide(tags) -> str:
    joins, cols = [], []
    for i, t in enumerate(tags):
        joins.append(f"LEFT JOIN (SELECT Date, COUNT(*) AS n FROM dated WHERE TagName = {_lst([t])} "
                     f"GROUP BY Date) c{i} ON c{i}.Date = s.Date")
        cols.append(f"COALESCE(c{i}.n, 0) AS {_q(t)}")
    return _with(f"""
, spine AS (SELECT DISTINCT Date FROM dated)
SELECT s.Date, {", ".join(cols)} FROM spine s
{chr(10).join(joins)}""")


POS_COUNTS = """, pc AS (SELECT ParentId, COUNT(*) AS PositiveAnswerCount FROM posts
          WHERE PostTypeId = 2 AND Score > 0 GROUP BY ParentId)"""

OWNER_RANKED = """, oq AS (SELECT OwnerUserId, Id, Title, FavoriteCount FROM posts
          WHERE PostTypeId = 1 AND OwnerUserId IS NOT NULL),
ob AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY OwnerUserId
                                    ORDER BY FavoriteCount DESC NULLS LAST, Id) AS rn,
                 RANK() OVER (PARTITION BY OwnerUserId
                              ORDER BY FavoriteCount DESC NULLS LAST) AS rk
       FROM oq)"""

_XML_POST_COLS = "Id, PostTypeId, ParentId, AcceptedAnswerId, CreationDate, Score, OwnerUserId, Title, FavoriteCount"

ORACLE: dict[str, str] = {
    "q1_top_authors": _q1(),
    "q1_ties_all": _q1(ties="all"),
    "q1_keep_unmatched": _q1(keep_unmatched=True),
    "q1_empty_sum_zero": _q1(empty_sum=True),
    "q1_sql_form": _q1(),
    "q2_positive_answers": Q2,
    "q2_sql_form": Q2,
    "q3_top_question_per_year": _q3(),
    "q3_ties_all": _q3("all"),
    "q3_sql_form": _q3(),
    "q4_accepted_gap": _q4(GAP),
    "q4_sql_form": _q4(GAP),
    "q5_author_comments": _q5(),
    "q5_null_keys_match": _q5(null_safe=True),
    "q5_sql_form": _q5(),
    "q6_rare_badge_users": Q6,
    "q6_sql_form": Q6,
    "q7_old_votes_conditional": _q7(),
    "q7_old_votes_anti": _q7(),
    "q7_old_votes_full_outer": _q7(),
    "q7_threshold_rule": _q7(THRESHOLD_YEAR),
    "q7_sql_form": _q7(),
    "t1_tag_list": _with("SELECT DISTINCT TagName FROM activity"),
    "t2_date_spine": _with("SELECT DISTINCT Date FROM dated ORDER BY Date"),
    "t3_series_long": _spine_long(TAGS3),
    "t3_series_tag_table": _with("""
, months AS (SELECT DISTINCT Date FROM dated), tags AS (SELECT DISTINCT TagName FROM dated)
SELECT m.Date, t.TagName, COUNT(d.Date) AS Count
FROM months m CROSS JOIN tags t LEFT JOIN dated d ON d.Date = m.Date AND d.TagName = t.TagName
GROUP BY m.Date, t.TagName"""),
    "t3_series_one": _with(f"""
, spine AS (SELECT DISTINCT Date FROM dated),
cnt AS (SELECT Date, COUNT(*) AS Count FROM dated WHERE TagName = {_lst(TAGS3[:1])} GROUP BY Date)
SELECT s.Date, COALESCE(c.Count, 0) AS Count FROM spine s LEFT JOIN cnt c ON c.Date = s.Date"""),
    "t4_series_wide": _series_wide(TAGS3),
    "t5_topics_series": _spine_long(TAGS2, by_topic=True),
    "s8_topic_files_series": _spine_long(TAGS2, by_topic=True),
    "s1_csv_gz_round_trip": _with("SELECT Id, Reputation, DisplayName, Location, Age FROM users"),
    "s2_plain_csv": _with("SELECT TagName, Year, Month FROM activity"),
    "s3_xml_round_trip": _with(f"SELECT {_XML_POST_COLS} FROM posts"),
    "s4_convert_dump": _with("""
, ts AS (SELECT *, strftime(CreationDate, '%Y-%m-%dT%H:%M:%S.%g') AS Made FROM posts),
vt AS (SELECT *, strftime(CreationDate, '%Y-%m-%dT%H:%M:%S.%g') AS Made FROM votes),
lines AS (
SELECT 'Badges' AS Source, [CAST(UserId AS VARCHAR), Name, CAST(Class AS VARCHAR)] AS v FROM badges
UNION ALL SELECT 'PostLinks', [CAST(Id AS VARCHAR), CAST(Id AS VARCHAR), CAST(AcceptedAnswerId AS VARCHAR)]
FROM posts WHERE AcceptedAnswerId IS NOT NULL
UNION ALL SELECT 'Posts', [CAST(Id AS VARCHAR), CAST(PostTypeId AS VARCHAR), CAST(ParentId AS VARCHAR),
  CAST(AcceptedAnswerId AS VARCHAR), Made, CAST(Score AS VARCHAR), CAST(OwnerUserId AS VARCHAR), Title,
  CAST(FavoriteCount AS VARCHAR)] FROM ts
UNION ALL SELECT 'Tags', [TagName, CAST(COUNT(*) AS VARCHAR)] FROM activity GROUP BY TagName
UNION ALL SELECT 'Users', [CAST(Id AS VARCHAR), CAST(Reputation AS VARCHAR), DisplayName, Location,
  CAST(Age AS VARCHAR)] FROM users
UNION ALL SELECT 'Votes', [CAST(PostId AS VARCHAR), CAST(VoteTypeId AS VARCHAR), Made] FROM vt
UNION ALL SELECT 'Comments', [CAST(PostId AS VARCHAR), CAST(Score AS VARCHAR), CAST(UserId AS VARCHAR)] FROM comments)
SELECT Source, array_to_string(list_transform(v, lambda x: COALESCE(x, '-')), '|') AS Line FROM lines"""),
    "s9_preview": _with(f"SELECT Id, Title FROM posts WHERE PostTypeId = 1 ORDER BY Id LIMIT {K}"),
    "p_project_rename_derive": _with("""
SELECT Id AS QuestionId, Title, OwnerUserId AS AuthorId, strftime(CreationDate, '%Y') AS Year
FROM posts WHERE PostTypeId = 1"""),
    "p_filter_equal": _with("SELECT PostId, VoteTypeId FROM votes WHERE VoteTypeId = 2"),
    "p_filter_conjunction": _with(
        "SELECT Id, ParentId, Score FROM posts WHERE PostTypeId = 2 AND Score > 0"),
    "p_filter_derived": _q4(0),
    "p_between_having": _with("""
SELECT Name, COUNT(*) AS n FROM badges WHERE Class = 1 GROUP BY Name
HAVING COUNT(*) BETWEEN 2 AND 10"""),
    "j_semi": _with("""
SELECT UserId, Name FROM badges
WHERE Class = 1 AND Name IN (SELECT Name FROM badges WHERE Class = 1 GROUP BY Name
                             HAVING COUNT(*) BETWEEN 2 AND 10)"""),
    "p_null_filter": _with(
        "SELECT Id, Title FROM posts WHERE PostTypeId = 1 AND FavoriteCount IS NULL"),
    "p_fill_columns": _with(
        "SELECT Id, COALESCE(FavoriteCount, 0) AS FavoriteCount FROM posts WHERE PostTypeId = 1"),
    "p_fill_all": _with("""
SELECT Id, PostTypeId, COALESCE(ParentId, 0) AS ParentId, COALESCE(AcceptedAnswerId, 0) AS AcceptedAnswerId,
       COALESCE(CreationDate, TIMESTAMP '1970-01-01') AS CreationDate, Score, COALESCE(OwnerUserId, 0) AS OwnerUserId,
       COALESCE(Title, '0') AS Title, COALESCE(FavoriteCount, 0) AS FavoriteCount
FROM posts"""),
    "p_distinct": _with("SELECT DISTINCT Name, Class FROM badges"),
    "p_distinct_by_key": _with("""
SELECT DISTINCT u.Id, u.DisplayName, u.Reputation, u.Age, u.Location
FROM users u JOIN badges b ON b.UserId = u.Id WHERE b.Class = 1"""),
    "p_bind_columns_keyed": _with(f"""{OWNER_RANKED}
SELECT t.OwnerUserId, t.FavoriteTotal, ob.Title AS MostFavoriteQuestion
FROM (SELECT OwnerUserId, CAST(SUM(FavoriteCount) AS BIGINT) AS FavoriteTotal FROM oq
      GROUP BY OwnerUserId) t
JOIN ob ON ob.OwnerUserId = t.OwnerUserId AND ob.rn = 1"""),
    "j_inner_preaggregated": _with(f"""{POS_COUNTS}
SELECT p.Id, p.Title, pc.PositiveAnswerCount FROM pc JOIN posts p ON p.Id = pc.ParentId"""),
    "j_inner_two_keys": _with(f"""{_comment_sums()}
SELECT cs.PostId, q.Title, cs.CommentsTotalScore
FROM cs JOIN questions q ON q.Id = cs.PostId AND q.OwnerUserId = cs.UserId"""),
    "j_null_safe": _with(f"""{_comment_sums()}
SELECT cs.PostId, q.Title, cs.CommentsTotalScore
FROM cs JOIN questions q ON q.Id = cs.PostId AND q.OwnerUserId IS NOT DISTINCT FROM cs.UserId"""),
    "j_left_lookup": _with("""
SELECT q.Id, u.DisplayName FROM questions q LEFT JOIN users u ON u.Id = q.OwnerUserId"""),
    "j_right_outer": _with(f"""
, cnt AS (SELECT Date, COUNT(*) AS Count FROM dated WHERE TagName = {_lst(TAGS3[:1])} GROUP BY Date)
SELECT s.Date, COALESCE(c.Count, 0) AS Count
FROM cnt c RIGHT JOIN (SELECT DISTINCT Date FROM dated) s ON c.Date = s.Date"""),
    "j_full_outer": _with(f"""{_classified()},
n AS (SELECT PostId, COUNT(*) AS NewVotes FROM cls WHERE VoteAge = 'new' GROUP BY PostId),
o AS (SELECT PostId, COUNT(*) AS OldVotes FROM cls WHERE VoteAge = 'old' GROUP BY PostId)
SELECT COALESCE(n.PostId, o.PostId) AS PostId, COALESCE(n.NewVotes, 0) AS NewVotes,
       COALESCE(o.OldVotes, 0) AS OldVotes
FROM n FULL OUTER JOIN o ON n.PostId = o.PostId"""),
    "j_full_outer_rows": _with("""
SELECT COALESCE(q.OwnerUserId, u.Id) AS UserId, q.Id, q.Title, u.DisplayName
FROM questions q FULL OUTER JOIN users u ON q.OwnerUserId = u.Id"""),
    "p_zip_frames": _with("""
, a AS (SELECT Id AS ById, row_number() OVER (ORDER BY Id) AS position FROM questions),
b AS (SELECT Title AS ByTitle, Id AS TitleId, row_number() OVER (ORDER BY Title, Id) AS position FROM questions)
SELECT a.position, ById, ByTitle, TitleId FROM a JOIN b ON a.position = b.position"""),
    "a_split_frames": _with(f"""{_classified()}
SELECT VoteAge || ' votes' AS Frame, PostId, COUNT(*) AS Total FROM cls GROUP BY VoteAge, PostId"""),
    "u_ordered_diff": _with(f"""{POS_COUNTS},
a AS (SELECT ParentId, PositiveAnswerCount,
             row_number() OVER (ORDER BY PositiveAnswerCount DESC, ParentId DESC) AS _position FROM pc),
b AS (SELECT ParentId, PositiveAnswerCount,
             row_number() OVER (ORDER BY PositiveAnswerCount DESC, ParentId ASC) AS _position FROM pc)
SELECT *, 'missing' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) m
UNION ALL SELECT *, 'extra' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) e"""),
    "u_bind_rows": _with("""
SELECT Id, Title, 'question' AS Kind FROM questions
UNION ALL SELECT Id, NULL AS Title, 'user' AS Kind FROM users u
WHERE NOT EXISTS (SELECT 1 FROM questions q WHERE q.OwnerUserId = u.Id)"""),
    "j_anti": _with(f"""{_classified()}
SELECT PostId, COUNT(*) AS OldVotes FROM cls o
WHERE VoteAge = 'old'
  AND NOT EXISTS (SELECT 1 FROM cls n WHERE n.VoteAge = 'new' AND n.PostId = o.PostId)
GROUP BY PostId"""),
    "j_self": _with("""
SELECT a.Id AS AnswerId, q.Id AS QuestionId, q.Title AS QuestionTitle, a.Score AS Score
FROM posts a JOIN posts q ON a.ParentId = q.Id
WHERE a.PostTypeId = 2 AND q.PostTypeId = 1"""),
    "j_chain": _q4(-(2 ** 62)),
    "j_spine_cross": _spine_long(TAGS3),
    "a_max": _with("SELECT ParentId, MAX(Score) AS MaxScore FROM posts WHERE PostTypeId = 2 GROUP BY ParentId"),
    "a_count_multi_key": _with("""
SELECT PostId, strftime(CreationDate, '%Y') AS Year, COUNT(*) AS Count
FROM votes WHERE VoteTypeId = 2 GROUP BY ALL"""),
    "a_group_by_alias": _with("""
SELECT PostId, strftime(CreationDate, '%Y') AS Year, COUNT(*) AS Count
FROM votes WHERE VoteTypeId = 2 GROUP BY PostId, Year"""),
    "a_frequency_table": _with(
        "SELECT Name, COUNT(*) AS Freq FROM badges WHERE Class = 1 GROUP BY Name"),
    "w_first_per_group": _with(f"""{OWNER_RANKED}
SELECT OwnerUserId, Id, Title, FavoriteCount FROM ob WHERE rn = 1"""),
    "w_ties_per_group": _with(f"""{OWNER_RANKED}
SELECT OwnerUserId, Id, Title, FavoriteCount FROM ob WHERE rk = 1"""),
    "a_two_level": _with(f"""{_classified()},
per AS (SELECT PostId, VoteAge, COUNT(*) AS Total FROM cls GROUP BY PostId, VoteAge)
SELECT PostId, MAX(Total) AS MaxTotal, CAST(SUM(Total) AS BIGINT) AS Votes FROM per GROUP BY PostId"""),
    "a_conditional": _with(f"""{_classified()}
SELECT PostId, COUNT(CASE WHEN VoteAge = 'new' THEN 1 END) AS NewVotes,
       COUNT(CASE WHEN VoteAge = 'old' THEN 1 END) AS OldVotes
FROM cls GROUP BY PostId"""),
    "a_split_by_class": _with(f"""{_classified()}
SELECT PostId, VoteAge, COUNT(*) AS Total FROM cls GROUP BY PostId, VoteAge"""),
    "a_pivot": _series_wide(TAGS3),
    "a_drop_null_keys": _with("""
SELECT PostId, UserId, CAST(SUM(Score) AS BIGINT) AS Total FROM comments
WHERE PostId IS NOT NULL AND UserId IS NOT NULL GROUP BY PostId, UserId"""),
    "w_group_max": _with("""
SELECT Id, OwnerUserId, FavoriteCount,
       MAX(FavoriteCount) OVER (PARTITION BY OwnerUserId) AS MaxFavorite
FROM posts WHERE PostTypeId = 1"""),
    "w_residual_group": _with("""
, pt AS (SELECT OwnerUserId, Title, MAX(FavoriteCount) AS MostFavoriteQuestionLikes
         FROM posts WHERE PostTypeId = 1 AND OwnerUserId IS NOT NULL GROUP BY OwnerUserId, Title)
SELECT OwnerUserId, Title, MostFavoriteQuestionLikes FROM (
  SELECT *, MAX(MostFavoriteQuestionLikes) OVER (PARTITION BY OwnerUserId) AS m FROM pt) x
WHERE MostFavoriteQuestionLikes = m"""),
    "o_top_k_desc": _with(f"""
SELECT Id, FavoriteCount FROM posts WHERE PostTypeId = 1
ORDER BY FavoriteCount DESC NULLS LAST, Id LIMIT {K}"""),
    "o_top_k_tiebreak": _with(f"""{POS_COUNTS}
SELECT ParentId, PositiveAnswerCount FROM pc ORDER BY PositiveAnswerCount DESC, ParentId DESC LIMIT {K}"""),
    "o_top_k_asc": _with(f"SELECT DISTINCT Date FROM dated ORDER BY Date LIMIT {K}"),
    "o_sort_whole": _with(f"""{POS_COUNTS}
SELECT ParentId, PositiveAnswerCount FROM pc ORDER BY PositiveAnswerCount DESC, ParentId DESC"""),
    "u_frames_equal_diff": _with(f"""{OWNER_RANKED}
SELECT Id, OwnerUserId, Title, FavoriteCount, 'extra' AS side FROM (
  SELECT OwnerUserId, Id, Title, FavoriteCount FROM ob WHERE rk = 1
  EXCEPT ALL
  SELECT OwnerUserId, Id, Title, FavoriteCount FROM ob WHERE rn = 1) d"""),
    "u_positions_by_tie_order": _with(f"""{POS_COUNTS},
a AS (SELECT ParentId, PositiveAnswerCount,
             row_number() OVER (ORDER BY PositiveAnswerCount DESC, ParentId DESC) AS position
      FROM pc),
b AS (SELECT ParentId, PositiveAnswerCount,
             row_number() OVER (ORDER BY PositiveAnswerCount DESC, ParentId ASC) AS position
      FROM pc)
SELECT *, 'missing' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) m
UNION ALL
SELECT *, 'extra' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) e"""),
    "c_year_text": _with("SELECT PostId, strftime(CreationDate, '%Y') AS Year FROM votes"),
    "c_year_prefix": _with("SELECT PostId, substr(CAST(CreationDate AS VARCHAR), 1, 4) AS Year FROM votes"),
    "c_age_class": _with(f"{_classified()} SELECT PostId, VoteAge FROM cls"),
    "c_age_threshold": _with(f"{_classified(THRESHOLD_YEAR)} SELECT PostId, VoteAge FROM cls"),
    "c_month_key": _with("SELECT TagName, Date FROM dated"),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
