"""Typed schemas of the Q&A dump tables and their code constants.

Column names follow the dump (CamelCase). Spark resolves names without regard
to case by default, so SQL text may write ``Posts.ID`` or ``ParentID``.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the dump format: post and vote type codes.
POST_TYPE_QUESTION = 1
POST_TYPE_ANSWER = 2
VOTE_TYPE_UP = 2
VOTE_TYPE_DOWN = 3
VOTE_TYPE_FAVORITE = 5
VOTE_TYPE_BOUNTY_START = 8
VOTE_TYPE_BOUNTY_CLOSE = 9
BADGE_CLASS_GOLD = 1

# Columns the dump converter drops per table (fixed values of the format).
DUMP_DROP_COLUMNS = {
    "Badges": [],
    "PostLinks": [],
    "Posts": ["Body", "Tags", "OwnerDisplayName", "LastEditorDisplayName"],
    "Tags": [],
    "Users": ["AboutMe", "WebsiteUrl", "ProfileImageUrl"],
    "Votes": [],
    "Comments": ["Text", "UserDisplayName"],
}


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


LONG, INT, STR, DBL, TS = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampType()

POSTS = T.StructType([
    _f("Id", LONG, False), _f("PostTypeId", INT, False), _f("ParentId", LONG),
    _f("AcceptedAnswerId", LONG), _f("CreationDate", TS), _f("Score", LONG),
    _f("ViewCount", LONG), _f("OwnerUserId", LONG), _f("LastEditorUserId", LONG),
    _f("LastEditDate", TS), _f("LastActivityDate", TS), _f("CommunityOwnedDate", TS),
    _f("ClosedDate", TS), _f("Title", STR), _f("AnswerCount", LONG),
    _f("CommentCount", LONG), _f("FavoriteCount", LONG),
])

USERS = T.StructType([
    _f("Id", LONG, False), _f("Reputation", DBL), _f("CreationDate", TS),
    _f("DisplayName", STR), _f("EmailHash", STR), _f("LastAccessDate", TS),
    _f("Location", STR), _f("Age", INT), _f("Views", LONG), _f("UpVotes", LONG),
    _f("DownVotes", LONG),
])

COMMENTS = T.StructType([
    _f("Id", LONG, False), _f("PostId", LONG, False), _f("Score", LONG),
    _f("CreationDate", TS), _f("UserId", LONG),
])

VOTES = T.StructType([
    _f("Id", LONG, False), _f("PostId", LONG, False), _f("VoteTypeId", INT, False),
    _f("CreationDate", TS), _f("UserId", LONG), _f("BountyAmount", LONG),
])

BADGES = T.StructType([
    _f("UserId", LONG, False), _f("Name", STR, False), _f("Date", TS), _f("Class", INT),
])

ACTIVITY = T.StructType([
    _f("TagName", STR, False), _f("Year", INT, False), _f("Month", INT, False),
])

TABLE_SCHEMAS = {
    "Posts": POSTS, "Users": USERS, "Comments": COMMENTS,
    "Votes": VOTES, "Badges": BADGES, "Activity": ACTIVITY,
}


def with_fields(schema: T.StructType, extra: list[tuple[str, str]]) -> T.StructType:
    """A new schema with extra nullable columns (``StructType.add`` would
    change the shared one in place)."""
    return T.StructType(list(schema.fields) + [
        T.StructField(n, T._parse_datatype_string(t), True) for n, t in extra])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; absent ones as NULL.

    CSV files carry no types and are read by position, so a frame is
    conformed before it is written and read back with the same schema.
    """
    present = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = present.get(f.name.lower())
        value = F.col(src) if src else F.lit(None)
        cols.append(value.cast(f.dataType).alias(f.name))
    return df.select(*cols)
