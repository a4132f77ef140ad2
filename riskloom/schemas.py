"""Table shapes shared by sources, operators and jobs."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# The field names of the interchange format.
CREATED = T.StructField("created_utc", T.DoubleType())

POST = T.StructType(
    [
        *_strings("id", "url", "subreddit", "author", "title", "text"),
        CREATED,
        *_strings("language"),
    ]
)

ITEM = T.StructType([*_strings("id", "url", "subreddit", "author", "kind", "text"), CREATED])

# A history row: which user's history the item belongs to, then the item.
HISTORY = T.StructType([*_strings("username"), *ITEM.fields])

USERS = T.StructType(_strings("username"))

SCORED_POST_COLUMNS = [
    *(f for f in POST.names if f != "language"),
    "language",
    "risk_score",
    "risk_label",
    "risk_explanation",
    "risk_features",
]

USER_RISK_COLUMNS = [
    "username",
    "score",
    "label",
    "max_post_score",
    "average_score",
    "count_high_posts",
    "total_posts",
    "explanation",
]
