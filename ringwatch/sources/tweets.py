"""Tweet files: posts to directed interaction events."""

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.functions.text import account, at_mentions, first_token, targets
from ringwatch.schemas import SOCIAL_EVENT
from ringwatch.sources.csvfiles import merge, read_csv_files, row_name
from ringwatch.sources.ranges import RANGE_BYTES

log = logging.getLogger(__name__)

# Fixed values of the tweet events.
SOURCE = "kaggle_tweets"
INTERACTION = "tweet_mention"

# Per role the rules in order of preference. A column fits a rule if its
# name contains all parts of one of the alternatives.
ROLE_RULES = {
    "user": [[("user", "name")], [("username",), ("author",)], [("user",)]],
    "text": [[("text",), ("tweet",), ("content",)]],
    "date": [[("date",), ("time",), ("created",)]],
}


def column_name(name: str) -> str:
    return name.lower().strip()


def infer_roles(columns: list[str]) -> dict[str, str | None]:
    """The first column of each role's first rule that fits any column."""
    found: dict[str, str | None] = {}
    for role, rules in ROLE_RULES.items():
        fitting = (c for rule in rules for c in columns if any(all(p in c for p in parts) for parts in rule))
        found[role] = next(fitting, None)
    return found


def with_roles(df: DataFrame, row_id: Column, now: Column | None = None) -> DataFrame | None:
    """``user``, ``text``, ``date`` of a post; None, with a warning, if nothing holds text.

    Without a user column each row gets a user of its own.
    """
    columns = [c for c in df.columns if not c.startswith("_")]
    roles = infer_roles(columns)
    if not roles["text"]:
        log.warning("no text column among %s", columns)
        return None
    when = F.current_timestamp() if now is None else now
    user = F.col(f"`{roles['user']}`") if roles["user"] else F.concat(F.lit("user_"), row_id)
    date = F.col(f"`{roles['date']}`") if roles["date"] else when
    return df.select(
        user.alias("user"), F.col(f"`{roles['text']}`").alias("text"), date.cast("string").alias("date")
    )


def read_tweets(
    spark: SparkSession, files: list[str] | DataFrame, now: Column | None = None, range_bytes: int = RANGE_BYTES
) -> DataFrame | None:
    """Posts of all files with a text column; malformed lines are dropped.

    Texts may run over line ends; a file of any size is read by many tasks.
    """
    groups = read_csv_files(spark, files, column_name, drop_malformed=True, range_bytes=range_bytes)
    posts = [with_roles(df, row_name(df), now) for df in groups]
    posts = [p for p in posts if p is not None]
    return merge(posts) if posts else None


def tweets_to_interactions(
    posts: DataFrame, max_mentions: int | None = None, max_name: int | None = None
) -> DataFrame:
    """One event per mentioned user, or one to the community account.

    Every mention counts and names are whole; ``max_mentions`` and ``max_name`` cut
    them to the first so many mentions of a post and characters of a name.
    """
    others = [c for c in posts.columns if c not in ("user", "text", "date")]
    named = posts.select(
        *others,
        "user",
        "date",
        first_token(F.col("text")).alias("token"),
        at_mentions(F.col("text")).alias("_mentions"),
    )
    return (
        named.select(
            *others,
            "user",
            "date",
            "token",
            F.posexplode(targets(F.col("_mentions"), max_mentions)).alias("position", "target"),
        )
        .select(
            *others,
            "position",
            F.lit(SOCIAL_EVENT).alias("event_type"),
            account(F.col("user"), max_name).alias("source_user"),
            account(F.col("target"), max_name).alias("target_user"),
            F.lit(INTERACTION).alias("interaction_type"),
            F.col("token").alias("token_mentioned"),
            F.col("date").alias("timestamp"),
            F.lit(False).alias("is_bot"),
            F.lit(False).alias("pump_signal"),
            F.lit(SOURCE).alias("source"),
        )
    )
