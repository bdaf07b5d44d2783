"""Filters, reply inlining and normalisation of messages, before they become turns.

Rows are never lost on the way: a message that goes gets a ``drop_reason``, so
that all counters are one aggregate.  Orders are by ``seq`` within a folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T




def drop_reason() -> Column:
    """system_type, deleted_ref or bot_command, the first that holds; else null."""
    return (
        F.when(~F.coalesce("type", F.lit(0)).isin(0, 19), "system_type")
        .when((F.col("type") == 19) & F.coalesce("reply_to_missing", F.lit(False)), "deleted_ref")
        .when(T.strip(F.coalesce("content", F.lit(""))).rlike(T.BOT_COMMAND), "bot_command")
    )


def mention_table(messages: DataFrame) -> DataFrame:
    """folder, id, name of everyone seen in a folder: the first name wins, an author's before the one replied to."""
    own = F.struct(F.col("author_id").alias("id"), F.col("author_name").alias("name"), F.lit(0).alias("kind"))
    other = F.struct(F.col("reply_to_author_id").alias("id"), F.col("reply_to_author_name").alias("name"), F.lit(1).alias("kind"))
    seen = messages.select("folder", "seq", F.explode(F.array(own, other)).alias("m")).select("folder", "seq", "m.*")
    seen = seen.filter(T.falsy("id").isNotNull() & T.falsy("name").isNotNull())
    return seen.groupBy("folder", "id").agg(F.min_by("name", F.struct("seq", "kind")).alias("name"))


def with_reply_prefix(messages: DataFrame) -> DataFrame:
    """``prefix``: who and what is replied to, unless that is the message before (of those without drop_reason)."""
    kept = messages.filter("drop_reason is null")
    before = F.lag("id").over(Window.partitionBy("folder").orderBy("seq"))
    quoted = (F.col("type") == 19) & T.falsy("referenced_id").isNotNull() & T.falsy("reply_to_preview").isNotNull() & ~F.col("referenced_id").eqNullSafe(before)
    who = F.coalesce(T.falsy("reply_to_author_name"), F.lit("user"))
    line = F.concat(F.lit("> "), who, F.lit(": "), T.shorten(F.col("reply_to_preview")), F.lit("\n"))
    kept = kept.withColumn("prefix", F.when(quoted, line).otherwise(F.lit("")))
    return kept.unionByName(messages.filter("drop_reason is not null").withColumn("prefix", F.lit("")))


def with_text(messages: DataFrame, mentions: DataFrame, url_strip: bool = False, pii_scrub: bool = True) -> DataFrame:
    """``text``, and drop_reason ``empty`` where nothing is left and nothing was attached.

    Names are looked up only for messages with mentions, by (folder, id).
    """
    ids = F.regexp_extract_all(F.coalesce("content", F.lit("")), F.lit(T.MENTION), F.lit(1))
    asked = messages.filter(F.coalesce("content", F.lit("")).rlike(T.MENTION)).select("folder", "seq", F.explode(F.array_distinct(ids)).alias("id"))
    names = asked.join(mentions, ["folder", "id"]).groupBy("folder", "seq").agg(F.map_from_entries(F.collect_list(F.struct("id", "name"))).alias("names"))
    m = messages.join(names, ["folder", "seq"], "left")
    body = T.normalize(F.col("content"), F.col("names"), url_strip, pii_scrub)
    whole = T.strip(F.concat("prefix", body))
    attached = (F.size("attachments") > 0) | (F.coalesce("num_embeds", F.lit(0)) > 0)
    m = m.withColumn("text", F.when(whole != "", whole).when(attached, F.lit("[image]")).otherwise(F.lit("")))
    return m.withColumn("drop_reason", F.coalesce("drop_reason", F.when(F.col("text") == "", F.lit("empty")))).drop("names")
