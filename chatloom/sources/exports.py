"""Raw chat exports: a folder per conversation, pages of JSON arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import falsy
from ..schemas import RAW_MESSAGE


def natural_key(name: Column) -> Column:
    """Sorts file names with their numbers as numbers: digits are padded, letters lower-cased."""
    padded = F.regexp_replace(F.lower(name), r"(\d+)", "0000000000000000000$1")
    return F.regexp_replace(padded, r"0*(\d{20})(?!\d)", "$1")


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """Every message of every page, with folder, page and its place on the page.

    ``root/*/*.json``; a file that isn't an array of objects gives no row, a malformed one fails.
    """
    text = spark.read.text(f"{root.rstrip('/')}/*/*.json", wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    # An array alone is read; its elements stay text until the schema is applied, so a stray element can't spoil a page.
    items = F.from_json(F.when(F.btrim("value", F.lit(" \t\r\n﻿")).startswith("["), F.col("value")), "array<string>", {"mode": "FAILFAST"})
    rows = text.select("path", F.posexplode(items).alias("at", "item")).filter(F.btrim("item").startswith("{"))
    parts = F.split("path", "/")
    return rows.select(
        F.url_decode(F.element_at(parts, -2)).alias("folder"), F.url_decode(F.element_at(parts, -1)).alias("page"), "at",
        F.from_json("item", RAW_MESSAGE).alias("raw"),
    ).select("folder", "page", "at", "raw.*")


def display_name(author: Column) -> Column:
    return F.coalesce(falsy(author["global_name"], author["username"], author["id"]), F.lit("unknown"))


def timestamp(x) -> Column:
    """Null of null or empty; a malformed one fails."""
    x = falsy(x)
    return F.when(x.isNotNull(), F.to_timestamp(x))


def to_messages(raw: DataFrame) -> DataFrame:
    """Raw rows (folder, page, at, ...) as messages. Rows without time or author are dropped;
    reply fields are set for type 19 alone."""
    kind = F.coalesce(F.expr("try_cast(type AS INT)"), F.lit(0))
    ref, author = F.col("referenced_message"), F.col("author")
    reply, present = kind == 19, F.col("referenced_message").isNotNull()
    urls = F.transform(F.coalesce("attachments", F.array()), lambda a: F.coalesce(falsy(a["url"], a["filename"]), F.lit("")))
    out = raw.select(
        "id", timestamp("timestamp").alias("ts"), author["id"].alias("author_id"), display_name(author).alias("author_name"),
        F.coalesce("content", F.lit("")).alias("content"), timestamp("edited_timestamp").alias("edited_ts"),
        F.filter(urls, lambda u: u != "").alias("attachments"), F.coalesce(F.size("embeds"), F.lit(0)).alias("num_embeds"), kind.alias("type"),
        F.when(reply, F.when(present, ref["id"]).otherwise(falsy(F.col("message_reference")["message_id"]))).alias("referenced_id"),
        F.when(reply & present, F.coalesce(ref["content"], F.lit(""))).alias("reply_to_preview"),
        F.when(reply & present, ref["author"]["id"]).alias("reply_to_author_id"),
        F.when(reply & present, display_name(ref["author"])).alias("reply_to_author_name"),
        (reply & ~present).alias("reply_to_missing"), "folder", "page", "at",
    )
    return out.filter(F.col("ts").isNotNull() & falsy("author_id").isNotNull())


def dedup_by_id(messages: DataFrame) -> DataFrame:
    """The first of each id in page order, of each folder; rows without id are dropped.

    One aggregate with the smallest (page, place), no sort of a folder.
    """
    named = messages.filter(falsy("id").isNotNull())
    rest = F.struct(*[c for c in messages.columns if c not in ("folder", "id", "page", "at")])
    first = named.groupBy("folder", "id").agg(F.min_by(rest, F.struct(natural_key(F.col("page")), F.col("at"))).alias("m"))
    return first.select("id", "m.*", "folder")


def ordered(messages: DataFrame) -> DataFrame:
    """With ``seq``, the place in the folder by time and then id, as text."""
    w = Window.partitionBy("folder").orderBy("ts", "id")
    return messages.withColumn("seq", F.row_number().over(w).cast("long"))


def read_messages(spark: SparkSession, root: str) -> DataFrame:
    return dedup_by_id(to_messages(read_pages(spark, root)))
