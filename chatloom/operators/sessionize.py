"""Turns and sessions: gaps and islands over the messages of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import session_id
from ..functions.text import word_count




def with_turns(messages: DataFrame, merge_gap_sec: float = 30, session_gap_min: float = 60) -> DataFrame:
    """``turn_no`` and ``session_no`` of every message, in one window over each folder.

    A turn goes on while the author is the same and the time since the message
    before is 0 to ``merge_gap_sec``. A session begins with a turn that begins
    more than ``session_gap_min`` after the message before it, so it never divides a turn.
    """
    folder = Window.partitionBy("folder").orderBy("seq")
    micros = F.unix_micros("ts")
    dt = micros - F.lag(micros).over(folder)
    same = F.lag("author_id").over(folder).eqNullSafe(F.col("author_id"))
    new_turn = ~(same & F.coalesce((dt >= 0) & (dt <= int(merge_gap_sec * 1_000_000)), F.lit(False)))
    m = messages.withColumns({"__turn": new_turn.cast("long"), "__far": F.coalesce(dt > int(session_gap_min * 60_000_000), F.lit(True))})
    m = m.withColumn("__session", (F.col("__far") & (F.col("__turn") == 1)).cast("long"))
    run = folder.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return m.withColumns({"turn_no": F.sum("__turn").over(run), "session_no": F.sum("__session").over(run)}).drop("__turn", "__far", "__session")


def merged(messages: DataFrame) -> DataFrame:
    """A row a turn: texts joined by lines, name of the first message, ids in order."""
    part = F.struct("seq", "text", "id")
    t = messages.groupBy("folder", "session_no", "turn_no").agg(
        F.min_by("author_id", "seq").alias("author_id"), F.min_by("author_name", "seq").alias("author_name"),
        F.min_by("ts", "seq").alias("start_ts"), F.max_by("ts", "seq").alias("end_ts"), F.array_sort(F.collect_list(part)).alias("parts"),
    )
    return t.withColumns({"text": F.array_join(F.col("parts.text"), "\n"), "source_ids": F.col("parts.id")}).drop("parts")


def named_sessions(turns: DataFrame) -> DataFrame:
    """``session_id`` from the folder and the session's first time, and ``turn_idx`` from 0."""
    s = Window.partitionBy("folder", "session_no")
    t = turns.withColumn("session_id", session_id(F.col("folder"), F.min("start_ts").over(s)))
    return t.withColumns({"turn_idx": F.row_number().over(s.orderBy("turn_no")) - 1, "words": word_count("text")})


def burst_merge(messages: DataFrame, merge_gap_sec: float = 30, session_gap_min: float = 60) -> DataFrame:
    return named_sessions(merged(with_turns(messages, merge_gap_sec, session_gap_min)))


def dedup_exact_turns(turns: DataFrame, cap: int = 1) -> DataFrame:
    """At most ``cap`` turns of an author with one text in a session, the first; ``dup`` marks the others, and turns are numbered anew."""
    if cap < 1:
        raise ValueError("the cap must be 1 or more")
    same = Window.partitionBy("folder", "session_no", "author_id", "text").orderBy("turn_idx")
    t = turns.withColumn("dup", F.row_number().over(same) > cap)
    order = Window.partitionBy("folder", "session_no", "dup").orderBy("turn_idx")
    return t.withColumn("turn_idx", F.row_number().over(order) - 1)


def session_summary(turns: DataFrame) -> DataFrame:
    """Per session: turns, authors, words, the largest share of an author, first and last time."""
    by_author = turns.groupBy("folder", "session_no", "session_id", "author_id").agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.min("start_ts").alias("first_ts"), F.max("end_ts").alias("last_ts"))
    s = by_author.groupBy("folder", "session_no", "session_id").agg(
        F.sum("n").alias("n_turns"), F.count("*").alias("n_authors"), F.sum("words").alias("n_words"), F.max("words").alias("top_words"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )
    return s.withColumn("top_share", F.col("top_words") / F.when(F.col("n_words") == 0, F.lit(1)).otherwise(F.col("n_words")))


def gate(min_turns: int = 2, min_authors: int = 2, monologue_max_share: float = 0.8):
    """drop_reason of a session summary, the first that holds; else null."""
    return F.when(F.col("n_turns") < min_turns, "short_session").when(F.col("n_authors") < min_authors, "single_author").when(F.col("top_share") > monologue_max_share, "monologue")
