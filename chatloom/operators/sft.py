"""Fine-tuning samples: one window of turns a session and persona.

A window ends with the persona's last turn.  How far back it goes is a closed
form: the number of role blocks doesn't grow as the start moves later, so the
start is the earliest that has no more than the largest number of blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import iso
from ..functions.prompts import system_prompt

SESSION = ("folder", "session_id")


def names_in_order(turns: DataFrame) -> DataFrame:
    """(session, author_id, name, first_idx): first name and first turn of every author of a session."""
    return turns.groupBy(*SESSION, "author_id").agg(F.min_by("author_name", "turn_idx").alias("name"), F.min("turn_idx").alias("first_idx"), F.max("turn_idx").alias("last_idx"))


def windows(turns: DataFrame, personas: list[str] | None = None, window_turns: int = 16, min_blocks: int = 2, max_blocks: int | None = 8) -> DataFrame:
    """(session, persona_id, end_idx, start_idx, blocks): the chosen window of every session and persona that has one.

    ``max_blocks=None`` takes the earliest start and asks for two blocks only.
    """
    people = names_in_order(turns)
    if personas:
        people = people.filter(F.col("author_id").isin(*personas))
    ends = people.select(*SESSION, F.col("author_id").alias("persona_id"), F.col("last_idx").alias("end_idx"))
    t = turns.select(*SESSION, "turn_idx", "author_id").join(ends, list(SESSION)).filter((F.col("turn_idx") <= F.col("end_idx")) & (F.col("turn_idx") > F.col("end_idx") - window_turns))
    role = F.col("author_id") == F.col("persona_id")
    w = Window.partitionBy(*SESSION, "persona_id").orderBy(F.col("turn_idx").desc())
    # Going back from the end: role changes between a turn and the one after it.
    change = F.coalesce((role != F.lag(role).over(w)).cast("int"), F.lit(0))
    t = t.withColumns({"role": role, "change": change})
    t = t.withColumn("blocks", F.sum("change").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + 1 - F.col("role").cast("int"))
    least = 2 if max_blocks is None else max(min_blocks, 2)
    found = t.groupBy(*SESSION, "persona_id", "end_idx")
    if max_blocks is None:
        found = found.agg(F.min("turn_idx").alias("start_idx"), F.min_by("blocks", "turn_idx").alias("blocks"))
    else:
        fits = F.when(F.col("blocks") <= max_blocks, F.col("turn_idx"))
        found = found.agg(F.min(fits).alias("start_idx"), F.min_by("blocks", fits).alias("blocks"))
    return found.filter(F.col("start_idx").isNotNull() & (F.col("blocks") >= least))


def samples(turns: DataFrame, personas: list[str] | None = None, window_turns: int = 16, min_blocks: int = 2, max_blocks: int | None = 8) -> DataFrame:
    """Rows (system, conversations, meta) with keys folder, session_id, persona_id and end_idx beside them.

    Neighbouring turns of a role become one block, joined by lines; leading blocks
    of the persona go, but the sample's first time keeps them. Names and ids of
    the others are those of the whole session.
    """
    key = [*SESSION, "persona_id"]
    chosen = windows(turns, personas, window_turns, min_blocks, max_blocks)
    t = turns.join(chosen, list(SESSION)).filter(F.col("turn_idx").between(F.col("start_idx"), F.col("end_idx")))
    w = Window.partitionBy(*key).orderBy("turn_idx")
    mine = F.col("author_id") == F.col("persona_id")
    t = t.withColumns({"mine": mine, "new": F.coalesce((mine != F.lag(mine).over(w)).cast("int"), F.lit(1))})
    t = t.withColumn("block", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = F.array_join(F.array_sort(F.collect_list(F.struct("turn_idx", "text")))["text"], "\n")
    b = t.groupBy(*key, "end_idx", "blocks", "block", "mine").agg(parts.alias("value"), F.min("start_ts").alias("f"), F.max("end_ts").alias("l"), F.max_by("source_ids", "turn_idx").alias("ids"))
    turn = F.struct("block", F.when(F.col("mine"), "assistant").otherwise("user").alias("from"), "value")
    rows = b.groupBy(*key, "end_idx", "blocks").agg(F.array_sort(F.collect_list(turn)).alias("all"), F.min("f").alias("f"), F.max("l").alias("l"), F.max_by("ids", "block").alias("ids"))
    whole = F.transform("all", lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value")))
    rows = rows.withColumn("conversations", F.when(F.element_at("all", 1)["from"] == "assistant", F.slice(whole, F.lit(2), F.greatest(F.size("all") - 1, F.lit(0)))).otherwise(whole))
    people = names_in_order(turns)
    everyone = people.groupBy(*SESSION).agg(F.array_sort(F.collect_list(F.struct("first_idx", F.col("author_id").alias("id"), "name"))).alias("people"))
    rows = rows.join(everyone, list(SESSION))
    others = F.filter("people", lambda p: p["id"] != F.col("persona_id"))
    name = F.element_at(F.filter("people", lambda p: p["id"] == F.col("persona_id")), 1)["name"]
    meta = F.struct(
        F.col("persona_id"), name.alias("persona_name"), F.array_sort(others["id"]).alias("counterparty_ids"), F.col("session_id"), F.col("folder"),
        iso(F.col("f")).alias("first_ts"), iso(F.col("l")).alias("last_ts"), F.size("conversations").alias("num_turns"), F.col("ids").alias("end_source_ids"),
    )
    return rows.select(*key, "end_idx", system_prompt(name, others["name"]).alias("system"), "conversations", meta.alias("meta"))


def perspective_counts(samples: DataFrame) -> DataFrame:
    """Per persona: distinct sessions, samples, first name; samples without persona are passed over."""
    s = samples.select("meta.*").filter(F.coalesce("persona_id", F.lit("")) != "")
    named = F.nullif(F.col("persona_name"), F.lit(""))
    return s.groupBy("persona_id").agg(F.min_by(named, F.when(named.isNotNull(), F.struct("session_id", "first_ts"))).alias("persona_name"), F.countDistinct("session_id").alias("n_sessions"), F.count("*").alias("n_samples"))
