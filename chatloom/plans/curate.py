"""Messages to curated sessions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, replace
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dedup, messages as M, sessionize as S
from ..operators.dedup import materialized


@dataclass(frozen=True)
class Options:
    merge_gap_sec: float = 30
    session_gap_min: float = 60
    min_turns: int = 2
    min_authors: int = 2
    monologue_max_share: float = 0.80
    url_strip: bool = False
    pii_scrub: bool = True
    lang: str | None = None
    near_dedup_threshold: float | None = 0.85
    dedupe_exact_turns: bool = True
    exact_turn_dup_cap: int = 1


@dataclass
class Curated:
    """``messages`` and ``sessions`` have drop reasons; ``turns`` are those of kept sessions; ``report`` is one row of counters."""

    messages: DataFrame
    sessions: DataFrame
    turns: DataFrame
    report: DataFrame


def normalized(messages: DataFrame, url_strip: bool = False, pii_scrub: bool = True) -> DataFrame:
    """Messages (with seq) with drop_reason and text."""
    marked = M.with_reply_prefix(messages.withColumn("drop_reason", M.drop_reason()))
    return M.with_text(marked, M.mention_table(messages), url_strip, pii_scrub)


def curate(messages: DataFrame, options: Options = Options(), language: Callable | None = None) -> Curated:
    """Filter, normalise, merge, split, remove repeated turns, gate, and remove near-duplicates.

    ``messages`` has ``seq`` (see sources.exports.ordered). ``language`` maps a
    column of text to a column of language codes, null for unknown; without it no
    session is dropped for its language.
    """
    return from_normalized(materialized(normalized(messages, options.url_strip, options.pii_scrub), "curate-messages"), options, language)


def from_normalized(messages: DataFrame, o: Options, language: Callable | None = None) -> Curated:
    if o.dedupe_exact_turns and o.exact_turn_dup_cap < 1:
        raise ValueError("the cap must be 1 or more")
    turns = S.burst_merge(messages.filter("drop_reason is null"), o.merge_gap_sec, o.session_gap_min)
    turns = S.dedup_exact_turns(turns, o.exact_turn_dup_cap) if o.dedupe_exact_turns else turns.withColumn("dup", F.lit(False))
    turns = materialized(turns, "curate-turns")
    live = turns.filter("not dup")
    sessions = S.session_summary(live).withColumn("drop_reason", S.gate(o.min_turns, o.min_authors, o.monologue_max_share))
    near = o.near_dedup_threshold is not None and o.near_dedup_threshold > 0
    if near or (o.lang and language):
        ordered = F.array_sort(F.collect_list(F.struct("turn_idx", "text")))["text"]
        passed = live.join(sessions.filter("drop_reason is null").select("folder", "session_no", "n_words"), ["folder", "session_no"])
        texts = passed.groupBy("folder", "session_no", "n_words").agg(ordered.alias("texts"))
        if o.lang and language:
            found = language(F.substring(F.array_join("texts", " "), 1, 4000))
            texts = materialized(texts.withColumn("foreign", F.coalesce(found != o.lang, F.lit(False))), "curate-language")
            sessions = sessions.join(texts.select("folder", "session_no", "foreign"), ["folder", "session_no"], "left")
            sessions = sessions.withColumn("drop_reason", F.coalesce("drop_reason", F.when(F.col("foreign"), F.lit("lang")))).drop("foreign")
            texts = texts.filter("not foreign").drop("foreign")
        if near:
            rows = texts.select(F.col("folder").alias("scope"), F.col("session_no").alias("id"), F.array_join("texts", "\n").alias("text"), F.col("n_words").alias("priority"))
            keep = dedup.near_dedup(rows, o.near_dedup_threshold).select(F.col("scope").alias("folder"), F.col("id").alias("session_no"), F.col("kept"))
            sessions = sessions.join(keep, ["folder", "session_no"], "left")
            sessions = sessions.withColumn("drop_reason", F.coalesce("drop_reason", F.when(~F.col("kept"), F.lit("near_dup")))).drop("kept")
    sessions = materialized(sessions, "curate-sessions")
    kept = live.join(sessions.filter("drop_reason is null").select("folder", "session_no"), ["folder", "session_no"], "left_semi").drop("dup")
    return Curated(messages, sessions, kept, report(messages, turns, sessions))


def report(messages: DataFrame, turns: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row: what was there and what was dropped, by reason."""
    n = lambda reason: F.count_if(F.col("drop_reason") == reason)
    m = messages.agg(F.count("*").alias("messages_in"), *[n(r).alias(f"dropped_{r}") for r in ("system_type", "deleted_ref", "bot_command", "empty")])
    t = turns.agg(F.count_if(F.col("dup")).alias("dropped_exact_turn_dup"), F.count("*").alias("turns_built"))
    s = sessions.agg(F.count("*").alias("sessions_built"), *[n(r).alias(f"dropped_{r}") for r in ("short_session", "single_author", "monologue", "lang", "near_dup")], F.count_if(F.col("drop_reason").isNull()).alias("sessions_kept"))
    # Each side is one row.
    return m.join(t, F.lit(True)).join(s, F.lit(True))


GRID = ("session_gap_min", "merge_gap_sec", "min_turns", "min_authors", "monologue_max_share")


def grid(options: Options = Options(), **lists) -> list[Options]:
    """All combinations of the lists; a list that isn't given has the options' own value."""
    return [replace(options, **dict(zip(GRID, x, strict=True))) for x in product(*[lists.get(k) or [getattr(options, k)] for k in GRID])]


def sweep(messages: DataFrame, options: Options = Options(), max_combos: int = 500, language: Callable | None = None, **lists) -> DataFrame:
    """A row a point of the grid of lists: params, sessions_built, sessions_kept and the report's other counters.

    One pass for all points: messages are normalised once; turns and sessions are built once for every two gaps (a copy of a folder's
    messages each); similar sessions are found once for those; gates and the greedy choice then run over the points of a session.
    """
    points = grid(options, **lists)
    if len(points) > max_combos:
        raise ValueError(f"{len(points)} combinations; at most {max_combos} are allowed")
    o, spark = options, messages.sparkSession
    if o.dedupe_exact_turns and o.exact_turn_dup_cap < 1:
        raise ValueError("the cap must be 1 or more")
    base = materialized(normalized(messages, o.url_strip, o.pii_scrub), "sweep-messages")
    gaps = list(dict.fromkeys((p.merge_gap_sec, p.session_gap_min) for p in points))
    parts = []
    for i, (merge_gap, session_gap) in enumerate(gaps):
        t = S.burst_merge(base.filter("drop_reason is null"), merge_gap, session_gap)
        t = S.dedup_exact_turns(t, o.exact_turn_dup_cap) if o.dedupe_exact_turns else t.withColumn("dup", F.lit(False))
        parts.append(t.withColumn("folder", F.concat(F.lit(f"{i}|"), "folder")))
    turns = materialized(reduce(DataFrame.unionByName, parts), "sweep-turns")
    live = turns.filter("not dup")
    gap_of = F.substring_index("folder", "|", 1).cast("int")
    kinds = "point int, gap int, min_turns int, min_authors int, share double"
    table = spark.createDataFrame([(i, gaps.index((p.merge_gap_sec, p.session_gap_min)), p.min_turns, p.min_authors, float(p.monologue_max_share)) for i, p in enumerate(points)], kinds)
    # At most max_combos rows.
    s = S.session_summary(live).withColumn("gap", gap_of).join(F.broadcast(table), "gap")
    reason = F.when(F.col("n_turns") < F.col("min_turns"), "short_session").when(F.col("n_authors") < F.col("min_authors"), "single_author").when(F.col("top_share") > F.col("share"), "monologue")
    s = s.withColumn("drop_reason", reason).select("point", "folder", "session_no", "n_words", "drop_reason")
    near = o.near_dedup_threshold is not None and o.near_dedup_threshold > 0
    if near or (o.lang and language):
        s = materialized(s, "sweep-gates")
        passed = s.filter("drop_reason is null").select("folder", "session_no").distinct()
        ordered = F.array_sort(F.collect_list(F.struct("turn_idx", "text")))["text"]
        texts = live.join(passed, ["folder", "session_no"]).groupBy("folder", "session_no").agg(ordered.alias("texts"))
        if o.lang and language:
            found = language(F.substring(F.array_join("texts", " "), 1, 4000))
            texts = materialized(texts.withColumn("foreign", F.coalesce(found != o.lang, F.lit(False))), "sweep-language")
            s = s.join(texts.select("folder", "session_no", "foreign"), ["folder", "session_no"], "left")
            s = materialized(s.withColumn("drop_reason", F.coalesce("drop_reason", F.when(F.col("foreign"), F.lit("lang")))).drop("foreign"), "sweep-foreign")
            texts = texts.filter("not foreign").drop("foreign")
        if near:
            named = texts.select(F.col("folder").alias("scope"), F.col("session_no").alias("id"), F.array_join("texts", "\n").alias("text"))
            members, sets = dedup.shingle_classes(named)
            pairs = materialized(dedup.similar_sets(sets, o.near_dedup_threshold).select("scope", "a", "b"), "sweep-pairs")
            # Per point the classes of the sessions that pass, each with its first, and the pairs between those.
            own = s.filter("drop_reason is null").select("point", F.col("folder").alias("scope"), F.col("session_no").alias("id"), F.col("n_words").alias("priority")).join(members, ["scope", "id"])
            at = F.concat_ws("|", F.col("point").cast("string"), "scope")
            rank = F.struct(-F.col("priority"), F.col("id"))
            firsts = materialized(own.groupBy("point", "scope", "rep").agg(F.min_by("id", rank).alias("id"), F.max("priority").alias("priority")), "sweep-firsts")
            side = lambda c: firsts.select("point", "scope", F.col("rep").alias(c), F.col("id").alias(f"f_{c}"))
            edges = pairs.join(side("a"), ["scope", "a"]).join(side("b"), ["point", "scope", "b"]).select(at.alias("scope"), F.col("f_a").alias("a"), F.col("f_b").alias("b"))
            kept = dedup.greedy_keep(firsts.select(at.alias("scope"), "id", "priority"), edges).filter("kept").select(F.col("scope").alias("at"), F.col("id").alias("session_no"), F.lit(True).alias("stays"))
            known = members.select(F.col("scope").alias("folder"), F.col("id").alias("session_no"), F.lit(True).alias("known"))
            s = s.withColumn("at", F.concat_ws("|", F.col("point").cast("string"), "folder")).join(kept, ["at", "session_no"], "left").join(known, ["folder", "session_no"], "left")
            gone = F.col("known").isNotNull() & F.col("stays").isNull()
            s = s.withColumn("drop_reason", F.coalesce("drop_reason", F.when(gone, F.lit("near_dup"))))
    n = lambda reason: F.count_if(F.col("drop_reason") == reason)
    reasons = ("short_session", "single_author", "monologue", "lang", "near_dup")
    counts = s.groupBy("point").agg(F.count("*").alias("sessions_built"), *[n(r).alias(f"dropped_{r}") for r in reasons], F.count_if(F.col("drop_reason").isNull()).alias("sessions_kept"))
    m = base.agg(F.count("*").alias("messages_in"), *[n(r).alias(f"dropped_{r}") for r in ("system_type", "deleted_ref", "bot_command", "empty")])
    t = turns.groupBy(gap_of.alias("gap")).agg(F.count_if(F.col("dup")).alias("dropped_exact_turn_dup"), F.count("*").alias("turns_built"))
    names = [k for k, v in asdict(o).items() if v is not None or k in GRID]
    values = spark.createDataFrame([(i, {k: str(getattr(p, k)) for k in names}) for i, p in enumerate(points)], "point int, p map<string,string>")
    kinds = {k: "double" if isinstance(getattr(o, k), float) or k in ("merge_gap_sec", "session_gap_min", "monologue_max_share") else "boolean" if isinstance(getattr(o, k), bool) else "string" if isinstance(getattr(o, k), str) else "int" for k in names}
    params = F.struct(*[F.col("p")[k].cast(kinds[k]).alias(k) for k in names])
    every = [*[c for c in counts.columns if c != "point"], *[c for c in t.columns if c != "gap"]]
    # A row a point, a row a pair of gaps, and one row.
    out = table.select("point", "gap").join(values, "point").join(counts, "point", "left").join(t, "gap", "left").join(m, F.lit(True))
    return out.orderBy("point").select(*m.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in every], params.alias("params"))


def sweep_table(rows: DataFrame) -> DataFrame:
    """A sweep's rows flat: the grid's parameters under short names, sessions kept and built, and the counters of what was dropped, of those that are anywhere above 0."""
    short = {"session_gap_min": "gap_min", "merge_gap_sec": "merge_s", "min_turns": "min_turns", "min_authors": "min_authors", "monologue_max_share": "mono_share"}
    dropped = [c for c in rows.columns if c.startswith("dropped_")]
    some = rows.agg(*[F.max(c).alias(c) for c in dropped]).head()
    return rows.select(*[F.col(f"params.{k}").alias(v) for k, v in short.items()], "sessions_kept", "sessions_built", *[F.nullif(F.col(c), F.lit(0)).alias(c) for c in dropped if some and some[c]])
