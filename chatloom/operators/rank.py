"""Ranking of runs by style: pairs to judge, ratings from judgements, fingerprints, and both combined.

Judgements are an input table; who judges is not this library's concern.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.prompts import user_prompt
from . import elo, merge
from .dedup import materialized
from .stylometry import FEATURES, cosine, features, vector

#: Errors of judgements that a report lists.
MAX_ERRORS = 80


def corpus_features(rows: DataFrame, fillers: list[str] | None = None) -> DataFrame:
    """A row a label of rows (label, place, text): the features of all its texts as one, joined by empty lines in order of place.

    No text of a label is ever put together: counts are added up, and only a text's first and last word meet
    its neighbours' for the pairs across texts. ``stylometry.features`` of the joined text has the same values.
    """
    x = rows.select("label", "place", F.coalesce("text", F.lit("")).alias("text"))
    x = features(x, "text", fillers).select("label", "place", "text", *FEATURES)
    w = x.withColumns({"w": T.style_words(F.col("text")), "s": F.size(T.sentences(F.col("text"))), "n": F.length("text"), "c": F.size(F.filter(F.transform(F.split("text", "\n\n"), T.strip), lambda c: c != ""))})
    some = T.strip(F.col("text")) != ""
    count = lambda c: F.sum(F.length("text") - F.length(F.replace("text", F.lit(c), F.lit(""))))
    # White space at the two ends of the joined text doesn't count, whatever texts it comes from.
    edge = F.struct("place", "text")
    sums = w.groupBy("label").agg(
        F.sum(F.size("w")).alias("words"), F.sum(F.aggregate("w", F.lit(0), lambda a, y: a + F.length(y))).alias("letters"),
        F.sum(F.col("avg_sentence_len") * F.col("s")).alias("in_sentences"), F.sum("s").alias("sentences"), F.sum(F.col("filler_rate") * F.col("c")).alias("hits"), F.sum("c").alias("chunks"),
        *[count(c).alias(k) for c, k in ((",", "comma"), (".", "period"), ("!", "excl"), ("?", "q"))],
        F.sum("n").alias("chars"), F.count("*").alias("texts"), F.min(F.when(some, edge)).alias("first"), F.max(F.when(some, edge)).alias("last"),
    )
    outside = w.join(sums.select("label", F.col("first.place").alias("f"), F.col("last.place").alias("l")), "label")
    outside = outside.groupBy("label").agg(
        F.sum(F.when(F.col("place") < F.col("f"), F.col("n") + 2).when(F.col("place") == F.col("f"), F.col("n") - F.length(F.ltrim("text", F.lit(T.BLANK)))).otherwise(0)).alias("lead"),
        F.sum(F.when(F.col("place") > F.col("l"), F.col("n") + 2).when(F.col("place") == F.col("l"), F.col("n") - F.length(F.rtrim("text", F.lit(T.BLANK)))).otherwise(0)).alias("tail"),
    )
    distinct = w.select("label", F.explode("w").alias("x")).groupBy("label").agg(F.countDistinct("x").alias("kinds"))
    before = F.lag(F.element_at("w", -1)).over(Window.partitionBy("label").orderBy("place"))
    across = w.filter(F.size("w") > 0).select("label", "place", F.slice("w", 1, 1).alias("a"), F.col("w")).withColumn("b", before).filter("b is not null").select("label", F.concat_ws(" ", "b", F.element_at("a", 1)).alias("x"))
    pairs = w.select("label", F.explode(T.grams(F.col("w"), 2)).alias("x")).unionByName(across).groupBy("label", "x").count()
    pairs = pairs.groupBy("label").agg(F.count("*").alias("pair_kinds"), F.count_if(F.col("count") > 1).alias("pair_twice"))
    g = sums.join(outside, "label").join(distinct, "label", "left").join(pairs, "label", "left")
    n = F.greatest(F.col("chars") + 2 * (F.col("texts") - 1) - F.coalesce("lead", F.lit(0)) - F.coalesce("tail", F.lit(0)), F.lit(1))
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    out = {
        "avg_sentence_len": ratio("in_sentences", "sentences"), "avg_word_len": ratio("letters", "words"), "filler_rate": ratio("hits", "chunks"),
        "punct_comma": F.col("comma") / n, "punct_period": F.col("period") / n, "punct_excl": F.col("excl") / n, "punct_q": F.col("q") / n,
        "word_repeat_rate": F.when(F.col("words") > 1, 1.0 - F.col("kinds") / F.col("words")).otherwise(F.lit(0.0)), "dup_bigram_rate": ratio("pair_twice", "pair_kinds"),
    }
    return g.select("label", *[v.alias(k) for k, v in out.items()])


@dataclass
class Ranking:
    """``merged`` has the prompts that all runs answer, ``jobs`` the pairs to judge, ``summary`` a row a run; ``errors`` the first failed
    judgements; ``report`` one row of counters."""

    merged: DataFrame
    warnings: DataFrame
    jobs: DataFrame
    fingerprint: DataFrame
    ratings: DataFrame | None
    summary: DataFrame
    quadrants: DataFrame
    errors: DataFrame | None
    report: DataFrame


def merged_runs(generations: DataFrame, labels: list[str]) -> tuple[DataFrame, DataFrame]:
    """Prompts that all runs answer, and what was left out, of rows (source, key, place, persona_id, reference, generated, context, context_turns)."""
    m = merge.merge_sources(generations, ["place", "persona_id", "reference", "generated", "context", "context_turns"], len(labels))
    if not m.limit(1).count():
        raise ValueError("the runs have no prompt in common")
    return m, merge.merge_warnings(generations, len(labels))


def rank_style(generations: DataFrame, labels: list[str], judged: DataFrame | None = None, profiles: DataFrame | None = None, priors: DataFrame | None = None, pairs_per_prompt: int = 6,
               seed: int = 0, pairwise_weight: float = 0.7, fingerprint_weight: float = 0.3, elo_k: float = 32.0, elo_start: float = 1500.0) -> Ranking:
    """Rank the runs ``labels`` (places are sources 0, 1, ...) by judgements of pairs and by likeness to the references.

    ``judged`` are comparison rows, error rows among them; without it, or without a good row, the fingerprint counts alone.
    Fillers are mined from the profiles of the personas that occur.
    """
    if len(labels) < 2 or len(set(labels)) != len(labels):
        raise ValueError("two runs or more are ranked, each with a label of its own")
    m, warnings = merged_runs(generations, labels)
    m = materialized(m, "rank-merged")
    fillers = None
    if profiles is not None:
        from .profiles import filler_union

        there = m.select(F.col("base.persona_id").alias("persona_id")).distinct()
        fillers = [r["token"] for r in filler_union(profiles.join(there, "persona_id", "left_semi")).orderBy("place").collect()] or None
    names = F.create_map(*[x for i, label in enumerate(labels) for x in (F.lit(i), F.lit(label))])
    own = m.select(F.col("base.place").alias("place"), F.explode("variants").alias("v")).select(F.element_at(names, F.col("v.source").cast("int")).alias("label"), "place", F.col("v.generated").alias("text"))
    target = m.select(F.lit("").alias("label"), F.col("base.place").alias("place"), T.strip(F.coalesce("base.reference", F.lit(""))).alias("text"))
    found = corpus_features(own.unionByName(target), fillers)
    aim = found.filter("label = ''").select(vector().alias("aim"))
    # One row, joined as a scalar.
    fingerprint = materialized(found.filter("label <> ''").join(F.broadcast(aim), F.lit(True)).withColumn("similarity", cosine(vector(), F.col("aim"))).drop("aim"), "rank-fingerprint")
    jobs = elo.pair_jobs(m.select(F.col("key").alias("sample_key")), labels, pairs_per_prompt, seed)
    v = lambda i: F.element_at(F.col("variants"), F.col(i) + 1)["generated"]
    jobs = jobs.join(m.select(F.col("key").alias("sample_key"), "base", "variants"), "sample_key")
    first, second = F.when(F.col("swap"), v("j")).otherwise(v("i")), F.when(F.col("swap"), v("i")).otherwise(v("j"))
    jobs = jobs.select("sample_key", "i", "j", "a", "b", "swap", user_prompt(F.col("base.context"), F.col("base.context_turns")).alias("user_prompt"), F.nullif(T.strip(F.col("base.reference")), F.lit("")).alias("reference_style"), first.alias("output_a"), second.alias("output_b"))
    ratings = errors = None
    if judged is not None:
        from ..sources.records import ok_comparisons

        good = ok_comparisons(judged).filter(F.col("winner_label").isin(labels) & F.col("loser_label").isin(labels))
        failed = judged.filter(F.coalesce("checkpoint_kind", F.lit("")) == "error")
        errors = failed.orderBy("sample_key", "i", "j").limit(MAX_ERRORS)
        if good.limit(1).count():
            ratings = materialized(elo.replay(good, priors, elo_start, elo_k, seed), "rank-ratings")
    base = fingerprint.select("label", "similarity")
    rated = base.join(ratings.select("label", "rating", "wins", "losses", "games", "win_rate"), "label", "left") if ratings is not None else base.selectExpr("*", "CAST(null AS DOUBLE) AS rating", "0L AS wins", "0L AS losses", "0L AS games", "CAST(null AS DOUBLE) AS win_rate")
    combined = elo.combined(rated, pairwise_weight, fingerprint_weight)
    quads = elo.quadrants(rated.withColumn("rating", F.coalesce("rating", F.lit(float(elo_start))))).select("label", "quadrant")
    summary = combined.join(quads, "label").orderBy(F.col("combined").desc(), "label")
    counts = m.agg(F.count("*").alias("n_merged_samples"), F.lit(len(labels)).alias("k_variants"))
    if judged is not None:
        # One row each, joined as scalars.
        counts = counts.join(good.agg(F.count("*").alias("n_comparisons")), F.lit(True)).join(failed.agg(F.count("*").alias("n_comparison_errors")), F.lit(True))
        counts = counts.withColumn("errors_truncated", F.col("n_comparison_errors") > MAX_ERRORS)
    return Ranking(m, warnings, jobs, fingerprint, ratings, summary, quads, errors, counts)


def backfill(comparisons: DataFrame, groups: DataFrame, store: DataFrame | None, stamp: str, k: float = 32.0, start: float = 1500.0) -> tuple[DataFrame, DataFrame]:
    """Ratings of all groups that checkpoint files speak of: the new store, and a row a group with what went into it.

    A file belongs to the smallest group (gkey, members) that has all its labels, or to one of its own. Of a group's files
    the newest row of each matchup counts; games are replayed by time from the store's ratings. Groups without files stay as they are.
    """
    from ..sources.records import ok_comparisons

    good = materialized(ok_comparisons(comparisons), "backfill-rows")
    labels = good.select("path", F.explode(F.array("winner_label", "loser_label")).alias("label")).groupBy("path").agg(F.array_sort(F.collect_set("label")).alias("labels"))
    keys = materialized(merge.keys_of(labels, groups), "backfill-keys")
    rows = good.join(keys.select("path", F.col("gkey").alias("scope")), "path")
    newest = materialized(elo.newest_wins(rows), "backfill-newest")
    priors = store.select(F.col("gkey").alias("scope"), "label", "rating") if store is not None else None
    rated = materialized(elo.replay_groups(newest, priors, start, k, chronological=True), "backfill-ratings")
    fresh = rated.select(F.col("scope").alias("gkey"), "label", "rating", "win_rate", F.lit(stamp).alias("updated_utc"))
    kept = store.join(fresh.select("gkey").distinct(), "gkey", "left_anti").unionByName(fresh) if store is not None else fresh
    used = newest.groupBy(F.col("scope").alias("gkey")).agg(F.count("*").alias("n_comparisons"), F.countDistinct("path").alias("n_checkpoints"), F.max("mtime").alias("mtime"))
    hint = keys.groupBy("gkey").agg(F.when(F.max("found"), F.lit("discovered_group")).otherwise(F.lit("checkpoint_hash")).alias("hint"))
    runs = rated.groupBy(F.col("scope").alias("gkey")).agg(F.array_sort(F.collect_set("label")).alias("run_ids"))
    return kept, used.join(hint, "gkey").join(runs, "gkey").orderBy("gkey")
