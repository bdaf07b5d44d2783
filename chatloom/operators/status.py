"""Figures on stored corpora and on how far a workspace has come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import falsy, word_count


def session_stats(turns: DataFrame) -> DataFrame:
    """One row on turns (folder, session_id, author_id, text): sessions, turns, words, authors, folders."""
    return turns.agg(F.countDistinct("folder", "session_id").alias("sessions"), F.count("*").alias("turns"), F.coalesce(F.sum(word_count("text")), F.lit(0)).cast("long").alias("words"), F.countDistinct("author_id").alias("authors"), F.countDistinct(falsy("folder")).alias("folders"))


def sample_stats(samples: DataFrame) -> DataFrame:
    """One row on samples (meta): samples, sessions, personas, mean number of turns of those that have any."""
    m = samples.select("meta.*")
    return m.agg(F.count("*").alias("samples"), F.countDistinct(falsy("session_id")).alias("sessions"), F.countDistinct(falsy("persona_id")).alias("personas"), F.round(F.avg(F.when(F.col("num_turns") > 0, F.col("num_turns"))), 2).alias("mean_turns"))


def top_personas(samples: DataFrame, n: int = 12) -> DataFrame:
    return samples.groupBy(F.col("meta.persona_id").alias("persona_id")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "persona_id").limit(n)


def folder_stats(files: DataFrame) -> DataFrame:
    """Files and bytes by folder of rows (path, length)."""
    return files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


#: Steps of a workspace in order.
STEPS = ("ingest", "curate", "sft", "fingerprint", "evals")


def effective(flags: dict[str, bool], steps=STEPS) -> dict[str, bool]:
    """A step counts as done if it, or any after it, is."""
    last = max((i for i, s in enumerate(steps) if flags.get(s)), default=-1)
    return {s: i <= last for i, s in enumerate(steps)}


def completion(flags: dict[str, bool], steps=STEPS) -> dict:
    """How many steps are done one after another, of how many, the next, and whether one that is there stands after a gap.

    Later results prove earlier steps, and a workspace that lacks only the first step's results has no gap.
    """
    done = effective(flags, steps)
    n = next((i for i, s in enumerate(steps) if not done[s]), len(steps))
    gap = next((i for i, s in enumerate(steps) if not flags.get(s)), len(steps))
    broken = 0 < gap < len(steps) and any(flags.get(s) for s in steps[gap + 1 :])
    return {"completed": n, "total": len(steps), "fraction": n / len(steps), "next": steps[n] if n < len(steps) else None, "chain_broken": broken}


def flags_of(spark: SparkSession, work: str) -> dict[str, bool]:
    """Which steps have results under a working folder."""
    from ..sources.stores import Files

    files, at = Files(spark), work.rstrip("/")
    some = lambda path: (files.is_file(path) and files.size(path) > 0) or any(n.startswith("part-") for n in files.names(path))
    found = lambda *paths: any(some(f"{at}/{p}") for p in paths)
    return {
        "ingest": any(files.is_dir(f"{at}/messages/{n}") for n in files.names(f"{at}/messages")), "curate": found("curated/sessions.jsonl", "curated/sessions"),
        "sft": found("sft/train.jsonl", "sft/train"), "fingerprint": found("sft/profiles.json"), "evals": any(n.endswith(".json") for n in files.names(f"{at}/evals/runs")),
    }


def profiles_summary(spark: SparkSession, path: str) -> dict | None:
    """Personas and bytes of a profiles document; none where it isn't one."""
    from ..sources.stores import Files

    doc = Files(spark).document(path)
    personas = (doc or {}).get("personas")
    return {"personas": len(personas), "bytes": Files(spark).size(path)} if isinstance(personas, dict) else None


def runs_summary(runs: DataFrame) -> DataFrame:
    """One row: how many runs, and the latest one's id, time and label."""
    last = F.max_by(F.struct("run_id", "created_utc", "label"), F.struct("created_utc", "run_id"))
    return runs.agg(F.count("*").alias("runs"), last.alias("latest"))


def snapshot(spark: SparkSession, work: str) -> dict:
    """Flags, completion, and the reports that are there."""
    from ..sources.stores import load_report

    at, flags = work.rstrip("/"), flags_of(spark, work)
    return {
        "work": at, "flags": flags, "pipeline": completion(flags), "curate_report": load_report(spark, f"{at}/curated/curate_report.json"),
        "balance_report": load_report(spark, f"{at}/sft/balance_report.json"), "profiles": profiles_summary(spark, f"{at}/sft/profiles.json"),
    }
