"""Merging generation dumps, verdicts on them, and keys of comparable groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import group_key, variant_id
from ..functions.text import strip


def last_by_key(rows: DataFrame) -> DataFrame:
    """Of rows (source, place, key, ...) the last of each source and key."""
    rest = F.struct(*[c for c in rows.columns if c not in ("source", "key")])
    return rows.groupBy("source", "key").agg(F.max_by(rest, "place").alias("r")).select("source", "key", "r.*")


def merge_sources(rows: DataFrame, payload: list[str], n_sources: int) -> DataFrame:
    """Keys that every source has: key, base (the payload of source 0) and variants (an array by source)."""
    v = F.struct("source", *payload)
    g = last_by_key(rows).groupBy("key").agg(F.array_sort(F.collect_list(v)).alias("variants")).filter(F.size("variants") == n_sources)
    return g.select("key", F.element_at("variants", 1).alias("base"), "variants")


def merge_warnings(rows: DataFrame, n_sources: int) -> DataFrame:
    """Per source: rows, repeated keys, and keys that some source lacks."""
    k = rows.groupBy("source", "key").agg(F.count("*").alias("n"))
    held = k.withColumn("held", F.count("*").over(Window.partitionBy("key")))
    return held.groupBy("source").agg(F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 1).alias("repeated_keys"), F.count_if(F.col("held") < n_sources).alias("dropped_keys"))


def verdicts(explicit: DataFrame, legacy: DataFrame | None = None) -> DataFrame:
    """(comparison, sample_key, variant_id, verdict): accepted or rejected; a legacy vote is accepted, and an explicit verdict wins."""
    e = explicit.filter(F.col("verdict").isin("accepted", "rejected")).withColumn("pri", F.lit(0))
    if legacy is not None:
        e = e.unionByName(legacy.select("comparison", "sample_key", "variant_id", F.lit("accepted").alias("verdict"), F.lit(1).alias("pri")))
    return e.groupBy("comparison", "sample_key", "variant_id").agg(F.min_by("verdict", F.struct("pri", "verdict")).alias("verdict"))


def verdict_tally(pairs: DataFrame, votes: DataFrame) -> DataFrame:
    """Per variant of all (sample_key, variant_id): accepted, rejected and neutral, best first."""
    j = pairs.join(votes.select("sample_key", "variant_id", "verdict"), ["sample_key", "variant_id"], "left").withColumn("v", F.coalesce("verdict", F.lit("neutral")))
    n = lambda v: F.count_if(F.col("v") == v).alias(v)
    return j.groupBy("variant_id").agg(n("accepted"), n("rejected"), n("neutral")).orderBy(F.col("accepted").desc(), "rejected", "variant_id")


def apply_verdict(votes: DataFrame, change: DataFrame) -> DataFrame:
    """One or more verdicts set; ``neutral`` takes a verdict away."""
    keys = ["comparison", "sample_key", "variant_id"]
    return votes.join(change.select(*keys), keys, "left_anti").unionByName(change.filter("verdict <> 'neutral'"))


def search(rows: DataFrame, words: str, columns: list[str], variants: str | None = None, personas: list[str] | None = None) -> DataFrame:
    """Rows one of whose columns, or one of whose ``variants`` (an array with ``generated``), contains the words, whatever the case; of the given personas."""
    low = words.lower()
    has = lambda x: F.contains(F.lower(F.coalesce(x, F.lit(""))), F.lit(low))
    hit = F.lit(False)
    for c in columns:
        hit = hit | has(F.col(c))
    if variants:
        hit = hit | F.exists(F.coalesce(F.col(variants)["generated"], F.array().cast("array<string>")), has)
    return (rows.filter(F.col("persona_id").isin(*personas)) if personas else rows).filter(hit)


def in_folders(rows: DataFrame, folders: list[str]) -> DataFrame:
    """Rows of the chosen folders; all without a choice."""
    return rows.filter(F.col("folder").isin(*folders)) if folders else rows


def compat_key(row_sha: Column, row_path: Column, slice_hash: Column, manifest_path: Column, path: Column) -> Column:
    """The key of what a dump can be compared with: the first that is there of validation hash, its path, the hash of the prompts, the manifest's path; else the hash of the dump's own path."""
    some = lambda kind, x: F.when(strip(F.coalesce(x, F.lit(""))) != "", group_key(F.lit(kind), strip(x)))
    return F.coalesce(some("valsha", row_sha), some("path", row_path), some("evalset", slice_hash), some("manifest_path", manifest_path), group_key(F.lit("unknown"), F.substring(F.sha2(path.cast("binary"), 256), 1, 16)))


def group_title(groups: DataFrame) -> DataFrame:
    """``title`` of rows (gkey, runs): what the key stands for and how many runs it has."""
    kind, value = F.substring_index("gkey", "\u001f", 1), F.substring_index("gkey", "\u001f", -1)
    name = F.substring_index(value, "/", -1)
    head = (
        F.when(kind == "valsha", F.concat(F.lit("Val file (sha256) "), F.substring(value, 1, 12), F.lit("\u2026"))).when(kind == "path", name)
        .when(kind == "evalset", F.concat(F.lit("Eval slice \u00b7 "), F.substring(value, 1, 10), F.lit("\u2026"))).when(kind == "manifest_path", F.concat(F.lit("Manifest only \u00b7 "), name)).otherwise(F.lit("Unknown val"))
    )
    return groups.withColumn("title", F.concat(head, F.lit(" \u2014 "), F.col("runs").cast("string"), F.lit(" runs")))


def slice_fingerprint(rows: DataFrame) -> DataFrame:
    """Per dump (source): rows and the hash of its sorted keys.

    A dump is the answers to one validation set, of some thousand rows; its keys meet in one row.
    """
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("key")), "\n").cast("binary"), 256).alias("fingerprint"))


def fallback_key(labels: Column) -> Column:
    """The key of a group that no saved dumps form, from an array of its labels."""
    return group_key(F.lit("checkpoint"), F.substring(F.sha2(F.array_join(F.array_sort(F.array_distinct(labels)), "|").cast("binary"), 256), 1, 24))


def smallest_superset(groups: DataFrame, ids: list[str]) -> DataFrame:
    """One row: gkey of the group (gkey, members) with fewest members that has all ids, the first by key of equal ones; else the fallback key. ``found`` tells which."""
    wanted = F.array(*map(F.lit, ids))
    g = groups.filter(F.size(F.array_except(wanted, F.col("members"))) == 0)
    best = g.agg(F.min_by("gkey", F.struct(F.size("members"), "gkey")).alias("g"))
    return best.select(F.coalesce("g", fallback_key(wanted)).alias("gkey"), F.col("g").isNotNull().alias("found"))


def keys_of(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """``sets`` (path, labels) with gkey and ``found``, as ``smallest_superset`` has them, for all sets at once.

    Sets and groups are joined by their labels and a group that has them all has as many; no set meets a group without a label in common.
    """
    size = groups.select("gkey", F.size("members").alias("n"), F.explode("members").alias("label"))
    asked = sets.select("path", F.size("labels").alias("wanted"), F.explode("labels").alias("label"))
    full = asked.join(size, "label").groupBy("path", "wanted", "gkey", "n").agg(F.count("*").alias("held")).filter("held = wanted")
    best = full.groupBy("path").agg(F.min_by("gkey", F.struct("n", "gkey")).alias("g"))
    return sets.join(best, "path", "left").select(*sets.columns, F.coalesce("g", fallback_key(F.col("labels"))).alias("gkey"), F.col("g").isNotNull().alias("found"))


def provenance(rows: DataFrame, by_hash: bool = False) -> DataFrame:
    """One row on runs (eval_val_jsonl, eval_val_sha256): the path (or hash) that all share; raises where a run has none, or another."""
    c, what = F.col("eval_val_sha256" if by_hash else "eval_val_jsonl"), "hash" if by_hash else "path"
    value = F.nullif(strip(c), F.lit(""))
    a = rows.agg(F.countDistinct(value).alias("n"), F.count_if(value.isNull()).alias("missing"), F.min(value).alias("value"))
    ok = F.when(F.col("missing") > 0, F.raise_error(F.lit(f"a run has no validation {what}")).cast("string"))
    ok = ok.when(F.col("n") > 1, F.raise_error(F.lit(f"the runs differ in their validation {what}")).cast("string")).otherwise(F.col("value"))
    return a.select(F.lit("sha256" if by_hash else "path").alias("mode"), ok.alias("value"))


def variant_metadata(sources: DataFrame) -> DataFrame:
    """(variant_id, path, label) of dumps (path, source, label); without a label the file's name."""
    return sources.select(variant_id(F.col("path"), F.col("source")).alias("variant_id"), "path", F.coalesce(F.nullif(F.col("label"), F.lit("")), F.substring_index("path", "/", -1)).alias("label"))


def aligned(generated: DataFrame, reference: DataFrame) -> DataFrame:
    """Rows (place, text) of both, by place; different numbers raise."""
    j = generated.select("place", F.col("text").alias("generated")).join(reference.select("place", F.col("text").alias("reference")), "place", "full_outer")
    bad = F.col("generated").isNull() | F.col("reference").isNull()
    return j.select("place", F.when(bad, F.raise_error(F.lit("different numbers of lines")).cast("string")).otherwise(F.col("generated")).alias("generated"), "reference")
