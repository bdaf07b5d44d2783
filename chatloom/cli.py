"""Command line: the pipeline's steps over files."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from . import session
from .functions.ids import sample_key
from .functions.judging import first_object, rating
from .operators import balance, elo, evals, merge, profiles, rank, sft, template, tokens
from .plans.curate import GRID, Options, curate, sweep, sweep_table
from .sources import exports, records, stores


def _messages(spark, source):
    return exports.ordered(exports.read_messages(spark, source))


def _options(a) -> Options:
    return Options(
        a.merge_gap_sec, a.session_gap_min, a.min_turns, a.min_authors, a.monologue_max_share, a.url_strip, not a.no_pii_scrub, a.lang,
        None if a.no_near_dedup else a.near_dedup_threshold, not a.no_dedupe_exact_turns, a.exact_turn_dup_cap,
    )


def ingest(spark, a):
    for r in records.write_by_folder(exports.read_messages(spark, a.source), a.out, a.format).orderBy("folder").toLocalIterator():
        print(f"{r['folder']}\t{r['count']}")


def run_curate(spark, a):
    out = curate(_messages(spark, a.source), _options(a))
    records.write_jsonl(records.session_records(out.turns), f"{a.out}/sessions", ["folder", "first_ts"])
    report = out.report.head().asDict()
    stores.save_report(spark, report, f"{a.out}/curate_report.json")
    print(json.dumps(report, indent=2))


def run_sweep(spark, a):
    o = _options(a)
    lists = balance.sweep_lists({k: getattr(o, k) for k in GRID}, {k: getattr(a, f"sweep_{k}") for k in GRID})
    rows = sweep(_messages(spark, a.source), o, a.max_combos, **lists).cache()
    records.write_jsonl(rows, a.out, one_file=True)
    for r in sweep_table(rows).toLocalIterator():
        print(json.dumps(r.asDict()))


def build_sft(spark, a):
    low, top = balance.parse_bounds(a.min_sharegpt_turns, a.max_sharegpt_turns)
    personas = None if a.personas == "all" else a.personas.split(",")
    s = sft.samples(records.read_sessions(spark, a.sessions), personas, a.window_turns, low, top)
    rows = s.select(F.concat_ws("|", "folder", "session_id", "persona_id").alias("key"), F.concat_ws("|", "folder", "session_id").alias("session"), F.col("persona_id").alias("persona"), F.col("meta.num_turns").alias("num_turns"), "system", "conversations", "meta")
    whole = balance.balance(rows, a.balance, a.balance_k, a.seed)
    kept = balance.split(balance.balance_turns(whole, a.turn_mix, a.seed), a.val_frac, a.seed).cache()
    for part in ("train", "val"):
        records.write_jsonl(balance.shuffled(kept.filter(F.col("split") == part), a.seed).select("system", "conversations", "meta"), f"{a.out}/{part}")
    # A row a persona, and a row a split and number of turns.
    personas = {r["persona"]: r.asDict() for r in balance.balance_report(rows, whole, a.balance, a.balance_k).collect()}
    report = {"policy": a.balance, "k": a.balance_k, **{name: {p: r[c] for p, r in personas.items()} for name, c in (("cap_per_persona", "cap"), ("counts_before", "before"), ("counts_after", "after"))}}
    turns = {"policy": a.turn_mix, "splits": [r.asDict() for r in balance.split_breakdown(kept).orderBy("split", "num_turns").collect()]}
    stores.save_report(spark, report, f"{a.out}/balance_report.json")
    stores.save_report(spark, turns, f"{a.out}/turn_length_report.json")
    n = {r["split"]: r["n"] for r in kept.groupBy("split").agg(F.count("*").alias("n")).collect()}
    print(json.dumps({"train": n.get("train", 0), "val": n.get("val", 0), "balance": report, "turn_length": turns}, indent=2))


def _encoder(name: str):
    """A tokenizer from a vocabulary file (see ``tokenizers.Tokenizer``), or one that counts words."""
    if name == "words":
        return tokens.T.word_count
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(name)
    return tokens.encoder(lambda s: loaded.encode(s).ids)


def stats(spark, a):
    samples = records.read_samples(spark, a.samples)
    if len(a.tokenizer) > 1:
        for r in tokens.compare_tokenizers(samples, {n: _encoder(n) for n in a.tokenizer}).orderBy("place").collect():
            print(json.dumps(r.asDict()))
        return
    c = tokens.counted(samples, _encoder(a.tokenizer[0])).cache()
    by = {r["persona_id"]: {"tokens": r["tokens"], "samples": r["samples"]} for r in tokens.tokens_by_persona(c).collect()}
    print(json.dumps(tokens.token_stats(c).head().asDict() | {"by_persona": by}, indent=2))


def validate(spark, a):
    s = records.head_rows(spark, a.samples, records.SAMPLE, a.max_samples).withColumn("place", F.monotonically_increasing_id())
    checks = template.checked(s).cache()
    print(json.dumps(template.summary(checks).head().asDict(), indent=2))
    for r in template.errors(checks, "place", a.max_errors).collect():
        print(json.dumps(r.asDict()))


def fingerprint(spark, a):
    p = profiles.build_profiles(profiles.assistant_texts(records.read_samples(spark, a.samples)), a.top_k)
    print(json.dumps({"personas": stores.save_profiles(spark, p, a.out)}))


def heuristics(spark, a):
    w = F.row_number().over(Window.orderBy("i"))
    read = lambda p: records.lines(spark, p).withColumn("i", F.monotonically_increasing_id()).select(w.alias("place"), F.col("line").alias("text"))
    rows = merge.aligned(read(a.generated), read(a.reference)).withColumn("persona_id", F.lit(a.persona or "all"))
    fillers = None
    if a.profile:
        p = stores.read_profiles(spark, a.profile)
        p = p.filter(F.col("persona_id") == a.persona) if a.persona else p
        found = [r["token"] for r in profiles.filler_union(p, 15).orderBy("place").collect()]
        fillers = F.array(*map(F.lit, found)) if found else None
    print(json.dumps(profiles.style_heuristics(rows, fillers).head().asDict(), indent=2))


def eval_run(spark, a):
    """Scores of given generations as a run document."""
    g = records.read_generations(spark, a.generations)
    known = stores.read_profiles(spark, a.profiles) if a.profiles else None
    scores = {r["metric"]: r["value"] for r in evals.persona_scores(g, known).orderBy("metric").collect()}
    if a.results:
        scores |= {r["metric"]: r["score"] for r in records.flatten_results(records.newest_results(spark, a.results)).orderBy("metric").collect()}
    when = a.stamp or stores.stamp()
    from .functions.ids import run_id

    name = spark.range(1).select(run_id(F.lit(a.model), F.lit(when), F.lit(a.label or ""))).head()[0]
    run = {"run_id": name, "created_utc": when, "label": a.label, "model": {"name_or_path": a.model}, "config": {"val_jsonl": a.val}, "scores": scores, "persona": {"generations_path": a.generations}}
    print(stores.save_run(spark, run, a.out))


def judge_persona(spark, a):
    """Averages of a judge's answers (JSON lines with persona_id and answer)."""
    rows = records.read_jsonl(spark, a.answers, "persona_id STRING, answer STRING").withColumn("r", rating(first_object("answer")))
    axes = ("vocabulary", "tone", "length", "authentic_persona", "overall")
    found = evals.judge_averages(rows.select("persona_id", *[F.col(f"r.{x}").alias(x) for x in axes]), axes).orderBy(F.col("is_total").desc(), "persona_id").collect()
    report = {"overall": next(r.asDict() for r in found if r["is_total"]), "personas": [r.asDict() for r in found if not r["is_total"]]} if found else {}
    if a.out:
        stores.save_report(spark, report, a.out)
    print(json.dumps(report, indent=2))


def rank_style(spark, a):
    labels = a.label or [p.rstrip("/").split("/")[-2] for p in a.generations]
    if len(labels) != len(a.generations):
        raise ValueError("a label for each dump")
    parts = []
    for i, path in enumerate(a.generations):
        place = F.monotonically_increasing_id().alias("place")
        parts.append(records.read_generations(spark, path).select("*", F.lit(i).alias("source"), place, sample_key(F.col("persona_id"), F.col("context_turns"), F.col("reference")).alias("key")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    if not a.skip_provenance_check:
        first = rows.groupBy("source").agg(F.min_by("eval_val_jsonl", "place").alias("eval_val_jsonl"), F.min_by("eval_val_sha256", "place").alias("eval_val_sha256"))
        merge.provenance(first, a.use_val_hash).head()
    judged = records.read_comparisons(spark, a.comparisons) if a.comparisons else None
    known = stores.read_profiles(spark, a.profiles) if a.profiles else None
    r = rank.rank_style(rows, labels, judged, known, None, a.pairs_per_prompt, a.seed, a.pairwise_weight, a.fingerprint_weight, a.elo_k, a.elo_start)
    records.write_jsonl(r.jobs, f"{a.out}/jobs", ["sample_key", "i", "j"])
    summary = [x.asDict() for x in r.summary.collect()]
    errors = [x.asDict() for x in r.errors.select("sample_key", "i", "j", "error", "error_type").collect()] if r.errors is not None else []
    stores.save_report(spark, r.report.head().asDict() | {"runs": summary, "warnings": [x.asDict() for x in r.warnings.collect()], "errors": errors}, f"{a.out}/report.json")
    for x in summary:
        print(json.dumps(x))


def backfill(spark, a):
    """Ratings of all groups from checkpoint files."""
    path = f"{a.root.rstrip('/')}/style_rank_group_elo.json"
    rows = records.read_comparisons(spark, a.checkpoints or f"{a.root.rstrip('/')}/style_rank_checkpoints")
    groups = stores.groups(stores.grouped_dumps(spark, stores.saved_dumps(spark, a.root)))
    store, written = rank.backfill(rows, groups, None if a.replace else stores.read_ratings(spark, path), stores.now(), a.elo_k, a.elo_start)
    found = written.collect()
    if found:
        stores.write_ratings(spark, store, path)
    for r in found:
        print(json.dumps(r.asDict(), default=str))


def run_list(spark, a):
    for r in records.list_runs(records.read_runs(spark, a.runs)).toLocalIterator():
        print(json.dumps(r.asDict()))


def run_compare(spark, a):
    scores = evals.flat_scores(records.read_runs(spark, a.runs))
    base = a.run[0] if a.baseline is None else (a.baseline or None)
    print(evals.rendered(evals.compare_runs(scores, a.run, base, a.metrics, not a.include_persona_metrics), a.run, a.format))


def run_rank(spark, a):
    rows = elo.newest_wins(records.ok_comparisons(records.read_comparisons(spark, a.comparisons)))
    for r in elo.replay(rows, start=a.elo_start, k=a.elo_k, seed=a.seed).orderBy(F.col("rating").desc()).collect():
        print(json.dumps(r.asDict()))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("chatloom")
    p.add_argument("--master")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name, f, *args):
        c = sub.add_parser(name)
        c.set_defaults(func=f)
        for x in args:
            c.add_argument(x)
        return c

    command("ingest", ingest, "source", "out").add_argument("--format", default="parquet", choices=("parquet", "jsonl"))
    for name, f in (("curate", run_curate), ("curate-sweep", run_sweep)):
        c = command(name, f, "source", "out")
        for k, v in (("merge-gap-sec", 30.0), ("session-gap-min", 60.0), ("monologue-max-share", 0.80), ("near-dedup-threshold", 0.85)):
            c.add_argument(f"--{k}", type=float, default=v)
        for k, v in (("min-turns", 2), ("min-authors", 2), ("exact-turn-dup-cap", 1)):
            c.add_argument(f"--{k}", type=int, default=v)
        for k in ("url-strip", "no-pii-scrub", "no-near-dedup", "no-dedupe-exact-turns"):
            c.add_argument(f"--{k}", action="store_true")
        c.add_argument("--lang")
        if name == "curate-sweep":
            c.add_argument("--max-combos", type=int, default=500)
            for k in GRID:
                c.add_argument(f"--sweep-{k.replace('_', '-')}", dest=f"sweep_{k}")
    c = command("build-sft", build_sft, "sessions", "out")
    for k, t, v in (("window-turns", int, 16), ("min-sharegpt-turns", int, 2), ("max-sharegpt-turns", str, "8"), ("turn-mix", str, "none"), ("personas", str, "all"), ("balance", str, "median"), ("balance-k", float, 1.5), ("val-frac", float, 0.10), ("seed", int, 0)):
        c.add_argument(f"--{k}", type=t, default=v)
    command("stats", stats, "samples").add_argument("--tokenizer", nargs="+", default=["words"])
    c = command("validate-chat-template", validate, "samples")
    c.add_argument("--max-samples", type=int, default=500)
    c.add_argument("--max-errors", type=int, default=20)
    command("fingerprint", fingerprint, "samples", "out").add_argument("--top-k", type=int, default=25)
    c = command("eval-heuristics", heuristics, "generated", "reference")
    c.add_argument("--profile")
    c.add_argument("--persona")
    c = command("eval-run", eval_run, "generations", "out")
    c.add_argument("--model", required=True)
    for k in ("label", "val", "profiles", "results", "stamp"):
        c.add_argument(f"--{k}")
    command("eval-judge-persona", judge_persona, "answers").add_argument("--out")
    c = command("eval-rank-style", rank_style, "out")
    c.add_argument("--generations", nargs="+", required=True)
    c.add_argument("--label", nargs="*")
    for k in ("comparisons", "profiles"):
        c.add_argument(f"--{k}")
    for k in ("skip-provenance-check", "use-val-hash"):
        c.add_argument(f"--{k}", action="store_true")
    for k, t, v in (("pairs-per-prompt", int, 6), ("seed", int, 0), ("pairwise-weight", float, 0.7), ("fingerprint-weight", float, 0.3), ("elo-k", float, 32.0), ("elo-start", float, 1500.0)):
        c.add_argument(f"--{k}", type=t, default=v)
    c = command("eval-backfill", backfill, "root")
    c.add_argument("--checkpoints")
    c.add_argument("--replace", action="store_true")
    for k, v in (("elo-k", 32.0), ("elo-start", 1500.0)):
        c.add_argument(f"--{k}", type=float, default=v)
    command("eval-list", run_list, "runs")
    c = command("eval-compare", run_compare, "runs")
    c.add_argument("run", nargs="+")
    c.add_argument("--baseline")
    c.add_argument("--metrics", nargs="*")
    c.add_argument("--include-persona-metrics", action="store_true")
    c.add_argument("--format", default="table", choices=("table", "markdown", "json"))
    c = command("rank", run_rank, "comparisons")
    for k, t, v in (("elo-k", float, 32.0), ("elo-start", float, 1500.0), ("seed", int, 0)):
        c.add_argument(f"--{k}", type=t, default=v)
    return p


def main(argv=None) -> None:
    a = parser().parse_args(argv)
    a.func(session.build(a.master), a)


if __name__ == "__main__":
    main()
