"""Evaluation rows, scores of runs and their comparison."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .profiles import profile_fillers, style_heuristics


def eval_samples(samples: DataFrame, limit_per_persona: int | None = None) -> DataFrame:
    """Samples that end with an assistant turn and have one before: persona, system, context_turns, reference; the first N a persona, by ``place``."""
    last = F.try_element_at("conversations", F.lit(-1))
    s = samples.filter((last["from"] == "assistant") & (F.size("conversations") > 1))
    cut = F.slice("conversations", F.lit(1), F.greatest(F.size("conversations") - 1, F.lit(0)))
    s = s.select("place", F.coalesce(T.falsy(F.col("meta.persona_id")), F.lit("unknown")).alias("persona_id"), F.col("meta.persona_name").alias("persona_name"), "system", cut.alias("context_turns"), last["value"].alias("reference"))
    if limit_per_persona is None:
        return s
    w = Window.partitionBy("persona_id").orderBy("place")
    return s.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= limit_per_persona).drop("__r")


def persona_scores(generations: DataFrame, profiles: DataFrame | None = None, top_n: int = 15) -> DataFrame:
    """(metric, value): persona.heuristics.<persona>.<name> of generations (persona_id, generated, reference)."""
    fillers = None
    if profiles is not None:
        mined = profiles.select("persona_id", profile_fillers(F.struct("top_fillers"), top_n).alias("fillers"))
        generations = generations.join(mined, "persona_id", "left").withColumn("fillers", F.coalesce("fillers", F.array().cast("array<string>")))
        fillers = F.col("fillers")
    h = style_heuristics(generations, fillers)
    names = ["avg_length_diff", "exclamation_rate", "caps_rate", "filler_rate"]
    long = h.select("persona_id", F.explode(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*names))).alias("k", "value"))
    return long.select(F.concat(F.lit("persona.heuristics."), "persona_id", F.lit("."), "k").alias("metric"), "value")


def judge_averages(ratings: DataFrame, axes=("vocabulary", "tone", "length", "authentic_persona", "overall")) -> DataFrame:
    """Per persona and for all (is_total, persona null): the mean of each axis, ratings and errors; rows without rating are errors. A null persona is one of its own."""
    ok = F.col(axes[0]).isNotNull()
    return ratings.groupingSets([["persona_id"], []], "persona_id").agg((F.grouping("persona_id") == 1).alias("is_total"), *[F.avg(a).alias(a) for a in axes], F.count_if(ok).alias("n_rated"), F.count_if(~ok).alias("n_errors"))


def flat_scores(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", F.explode("scores").alias("metric", "value")).filter("value is not null")


def glob_regex(pattern: str) -> str:
    """A shell pattern as a regular expression; case counts."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        end = pattern.find("]", i + 2)
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif c == "[" and end > 0:
            body = pattern[i + 1 : end].replace("\\", "\\\\")
            out += "[" + ("^" + body[1:] if body[0] == "!" else body) + "]"
            i = end
        else:
            out += re.escape(c)
        i += 1
    return f"(?s)^{out}$"


def match_metrics(metrics: DataFrame, patterns: list[str] | None, omit_personas: bool = False) -> DataFrame:
    """Metrics that match, with the place of their first pattern; without patterns all, or all but persona ones."""
    if not patterns:
        kept = metrics.filter(~F.col("metric").startswith("persona.")) if omit_personas else metrics
        return kept.withColumn("place", F.lit(0))
    place = F.coalesce(*[F.when(F.col("metric").rlike(glob_regex(p)), F.lit(i)) for i, p in enumerate(patterns)])
    return metrics.withColumn("place", place).filter("place is not null")


def compare_runs(scores: DataFrame, run_ids: list[str], baseline: str | None, patterns: list[str] | None = None, omit_personas: bool = True) -> DataFrame:
    """Rows (place, metric) with, for each run, its value and its delta and forgetting against the baseline.

    Deltas are null without baseline, or where a value is; forgetting also where the baseline's is 0.
    """
    s = match_metrics(scores.filter(F.col("run_id").isin(*run_ids)), patterns, omit_personas)
    wide = s.groupBy("place", "metric").agg(*[F.max(F.when(F.col("run_id") == r, F.col("value"))).alias(f"value_{i}") for i, r in enumerate(run_ids)])
    k = run_ids.index(baseline) if baseline in run_ids else None
    null = F.lit(None).cast("double")
    base = F.col(f"value_{k}") if k is not None else null
    for i, _ in enumerate(run_ids):
        own = F.col(f"value_{i}") if i != k else null
        wide = wide.withColumns({f"delta_{i}": own - base, f"forgetting_{i}": F.try_divide(base - own, F.nullif(base, F.lit(0.0)))})
    return wide.orderBy("place", "metric")


def top_by_delta(compared: DataFrame, n: int, runs: int) -> DataFrame:
    """The n metrics with the largest absolute delta of a run."""
    size = F.greatest(*[F.abs(f"delta_{i}") for i in range(runs)], F.lit(None).cast("double"))
    return compared.withColumn("size", size).orderBy(F.col("size").desc_nulls_last(), "metric").limit(n)


def top_by_spread(scores: DataFrame, n: int) -> DataFrame:
    """The n metrics with the largest population standard deviation over runs."""
    return scores.groupBy("metric").agg(F.stddev_pop("value").alias("spread")).orderBy(F.col("spread").desc_nulls_last(), "metric").limit(n)


def timeline(scores: DataFrame, runs: DataFrame, metrics: list[str]) -> DataFrame:
    """created_utc and run by chosen metrics."""
    j = scores.filter(F.col("metric").isin(*metrics)).join(runs.select("run_id", "created_utc"), "run_id")
    return j.groupBy("created_utc", "run_id").pivot("metric", metrics).max("value").orderBy("created_utc", "run_id")


def primary_metric(scores: DataFrame, task: str, metric: str) -> DataFrame:
    """The value of task.metric, else of the first that begins so, else of the task's first."""
    rank = F.when(F.col("metric") == f"{task}.{metric}", 0).when(F.col("metric").startswith(f"{task}.{metric}"), 1).when(F.col("metric").startswith(f"{task}."), 2)
    return scores.withColumn("rank", rank).filter("rank is not null").orderBy("rank", "metric").limit(1).select("metric", "value")


def rendered(compared: DataFrame, run_ids: list[str], fmt: str = "table") -> str:
    """A comparison as table, markdown or json; a report is small, so it is rendered on the driver."""
    import json

    rows = [r.asDict() for r in compared.collect()]
    if fmt == "json":
        return json.dumps(rows, indent=2)
    number = lambda x: "—" if x is None else f"{x:.4f}"
    percent = lambda x: "—" if x is None else f"{100 * x:+.1f}%"
    head = ["metric", *(c for r in run_ids for c in (r, "delta", "forgetting"))]
    body = [[r["metric"], *(c for i in range(len(run_ids)) for c in (number(r[f"value_{i}"]), number(r[f"delta_{i}"]), percent(r[f"forgetting_{i}"])))] for r in rows]
    if fmt == "markdown":
        return "\n".join("| " + " | ".join(x) + " |" for x in [head, ["---"] * len(head), *body])
    width = [max(len(x[i]) for x in [head, *body]) for i in range(len(head))]
    return "\n".join("  ".join(c.ljust(w) for c, w in zip(x, width, strict=True)).rstrip() for x in [head, *body])


def delta_bars(compared: DataFrame, column: str = "delta_1", width: int = 20) -> DataFrame:
    """Bars as long as the delta is beside the largest; forgetting in percent."""
    top = F.max(F.abs(column)).over(Window.partitionBy())
    return compared.withColumn("bar", F.repeat(F.lit("#"), F.coalesce(F.bround(F.try_divide(F.abs(column), top) * width).cast("int"), F.lit(0))))


def tracker_metrics(scores: DataFrame) -> DataFrame:
    """persona.x.y as eval/persona/x/y."""
    return scores.filter(F.col("metric").startswith("persona.")).withColumn("metric", F.concat(F.lit("eval/"), F.replace("metric", F.lit("."), F.lit("/"))))


def training_log(log: DataFrame, order: str = "step") -> DataFrame:
    """Per logged step of a run: steps a second, the least eval loss so far, perplexity (below a loss of 80), and the gap of the losses."""
    w = Window.partitionBy("run_id").orderBy(order)
    dt = F.col("time_s") - F.lag("time_s").over(w)
    return log.withColumns({
        "steps_per_s": F.try_divide(F.col("step") - F.lag("step").over(w), F.when(dt > 0, dt)), "best_eval_loss": F.min("eval_loss").over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "perplexity": F.when(F.col("eval_loss") < 80, F.exp("eval_loss")), "loss_gap": F.col("eval_loss") - F.col("train_loss"),
    })


def best_checkpoint(log: DataFrame) -> DataFrame:
    """Per run the checkpoint with the least eval loss, the first of equal ones."""
    return log.filter("eval_loss is not null").groupBy("run_id").agg(F.min_by("step", F.struct("eval_loss", "step")).alias("step"), F.min("eval_loss").alias("eval_loss"))
