"""Balancing, splitting and ordering of samples.

Random choices are orders by the md5 of seed and key: a rerun, on any cluster,
chooses the same rows.  Rows need ``key`` (unique), ``session`` and ``persona``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import stable_order

#: Bins of the uniform turn mix.
UNIFORM = (2, 4, 6, 8)


def parse_policy(policy: str) -> tuple[str, int | None]:
    kind, _, n = policy.partition(":")
    if policy in ("median", "none", "min"):
        return policy, None
    if kind == "cap" and n.strip().isdigit():
        return "cap", int(n)
    raise ValueError(f"unknown balance policy {policy!r}")


def parse_turn_mix(policy: str) -> dict[int, float] | None:
    """none, uniform, or a JSON object of weights by number of turns; weights add up to 1."""
    if policy == "none":
        return None
    raw = dict.fromkeys(UNIFORM, 1.0) if policy == "uniform" else {int(k): float(v) for k, v in json.loads(policy).items()}
    raw = {k: v for k, v in raw.items() if v > 0}
    if not raw:
        raise ValueError("a turn mix needs a weight above 0")
    return {k: v / sum(raw.values()) for k, v in sorted(raw.items())}


def parse_bounds(low: int, high: str | int | None) -> tuple[int, int | None]:
    top = None if high is None or str(high).lower() in ("none", "off", "0") else int(high)
    if low < 2 or low % 2 or (top is not None and (top % 2 or top < low)):
        raise ValueError("numbers of turns must be even, 2 or more, the largest not below the smallest")
    return low, top


def parse_list(text: str, kind=int) -> list:
    out = [kind(x) for x in text.split(",") if x.strip()]
    if not out:
        raise ValueError("an empty list")
    return out


def sweep_lists(baseline: dict, given: dict[str, str | None]) -> dict[str, list]:
    """Lists of a parameter grid: those given as text, of numbers like the baseline's, and the baseline's own value for others."""
    return {k: parse_list(given[k], type(v)) if given.get(k) else [v] for k, v in baseline.items()}


def cap_of(counts: DataFrame, policy: str, k: float = 1.5) -> DataFrame:
    """One row: cap, null for none. ``counts`` has n per persona."""
    kind, n = parse_policy(policy)
    value = {"median": F.bround(F.expr("percentile(n, 0.5)") * k).cast("long"), "min": F.min("n"), "none": F.lit(None).cast("long"), "cap": F.lit(n).cast("long")}[kind]
    return counts.agg(value.alias("cap"))


def round_robin(rows: DataFrame, group: str, cap: Column, seed: int) -> DataFrame:
    """At most ``cap`` rows of a group, taken from its sessions in turn; groups within their cap stay whole.

    A row's rank is what comes before its cell (turn, range of the session's hash) by prefix sums over cells, and its
    place in the cell; so what a task sorts is a session or a cell, never a group.
    """
    inner = Window.partitionBy(group, "session").orderBy(stable_order(seed, F.col("key")), "key")
    r = rows.withColumn("__turn", F.row_number().over(inner)).withColumn("__session", stable_order(seed, F.col("session")))
    r = r.withColumn("__part", F.substring("__session", 1, 3))
    cells = r.groupBy(F.col(group).alias("__group"), F.col("__turn").alias("__t"), F.col("__part").alias("__p")).agg(F.count("*").alias("__n"))
    ahead = Window.partitionBy("__group").orderBy("__t", "__p").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("__before", F.coalesce(F.sum("__n").over(ahead), F.lit(0))).drop("__n")
    r = r.join(cells, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__turn") == F.col("__t")) & (F.col("__part") == F.col("__p")))
    place = Window.partitionBy(group, "__turn", "__part").orderBy("__session", "session")
    r = r.withColumn("__rank", F.col("__before") + F.row_number().over(place)).filter(cap.isNull() | (F.col("__rank") <= cap))
    return r.drop("__turn", "__session", "__part", "__group", "__t", "__p", "__before", "__rank")


def balance(rows: DataFrame, policy: str = "median", k: float = 1.5, seed: int = 0) -> DataFrame:
    """Rows of personas above the cap are sampled down to it, spread over their sessions."""
    cap = cap_of(rows.groupBy("persona").agg(F.count("*").alias("n")), policy, k)
    # One row: a scalar, joined by broadcast.
    return round_robin(rows.join(F.broadcast(cap), F.lit(True)), "persona", F.col("cap"), seed).drop("cap")


def balance_report(before: DataFrame, after: DataFrame, policy: str = "median", k: float = 1.5) -> DataFrame:
    """A row a persona: its cap (its own count, without a cap), and its rows before and after."""
    n = before.groupBy("persona").agg(F.count("*").alias("n"))
    left = after.groupBy(F.col("persona").alias("p")).agg(F.count("*").alias("m"))
    # One row, joined as a scalar.
    j = n.join(F.broadcast(cap_of(n, policy, k)), F.lit(True)).join(left, F.col("persona").eqNullSafe(F.col("p")), "left")
    return j.select("persona", F.coalesce("cap", "n").alias("cap"), F.col("n").alias("before"), F.coalesce("m", F.lit(0)).alias("after"))


def balance_turns(rows: DataFrame, policy: str = "none", seed: int = 0) -> DataFrame:
    """Rows (with num_turns) so that numbers of turns with a weight are in its proportions; others stay.

    alpha is the smallest count by weight of the bins that have rows; a bin keeps int(alpha * weight) rows.
    """
    weights = parse_turn_mix(policy)
    if weights is None:
        return rows
    w = F.try_element_at(F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(v))]), F.col("num_turns").cast("int"))
    r = rows.withColumn("__w", w)
    counts = r.filter("__w is not null").groupBy("num_turns", "__w").agg(F.count("*").alias("n"))
    alpha = counts.agg(F.min(F.col("n") / F.col("__w")).alias("alpha"))
    bins = round_robin(r.filter("__w is not null").join(F.broadcast(alpha), F.lit(True)), "num_turns", F.floor(F.col("alpha") * F.col("__w") + 1e-9), seed)
    return bins.drop("alpha", "__w").unionByName(r.filter("__w is null").drop("__w"))


def split(rows: DataFrame, val_frac: float = 0.10, seed: int = 0) -> DataFrame:
    """``split``: val for the sessions that come first in hash order (one at least, if val_frac > 0), train for the rest."""
    s = rows.select("session").distinct().withColumn("h", stable_order(seed, F.col("session")))
    # Ranks by parts: sessions are counted in 4096 ranges of the hash, and ranked within the one where the cut falls.
    s = s.withColumn("part", F.conv(F.substring("h", 1, 3), 16, 10).cast("int"))
    n = s.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    n_val = F.when(F.lit(val_frac > 0), F.greatest(F.lit(1), F.floor(F.sum("n").over(every) * val_frac).cast("long"))).otherwise(F.lit(0))
    parts = n.withColumns({"before": F.coalesce(F.sum("n").over(before), F.lit(0)), "n_val": n_val})
    s = s.join(F.broadcast(parts), "part").withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy("h", "session")))
    marked = s.select("session", F.when(F.col("rank") <= F.col("n_val"), "val").otherwise("train").alias("split"))
    return rows.join(marked, "session")


def turn_histogram(rows: DataFrame) -> DataFrame:
    """Rows by number of turns; null is ``other``."""
    return rows.groupBy(F.coalesce(F.col("num_turns").cast("string"), F.lit("other")).alias("num_turns")).agg(F.count("*").alias("n"))


def split_breakdown(rows: DataFrame) -> DataFrame:
    c = rows.groupBy("split", F.coalesce(F.col("num_turns").cast("string"), F.lit("other")).alias("num_turns")).agg(F.count("*").alias("n"))
    return c.withColumn("fraction", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("split")), 6))


def shuffled(rows: DataFrame, seed: int = 0) -> DataFrame:
    return rows.orderBy(stable_order(seed, F.col("key")), "key")
