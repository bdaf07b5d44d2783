"""Gradient probes: sums by module and layer, inequality, scores, and a census of adapter tensors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parse_names(records: DataFrame, modules: str = "q_proj|k_proj|v_proj|o_proj|gate_proj|up_proj|down_proj") -> DataFrame:
    """``module`` and ``layer`` from parameter names."""
    return records.withColumns({"module": F.nullif(F.regexp_extract("name", rf"\.({modules})(?:\.|$)", 1), F.lit("")), "layer": F.expr(r"try_cast(nullif(regexp_extract(name, '\\.(\\d+)\\.', 1), '') AS INT)")})


def gradient_sums(records: DataFrame) -> DataFrame:
    """(level, module, layer): sum, mean, max and count of grad_norm by module, by layer and by both; records that lack a level's key don't count for it."""
    g = records.groupingSets([["module"], ["layer"], ["layer", "module"]], "module", "layer").agg(
        F.grouping_id("module", "layer").alias("gid"), F.sum("grad_norm").alias("sum"), F.avg("grad_norm").alias("mean"), F.max("grad_norm").alias("max"), F.count("*").alias("count")
    )
    level = F.when(F.col("gid") == 1, "module").when(F.col("gid") == 2, "layer").otherwise("layer_module")
    g = g.withColumn("level", level).drop("gid")
    ok = F.when(F.col("level") == "module", F.col("module").isNotNull()).when(F.col("level") == "layer", F.col("layer").isNotNull()).otherwise(F.col("module").isNotNull() & F.col("layer").isNotNull())
    return g.filter(ok)


def ranked(sums: DataFrame) -> DataFrame:
    w = Window.partitionBy("level").orderBy(F.col("sum").desc(), "module", "layer")
    return sums.withColumn("rank", F.row_number().over(w))


def gini(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Gini coefficient by group; null and negative values count as 0, a group of zeros has 0.

    Ranks are those before a value's bin, by prefix sums over bins (256 to a factor of 2), and the place in it, so a task sorts
    a bin and never a group. Zeros add nothing but their number.
    """
    x = rows.select(F.col(group), F.greatest(F.coalesce(F.col(value).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("x"))
    x = x.withColumn("bin", F.when(F.col("x") > 0, F.floor(F.log2("x") * 256)).otherwise(F.lit(-(2**40))))
    bins = x.groupBy(group, "bin").agg(F.count("*").alias("n"), F.sum("x").alias("s"))
    ahead = Window.partitionBy(group).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    place = F.row_number().over(Window.partitionBy(group, "bin").orderBy("x"))
    inner = x.filter("x > 0").withColumn("i", place).groupBy(F.col(group).alias("__g"), F.col("bin").alias("__b")).agg(F.sum(F.col("i") * F.col("x")).alias("ix"))
    both = bins.join(inner, F.col(group).eqNullSafe(F.col("__g")) & (F.col("bin") == F.col("__b")), "left")
    g = both.groupBy(group).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum(F.coalesce("ix", F.lit(0.0)) + F.col("before") * F.col("s")).alias("ix"))
    n = F.col("n")
    return g.select(group, n, F.coalesce(F.try_divide(2 * F.col("ix"), n * F.col("s")) - (n + 1) / n, F.lit(0.0)).alias("gini"))


def probe_score(rows: DataFrame) -> DataFrame:
    """``score`` of rows (loss_drop, stability, gini_layer, gini_module, supervised); -1 without supervised tokens."""
    s = 0.30 * F.least("loss_drop", F.lit(1.0)) + 0.30 * F.col("stability") + 0.25 * F.least("gini_layer", F.lit(0.8)) + 0.15 * F.least("gini_module", F.lit(0.8))
    return rows.withColumn("score", F.when(F.col("supervised") > 0, s).otherwise(F.lit(-1.0))).orderBy(F.col("score").desc())


def heat_map(records: DataFrame, modules: list[str]) -> DataFrame:
    return records.filter("layer is not null").groupBy("layer").pivot("module", modules).sum("grad_norm").fillna(0.0).orderBy("layer")


IGNORE = -100  # fixed value: the label of a token that isn't learned from


def supervised_labels(ids: Column, mask: Column, instruction: list[int], response: list[int]) -> Column:
    """Labels of an array of token ids: those of responses as they are, others IGNORE.

    A response begins after the marks ``response`` and ends before the next marks ``instruction``, or where the attention mask
    ends. Every token takes the last mark that is whole before it, in one pass over the places where marks begin.
    """
    size = F.size(F.filter(mask, lambda m: m != 0))
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    has = lambda i, marks: (i + len(marks) <= size) & (F.slice(ids, i + 1, len(marks)) == F.array(*map(F.lit, marks)).cast("array<bigint>"))
    step = lambda acc, i: F.when((acc["until"] <= i) & ~acc["on"] & has(i, response), F.struct(F.lit(True).alias("on"), (i + len(response)).alias("until"), acc["out"].alias("out"))).when(
        acc["on"] & (i >= acc["until"]) & has(i, instruction), F.struct(F.lit(False).alias("on"), i.alias("until"), acc["out"].alias("out"))
    ).otherwise(acc)
    put = lambda acc, i: F.struct(acc["on"].alias("on"), acc["until"].alias("until"), F.concat(acc["out"], F.array(F.when(acc["on"] & (i >= acc["until"]), F.get(ids, i)).otherwise(F.lit(IGNORE).cast("bigint")))).alias("out"))
    start = F.struct(F.lit(False).alias("on"), F.lit(0).alias("until"), F.array().cast("array<bigint>").alias("out"))
    found = F.aggregate(places, start, lambda acc, i: put(step(acc, i), i))["out"]
    return F.concat(found, F.array_repeat(F.lit(IGNORE).cast("bigint"), F.size(ids) - size))


def supervised_tokens(rows: DataFrame, instruction: list[int], response: list[int]) -> DataFrame:
    """Rows (ids, mask) with ``labels``, and ``supervised``, how many tokens are learned from."""
    labelled = rows.withColumn("labels", supervised_labels(F.col("ids"), F.col("mask"), instruction, response))
    return labelled.withColumn("supervised", F.size(F.filter("labels", lambda x: x != IGNORE)))


def losses(log: DataFrame) -> DataFrame:
    return log.groupBy("run_id").agg(F.min_by("loss", "step").alias("first_loss"), F.max_by("loss", "step").alias("last_loss"), F.avg("loss").alias("mean_loss"))


def adapter_census(tensors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows (key, shape): adapter pairs (module path, rank, sizes), and tensors by layer.

    The A and B tensors of a module meet in one aggregate on the path they share.
    """
    x = tensors.withColumns({"side": F.regexp_extract("key", r"\.lora_([AB])\.", 1), "base": F.regexp_replace("key", r"\.lora_[AB]\..*$", "")})
    pairs = x.filter("side <> ''").groupBy("base").agg(F.max(F.when(F.col("side") == "A", F.col("shape"))).alias("a"), F.max(F.when(F.col("side") == "B", F.col("shape"))).alias("b"))
    pairs = pairs.withColumns({"rank": F.element_at("a", 1), "paired": F.element_at("a", 1).eqNullSafe(F.try_element_at("b", F.lit(2)))})
    layers = x.withColumn("layer", F.expr(r"try_cast(nullif(regexp_extract(key, '\\.(\\d+)\\.', 1), '') AS INT)")).groupBy("layer").agg(F.count("*").alias("n"))
    return pairs, layers


def adapter_buckets(tensors: DataFrame, depth: int = 3) -> DataFrame:
    """Tensors and parameters by the first parts of their keys and by data type."""
    size = F.aggregate("shape", F.lit(1).cast("long"), lambda acc, n: acc * n)
    prefix = F.array_join(F.slice(F.split("key", r"\."), 1, depth), ".")
    return tensors.withColumns({"prefix": prefix, "params": size}).groupBy("prefix", "dtype").agg(F.count("*").alias("n"), F.sum("params").alias("params"))


def adapter_rank(pairs: DataFrame) -> DataFrame:
    """Ranks by how many pairs have them, the most frequent first, the larger of equal ones."""
    return pairs.filter("rank is not null").groupBy("rank").agg(F.count("*").alias("votes"), F.count_if("paired").alias("paired")).orderBy(F.col("votes").desc(), F.col("rank").desc())
