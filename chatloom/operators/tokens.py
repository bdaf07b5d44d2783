"""Token and vocabulary statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions import text as T
from ..functions.prompts import sample_text


def encoder(encode: Callable[[str], list]) -> Callable[[Column], Column]:
    """The number of tokens that a Python tokenizer makes of a column, in Arrow batches."""

    @F.pandas_udf(LongType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield x.map(lambda s: len(encode(s or "")))

    return run


def counted(samples: DataFrame, encode: Callable[[Column], Column] = T.word_count) -> DataFrame:
    """(persona_id, tokens) of every sample."""
    return samples.select(F.coalesce(T.falsy(F.col("meta.persona_id")), F.lit("unknown")).alias("persona_id"), encode(sample_text(F.col("system"), F.col("conversations"))).cast("long").alias("tokens"))


def token_stats(rows: DataFrame) -> DataFrame:
    """One row: n, total, mean, p50, p95, p99 (interpolated) and max of rows (tokens)."""
    p = lambda q: F.coalesce(F.expr(f"percentile(tokens, {q})"), F.lit(0.0))
    return rows.agg(
        F.count("tokens").alias("n"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"), F.coalesce(F.avg("tokens"), F.lit(0.0)).alias("mean"),
        p(0.5).alias("p50"), p(0.95).alias("p95"), p(0.99).alias("p99"), F.coalesce(F.max("tokens"), F.lit(0)).alias("max"),
    )


def tokens_by_persona(rows: DataFrame) -> DataFrame:
    """persona_id, tokens, samples."""
    return rows.groupBy("persona_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("samples"))


def compare_tokenizers(samples: DataFrame, encoders: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """A row a tokenizer: its statistics, and its total against the first one's. Every sample is tokenised once by each."""
    text = sample_text(F.col("system"), F.col("conversations"))
    each = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(name).alias("tokenizer"), encode(F.col("__text")).cast("long").alias("tokens")) for i, (name, encode) in enumerate(encoders.items())])
    rows = samples.select(text.alias("__text")).select(F.explode(each).alias("r")).select("r.*")
    p = lambda q: F.expr(f"percentile(tokens, {q})")
    s = rows.groupBy("place", "tokenizer").agg(F.count("tokens").alias("n"), F.sum("tokens").alias("total"), F.avg("tokens").alias("mean"), p(0.5).alias("p50"), p(0.95).alias("p95"), p(0.99).alias("p99"), F.max("tokens").alias("max"))
    # A row a tokenizer.
    base = F.first("total").over(Window.orderBy("place"))
    return s.withColumn("delta", F.col("total") - base).withColumn("delta_ratio", F.col("delta") / F.when(base == 0, F.lit(1)).otherwise(base))


def probe_tokenization(probes: DataFrame, tokenizers: dict[str, Callable[[str], list[str]]]) -> DataFrame:
    """Rows (probe) with, for each tokenizer, its pieces without marks of leading spaces, and their number."""

    def pieces(split):
        @F.pandas_udf("array<string>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                yield x.map(lambda s: [str(y) for y in split(s or "")])

        return run

    out = probes.select("probe")
    for name, split in tokenizers.items():
        out = out.withColumn(f"{name}_pieces", F.transform(pieces(split)(F.col("probe")), T.strip_space_marker)).withColumn(f"{name}_count", F.size(f"{name}_pieces"))
    return out


def vocab_overlap(vocab: DataFrame) -> DataFrame:
    """(a, b, n_common, n_union, n_only_a, n_only_b, jaccard) for every two names of rows (name, token).

    Tokens are grouped once; a token's set of names is as small as there are vocabularies.
    """
    sets = vocab.select("name", "token").distinct().groupBy("token").agg(F.array_sort(F.collect_list("name")).alias("names")).groupBy("names").agg(F.count("*").alias("n"))
    names = [r["name"] for r in vocab.select("name").distinct().orderBy("name").collect()]
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in combinations(names, 2)]
    if not pairs:
        return sets.select(F.lit("").alias("a"), F.lit("").alias("b"), *[F.lit(0).cast("long").alias(c) for c in ("n_common", "n_union", "n_only_a", "n_only_b")], F.lit(0.0).alias("jaccard")).limit(0)
    x = sets.select("names", "n", F.explode(F.array(*pairs)).alias("p")).select("n", "p.*", F.array_contains("names", F.col("p.a")).alias("ina"), F.array_contains("names", F.col("p.b")).alias("inb"))
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    a, b = F.col("ina"), F.col("inb")
    g = x.groupBy("a", "b").agg(n(a & b).alias("n_common"), n(a | b).alias("n_union"), n(a & ~b).alias("n_only_a"), n(b & ~a).alias("n_only_b"))
    return g.withColumn("jaccard", F.coalesce(F.try_divide(F.col("n_common"), F.col("n_union")), F.lit(0.0)))


def unique_tokens(a: DataFrame, b: DataFrame, limit: int = 50) -> DataFrame:
    """Readable tokens of ``a`` that ``b`` lacks, the shortest first, as they read without space marks."""
    only = a.select("token").distinct().join(b.select("token").distinct(), "token", "left_anti").filter(T.readable(F.col("token")))
    return only.withColumn("shown", T.strip_space_marker(F.col("token"))).orderBy(F.length("shown"), F.lower("shown"), "token").limit(limit)


#: Parts of a tokenizer's document that are compared as wholes.
PARTS = ("normalizer", "pre_tokenizer", "post_processor", "decoder", "truncation", "padding")


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """One row with the text of a tokenizer's document."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("doc"))


def vocab_of(doc: DataFrame) -> DataFrame:
    """(token, id) of a document's vocabulary: an object of ids, or a list whose entries begin with the token."""
    v = F.get_json_object("doc", "$.model.vocab")
    mapped = doc.filter(v.startswith("{")).select(F.explode(F.from_json(v, "map<string,bigint>")).alias("token", "id"))
    listed = doc.filter(v.startswith("[")).select(F.posexplode(F.from_json(v, "array<array<string>>")).alias("id", "e")).select(F.element_at("e", 1).alias("token"), F.col("id").cast("long").alias("id"))
    return mapped.unionByName(listed)


def _first_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row on two lists (place, item): sizes, and the first place where they differ (the end of the shorter one, if it begins the longer one)."""
    j = a.select("place", F.col("item").alias("x")).join(b.select("place", F.col("item").alias("y")), "place", "full_outer")
    return j.agg(F.count("x").alias("n_a"), F.count("y").alias("n_b"), F.min(F.when(~F.col("x").eqNullSafe(F.col("y")), F.col("place"))).alias("first_difference"))


def config_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row on two vocabularies (token, id): sizes, shared tokens, ids that differ, tokens of one alone, and the first place where the orders by id differ."""
    j = a.select("token", F.col("id").alias("ia")).join(b.select("token", F.col("id").alias("ib")), "token", "full_outer")
    one = j.agg(
        F.count("ia").alias("size_a"), F.count("ib").alias("size_b"), F.count_if(F.col("ia").isNotNull() & F.col("ib").isNotNull()).alias("shared"),
        F.count_if(F.col("ia") != F.col("ib")).alias("id_mismatches"), F.count_if(F.col("ib").isNull()).alias("only_a"), F.count_if(F.col("ia").isNull()).alias("only_b"),
    )
    # Vocabularies have some hundred thousand tokens, so one window each is a small sort.
    ranked = lambda v: v.select((F.row_number().over(Window.orderBy("id", "token")) - 1).alias("place"), F.col("token").alias("item"))
    return one.join(_first_difference(ranked(a), ranked(b)).select("first_difference"), F.lit(True))


def compare_configs(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row on two documents (doc): ``config_diff`` of the vocabularies, merges, added tokens, and whether the other parts are equal."""
    merges = lambda d: d.select(F.posexplode(F.from_json(F.get_json_object("doc", "$.model.merges"), "array<string>")).alias("place", "item"))
    added = lambda d, n: d.select(F.explode(F.from_json(F.get_json_object("doc", "$.added_tokens"), "array<string>")).alias("t")).select(F.get_json_object("t", "$.content").alias("content"), _canonical(F.col("t")).alias(n)).filter("content is not null")
    m = _first_difference(merges(a), merges(b)).select(F.col("n_a").alias("merges_a"), F.col("n_b").alias("merges_b"), F.col("first_difference").alias("first_merge_difference"))
    t = added(a, "x").join(added(b, "y"), "content", "full_outer").agg(F.count_if(F.col("y").isNull()).alias("added_only_a"), F.count_if(F.col("x").isNull()).alias("added_only_b"), F.count_if(F.col("x") != F.col("y")).alias("added_mismatches"))
    whole = lambda d, n: d.select(*[_canonical(F.get_json_object("doc", f"$.{p}")).alias(f"{n}_{p}") for p in PARTS], F.get_json_object("doc", "$.model.type").alias(f"{n}_type"))
    w = whole(a, "a").join(whole(b, "b"), F.lit(True))
    w = w.select(F.col("a_type").eqNullSafe(F.col("b_type")).alias("model_type_equal"), *[F.col(f"a_{p}").eqNullSafe(F.col(f"b_{p}")).alias(f"{p}_equal") for p in PARTS])
    # One row each.
    return config_diff(vocab_of(a), vocab_of(b)).join(m, F.lit(True)).join(t, F.lit(True)).join(w, F.lit(True))


def _canonical(x) -> Column:
    """JSON text without regard to white space and the order of an object's keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.from_json(x, "map<string,string>")))))


def config_summary(doc: DataFrame) -> DataFrame:
    """One row: model type, sizes, and the kinds of the parts."""
    n = lambda path: F.coalesce(F.json_array_length(F.get_json_object("doc", path)), F.lit(0))
    vocab = F.get_json_object("doc", "$.model.vocab")
    size = F.when(vocab.startswith("{"), F.size(F.json_object_keys(vocab))).otherwise(F.coalesce(F.json_array_length(vocab), F.lit(0)))
    return doc.select(F.get_json_object("doc", "$.model.type").alias("model_type"), size.alias("vocab_size"), n("$.model.merges").alias("merges"), n("$.added_tokens").alias("added_tokens"), *[F.get_json_object("doc", f"$.{p}.type").alias(p) for p in PARTS[:4]])
