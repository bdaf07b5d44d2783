"""Style profiles of personas: lengths, rates, characteristic n-grams, and drift from them.

Texts are rows (persona_id, text, seq); ``seq`` breaks ties of what is "first".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import spread
from .dedup import materialized

#: Wanted n-grams that are looked for as a list within a text; of more, all are looked up by a join.
MAX_LISTED = 64

#: Fillers without a profile.
FILLERS = ("lol", "bro", "ngl", "tbh", "fr", "lowkey")


def assistant_texts(samples: DataFrame) -> DataFrame:
    """The last assistant value of each sample, by persona; without persona it is ``unknown``."""
    last = F.try_element_at(F.filter("conversations", lambda t: t["from"] == "assistant"), F.lit(-1))["value"]
    return samples.select(F.coalesce(T.falsy(F.col("meta.persona_id")), F.lit("unknown")).alias("persona_id"), last.alias("text")).filter("text is not null")


def length_stats(texts: DataFrame) -> DataFrame:
    """n, mean_words, p50 (the median, cut to an integer) and p95 (the value of rank int(.95 n), 1 at least); empty texts don't count.

    Ranks come from counts by length, so no persona is sorted.
    """
    w = texts.withColumn("w", T.word_count("text")).filter("w > 0")
    c = w.groupBy("persona_id", "w").agg(F.count("*").alias("c"))
    run = Window.partitionBy("persona_id").orderBy("w").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy("persona_id")
    c = c.withColumns({"upto": F.sum("c").over(run), "n": F.sum("c").over(every)})
    at = lambda rank: F.min(F.when(F.col("upto") >= rank, F.col("w")))
    half = (at(F.floor((F.col("n") + 1) / 2)) + at(F.floor(F.col("n") / 2) + 1)) / 2
    return c.groupBy("persona_id", "n").agg(
        (F.sum(F.col("w") * F.col("c")) / F.first("n")).alias("mean_words"), half.cast("int").alias("p50"), at(F.greatest(F.lit(1), F.floor(F.col("n") * 95 / 100))).cast("int").alias("p95")
    )


def style_rates(texts: DataFrame) -> DataFrame:
    """lowercase_start_rate over texts that aren't blank; emoji per text and burst_size (lines, of texts that aren't empty) over all."""
    x = F.coalesce("text", F.lit(""))
    some = T.strip(x) != ""
    return texts.groupBy("persona_id").agg(
        F.coalesce(F.avg(F.when(some, T.lowercase_start(x).cast("double"))), F.lit(0.0)).alias("lowercase_start_rate"),
        F.avg(T.emoji_count(x).cast("double")).alias("unicode_per_turn"), F.avg(T.shortcode_count(x).cast("double")).alias("custom_per_turn"),
        (F.sum(F.when(x != "", T.line_count(x)).otherwise(0)) / F.count("*")).alias("burst_size"),
    )


def ngram_counts(texts: DataFrame, n: int) -> DataFrame:
    """(persona_id, token, count) of n-grams of style words, within a text."""
    return spread(texts.select("persona_id", "text")).select("persona_id", F.explode(T.grams(T.style_words(F.col("text")), n)).alias("token")).groupBy("persona_id", "token").agg(F.count("*").alias("count"))


def gram_hashes(words, n: int):
    """Hashes of the n-grams of an array of words; the same as of the joined words of ``T.grams`` in number and order."""
    runs = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)]))
    return T.let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) >= n, runs(h)).otherwise(F.array().cast("array<bigint>")))


def _scored(counts: DataFrame, key: str, alpha: float, min_count: int) -> DataFrame:
    """``counts`` (persona_id, key, count) of ``min_count`` and more with z. Counts are written once, as four sums are made of them."""
    counts = materialized(counts, "gram-counts")
    everyone = materialized(counts.groupBy(key).agg(F.sum("count").alias("yg")), "gram-totals")
    # One row, and a row a persona: they are joined as scalars are.
    size = everyone.agg(F.count("*").alias("v"), F.sum("yg").alias("ng"))
    mine = counts.groupBy("persona_id").agg(F.sum("count").alias("np"))
    c = counts.filter(F.col("count") >= min_count).join(everyone, key).join(mine, "persona_id").join(F.broadcast(size), F.lit(True))
    yp, a0 = F.col("count"), F.lit(alpha) * F.col("v")
    yn, nn = F.greatest(F.col("yg") - yp, F.lit(0)), F.col("ng") - F.col("np")
    num = F.try_divide(yp + alpha, F.col("np") + a0 - yp - alpha)
    den = F.try_divide(yn + alpha, nn + a0 - yn - alpha)
    var = 1 / (yp + alpha) + 1 / F.greatest(yn + alpha, F.lit(1e-9))
    c = c.withColumns({"num": num, "den": den}).filter("num > 0 and den > 0")
    return c.withColumn("z", (F.ln("num") - F.ln("den")) / F.sqrt(var)).select("persona_id", key, "z", "count")


def _best(scored: DataFrame, top_k: int) -> DataFrame:
    w = Window.partitionBy("persona_id").orderBy(F.col("z").desc(), "token")
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_k).select("persona_id", "token", "z", "count", "rank")


def log_odds(counts: DataFrame, alpha: float = 0.01, top_k: int = 25, min_count: int = 3) -> DataFrame:
    """(persona_id, token, z, count, rank): log-odds with a Dirichlet prior of each persona against all others.

    The vocabulary is that of all personas, the persona itself included. Ties go to the token that sorts first.
    """
    return _best(_scored(counts, "token", alpha, min_count), top_k)


def characteristic(texts: DataFrame, n: int, alpha: float = 0.01, top_k: int = 25, min_count: int = 3) -> DataFrame:
    """``log_odds`` of the n-grams of texts (persona_id, text), counted by 64-bit hashes; only the grams that come first, ties included, are read as text."""
    words = spread(texts.select("persona_id", "text")).select("persona_id", T.style_words(F.col("text")).alias("w"))
    counts = words.select("persona_id", F.explode(gram_hashes(F.col("w"), n)).alias("h")).groupBy("persona_id", "h").agg(F.count("*").alias("count"))
    scored = _scored(counts, "h", alpha, min_count)
    first = materialized(scored.withColumn("r", F.rank().over(Window.partitionBy("persona_id").orderBy(F.col("z").desc()))).filter(F.col("r") <= top_k).drop("r"), "log-odds")
    wanted = first.select("h").distinct()
    grams = F.arrays_zip(gram_hashes(F.col("w"), n).alias("h"), (T.grams(F.col("w"), n) if n > 1 else F.col("w")).alias("token"))
    hashes = [r["h"] for r in wanted.limit(MAX_LISTED + 1).collect()] if n > 1 else []
    if 0 < len(hashes) <= MAX_LISTED:
        # Few are wanted, so they are looked for within a text, and no other gram is put together.
        keep = F.array(*[F.lit(h).cast("long") for h in hashes])
        grams = T.let(gram_hashes(F.col("w"), n), lambda h: F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(keep, x), F.struct(x.alias("h"), F.array_join(F.slice("w", i + 1, n), " ").alias("token")))), lambda g: g.isNotNull()))
    names = words.select(F.explode(grams).alias("g")).select("g.h", "g.token").join(wanted, "h", "left_semi").dropDuplicates(["h"])
    return _best(first.join(names, "h"), top_k)


def build_profiles(texts: DataFrame, top_k: int = 25, sizes=(1, 2, 3)) -> DataFrame:
    """A row a persona: persona_id, length, lowercase_start_rate, emoji, burst_size, burst_rate, top_fillers (by ``ngram``).

    burst_rate is a figure that only hand-made profiles have, and null here; prompts read it.
    """
    out = style_rates(texts).join(length_stats(texts), "persona_id", "left")
    fillers = []
    for n in sizes:
        top = characteristic(texts, n, top_k=top_k)
        entry = F.struct("rank", "token", F.round("z", 3).alias("z"), F.col("count").cast("long").alias("count"))
        lists = top.groupBy("persona_id").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["token"].alias("token"), e["z"].alias("z"), e["count"].alias("count"))).alias(f"t{n}"))
        out = out.join(lists, "persona_id", "left")
        fillers.append(F.coalesce(F.col(f"t{n}"), F.array().cast("array<struct<token:string,z:double,count:bigint>>")).alias(f"{n}gram"))
    zero = lambda c, t: F.coalesce(F.col(c), F.lit(0)).cast(t)
    length = F.struct(zero("n", "long").alias("n"), zero("mean_words", "double").alias("mean_words"), zero("p50", "int").alias("p50"), zero("p95", "int").alias("p95"))
    return out.select("persona_id", length.alias("length"), "lowercase_start_rate", F.struct("unicode_per_turn", "custom_per_turn").alias("emoji"), "burst_size", F.lit(None).cast("double").alias("burst_rate"), F.struct(*fillers).alias("top_fillers"))


def drift(generated: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per persona of rows (persona_id, persona_name, text): its figures, its profile's, and their absolute differences.

    Blank texts are passed over; personas without a profile get ``warning``.
    """
    g = generated.withColumn("text", T.strip(F.coalesce("text", F.lit("")))).filter("text <> '' and coalesce(persona_id, '') <> ''")
    names = generated.filter("coalesce(persona_name, '') <> ''").groupBy("persona_id").agg(F.min("persona_name").alias("persona_name"))
    x = length_stats(g).join(style_rates(g), "persona_id").join(names, "persona_id", "left")
    p = profiles.select("persona_id", F.lit(True).alias("known"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"profile_{k}") for c, k in (("length.mean_words", "mean_words"), ("lowercase_start_rate", "lowercase_start_rate"), ("burst_size", "burst_size"), ("emoji.unicode_per_turn", "emoji_unicode_per_turn"), ("emoji.custom_per_turn", "emoji_custom_per_turn"))])
    j = x.join(p, "persona_id", "left")
    pairs = {"mean_words": ("mean_words", "mean_words_delta"), "lowercase_start_rate": ("lowercase_start_rate", "lowercase_start_delta"), "burst_size": ("burst_size", "burst_size_delta"), "unicode_per_turn": ("emoji_unicode_per_turn", "emoji_unicode_per_turn_delta"), "custom_per_turn": ("emoji_custom_per_turn", "emoji_custom_per_turn_delta")}
    cols = [c for k, (name, delta) in pairs.items() for c in (F.abs(F.col(k) - F.col(f"profile_{name}")).alias(delta), F.col(f"profile_{name}"), F.col(k).alias(f"generated_{name}"))]
    return j.select("persona_id", F.coalesce("persona_name", F.lit("")).alias("persona_name"), F.col("n").cast("long").alias("n_generated"), *cols, F.when(F.col("known").isNull(), F.concat(F.lit("no profile for "), "persona_id")).alias("warning"))


def style_heuristics(rows: DataFrame, fillers=None) -> DataFrame:
    """Per persona of rows (persona_id, generated, reference): avg_length_diff, exclamation_rate, caps_rate, filler_rate.

    ``fillers`` is a column of arrays, or None for the default ones. ``error`` is set if either side is blank throughout.
    """
    picks = F.array(*map(F.lit, FILLERS)) if fillers is None else F.when(F.size(fillers) > 0, fillers).otherwise(F.array(*map(F.lit, FILLERS)))
    g, r = T.strip(F.col("generated")), T.strip(F.col("reference"))
    x = rows.withColumns({"g": g, "r": r, "hit": T.contains_any(g, picks)})
    gw, rw = F.when(F.col("g") != "", T.word_count("g")), F.when(F.col("r") != "", T.word_count("r"))
    s = x.groupBy("persona_id").agg(
        F.count("g").alias("n"), F.abs(F.avg(gw) - F.avg(rw)).alias("d"), F.avg(F.contains("g", F.lit("!")).cast("double")).alias("e"),
        F.avg(F.when(F.col("g") != "", F.col("g").rlike(r"^\p{Lu}").cast("double"))).alias("c"), F.avg(F.col("hit").cast("double")).alias("f"),
    )
    ok = F.col("d").isNotNull()
    pick = lambda c: F.when(ok, F.coalesce(F.col(c), F.lit(0.0))).otherwise(F.lit(0.0))
    return s.select("persona_id", "n", pick("d").alias("avg_length_diff"), pick("e").alias("exclamation_rate"), pick("c").alias("caps_rate"), pick("f").alias("filler_rate"), F.when(~ok, F.lit("empty or blank input")).alias("error"))


def profile_fillers(profile, n: int = 15):
    """The first n of a profile's 1-grams and then 2-grams."""
    return F.slice(F.concat(profile["top_fillers"]["1gram"]["token"], profile["top_fillers"]["2gram"]["token"]), 1, n)


def filler_union(profiles: DataFrame, top_n: int = 12, cap: int = 40) -> DataFrame:
    """(place, token): fillers of all profiles without repeats, personas by id, the first ``cap``."""
    rows = profiles.select("persona_id", F.posexplode(profile_fillers(F.struct("top_fillers"), top_n)).alias("i", "token"))
    first = rows.groupBy("token").agg(F.min(F.struct("persona_id", "i")).alias("at")).orderBy("at", "token").limit(cap)
    return first.select(F.row_number().over(Window.orderBy("at", "token")).alias("place"), "token")
