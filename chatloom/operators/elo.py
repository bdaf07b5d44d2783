"""Pairwise comparisons and Elo ratings."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import stable_order
from .dedup import materialized

TOLERANCE = 8.0  # of starting ratings, within which two players are rated by their wins alone


def expected(a, b) -> Column:
    return 1.0 / (1.0 + F.pow(F.lit(10.0), (b - a) / 400.0))


def pair_jobs(keys: DataFrame, labels: list[str], pairs_per_prompt: int = 6, seed: int = 0) -> DataFrame:
    """(sample_key, i, j, a, b, swap): up to N pairs of runs a prompt, drawn by hash, sides by hash."""
    k = len(labels)
    pairs = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(labels[i]).alias("a"), F.lit(labels[j]).alias("b")) for i in range(k) for j in range(i + 1, k)]
    x = keys.select("sample_key", F.explode(F.array(*pairs)).alias("p")).select("sample_key", "p.*")
    h = stable_order(seed, F.col("sample_key"), F.col("i"), F.col("j"))
    w = Window.partitionBy("sample_key").orderBy(h, "i", "j")
    n = min(max(1, pairs_per_prompt), max(1, len(pairs)))
    swap = F.conv(F.substring(stable_order(seed + 1, F.col("sample_key"), F.col("i"), F.col("j")), 1, 1), 16, 10).cast("int") % 2 == 1
    return x.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= n).select("sample_key", "i", "j", "a", "b", swap.alias("swap"))


def newest_wins(rows: DataFrame) -> DataFrame:
    """Of rows with one prompt, i, j and two labels (and of one scope, if they have any), the one from the newest file, and the first in it."""
    scope = ["scope"] if "scope" in rows.columns else []
    pair = F.array_sort(F.array("winner_label", "loser_label"))
    rest = F.struct(*rows.columns)
    order = F.struct(-F.unix_micros(F.col("mtime").cast("timestamp")), F.col("path"), F.col("line"))
    return rows.withColumns({"__pair": pair, "__order": order, "__row": rest}).groupBy(*scope, "sample_key", "i", "j", "__pair").agg(F.min_by("__row", "__order").alias("r")).select("r.*")


def win_rates(rows: DataFrame) -> DataFrame:
    """label, wins, losses, games, win_rate (null without a game)."""
    x = rows.select(F.explode(F.array(F.struct(F.col("winner_label").alias("label"), F.lit(1).alias("won")), F.struct(F.col("loser_label").alias("label"), F.lit(0).alias("won")))).alias("g")).select("g.*")
    g = x.groupBy("label").agg(F.sum("won").cast("long").alias("wins"), F.count("*").alias("games"))
    return g.select("label", "wins", (F.col("games") - F.col("wins")).alias("losses"), "games", F.try_divide(F.col("wins"), F.col("games")).alias("win_rate"))


def initial(labels: DataFrame, priors: DataFrame | None = None, start: float = 1500.0) -> DataFrame:
    """(label, rating): a finite prior, else the start."""
    if priors is None:
        return labels.select("label", F.lit(float(start)).alias("rating"))
    p = priors.select("label", F.col("rating").alias("prior"))
    fine = F.col("prior").isNotNull() & ~F.isnan("prior") & (F.abs("prior") < float("inf"))
    return labels.join(p, "label", "left").select("label", F.when(fine, F.col("prior")).otherwise(F.lit(float(start))).alias("rating"))


def two_player(wins_a: Column, wins_b: Column, start_a: Column, start_b: Column) -> tuple[Column, Column]:
    """Ratings around the middle of the starting ones with the gap that the win rate stands for."""
    n = (wins_a + wins_b).cast("double")
    eps = F.greatest(1.0 / (2 * n), F.lit(1e-9))
    p = F.greatest(F.least(wins_a / n, 1.0 - eps), eps)
    center, half = 0.5 * (start_a + start_b), 200.0 * F.log10(p / (1.0 - p))
    return F.when(n == 0, start_a).otherwise(center + half), F.when(n == 0, start_b).otherwise(center - half)


def fold(games: DataFrame, start: DataFrame, k: float = 32.0) -> DataFrame:
    """(scope, label, rating) after the games (scope, ord, winner_label, loser_label), one after another.

    A scope's games are sorted within a partition and streamed through; its ratings are all that is held, whatever the number
    of games. There are as many tasks at work as there are scopes. ``start`` has (scope, label, rating), for every label
    of the scope's games; labels without games keep theirs.
    """
    null = lambda t, c: F.lit(None).cast(t).alias(c)
    kind = games.schema["ord"].dataType
    first = start.select("scope", F.lit(0).alias("kind"), null(kind, "ord"), F.col("label").alias("a"), null("string", "b"), F.col("rating").cast("double").alias("rating"))
    then = games.select("scope", F.lit(1).alias("kind"), "ord", F.col("winner_label").alias("a"), F.col("loser_label").alias("b"), null("double", "rating"))
    # By a hash of the scope, since Spark leaves a shuffle by the scope out where both parts are already dealt by it, and may then merge the
    # partitions of one part and not of the other, so that a scope's games meet another task than its start.
    rows = first.unionByName(then).repartition(F.xxhash64("scope")).sortWithinPartitions("scope", "kind", "ord").select("scope", "kind", "a", "b", "rating")
    out = rows.select("scope", F.col("a").alias("label"), "rating").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ratings = None, {}

        def given(kinds):
            return pa.RecordBatch.from_arrays([pa.array([now[0]] * len(ratings), kinds), pa.array(list(ratings)), pa.array(list(ratings.values()), pa.float64())], names=["scope", "label", "rating"])

        for batch in batches:
            for scope, game, a, b, rating in zip(*(batch.column(c).to_pylist() for c in ("scope", "kind", "a", "b", "rating")), strict=True):
                if now != (scope,):
                    if ratings:
                        yield given(batch.schema.field("scope").type)
                    now, ratings = (scope,), {}
                if not game:
                    ratings[a] = rating
                    continue
                won = 1.0 / (1.0 + 10.0 ** ((ratings[b] - ratings[a]) / 400.0))
                ratings[a], ratings[b] = ratings[a] + k * (1.0 - won), ratings[b] - k * (1.0 - won)
            kinds = batch.schema.field("scope").type
        if ratings:
            yield given(kinds)

    return rows.mapInArrow(run, out)


def replay_groups(rows: DataFrame, priors: DataFrame | None = None, start: float = 1500.0, k: float = 32.0, seed: int = 0, chronological: bool = False) -> DataFrame:
    """scope, label, rating, wins, losses, games, win_rate from comparison rows with a scope, each scope for itself.

    A scope of two labels with near starting ratings is rated by wins alone; of others the games are
    folded, in hash order or (chronological) by file time and line. ``priors`` has (scope, label, rating).
    The rows are written once, since players and games are read from them one after the other and must be the same.
    """
    rows = materialized(rows, "elo-rows")
    side = lambda c, won: F.struct(F.col(c).alias("label"), F.lit(won).alias("won"))
    x = rows.select("scope", F.explode(F.array(side("winner_label", 1), side("loser_label", 0))).alias("g")).select("scope", "g.*")
    rates = x.groupBy("scope", "label").agg(F.sum("won").cast("long").alias("wins"), F.count("*").alias("games"))
    rates = rates.select("scope", "label", "wins", (F.col("games") - F.col("wins")).alias("losses"), "games", F.try_divide(F.col("wins"), F.col("games")).alias("win_rate"))
    fine = F.col("prior").isNotNull() & ~F.isnan("prior") & (F.abs("prior") < float("inf"))
    if priors is None:
        begin = rates.withColumn("start", F.lit(float(start)))
    else:
        begin = rates.join(priors.select("scope", "label", F.col("rating").alias("prior")), ["scope", "label"], "left").withColumn("start", F.when(fine, F.col("prior")).otherwise(F.lit(float(start)))).drop("prior")
    # A window has the labels of a scope, not its games.
    w = Window.partitionBy("scope")
    begin = begin.withColumns({"n": F.count("*").over(w), "gap": F.max("start").over(w) - F.min("start").over(w), "mid": F.avg("start").over(w), "all": F.sum("wins").over(w)})
    begin = begin.withColumn("two", (F.col("n") == 2) & (F.col("gap") <= TOLERANCE))
    own, _ = two_player(F.col("wins"), F.col("all") - F.col("wins"), F.col("mid"), F.col("mid"))
    closed = begin.filter("two").withColumn("rating", own)
    rest = begin.filter("not two")
    order = F.struct(F.unix_micros(F.col("mtime").cast("timestamp")), F.col("line")) if chronological else F.struct(stable_order(seed, F.col("sample_key"), F.col("i"), F.col("j"), F.col("swap")), F.col("sample_key"))
    games = rows.join(rest.select("scope").distinct(), "scope", "left_semi").select("scope", order.alias("ord"), "winner_label", "loser_label")
    folded = rest.join(fold(games, rest.select("scope", "label", F.col("start").alias("rating")), k), ["scope", "label"])
    names = ["scope", "label", "rating", "wins", "losses", "games", "win_rate"]
    return closed.select(*names).unionByName(folded.select(*names))


def replay(rows: DataFrame, priors: DataFrame | None = None, start: float = 1500.0, k: float = 32.0, seed: int = 0, chronological: bool = False) -> DataFrame:
    """``replay_groups`` of one group: label, rating, wins, losses, games, win_rate."""
    one = lambda d: d.withColumn("scope", F.lit(0)) if d is not None else None
    return replay_groups(one(rows), one(priors), start, k, seed, chronological).drop("scope")


def rating_map(x) -> Column:
    """A map of ratings from a JSON object, without what isn't a finite number."""
    number = F.transform_values(F.from_json(x, "map<string,string>"), lambda k, v: v.try_cast("double"))
    return F.map_filter(number, lambda k, v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def normalized(rows: DataFrame, column: str, scope: list[str] | None = None) -> Column:
    """Between 0 and 1 by the least and largest; 0.5 if they are equal."""
    w = Window.partitionBy(*(scope or []))
    lo, hi = F.min(column).over(w), F.max(column).over(w)
    return F.when(hi - lo <= 1e-9, F.lit(0.5)).otherwise((F.col(column) - lo) / F.when(hi - lo > 1e-9, hi - lo))


def combined(rows: DataFrame, pairwise_weight: float = 0.7, fingerprint_weight: float = 0.3, scope: list[str] | None = None) -> DataFrame:
    """Rows (label, rating, similarity) with norm_pairwise, norm_fingerprint and combined; without ratings the fingerprint counts alone."""
    x = rows.withColumns({"norm_pairwise": F.when(F.col("rating").isNotNull(), normalized(rows, "rating", scope)), "norm_fingerprint": normalized(rows, "similarity", scope)})
    both = pairwise_weight * F.col("norm_pairwise") + fingerprint_weight * F.col("norm_fingerprint")
    return x.withColumn("combined", F.coalesce(both, F.col("norm_fingerprint")))


def quadrants(rows: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """high or low against the median, the upper one of two, of rating and similarity."""
    w = Window.partitionBy(*(scope or []))
    upper = lambda c: F.element_at(F.array_sort(F.collect_list(c).over(w)), (F.floor(F.count("*").over(w) / 2) + 1).cast("int"))
    x = rows.withColumns({"high_elo": F.col("rating") >= upper("rating"), "high_fingerprint": F.col("similarity") >= upper("similarity")})
    e, f = F.col("high_elo"), F.col("high_fingerprint")
    return x.withColumn("quadrant", F.when(f & e, "high_fingerprint_high_elo").when(f, "high_fingerprint_low_elo").when(e, "low_fingerprint_high_elo").otherwise("low_both"))


def summary_rows(ratings: DataFrame, similarity: DataFrame, combined_rows: DataFrame) -> DataFrame:
    return ratings.join(similarity, "label", "left").join(combined_rows.select("label", "combined"), "label", "left").orderBy(F.col("rating").desc_nulls_last(), "label")


def upsert_group(store: DataFrame, gkey: str, ratings: DataFrame, stamp: str) -> DataFrame:
    """A store (gkey, label, rating, win_rate, updated_utc) with one group replaced."""
    new = ratings.select(F.lit(gkey).alias("gkey"), "label", "rating", "win_rate", F.lit(stamp).alias("updated_utc"))
    return store.filter(F.col("gkey") != gkey).unionByName(new)
