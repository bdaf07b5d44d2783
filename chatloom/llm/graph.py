"""Connected components of a link table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id that has a link; a component is named by its smallest id.

    Every round takes the smallest label of the neighbours and then the label
    of that label, so chains shorten by half a round; a star takes two rounds.
    Labels go to the shared folder after each round. A table without links
    gives no row; null ids are ignored, and repeated links count once.
    """
    both = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).filter("u is not null and v is not null and u <> v")
    both = written(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-links")
    labels = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("label")), "cc-labels")
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("u").alias("v"), F.col("label").alias("other")), "v").groupBy("u").agg(F.min("other").alias("other"))
        lower = labels.join(near, "u").select("u", F.least("label", "other").alias("next"), "label")
        of = labels.select(F.col("u").alias("next"), F.col("label").alias("jump"))
        fresh = written(lower.join(of, "next").select("u", F.least("next", "jump").alias("label"), (F.least("next", "jump") != F.col("label")).alias("moved")), "cc-labels")
        moved = fresh.filter("moved").limit(1).count()
        discard(labels)
        labels = fresh.select("u", "label")
        labels._chatloom_path = fresh._chatloom_path
        if not moved:
            discard(both)
            out = labels.select(F.col("u").alias("id"), F.col("label").alias("component"))
            out._chatloom_path = fresh._chatloom_path
            return out
    raise RuntimeError("the components didn't settle")
