"""Near-duplicate sessions: exact Jaccard similarity, resolved greedily by priority.

Texts with equal shingle sets form a class, and one of each class, the one with the
smallest id, stands for it; copies are never listed as pairs.  Candidates come from an
exact prefix filter: if two sets have a Jaccard similarity of t, they share one of
their rarest ``size - ceil(t * size) + 1`` shingles.  Of frequent shingles few are among
those once copies are out.  Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import atexit
import re
import shutil
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let, split_words
from ..session import spread

#: Tables that are still there.
_LEFT: set[str] = set()
#: Open edges that one task resolves in order, where rounds would each settle little.
LAST_EDGES = 500_000


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Written to the cluster's shared folder (``spark.checkpoint.dir``) and read again, which ends the lineage.

    Without that setting a folder under /tmp serves a local master; on a cluster it is an error.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{(root or '/tmp/chatloom-local').rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._materialized = path
    _LEFT.add(path)
    return out


def _clean() -> None:
    """What is left at the end of the driver's process goes, where the folder is one that it reaches itself."""
    for path in _LEFT:
        if path.startswith(("/", "file:")):
            shutil.rmtree("/" + re.sub(r"^file:/*", "", path).lstrip("/"), ignore_errors=True)


atexit.register(_clean)


def released(*frames: DataFrame) -> None:
    """Delete what ``materialized`` wrote, once nothing reads it any more."""
    for df in frames:
        path = getattr(df, "_materialized", None)
        if path:
            spark = df.sparkSession
            _LEFT.discard(path)
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def shingle_hashes(text, n: int = 5):
    """The sorted set of hashes of the n-word shingles; of fewer words, of all as one; of none, empty."""
    return let(F.transform(split_words(F.lower(text)), lambda w: F.xxhash64(w)), lambda h: F.array_sort(F.array_distinct(_runs(h, n))))


def _runs(h, n: int):
    few = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    rows = F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)]))
    return F.when(F.size(h) >= n, rows).otherwise(few)


def shingle_classes(texts: DataFrame, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """Of rows (scope, id, text): members (scope, id, rep), and the sets (scope, id, s, size) of the representatives.

    Texts without a word are in neither.
    """
    s = materialized(spread(texts.select("scope", "id", "text")).select("scope", "id", shingle_hashes(F.col("text"), n).alias("s")).withColumn("size", F.size("s")).filter("size > 0"), "shingle-sets")
    digest = s.select("scope", "id", "size", F.xxhash64("s").alias("d1"), F.xxhash64(F.lit(1), "s").alias("d2"))
    key = ["scope", "size", "d1", "d2"]
    reps = materialized(digest.groupBy(*key).agg(F.min("id").alias("rep")), "shingle-classes")
    members = digest.join(reps, [digest[c].eqNullSafe(reps[c]) for c in key]).select(digest["scope"], "id", "rep")
    own = reps.select(F.col("scope").alias("r_scope"), "rep")
    sets = s.join(own, F.col("scope").eqNullSafe(F.col("r_scope")) & (F.col("id") == F.col("rep")), "left_semi")
    return members, sets


def similar_sets(s: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(scope, a, b, common, union, jaccard) of sets (scope, id, s, size) of one scope, a < b, none of them equal."""
    s = materialized(s, "similar-sets")
    rows = s.select("scope", "id", "size", F.explode("s").alias("x"))
    rarity = rows.groupBy("scope", "x").count().filter("count > 1")
    own = Window.partitionBy("scope", "id")
    # Shingles of one set alone come first and can be no candidate's, so only shared ones are ranked, after as many places as a set has others.
    alone = F.col("size") - F.count("*").over(own)
    ranked = rows.join(rarity, ["scope", "x"]).withColumn("r", alone + F.row_number().over(own.orderBy("count", "x")))
    prefix = F.col("size") - F.ceil(F.col("size") * threshold - 1e-9) + 1
    rare = materialized(ranked.filter(F.col("r") <= prefix).select("scope", "id", "size", "x"), "similar-prefixes")
    a = rare.select("scope", "x", F.col("id").alias("a"), F.col("size").alias("size_a"))
    b = rare.select(F.col("scope").alias("scope_b"), F.col("x").alias("x_b"), F.col("id").alias("b"), F.col("size").alias("size_b"))
    near = F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * threshold - 1e-9
    pairs = a.join(b, (F.col("scope") == F.col("scope_b")) & (F.col("x") == F.col("x_b")) & (F.col("a") < F.col("b")) & near).select("scope", "a", "b").distinct()
    sa, sb = s.select("scope", F.col("id").alias("a"), F.col("s").alias("sa")), s.select("scope", F.col("id").alias("b"), F.col("s").alias("sb"))
    full = pairs.join(sa, ["scope", "a"]).join(sb, ["scope", "b"])
    full = full.withColumn("common", F.size(F.array_intersect("sa", "sb"))).withColumn("union", F.size("sa") + F.size("sb") - F.col("common"))
    full = full.withColumn("jaccard", F.col("common") / F.col("union")).filter(F.col("jaccard") >= threshold)
    return full.select("scope", "a", "b", "common", "union", "jaccard")


def similar_pairs(texts: DataFrame, threshold: float = 0.85, n: int = 5) -> DataFrame:
    """(scope, a, b, common, union, jaccard) of rows (scope, id, text) of one scope, a < b, ``jaccard`` at ``threshold`` or above.

    Pairs are of class representatives; ``shingle_classes`` has whom they stand for.
    """
    return similar_sets(shingle_classes(texts, n)[1], threshold)


def lsh_pairs(sets: DataFrame, threshold: float = 0.85, tables: int = 24, buckets: int = 1 << 18) -> DataFrame:
    """(scope, a, b, common, union, jaccard) as ``similar_sets``, found by minwise hashing and verified on the sets.

    An approximate form: of pairs just at the threshold some may be missing, none is wrong. Hash tables are those of the ML library,
    over shingles folded to ``buckets``.
    """
    from pyspark.ml.feature import MinHashLSH
    from pyspark.ml.linalg import SparseVector, VectorUDT

    def folded(values):
        at = sorted({int(v) % buckets for v in values})
        return SparseVector(buckets, at, [1.0] * len(at))

    rows = materialized(sets.select("scope", "id", "s", "size", F.udf(folded, VectorUDT())("s").alias("v")), "lsh-sets")
    model = MinHashLSH(inputCol="v", outputCol="h", numHashTables=tables, seed=5).fit(rows)
    near = model.approxSimilarityJoin(rows, rows, 1.0 - threshold + 0.05, "distance")
    side = lambda x, c: F.col(f"{x}.{c}")
    pairs = near.filter((side("datasetA", "id") < side("datasetB", "id")) & (side("datasetA", "scope") == side("datasetB", "scope")))
    full = pairs.select(side("datasetA", "scope").alias("scope"), side("datasetA", "id").alias("a"), side("datasetB", "id").alias("b"), side("datasetA", "s").alias("sa"), side("datasetB", "s").alias("sb"))
    full = full.withColumn("common", F.size(F.array_intersect("sa", "sb"))).withColumn("union", F.size("sa") + F.size("sb") - F.col("common"))
    full = full.withColumn("jaccard", F.col("common") / F.col("union")).filter(F.col("jaccard") >= threshold)
    return full.select("scope", "a", "b", "common", "union", "jaccard").dropDuplicates(["scope", "a", "b"])


def _in_order(schema: pa.Schema):
    """Edges (scope, late, early, early_kept), in order of late's rank: decides the late ones. A kept early one drops the late one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for batch in batches:
            for scope, late, early, known in zip(*(batch.column(c).to_pylist() for c in ("scope", "late", "early", "early_kept")), strict=True):
                # Who isn't late in an open edge before is decided already, or has no one before it.
                own = known if known is not None else kept.get((scope, early), True)
                kept[scope, late] = kept.get((scope, late), True) and not own
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in kept], schema.field(0).type), pa.array([k[1] for k in kept], schema.field(1).type), pa.array(list(kept.values()), pa.bool_())], schema=schema)

    return run


def greedy_keep(nodes: DataFrame, pairs: DataFrame, last_edges: int = LAST_EDGES) -> DataFrame:
    """``kept`` of every node (scope, id, priority): in priority order (largest first, then id) a
    node is kept unless a kept one before it is similar.

    Rounds instead of a loop over nodes: kept is who has no undecided and no kept
    neighbour before it, dropped who has a kept one. When few edges are open, one task goes through them
    in order, so a long chain doesn't take a round a node; beyond ``last_edges`` rounds go on until all is settled.
    """
    rank = F.struct(-F.col("priority"), F.col("id"))
    p = nodes.select("scope", "id", rank.alias("rank"))
    e = pairs.join(p.select("scope", F.col("id").alias("a"), F.col("rank").alias("ra")), ["scope", "a"]).join(p.select("scope", F.col("id").alias("b"), F.col("rank").alias("rb")), ["scope", "b"])
    first = F.col("ra") < F.col("rb")
    edges = materialized(e.select("scope", F.when(first, F.col("a")).otherwise(F.col("b")).alias("early"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("late"), F.greatest("ra", "rb").alias("rank")), "greedy-edges")
    touched = edges.select("scope", F.col("early").alias("id")).union(edges.select("scope", F.col("late"))).distinct()
    state = materialized(touched.withColumn("kept", F.lit(None).cast("boolean")), "greedy-state")
    while True:
        open_ = state.filter("kept is null").select("scope", F.col("id").alias("late"))
        left = edges.join(open_, ["scope", "late"], "left_semi").join(state.select("scope", F.col("id").alias("early"), F.col("kept").alias("early_kept")), ["scope", "early"])
        n = left.limit(last_edges + 1).count()
        if n <= last_edges:
            break
        seen = left.groupBy("scope", F.col("late").alias("id")).agg(F.bool_or(F.coalesce("early_kept", F.lit(False))).alias("any_kept"), F.bool_or(F.col("early_kept").isNull()).alias("any_open"))
        s = state.join(seen, ["scope", "id"], "left")
        kept = F.when(F.col("any_kept"), F.lit(False)).when(~F.coalesce("any_open", F.lit(False)), F.lit(True))
        old, state = state, materialized(s.select("scope", "id", F.coalesce("kept", kept).alias("kept")), "greedy-state")
        released(old)
    if n:
        schema = pa.schema([(f.name, pa.int64() if f.dataType.typeName() in ("long", "integer") else pa.string()) for f in state.schema.fields[:2]] + [("kept", pa.bool_())])
        kinds = [f"{x.name} {'long' if x.type == pa.int64() else 'string'}" for x in schema][:2]
        cast = [F.col(c).cast(k.split()[1]).alias(c) for c, k in zip(("scope", "late", "early"), (kinds[0], kinds[1], kinds[1]), strict=True)]
        rows = left.repartition(1).sortWithinPartitions("rank").select(*cast, "early_kept")
        settled = rows.mapInArrow(_in_order(schema), ", ".join(kinds) + ", kept boolean").select("scope", "id", F.col("kept").alias("settled"))
        state = state.join(settled, ["scope", "id"], "left")
        state = state.select("scope", "id", F.coalesce("kept", "settled", F.lit(True)).alias("kept"))
    return nodes.join(state, ["scope", "id"], "left").withColumn("kept", F.coalesce("kept", F.lit(True)))


def near_dedup(texts: DataFrame, threshold: float = 0.85, n: int = 5, pairs_of=similar_sets) -> DataFrame:
    """``kept`` of rows (scope, id, text, priority). ``pairs_of`` finds the similar sets: ``similar_sets``, or ``lsh_pairs``.

    Of a class the first in priority order is compared with other classes; the others go, as they are like the first,
    or like what the first is dropped for. Texts without a word are kept.
    """
    members, sets = shingle_classes(texts, n)
    rank = F.struct(-F.col("priority"), F.col("id"))
    m = members.join(texts.select("scope", "id", "priority"), ["scope", "id"])
    firsts = materialized(m.groupBy("scope", "rep").agg(F.min(rank).alias("rank"), F.min_by("id", rank).alias("first"), F.min_by("priority", rank).alias("priority")), "near-firsts")
    pairs = pairs_of(sets, threshold)
    name = lambda c: firsts.select("scope", F.col("rep").alias(c), F.col("first").alias(f"f_{c}"))
    pairs = pairs.select("scope", "a", "b").join(name("a"), ["scope", "a"]).join(name("b"), ["scope", "b"]).select("scope", F.col("f_a").alias("a"), F.col("f_b").alias("b"))
    kept = greedy_keep(firsts.select("scope", F.col("first").alias("id"), "priority"), pairs).filter("kept").select("scope", "id", F.lit(True).alias("stays"))
    some = members.select("scope", "id", F.lit(True).alias("some"))
    out = texts.select("scope", "id", "priority").join(some, ["scope", "id"], "left").join(kept, ["scope", "id"], "left")
    return out.select("scope", "id", "priority", (F.col("some").isNull() | F.col("stays").isNotNull()).alias("kept"))
