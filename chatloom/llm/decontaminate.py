"""Benchmark decontamination by size-partitioned MinHash containment search (DataFrame functions only).

Looked for are short test items whose word shingles lie, for the most part,
inside a document that may be a thousand times as long.  A Jaccard estimate is
of no use there, so the search is one for containment, and it is partitioned by
the size of the items:

* Items fall into partitions by the power of two of their number of shingles.
  An item is represented by its ``k`` smallest shingle hashes (its minwise
  sketch).  ``k`` is set for the partition's largest size ``u`` and the
  threshold ``t`` to ``floor((1 - t) * u) + 1``: an item contained to ``t`` or
  more misses fewer shingles than that, so at least one hash of its sketch is a
  hash of the document.  The candidate search loses nothing, and it isn't
  bounded by what a random sketch happens to catch.
* A document is probed with its own shingle hashes. A partition's sketches have no
  hash above a limit, which is low where items are large, so a document's hashes
  are kept only up to the largest of the limits, and one join on the hash serves all
  partitions: above a partition's own limit it finds none of its items.
* Candidates are verified by exact shingle containment on the whole text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, numbered, position, small, text_or_empty, with_columns_of, written

#: Items that are broadcast have this many shingles together at most.
MAX_BROADCAST_ROWS = 500_000


def word_hashes(text):
    """64-bit hashes of the words; A-Z lower-cased."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.transform(F.regexp_extract_all(lowered, F.lit(f"({WORD})"), F.lit(1)), lambda w: F.xxhash64(w))


def shingle_hashes(hashes: str, n: int):
    """Distinct hashes of the n-word shingles of a column of word hashes; of all words if they are fewer."""
    h = F.col(hashes)
    at = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)])
    rows = F.when(F.size(h) >= n, F.transform(F.sequence(F.lit(0), F.size(h) - n), at))
    few = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    return F.array_distinct(F.coalesce(rows, few))


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """item_id, hash, n, size_class, sketched: the items' shingles, and whether the sketch has them."""
    s = items.withColumn("n", F.size("hashes")).filter("n > 0").withColumn("size_class", F.floor(F.log2("n")).cast("int"))
    s = s.select("item_id", "n", "size_class", F.explode("hashes").alias("hash"))
    most = F.pow(F.lit(2.0), F.col("size_class") + 1) - 1
    # The exact bound of the item, which its class's largest size never undercuts.
    k = F.floor(F.lit(1.0 - threshold) * F.greatest(most, F.col("n")) + 1e-9) + 1
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("hash"))
    return s.withColumn("sketched", rank <= k)


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """A row a document and item that it contains: doc_id, item_id, n_item, n_common, containment.

    ``n_item`` is the number of distinct shingles of the item, ``n_common`` of
    those in the document; listed are pairs with n_common >= threshold * n_item.
    Null and empty texts contain nothing and are contained in nothing. Items
    (and documents) of fewer than ``n`` words have one shingle, all their words.
    Rows that repeat an id count as one document (item) with the shingles of
    all; rows with a null id give nothing. An empty table of either gives no row.
    Other columns are ignored, whatever their names.
    """
    d = with_columns_of(docs, {"doc_id": "long", "text": "string"}).filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    b = with_columns_of(benchmark, {"item_id": "long", "text": "string"}).filter(F.col("item_id").isNotNull())
    hashed = b.select("item_id", word_hashes(text_or_empty()).alias("w")).select("item_id", F.explode(shingle_hashes("w", n)).alias("hash"))
    hashed = hashed.groupBy("item_id").agg(F.collect_set("hash").alias("hashes"))
    items = written(sketches(hashed, threshold), "bench-shingles")
    # The limits of the partitions; a document's hashes above all of them match no sketch. A row a partition, of which there are 32 at most.
    limits = [r["top"] for r in items.filter("sketched").groupBy("size_class").agg(F.max("hash").alias("top")).collect()]
    probes = items.filter("sketched").select("hash", "item_id")
    shingled = d.select("doc_id", word_hashes(F.col("text")).alias("w")).select("doc_id", shingle_hashes("w", n).alias("s"))
    limit = F.lit(max(limits, default=-(2**63)))
    probing = shingled.select("doc_id", F.explode(F.filter("s", lambda x: x <= limit)).alias("hash"))
    candidates = written(probing.join(small(probes, MAX_BROADCAST_ROWS), "hash").select("doc_id", "item_id").distinct(), "bench-candidates")
    return verified(d, items, candidates, n, threshold)


def verified(docs: DataFrame, items: DataFrame, candidates: DataFrame, n: int, threshold: float) -> DataFrame:
    """The candidates that exact containment on whole texts confirms."""
    ids = candidates.select("doc_id").distinct()
    texts = docs.join(ids, "doc_id", "left_semi").select("doc_id", word_hashes(F.col("text")).alias("w")).select("doc_id", F.explode(shingle_hashes("w", n)).alias("hash"))
    shared = texts.join(small(items.select("hash", "item_id", "n"), MAX_BROADCAST_ROWS), "hash").join(candidates, ["doc_id", "item_id"], "left_semi")
    counts = shared.groupBy("doc_id", "item_id").agg(F.max("n").cast("long").alias("n_item"), F.countDistinct("hash").alias("n_common"))
    kept = counts.filter(F.col("n_common") * 1000 >= F.lit(round(threshold * 1000)) * F.col("n_item"))
    return kept.select("doc_id", "item_id", "n_item", "n_common", (F.col("n_common") / F.col("n_item")).alias("containment"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The documents that contain no item, with their columns. Rows with a null doc_id and null or empty texts stay; of rows that repeat a
    doc_id all go if one of them contains an item. Without items all documents stay."""
    found = contaminated(docs, benchmark, **kw).select(F.col("doc_id").alias("__leaked")).distinct()
    plain, key = numbered(docs), F.col(f"c{position(docs, 'doc_id')}").cast("long")
    return plain.join(found, key == F.col("__leaked"), "left_anti").toDF(*docs.columns)


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


def _sql_shingles(table: str, key: str) -> str:
    return f"""SELECT {key}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM (SELECT {key}, {_WORDS} AS w FROM {table} WHERE {key} IS NOT NULL AND text IS NOT NULL) WHERE len(w) > 0"""


SQL = f"""
WITH ds AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM ({_sql_shingles("documents", "doc_id")})),
bs AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM ({_sql_shingles("benchmark", "item_id")})),
bn AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
c AS (SELECT ds.doc_id, bs.item_id, count(*) AS n_common FROM ds JOIN bs ON ds.s = bs.s GROUP BY ALL)
SELECT doc_id, item_id, CAST(n_item AS BIGINT) AS n_item, CAST(n_common AS BIGINT) AS n_common, n_common::DOUBLE / n_item::DOUBLE AS containment
FROM c JOIN bn USING (item_id) WHERE 1000 * n_common >= 800 * n_item
"""
