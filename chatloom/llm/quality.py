"""Quality rules: a hashed n-gram log-likelihood ratio and simple counts.

Two multinomials over hashed n-grams (words, and pairs of neighbouring words'
shapes), with additive smoothing: one of trusted texts, one of the whole corpus.
A text's ratio is the mean, over its n-grams, of the difference of their
log-probabilities.  The raw multinomial counts all texts, the trusted one a
bounded sample of the labelled ones (``MAX_TRUSTED``); both are vectors of a fixed
number of buckets, added up by task before anything is sent on.  The threshold is
read from the ratios of all trusted texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grid
from .common import discard, in_batches, text_or_empty, with_columns_of, written

BUCKETS, WINDOW = 1 << 16, 8
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
#: Histogram of ratios, from which the threshold is read: bins over [-LIMIT, LIMIT].
BINS, LIMIT = 4096, 16.0


def _shape(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of what a word looks like: runs of letters, capitals, figures and other characters."""
    kind = np.full(256, 4, np.uint64)
    kind[97:123], kind[65:91], kind[48:58], kind[128:] = 1, 2, 3, 1
    kind[list(b".,;:'!?-")] = [5, 6, 7, 8, 9, 10, 11, 12]
    k = kind[data]
    change = np.ones(len(k), bool)
    change[1:] = k[1:] != k[:-1]
    change[starts] = True
    lens = ends - starts
    cum = np.concatenate([[0], np.cumsum(lens)])
    at = np.arange(cum[-1]) - np.repeat(cum[:-1], lens) + np.repeat(starts, lens)
    seen = change[at]
    run = np.cumsum(seen) - np.repeat(np.concatenate([[0], np.cumsum(np.add.reduceat(seen.astype(np.int64), cum[:-1]))[:-1]]), lens)
    value = np.where(seen, grid.mix(k[at] + np.uint64(16) * np.minimum(run, 16).astype(np.uint64)), np.uint64(0))
    return grid.mix(np.add.reduceat(value, cum[:-1]))


def features(data: np.ndarray, offs: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams (lower-cased words, and pairs of neighbouring word shapes) and their text numbers."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, shape = grid.hashes(grid.lower(data), starts, ends), _shape(data, starts, ends)
    pair = doc[1:] == doc[:-1]
    two = grid.mix(shape[:-1] * np.uint64(3) + shape[1:])[pair]
    key = np.concatenate([h, two])
    return (key % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([doc, doc[1:][pair]])


def counts(data: np.ndarray, offs: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every text."""
    n = len(offs) - 1
    n_words = np.bincount(doc, minlength=n)

    def per_text(is_so: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(is_so, dtype=np.int64 if len(is_so) >> 31 else np.int32)])
        return (upto[offs[1:]] - upto[offs[:-1]]).astype(np.int64)

    out = {"n_words": n_words, "word_chars": per_text(~grid._SPACE[data] & ((data & 0xC0) != 0x80)), "n_symbols": per_text(_SYMBOLS[data])}
    # Lines with a word, by hash: all but the first of equal ones.
    dup = np.zeros(n, np.int64)
    if len(starts):
        l_start, l_end = grid.runs(data != 10, offs)
        has = np.searchsorted(starts, l_end, "left") > np.searchsorted(starts, l_start, "left")
        l_start, l_end = l_start[has], l_end[has]
        l_doc = np.searchsorted(offs, l_start, "right") - 1
        dup = np.bincount(l_doc, minlength=n) - _distinct(grid.hashes(data, l_start, l_end), l_doc, n)
    out["n_dup_lines"] = dup
    repeat = np.zeros(n, np.int64)
    if len(starts) >= WINDOW:
        h = grid.hashes(data, starts, ends)
        w, w_doc = grid.shingles(h, doc, n, WINDOW)
        long = n_words[w_doc] >= WINDOW
        w, w_doc = w[long], w_doc[long]
        if len(w):
            key = grid.mix(w + w_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            _, inverse, number = np.unique(key, return_inverse=True, return_counts=True)
            twice = number[inverse] > 1
            first_word = np.concatenate([[0], np.cumsum(n_words)])
            first_window = np.concatenate([[0], np.cumsum(np.bincount(w_doc, minlength=n))])
            at = (first_word[w_doc] + np.arange(len(w)) - first_window[w_doc])[twice]
            cover = np.zeros(len(starts) + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + WINDOW, -1)
            repeat = np.bincount(doc[np.cumsum(cover)[:-1] > 0], minlength=n)
    out["n_repeat_words"] = repeat
    return out


def _distinct(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    key = grid.mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.bincount(doc[np.unique(key, return_index=True)[1]], minlength=n)


class Ratio:
    """Log-probability differences by bucket."""

    def __init__(self, trusted: np.ndarray, raw: np.ndarray, smoothing: float = 0.5):
        p, q = trusted + smoothing, raw + smoothing
        self.table = (np.log(p / p.sum()) - np.log(q / q.sum())).astype(np.float32)

    def of(self, data, offs, starts, ends, doc) -> np.ndarray:
        """The mean difference of a text's n-grams; 0 without a word."""
        n = len(offs) - 1
        bucket, of = features(data, offs, starts, ends, doc)
        size = np.bincount(of, minlength=n)
        return np.bincount(of, self.table[bucket], minlength=n) / np.maximum(size, 1)


#: The trusted multinomial is fitted on so many trusted texts at most.
MAX_TRUSTED = 20_000


def trusted_labels(labels: DataFrame) -> DataFrame:
    """doc_id of the ids whose labels all have quality 1; written."""
    good = with_columns_of(labels, {"doc_id": "long", "quality": "int"}).filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return written(good.filter("quality = 1").select("doc_id"), "quality-trusted")


def fitted(docs: DataFrame, trusted: DataFrame, max_trusted: int = MAX_TRUSTED, seed: int = 0) -> Ratio:
    """The ratio table. The raw counts are of all texts; of more than ``max_trusted`` trusted ids, those with the smallest hashes count."""
    rows = with_columns_of(docs, {"doc_id": "long", "text": "string"}).withColumn("text", text_or_empty())
    ids = np.sort(np.array([r["doc_id"] for r in trusted.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(max_trusted).collect()], np.int64))

    def in_sample(part: pa.RecordBatch) -> np.ndarray:
        own = part.column("doc_id")
        value = own.fill_null(-1).to_numpy()
        at = np.minimum(np.searchsorted(ids, value), max(len(ids) - 1, 0))
        return (ids[at] == value if len(ids) else np.zeros(len(value), bool)) & own.is_valid().to_numpy(zero_copy_only=False)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for part, data, offs in grid.pieces(batches, "text"):
            bucket, of = features(data, offs, *grid.words(data, offs))
            raw += np.bincount(bucket, minlength=BUCKETS)
            good += np.bincount(bucket[in_sample(part)[of]], minlength=BUCKETS)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": some, "raw": raw[some], "trusted": good[some]}, pa.schema([("bucket", pa.int64()), ("raw", pa.int64()), ("trusted", pa.int64())]))

    sums = in_batches(rows, add, "bucket long, raw long, trusted long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).toPandas()
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[sums["bucket"]], good[sums["bucket"]] = sums["raw"], sums["trusted"]
    return Ratio(good, raw)


def threshold_of(scored: DataFrame, trusted: DataFrame, keep_share: float = 0.98, slack: float = 0.25) -> float:
    """The ratio that ``keep_share`` of all trusted texts with a word reach, to a bin's width, less ``slack``; none without such texts.

    Only ids and ratios are joined with the labels.
    """
    bin_ = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("ratio") + LIMIT) / (2 * LIMIT) * BINS)))
    rows = scored.filter("n_words > 0").select("doc_id", bin_.alias("bin")).join(trusted.hint("shuffle_hash"), "doc_id", "left_semi")
    found = rows.groupBy("bin").agg(F.count("*").alias("n")).toPandas().sort_values("bin")
    if not len(found):
        return -np.inf
    upto = found["n"].cumsum().to_numpy()
    edge = found["bin"].to_numpy()[int(np.searchsorted(upto, (1 - keep_share) * upto[-1], "right"))]
    return float(edge / BINS * 2 * LIMIT - LIMIT - slack)


def quality(docs: DataFrame, labels: DataFrame, min_words: int = 20, max_repeat: float = 0.3, max_trusted: int = MAX_TRUSTED, **kw) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, kept.

    kept: not base_failed, and the ratio is at the threshold or above. Null
    texts are empty ones (base_failed). Without trusted texts there is no
    threshold. An empty table gives no row; repeated rows are rows of their own.
    Other columns are ignored, whatever their names.
    """
    trusted = trusted_labels(labels)
    ratio = fitted(docs, trusted, max_trusted)
    base = with_columns_of(docs, {"doc_id": "long", "text": "string"}).withColumn("text", text_or_empty())
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = pa.schema([("doc_id", pa.int64()), *((x, pa.int64()) for x in names), ("base_failed", pa.bool_()), ("ratio", pa.float64())])
    per_mille = round(1000 * max_repeat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in grid.pieces(batches, "text"):
            starts, ends, doc = grid.words(data, offs)
            c = counts(data, offs, starts, ends, doc)
            failed = (c["n_words"] < min_words) | (1000 * c["n_repeat_words"] > per_mille * c["n_words"])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c[k].astype(np.int64)) for k in names), pa.array(failed), pa.array(ratio.of(data, offs, starts, ends, doc))], schema=schema)

    scored = written(in_batches(base, run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double"), "quality-scored")
    least = threshold_of(scored, trusted, **kw)
    discard(trusted)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= F.lit(float(least))))
