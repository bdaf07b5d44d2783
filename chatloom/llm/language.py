"""Language identification as inference of a mixture.

A word has a likelihood under every language from its character n-grams.  A
text is a mixture of languages; expectation-maximisation estimates its
proportions.  Which languages the mixture has is chosen by the likelihood
less a penalty for each language more: sets of the one, two, ... most
likely languages are fitted and compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grid
from .common import in_batches, remainder, text_or_empty, with_columns_of

BUCKETS = 1 << 15
#: The model is fitted on about so many texts, shared among the languages.
SAMPLE_TEXTS = 4000
#: Most languages of a text's mixture, rounds of expectation-maximisation, penalty (times half the logarithm of the number of words) of a language more.
MOST, ROUNDS, PENALTY = 3, 12, 4.0

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters lower-cased, in UTF-8."""
    out = grid.lower(data)
    at = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[at] += 0x20
    return out


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' 2- and 4-grams of bytes, with marks at both ends, and where each word's begin."""
    lens = ends - starts
    first = np.concatenate([[0], np.cumsum(lens)])
    pos = np.arange(first[-1]) - np.repeat(first[:-1], lens)
    size, at = np.repeat(lens, lens), pos + np.repeat(starts, lens)
    near = lambda k: np.where((pos + k >= 0) & (pos + k < size), data[np.clip(at + k, 0, len(data) - 1)], 1 if k < 0 else 2).astype(np.uint64)
    two = (near(0) << np.uint64(8)) | near(1)
    four = (near(-1) << np.uint64(24)) | (two << np.uint64(8)) | near(2) | np.uint64(1 << 33)
    return (np.stack([grid.mix(two), grid.mix(four)], axis=1).ravel() % np.uint64(BUCKETS)).astype(np.int64), 2 * first[:-1]


def _words(data: np.ndarray, offs: np.ndarray):
    """Of the runs of letters: distinct ones (starts, ends), number of each run's, text numbers. Runs without a letter are left out."""
    starts, ends = grid.runs(_LETTER[data], offs)
    if not len(starts):
        return starts, ends, starts, starts
    doc = np.searchsorted(offs, starts, "right") - 1
    _, at, word = np.unique(grid.hashes(data, starts, ends), return_index=True, return_inverse=True)
    u0, u1 = starts[at], ends[at]
    high = np.concatenate([[0], np.cumsum(data >= 128)])
    good = high[u1] - high[u0] < u1 - u0
    for i in np.flatnonzero(~good):
        good[i] = any(c.isalpha() for c in data[u0[i] : u1[i]].tobytes().decode("utf-8", "ignore"))
    keep = good[word]
    return u0, u1, word[keep], doc[keep]


class Model:
    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    def likelihoods(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log-likelihoods, a row a word. 2- and 4-grams overlap, so each counts for half."""
        grams, first = _grams(data, starts, ends)
        return 0.5 * np.add.reduceat(self.table[grams], first, axis=0)

    def predict(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every text the number of its main language (-1 without a letter) and that one's proportion."""
        n, k = len(offs) - 1, len(self.languages)
        data = _lowered(data) if len(data) else data
        u0, u1, word, doc = _words(data, offs)
        if not k or not len(word):
            return np.full(n, -1), np.zeros(n)
        per = np.bincount(doc, minlength=n)
        some = np.flatnonzero(per)
        first = np.concatenate([[0], np.cumsum(per[some])[:-1]])
        ll = self.likelihoods(data, u0, u1)
        top = ll.max(axis=1)
        lik = np.exp(np.maximum(ll - top[:, None], -30))[word].astype(np.float32)
        base = np.add.reduceat(top[word], first)
        row = np.repeat(np.arange(len(some)), per[some])

        def fit(share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
            for _ in range(rounds):
                part = lik * share[row]
                part /= part.sum(axis=1, keepdims=True)
                share = (np.add.reduceat(part, first, axis=0) / per[some][:, None]).astype(np.float32)
            return share, np.add.reduceat(np.log((lik * share[row]).sum(axis=1) + 1e-30), first) + base

        share, _ = fit(np.full((len(some), k), 1 / k, np.float32), ROUNDS)
        order = np.argsort(-share, axis=1, kind="stable")
        best, best_at, best_share = np.full(len(some), -np.inf), np.zeros(len(some), int), np.ones(len(some))
        for m in range(1, min(MOST, k) + 1):
            allowed = np.zeros((len(some), k), np.float32)
            np.put_along_axis(allowed, order[:, :m], 1, axis=1)
            start = allowed * np.maximum(share, 1e-3)
            p, value = fit(start / start.sum(axis=1, keepdims=True), 0 if m == 1 else ROUNDS // 2)
            value = value - 0.5 * PENALTY * (m - 1) * np.log(per[some] + 1)
            better = value > best
            best[better], best_at[better], best_share[better] = value[better], p.argmax(axis=1)[better], p.max(axis=1)[better]
        out, score = np.full(n, -1), np.zeros(n)
        out[some], score[some] = best_at, np.clip(best_share, 0, 1)
        return out, score


def counted(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How often the buckets occur in the texts."""
    if not len(data):
        return np.zeros(BUCKETS)
    data = _lowered(data)
    u0, u1, word, _ = _words(data, offs)
    if not len(word):
        return np.zeros(BUCKETS)
    grams, first = _grams(data, u0, u1)
    times = np.bincount(word, minlength=len(u0))
    return np.bincount(grams, np.repeat(times, np.diff(np.append(first, len(grams)))), BUCKETS)


def fitted(docs: DataFrame, sample_texts: int = SAMPLE_TEXTS, smoothing: float = 0.1, seed: int = 0) -> Model:
    """A model from texts with a language whose crc32(doc_id) mod 4 isn't 2.

    Of each language a share of the texts is drawn by a hash of the id, so that
    about ``sample_texts`` are drawn in all, and of a language as many as of any other.
    The texts are counted where they are; the driver gets a number a language and bucket.
    """
    base = with_columns_of(docs, {"doc_id": "long", "text": "string", "lang": "string"}).filter("text is not null and lang is not null and doc_id is not null").filter(remainder("doc_id", 4) != 2)
    counts = {r["lang"]: r["count"] for r in base.groupBy("lang").count().collect()}
    if not counts:
        return Model([], np.zeros((BUCKETS, 1), np.float32))
    each = max(1, sample_texts // len(counts))
    rate = F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(min(1.0, each / n)))])
    u = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in grid.pieces(batches, "text"):
            langs = np.array(part.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                own = np.flatnonzero(langs == lang)
                lens = (offs[own + 1] - offs[own]).astype(np.int64)
                n = counted(np.concatenate([data[offs[i] : offs[i + 1]] for i in own]), np.concatenate([[0], np.cumsum(lens)]))
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(n[some].astype(np.int64))], schema=schema)

    rows = in_batches(base.filter(u < F.element_at(rate, F.col("lang"))).select("text", "lang"), run, "lang string, bucket int, n long")
    found = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts)
    table = np.full((BUCKETS, len(languages)), smoothing)
    at = {k: j for j, k in enumerate(languages)}
    table[found["bucket"].to_numpy(int), found["lang"].map(at).to_numpy(int)] += found["n"].to_numpy(float)
    return Model(languages, np.log(table / table.sum(axis=0)).astype(np.float32))


def languages(docs: DataFrame, model: Model | None = None, **kw) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score (the language's proportion in the text).

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text if there is nothing to learn from. held_out is false for a null doc_id.
    An empty table gives no row; repeated rows are rows of their own. Other columns
    are ignored, whatever their names.
    """
    model = model or fitted(docs, **kw)
    base = with_columns_of(docs, {"doc_id": "long", "text": "string"}).withColumn("text", text_or_empty())
    base = base.withColumn("held_out", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)))
    names = np.array([*model.languages, "und"], object)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in grid.pieces(batches, "text"):
            at, score = model.predict(data, offs)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(names[at], pa.string()), pa.array(score.astype(float))], schema=schema)

    return in_batches(base, run, "doc_id long, held_out boolean, lang_pred string, score double")
