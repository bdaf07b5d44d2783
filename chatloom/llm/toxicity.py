"""Toxicity by a bidirectional gated recurrent network over all overlapping windows.

The network (``rnn``) reads windows of words and is trained in numpy from
labelled texts.  A label holds for a text, not for its windows, so training
goes from all windows to the window with the largest score of each text.  A
text's score is the largest of its windows, calibrated on the training texts.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grid, rnn
from .common import discard, in_batches, numbered, position, remainder, text_or_empty, with_columns_of, written

#: Words of a window and between the starts of windows.
LENGTH, STRIDE = 32, 16
#: The classifier is fitted on so many labelled texts of each class at most, and so many bytes of them.
MAX_POSITIVE, MAX_NEGATIVE, MAX_BYTES = 1500, 2500, 24 << 20
#: Words of the word table, and in how many texts of the sample each must be.
VOCABULARY, MIN_TEXTS = 20_000, 4
#: Windows that a round of training goes through at least; that the first rounds go through at most; of texts of label 0
#: that a later round scores at most, and takes from them: those with the largest scores, and others drawn at random.
LEAST_WINDOWS, FIRST_WINDOWS, OTHER_WINDOWS, HARD_WINDOWS, DRAWN_WINDOWS = 4000, 8000, 20_000, 1500, 3000


class Model:
    def __init__(self, net: rnn.Network, scale: float, shift: float):
        self.net, self.scale, self.shift = net, scale, shift

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Probabilities; 0 for texts without a letter or figure."""
        raw = rnn.score_texts(self.net, data, offs, LENGTH, STRIDE)
        return np.where(np.isfinite(raw), rnn._sigmoid(self.scale * np.where(np.isfinite(raw), raw, 0) + self.shift), 0.0)


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [x.encode("utf-8", "replace") for x in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


def _platt(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic fit with the usual soft targets."""
    pos, neg = y.sum(), (1 - y).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        q = rnn._sigmoid(a * raw + b)
        d, s = weight * (q - t), weight * q * (1 - q) + 1e-9
        h = np.array([[(s * raw * raw).sum() + 1e-3, (s * raw).sum()], [(s * raw).sum(), s.sum() + 1e-3]])
        step = np.linalg.solve(h, [(d * raw).sum() + 1e-3 * (a - 1), d.sum()])
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return float(max(a, 1e-3)), float(b)


def train(texts: list[str], labels: list[int], prior: float, seed: int = 0, rounds: int = 8, epochs_all: int = 2) -> Model:
    """Fit on texts and labels of 0 or 1; ``prior`` is the share of 1 where the model is used.

    Every fifth text is left out of the fit and used to calibrate. Equal texts count once.
    How many windows of the sample a round goes through is bounded (FIRST_WINDOWS and the
    others above); the choice among the windows of texts of label 0 is drawn anew each round.
    """
    first_of = {t: i for i, t in reversed(list(enumerate(texts)))}
    texts, labels = [texts[i] for i in sorted(first_of.values())], [labels[i] for i in sorted(first_of.values())]
    data, offs = _joined(texts)
    y, data = np.array(labels, np.float32), grid.lower(data)
    starts, ends, doc = rnn.tokens(data, offs)
    if not len(starts) or y.min(initial=1) == y.max(initial=0):
        # Nothing to learn from: every text gets the prior.
        net = rnn.Network(np.zeros(0, np.uint64))
        net.p["out"][:] = 0
        q = min(max(prior, 1e-4), 1 - 1e-4)
        return Model(net, 1.0, float(np.log(q / (1 - q))))
    fit = np.arange(len(texts)) % 5 != 4
    h, at, word = np.unique(grid.hashes(data, starts, ends), return_index=True, return_inverse=True)
    # A word has a row of its own if enough texts have it.
    once = np.unique(np.stack([word, doc])[:, fit[doc]], axis=1)
    count = np.bincount(once[0], minlength=len(h))
    frequent = np.flatnonzero(count >= MIN_TEXTS)
    frequent = frequent[np.argsort(-count[frequent], kind="stable")[:VOCABULARY]]
    net = rnn.Network(np.sort(h[frequent]), seed=seed + 3)
    grams, first = rnn.grams_of(data, starts[at], ends[at], net.buckets)
    rows, adam, g = net.rows(h), rnn.Adam(0.01), np.random.default_rng(seed)
    start, size, of = rnn.windows(doc, len(texts), LENGTH, STRIDE)
    for k in range(rounds):
        usable = np.flatnonzero(fit[of])
        if k < epochs_all:
            pick = g.permutation(usable)[:FIRST_WINDOWS]
        else:
            raw = np.full(len(start), -np.inf)
            near = np.union1d(usable[y[of[usable]] > 0], g.permutation(usable[y[of[usable]] == 0])[:OTHER_WINDOWS])
            raw[near] = _window_logits(net, rows, grams, first, word, start[near], size[near], len(h))
            best = near[np.lexsort((-raw[near], of[near]))]
            best = best[np.unique(of[best], return_index=True)[1]]
            more = near[y[of[near]] == 0]
            hard = more[np.argsort(-raw[more], kind="stable")[:HARD_WINDOWS]]
            pick = np.unique(np.concatenate([best[y[of[best]] > 0], hard, g.permutation(more)[:DRAWN_WINDOWS]]))
        ids, mask = rnn.window_ids(word, start[pick], size[pick], LENGTH, len(h))
        target = y[of[pick]]
        weight = np.where(target > 0, 0.5 / max(target.mean(), 1e-6), 0.5 / max(1 - target.mean(), 1e-6)).astype(np.float32)
        # Small samples are gone through more than once, so that the number of steps doesn't fall with them.
        for again in range(min(12, max(1, LEAST_WINDOWS // len(pick)))):
            rnn.fit(net, ids, mask, rows, grams, first, target, weight, adam, batch=64, seed=seed + k + 100 * again)
    raw = np.full(len(texts), -np.inf)
    np.maximum.at(raw, of, _window_logits(net, rows, grams, first, word, start, size, len(h)))
    held = np.isfinite(raw) & ~fit
    if held.sum() < 20 or y[held].min() == y[held].max():
        held = np.isfinite(raw)
    share, prior = y[held].mean(), min(max(prior, 0.01), 0.99)
    weight = np.where(y > 0, prior / share, (1 - prior) / (1 - share))
    return Model(net, *_platt(raw[held], y[held], weight[held]))


def _window_logits(net, rows, grams, first, word, start, size, pad) -> np.ndarray:
    gates, out = net.projected(net.inputs(rows, grams, first)), np.empty(len(start))
    for lo in range(0, len(start), 4096):
        ids, mask = rnn.window_ids(word, start[lo : lo + 4096], size[lo : lo + 4096], LENGTH, pad)
        out[lo : lo + 4096] = net.logits(gates, ids, mask)
    return out


def fitted(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_negative: int = MAX_NEGATIVE, max_bytes: int = MAX_BYTES, seed: int = 0) -> Model:
    """A model from the labelled texts whose crc32(doc_id) mod 4 isn't 2.

    The sample is bounded: the texts of each class with the smallest hashes of
    their ids, ``max_positive`` and ``max_negative`` at most; a text of over a
    24th of ``max_bytes`` (UTF-8) is passed over, and so is one that would bring the
    sample over ``max_bytes``. Null ids, labels and texts are passed over; an id
    with both labels is toxic; of rows that repeat an id the smallest text counts.

    One task trains on the sample and returns the weights; the driver never holds
    the texts.
    """
    spark = docs.sparkSession
    known = with_columns_of(labels, {"doc_id": "long", "toxic": "int"}).filter("doc_id is not null and toxic in (0, 1)").filter(remainder("doc_id", 4) != 2)
    known = written(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("h", F.xxhash64(F.lit(seed), "doc_id")), "toxic-labels")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = [known.filter(F.col("toxic") == y).orderBy("h", "doc_id").limit(most) for y, most in ((1, max_positive), (0, max_negative))]
    chosen = [(r["doc_id"], r["toxic"], r["h"]) for r in parts[0].unionByName(parts[1]).collect()]
    discard(known)
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    if not chosen:
        return train([], [], prior, seed)
    base = with_columns_of(docs, {"doc_id": "long", "text": "string"}).filter("text is not null").filter(F.octet_length("text") <= max_bytes // 24)
    sample = base.join(F.broadcast(spark.createDataFrame(chosen, "doc_id long, toxic int, h long")), "doc_id")
    sample = written(sample.groupBy("doc_id", "toxic", "h").agg(F.min("text").alias("text")), "toxic-sample")
    sizes = sample.select("doc_id", "h", F.octet_length("text").alias("n")).collect()
    ids, held = [], 0
    for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"])):
        if held + r["n"] <= max_bytes:
            held += r["n"]
            ids.append((r["doc_id"],))
    if not ids:
        discard(sample)
        return train([], [], prior, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((h, i, t, y) for b in batches for i, t, y, h in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "toxic", "h")), strict=True)), key=lambda r: r[:2])
        model = train([r[2] for r in rows], [r[3] for r in rows], prior, seed)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]}, pa.schema([("model", pa.binary())]))

    one = sample.join(F.broadcast(spark.createDataFrame(ids, "doc_id long")), "doc_id", "left_semi").repartition(1)
    model = pickle.loads(in_batches(one, run, "model binary").head()["model"])
    discard(sample)
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row; null texts are empty ones, of score 0."""
    base = with_columns_of(docs, {"doc_id": "long", "text": "string"}).withColumn("text", text_or_empty())
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in grid.pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(data, offs))], schema=schema)

    return in_batches(base, run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **kw) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= threshold).

    held_out is false for a null doc_id. Empty texts get score 0. An empty table
    gives no row; without labels of both values every text gets the prior.
    Repeated rows are rows of their own; other columns are ignored, whatever their names.
    """
    out = scored(docs, fitted(docs, labels, **kw))
    return out.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **kw) -> DataFrame:
    """The rows of ``docs``, whole, whose text scores under the threshold. Null and empty texts stay, rows with a null id are
    scored like others, and repeated rows are rows of their own."""
    model = fitted(docs, labels, **kw)
    text = f"c{position(docs, 'text')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in grid.pieces(batches, text):
            yield part.filter(pa.array(model.score(data, offs) < threshold))

    plain = numbered(docs)
    return in_batches(plain, run, plain.schema).toDF(*docs.columns)
