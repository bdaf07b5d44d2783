"""N-gram language model with deleted interpolation.

A token's probability is a mixture of the maximum-likelihood estimates of
every order, down to words alone, and of a uniform distribution.  Mixture weights
depend on a bucket of the context's frequency and are learned by
expectation-maximisation on counts of texts held out of the counting (a part
of the training texts, deleted from the counts for that purpose alone).

The model is as large as the corpus, so no task or driver ever holds it:

1. Texts are packed into *blocks* of some megabytes, written once: their tokens as
   numbers into the block's list of word hashes. Texts themselves don't travel on.
2. A block sends the sorted hashes of its distinct n-grams, with its counts, in
   one binary row to each of ``2 ** BITS`` *cells* of the hash range. So rows grow
   in proportion to the blocks, whatever the corpus.
3. As long as a cell has more n-grams than a task may hold, as many blocks as
   there are cells are merged to one *group*, which sends its distinct n-grams on
   to the cells within its cell. Each such level multiplies the cells by
   ``2 ** BITS``, and a group's share of a cell is never larger than a block.
4. A last cell adds up the counts and answers each block (or group) with an array
   of totals in the order of its own hashes; hashes don't travel back. Groups
   answer theirs in the same way.
5. The orders are counted one after another. Blocks meet their answers and score their texts.

A frequent n-gram is one entry per block, whatever its frequency, so no cell
is hot.  Training of the weights needs a histogram of a bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grid
from .common import discard, free_shuffles, in_batches, remainder, text_or_empty, with_columns_of, written

BLOCK_BYTES = 8 << 20
#: A row of a block has its n-grams whose hashes have the same first BITS bits. A last cell has so many n-grams of one order at most, about; a task of the
#: last level has about as many.
BITS, CELL_KEYS = 8, 1_500_000
#: Kinds of texts: counted; held out for the weights, counted in the end; only scored.
COUNTED, TUNING, OTHER = 0, 1, 2
#: Buckets by the frequency of a context, of each order of context.
WIDTH = 24
_END, _BEGIN = np.uint64(0x51C64E9B7F3A2D15), np.uint64(0xA3D95B1E07C8F462)
_ORDER = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    batch = pa.RecordBatch.from_arrays([col], ["text"])
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    parts = list(grid.pieces(iter([batch]), "text", 1 << 40))
    data = np.concatenate([p[1] for p in parts])
    lens = np.concatenate([np.diff(p[2]) for p in parts])
    return data, np.concatenate([[0], np.cumsum(lens)])


def sequence(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes (an end after each text's words), text numbers, and where each text begins."""
    data, n = grid.lower(data), len(offs) - 1
    starts, ends, doc = grid.words(data, offs)
    per = np.bincount(doc, minlength=n)
    begin = np.concatenate([[0], np.cumsum(per + 1)])
    seq = np.empty(begin[-1], np.uint64)
    seq[np.arange(len(doc)) + doc] = grid.hashes(data, starts, ends)
    seq[begin[1:] - 1] = _END
    return seq, np.repeat(np.arange(n), per + 1), begin[:-1]


def ngrams(seq: np.ndarray, begin: np.ndarray, order: int) -> list[np.ndarray]:
    """For each order from 1, the hashes of the n-grams that end at each token."""
    out, state, back = [seq], seq, seq
    for k in range(1, order):
        back = np.concatenate([[_BEGIN], back[:-1]]) if len(back) else back
        back = back.copy()
        back[begin] = _BEGIN
        state = grid.mix(state + grid.mix(back * _ORDER[k] + np.uint64(k)))
        out.append(state)
    return out


def contexts(grams: list[np.ndarray], begin: np.ndarray) -> list[np.ndarray]:
    """For each order from 2, the hash of the context: the n-gram of one order less that ends one token before.
    The context of a text's first token is the end before it, as often as there are texts."""
    out = []
    for g in grams[:-1]:
        c = np.concatenate([[_END], g[:-1]]) if len(g) else g
        c[begin] = _END
        out.append(c)
    return out


def _pack(x: np.ndarray) -> bytes:
    """As many byte planes as the largest number needs, and before them their number."""
    planes = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    return bytes([planes]) + np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()


def _unpack(b: bytes) -> np.ndarray:
    planes = b[0]
    out = np.zeros(((len(b) - 1) // planes, 8), np.uint8)
    out[:, :planes] = np.frombuffer(b, np.uint8, offset=1).reshape(planes, -1).T
    return out.view("<u8").ravel()


def _kind(tune: int):
    r = remainder("doc_id", 7)
    return F.when(r.isNull() | (r == 2), F.lit(OTHER)).when(r == tune, F.lit(TUNING)).otherwise(F.lit(COUNTED))


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (block, kind, ids, sizes, words, seq, tokens) from rows (doc_id, kind, text).

    words are the hashes of the block's words, the most frequent first; seq has the place of each token's in that
    list; sizes are the numbers of tokens of the texts.
    """
    schema = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("words", pa.binary()), ("seq", pa.binary()), ("tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[int, list] = {}
        number = TaskContext.get().partitionId() << 32

        def flush(kind: int):
            nonlocal number
            parts, _ = held.pop(kind)
            ids = pa.concat_arrays([p.column("doc_id") for p in parts])
            texts = pa.concat_arrays([p.column("text").cast(pa.string()) for p in parts])
            seq, _, begin = sequence(*_flat(texts))
            words, at, times = np.unique(seq, return_inverse=True, return_counts=True)
            order = np.argsort(-times, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            packed = [pa.array([x], pa.binary()) for x in (_pack(np.diff(np.append(begin, len(seq)))), words[order].tobytes(), _pack(place[at]))]
            out = pa.RecordBatch.from_arrays([pa.array([number]), pa.array([kind], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *packed, pa.array([len(seq)])], schema=schema)
            number += 1
            return out

        for part, _, offs in grid.pieces(batches, "text", block_bytes // 8):
            kinds, size = part.column("kind").to_numpy(), np.diff(offs)
            for kind in np.unique(kinds):
                own = held.setdefault(int(kind), [[], 0])
                own[0].append(part.filter(pa.array(kinds == kind)))
                own[1] += int(size[kinds == kind].sum()) + 64 * int((kinds == kind).sum())
                if own[1] >= block_bytes:
                    yield flush(int(kind))
        for kind in sorted(held):
            yield flush(kind)

    return in_batches(docs.select("doc_id", "kind", "text"), run, "block long, kind int, ids array<long>, sizes binary, words binary, seq binary, tokens long")


def tokens_of(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``sequence`` of a block's texts."""
    sizes = _unpack(batch.column("sizes")[i].as_py()).astype(np.int64)
    seq = np.frombuffer(batch.column("words")[i].as_py(), np.uint64)[_unpack(batch.column("seq")[i].as_py())]
    return seq, np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes


#: What the owner of n-grams (a block or group) sends to a cell of a level: sorted hashes as differences, counts of the kinds that are counted (empty for none).
ASK = "gram int, cell long, owner long, keys binary, kept binary, tuned binary"
#: What it gets back: totals with the tuning texts and, if it has some, without.
ANSWER = "gram int, cell long, owner long, kept binary, total binary, distinct long, tokens long"
_ASK = pa.schema([("gram", pa.int32()), ("cell", pa.int64()), ("owner", pa.int64()), ("keys", pa.binary()), ("kept", pa.binary()), ("tuned", pa.binary())])
_ANSWER = pa.schema([("gram", pa.int32()), ("cell", pa.int64()), ("owner", pa.int64()), ("kept", pa.binary()), ("total", pa.binary()), ("distinct", pa.int64()), ("tokens", pa.int64())])


def _asks(bits: int, gram: int, cell: int, level: int, owner: int, keys: np.ndarray, kept: np.ndarray | None, tuned: np.ndarray | None) -> pa.RecordBatch:
    """Rows that send sorted hashes of a cell (0 of level 0 is all) to the cells of the next level within it."""
    inner = np.array([(cell << bits) + i << (64 - bits * (level + 1)) for i in range(1 << bits)], np.uint64)
    cut = np.append(np.searchsorted(keys, inner), len(keys))
    some = np.flatnonzero(cut[1:] > cut[:-1])
    part = lambda x: pa.array([_pack(x[cut[i] : cut[i + 1]]) if x is not None else b"" for i in some], pa.binary())
    deltas = [_pack(np.diff(keys[cut[i] : cut[i + 1]], prepend=inner[i : i + 1])) for i in some]
    return pa.RecordBatch.from_arrays([pa.array([gram] * len(some), pa.int32()), pa.array((cell << bits) + some, pa.int64()), pa.array([owner] * len(some), pa.int64()), pa.array(deltas, pa.binary()), part(kept), part(tuned)], schema=_ASK)


def _requests(rows: DataFrame, gram: int, bits: int) -> DataFrame:
    """What blocks ask and add of the n-grams of one order, to the cells of the first level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                seq, _, begin = tokens_of(batch, i)
                block, kind = batch.column("block")[i].as_py(), batch.column("kind")[i].as_py()
                keys, n = np.unique(ngrams(seq, begin, gram)[-1], return_counts=True)
                yield _asks(bits, gram, 0, 0, block, keys, n if kind == COUNTED else None, n if kind == TUNING else None)

    return in_batches(rows.select("block", "kind", "sizes", "words", "seq"), run, ASK)


def _runs(batches: Iterator[pa.RecordBatch], key: tuple[str, ...], names: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of neighbours with the same key."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in (*key, *names)), strict=True):
            if row[: len(key)] != now:
                if rows:
                    yield now, rows
                now, rows = row[: len(key)], []
            rows.append(row[len(key) :])
    if rows:
        yield now, rows


class _Merged:
    """Distinct hashes of the rows (owner, keys, kept, tuned) of a cell, with their counts."""

    def __init__(self, bits: int, cell: int, level: int, rows: list[tuple]):
        edge = np.array([cell << (64 - bits * level)], np.uint64)
        each = [np.cumsum(_unpack(k), dtype=np.uint64) + edge for _, k, _, _ in rows]
        self.ends = np.cumsum([len(x) for x in each])
        self.keys, self.where = np.unique(np.concatenate(each), return_inverse=True)
        self.sums = np.zeros((2, len(self.keys)), np.int64)
        for i, row in enumerate(rows):
            for sums, n in zip(self.sums, row[2:], strict=True):
                if n:
                    sums[self.own(i)] += _unpack(n).view(np.int64)

    def own(self, i: int) -> np.ndarray:
        """Where the hashes of a row stand; no one twice."""
        return self.where[self.ends[i - 1] if i else 0 : self.ends[i]]


def _batched(rows: Iterator[tuple], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of answers as batches of some megabytes."""
    held, size = [], 0
    for gram, cell, owner, kept, total, distinct, tokens in rows:
        held.append((gram, cell, owner, _pack(kept) if kept is not None else None, _pack(total) if total is not None else None, distinct, tokens))
        size += 100 + len(held[-1][3] or b"") + len(held[-1][4] or b"")
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), _ANSWER, strict=True)], schema=_ANSWER)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), _ANSWER, strict=True)], schema=_ANSWER)


def _dealt(rows: DataFrame, parts: int, cells: int, *by: str) -> DataFrame:
    """Rows of a cell (and of equal ``by``) in one partition, in order. The cells, which are alike in size, are dealt out evenly, each order's from another partition on."""
    cell, shift = F.col("cell"), F.col("gram") * F.lit(parts // 3 + 1) + (F.xxhash64(*by) if by else F.lit(0))
    at = F.pmod((cell * F.lit(7919) if cells < parts else F.floor(cell * F.lit(parts / cells))) + shift, F.lit(parts))
    return rows.repartitionById(parts, at.cast("int")).sortWithinPartitions("gram", "cell", *by)


def _answers(requests: DataFrame, bits: int, level: int, last: int, parts: int, blocks: int, spent: list[DataFrame]) -> DataFrame:
    """Answers to the requests of a level. At the last level a cell is whole; before it, groups ask for their owners.
    ``spent`` gets the tables that aren't needed once the answers are written."""
    if level == last:

        def answers(gram: int, cell: int, rows: list[tuple]) -> Iterator[tuple]:
            m = _Merged(bits, cell, level, rows)
            total = m.sums.sum(axis=0)
            yield gram, cell, None, None, None, int((total > 0).sum()), int(total.sum())
            for i, row in enumerate(rows):
                yield gram, cell, row[0], m.sums[0, m.own(i)] if row[3] else None, total[m.own(i)], None, None

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _batched(x for key, rows in _runs(batches, ("gram", "cell"), ("owner", "keys", "kept", "tuned")) for x in answers(*key, rows))

        return in_batches(_dealt(requests, parts, 1 << bits * level), whole, ANSWER)

    requests = written(requests, f"lm-requests-{level}", compression="zstd")
    grouped = requests.withColumn("group", F.pmod(F.xxhash64("owner"), F.lit(max(1, blocks >> bits * level))))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (gram, cell, group), rows in _runs(batches, ("gram", "cell", "group"), ("owner", "keys", "kept", "tuned")):
            m = _Merged(bits, cell, level, rows)
            yield _asks(bits, gram, cell, level, group, m.keys, m.sums[0], m.sums[1] if any(r[3] for r in rows) else None)

    asked = in_batches(_dealt(grouped, parts, 1 << bits * level, "group"), merge, ASK)
    above = written(_answers(asked, bits, level + 1, last, parts, blocks, spent), f"lm-answers-{level + 1}", compression="zstd")
    spent += [requests, above]
    own = grouped.select("gram", "cell", "group", F.lit(0).alias("from"), F.lit(0).cast("long").alias("inner"), "owner", "keys", "kept", "tuned")
    null = lambda t, c: F.lit(None).cast(t).alias(c)
    back = above.filter("owner is not null").select("gram", F.shiftright("cell", bits).alias("cell"), F.col("owner").alias("group"), F.lit(1).alias("from"), F.col("cell").alias("inner"), null("long", "owner"), F.col("total").alias("keys"), "kept", null("binary", "tuned"))

    def answers_down(gram: int, cell: int, rows: list[tuple]) -> Iterator[tuple]:
        asked, got = [r[2:] for r in rows if not r[0]], sorted((r for r in rows if r[0]), key=lambda r: r[1])
        m = _Merged(bits, cell, level, asked)
        total = np.concatenate([_unpack(r[3]) for r in got])
        kept = np.concatenate([_unpack(r[4]) for r in got]) if got[0][4] is not None else None
        for i, row in enumerate(asked):
            yield gram, cell, row[0], kept[m.own(i)] if row[3] else None, total[m.own(i)], None, None

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(x for (gram, cell, _), rows in _runs(batches, ("gram", "cell", "group"), ("from", "inner", "owner", "keys", "kept", "tuned")) for x in answers_down(gram, cell, rows))

    out = in_batches(_dealt(own.union(back), parts, 1 << bits * level, "group"), down, ANSWER)
    return out.unionByName(above.filter("owner is null"))


def _met(rows: DataFrame, answers: DataFrame, parts: int) -> DataFrame:
    """Blocks with their answers, dealt by block."""
    a = answers.filter("owner is not null").repartition(parts, "owner").groupBy(F.col("owner").alias("block")).agg(F.collect_list(F.struct("gram", "cell", "kept", "total")).alias("answers"))
    return rows.repartition(parts, "block").join(a, "block")


class _Counts:
    """Counts of a block's n-grams and contexts, a value a token."""

    def __init__(self, batch: pa.RecordBatch, i: int, order: int, which: str):
        self.seq, self.doc, self.begin = tokens_of(batch, i)
        answers = batch.column("answers")[i].as_py()
        grams = ngrams(self.seq, self.begin, order)
        self.n, unique, counts = [], [], []
        for k, g in enumerate(grams):
            u, inverse = np.unique(g, return_inverse=True)
            c = np.concatenate([_unpack(a[which]) for a in sorted((a for a in answers if a["gram"] == k + 1), key=lambda a: a["cell"])]).astype(np.float64)
            unique.append(u)
            counts.append(c)
            self.n.append(c[inverse])
        self.context = []
        for k, c in enumerate(contexts(grams, self.begin)):
            # The end as context is a word; its count is the number of texts.
            word = c == _END
            at = np.minimum(np.searchsorted(unique[k], c), len(unique[k]) - 1)
            value = np.where(unique[k][at] == c, counts[k][at], 0.0)
            end = np.searchsorted(unique[0], _END)
            value[word] = counts[0][end] if end < len(unique[0]) and unique[0][end] == _END else 0.0
            self.context.append(value)

    def estimates(self, total: float) -> list[np.ndarray]:
        """Maximum-likelihood estimates, lowest order first; 0 after an unknown context."""
        out = [self.n[0] / max(total, 1)]
        for n, c in zip(self.n[1:], self.context, strict=True):
            out.append(np.where(c > 0, np.minimum(n / np.maximum(c, 1), 1.0), 0.0))
        return out

    def bucket(self) -> np.ndarray:
        """0 if no context is known, else by the longest known one: its order, and the power of two of its frequency."""
        out = np.zeros(len(self.seq), np.int64)
        for k, c in enumerate(self.context):
            out = np.where(c > 0, 1 + k * WIDTH + np.minimum(np.log2(np.maximum(c, 1)).astype(np.int64), WIDTH - 1), out)
        return out


#: Estimates are counted by their logarithm to base 2, in LEVELS steps of so much for words alone and for longer n-grams.
LEVELS, STEPS = 32, (0.75, 0.4)


def _level(f: np.ndarray, k: int) -> np.ndarray:
    """0 for nothing, else 1 and more."""
    return np.where(f > 0, 1 + np.clip(np.round(-np.log2(np.maximum(f, 1e-18)) / STEPS[min(k, 1)]), 0, LEVELS - 2), 0).astype(np.int64)


def learned(tuning: DataFrame, order: int, kept_tokens: int, words: int, rounds: int = 30) -> np.ndarray:
    """Weights (bucket, component): uniform, then orders from 1, by expectation-maximisation on a histogram of the tuning texts' tokens.

    The histogram has LEVELS steps an order, so LEVELS ** order rows a bucket at most (some million for three orders), whatever the corpus.
    Orders whose context a bucket doesn't know have no weight in it.
    """
    cells = LEVELS**order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = _Counts(batch, i, order, "kept")
                key = np.zeros(len(c.seq), np.int64)
                for k, f in enumerate(c.estimates(kept_tokens)):
                    key = key * LEVELS + _level(f, k)
                both, n = np.unique(c.bucket() * cells + key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(both), pa.array(n)], schema=pa.schema([("key", pa.int64()), ("n", pa.int64())]))

    found = in_batches(tuning.select("sizes", "words", "seq", "answers"), run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    buckets = 1 + WIDTH * max(order - 1, 0)
    key, n = found["key"].to_numpy(np.int64), found["n"].to_numpy(float)
    bucket = key // cells
    every = np.full((len(key), order + 1), 1 / (words + 1))
    for k in range(order):
        q = key // LEVELS ** (order - 1 - k) % LEVELS
        every[:, k + 1] = np.where(q > 0, 2.0 ** (-STEPS[min(k, 1)] * (q - 1)), 0.0)
    # A bucket of a context of k words knows the orders to k + 1.
    known = np.arange(order + 1) <= 1 + np.where(np.arange(buckets) > 0, 1 + (np.arange(buckets) - 1) // WIDTH, 0)[:, None]
    weights = known / known.sum(axis=1, keepdims=True)
    # A bucket starts from what all that know as many orders learn together; one without tokens keeps that.
    together = known.sum(axis=1)
    for group in (together, np.arange(buckets)):
        for _ in range(rounds):
            part = every * weights[bucket]
            part *= (n / np.maximum(part.sum(axis=1), 1e-300))[:, None]
            sums = np.zeros((int(group.max()) + 1, order + 1))
            np.add.at(sums, group[bucket], part)
            sums = (sums[group] + 1e-3) * known
            weights = sums / sums.sum(axis=1, keepdims=True)
            if group is not together:
                none = ~np.isin(np.arange(buckets), bucket)
                weights[none] = start[none]  # noqa: F821
        start = weights.copy()
    return weights


def score(docs: DataFrame, order: int = 3, tune: int = 3, bits: int = BITS, cell_keys: int = CELL_KEYS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Trained on texts whose crc32(doc_id) mod 7 isn't 2; of these, the ones with
    remainder ``tune`` tune the weights. Scores are log10 probabilities of the
    whole text and its end. A null text is an empty one; a row with a null
    doc_id is scored but not learned from, and not held out. Repeated rows count
    as often as they are there. An empty table gives no row. Without training
    texts every token is unknown. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    base = with_columns_of(docs, {"doc_id": "long", "text": "string"}).withColumn("text", text_or_empty()).withColumn("kind", _kind(tune))
    packed = written(blocks(base, block_bytes), "lm-blocks", compression="zstd")
    size = packed.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.count("*").alias("blocks")).head()
    last = 1
    while int(size["tokens"]) >> bits * last > cell_keys:
        last += 1
    parts, n = int(size["blocks"]) // 2 + 1, int(size["tokens"]) // cell_keys + 1
    # One order after another, so that the shuffle of one is gone before the next one's is written.
    each = []
    for gram in range(1, order + 1):
        spent: list[DataFrame] = []
        each.append(written(_answers(_requests(packed, gram, bits), bits, 1, last, n, int(size["blocks"]), spent), f"lm-answers-{gram}", compression="zstd"))
        discard(*spent)
        free_shuffles(spark)
    answers = reduce(DataFrame.unionByName, each)
    sums = answers.filter("owner is null and gram = 1").agg(F.coalesce(F.sum("distinct"), F.lit(0)).alias("words"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).head()
    words, total = int(sums["words"]), int(sums["tokens"])
    kept = int(packed.filter(F.col("kind") == COUNTED).agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).head()["n"])
    tuning = packed.filter(F.col("kind") == TUNING)
    weights = learned(_met(tuning, answers.filter("kept is not null"), max(1, parts // 4)), order, kept, words)
    free_shuffles(spark)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                c = _Counts(batch, i, order, "total")
                bucket = c.bucket()
                p = weights[bucket, 0] / (words + 1)
                for k, f in enumerate(c.estimates(total)):
                    p += weights[bucket, k + 1] * f
                add = lambda x: np.add.reduceat(x, c.begin)  # noqa: B023, E731
                known = add((c.n[0] > 0).astype(np.int64))
                simple = add(np.log10((c.n[0] + 1) / (total + 1 * (words + 1))))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.bincount(c.doc, minlength=len(ids))), pa.array(known), pa.array(simple), pa.array(add(np.log10(np.maximum(p, 1e-300))))], schema=schema)

    out = in_batches(_met(packed.select("block", "ids", "sizes", "words", "seq"), answers, parts).select("ids", "sizes", "words", "seq", "answers"), run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    held = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
