"""Near-duplicates by a chosen-path set similarity join over minwise hashes.

A document is the set of its word shingles.  Documents with equal sets form a
class; one of a class, the one with the smallest id, stands for it.

*Chosen paths.*  A tree splits the documents recursively: its root has a
position of the minwise signature of its own, a later node picks positions by its
own hash, and the documents of the node that agree at a position go to the same
child.  Later nodes pick ``branches`` positions, more than one over the threshold,
so a pair at the threshold that parts in one child mostly stays together in
another, however deep the path is.  Two sets that share only a common passage soon
part.  There are as many trees as miss a pair at the threshold, over whole paths of
any length, with less than ``MISS``.

*Small nodes* are compared exhaustively by 8-bit sketches of the signature, and
what a sketch can't exclude is confirmed on the full shingle sets.  After the
first level the sketches have eight times as many hashes, of four bits, so that
of sets just below the threshold few are left to confirm.

*Large nodes.*  The links of the first level are confirmed and joined to
components first; in that level the blocks of a large node are compared with two
fixed members each.  From then on only nodes with documents of more than one
component are worked on, and only pairs across components count: a large group
of near copies is one component after the first level and is never expanded to
pairs.  A node descends while its children have clearly fewer such pairs than it
has.  Otherwise, and when it is small, the node ends: all its pairs are compared, of
a large one by pairs of blocks, so no task ever holds a whole node.

*Dense blocks.*  Where so many pairs of a block are just below the threshold that
sketches leave a multiple of its members, no pair is listed: the block's whole texts go
to one task, which finds the links on the full sets and returns a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import grid
from .common import discard, free_shuffles, in_batches, numbered, position, text_or_empty, with_columns_of, written
from .graph import components

#: Hashes that nodes split by, and whose low bytes are the sketch of the first level; and those whose low
#: four bits are the finer sketch after it.
N_HASHES, N_FINE = 128, 1024
#: Most probable miss of a pair at the threshold by the paths.
MISS = 1e-6
#: Members of a small node of the first level and after it, which is also what a block of a larger one has, shingles of a block, and the share of
#: a node's pairs across components that its children may have for it to descend.
LEAF, WHOLE, BLOCK_SHINGLES, SHRINK = 24, 1024, 1 << 20, 0.75
#: A block is dense if sketches leave more pairs than so many a member.
DENSE = 4
#: Pairs of one document that are confirmed in one task, about.
STAR = 64
#: Positions of the roots, all different.
_ROOTS = np.random.default_rng(11).permutation(N_HASHES).tolist()
_FACTORS = np.random.default_rng(7).integers(1, 2**63, N_FINE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sets(h: np.ndarray, doc: np.ndarray, n_docs: int, n: int) -> list[np.ndarray]:
    s, d = grid.shingles(h, doc, n_docs, n)
    at = np.searchsorted(d, np.arange(n_docs + 1))
    return [np.unique(s[at[i] : at[i + 1]]) for i in range(n_docs)]


def _shingle_sets(data: np.ndarray, offs: np.ndarray, n: int) -> list[np.ndarray]:
    data = grid.lower(data)
    starts, ends, doc = grid.words(data, offs)
    return _sets(grid.hashes(data, starts, ends), doc, len(offs) - 1, n)


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles, d1 and d2 (a 128-bit digest of the shingle set), mins (array of 32-bit minwise hashes), sketch (their low bytes) and fine (four bits of more hashes)."""
    schema = "doc_id long, n_shingles long, d1 long, d2 long, mins array<int>, sketch binary, fine binary"
    arrow = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("mins", pa.list_(pa.int32())), ("sketch", pa.binary()), ("fine", pa.binary())])

    def fixed(x: np.ndarray) -> pa.Array:
        ends = pa.py_buffer((np.arange(len(x) + 1) * x.shape[1]).astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(x), [None, ends, pa.py_buffer(np.ascontiguousarray(x))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in grid.pieces(batches, "text"):
            sets = _shingle_sets(data, offs, n)
            size = np.array([len(s) for s in sets])
            some = np.flatnonzero(size)
            mins = np.zeros((len(sets), N_FINE), np.uint32)
            digest = np.zeros((2, len(sets)), np.uint64)
            if len(some):
                flat, first = np.concatenate([sets[i] for i in some]), np.concatenate([[0], np.cumsum(size[some])[:-1]])
                for k in range(N_FINE):
                    mins[some, k] = np.minimum.reduceat(flat * _FACTORS[k], first) >> np.uint64(32)
                for k in range(2):
                    digest[k, some] = grid.mix(np.add.reduceat(grid.mix(flat + _FACTORS[k]), first) + size[some].astype(np.uint64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * N_HASHES, pa.int32()), pa.array(np.ascontiguousarray(mins[:, :N_HASHES]).ravel().view(np.int32)))
            low = mins.astype(np.uint8)
            fine = (low[:, ::2] & 15) | (low[:, 1::2] << 4)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(size, pa.int64()), *(pa.array(x.view(np.int64)) for x in digest), lists, fixed(low[:, :N_HASHES]), fixed(fine)], schema=arrow)

    return in_batches(docs.select("doc_id", "text"), run, schema)


def branches(threshold: float) -> int:
    """Positions that a node below the root picks; 0 below a threshold of 0.5, where no node descends."""
    return 2 if threshold >= 0.8 else math.ceil(1.6 / threshold) if threshold >= 0.5 else 0


def missed(threshold: float, trees: int) -> float:
    """Probability that ``trees`` trees with paths of any length miss a pair with the similarity ``threshold``.

    The pair agrees at some of the N_HASHES positions. Roots are drawn from them without repetition, later positions with.
    """
    total, b = 0.0, branches(threshold)
    for agree in range(N_HASHES + 1):
        share, lost = agree / N_HASHES, 0.0
        for _ in range(400 if b else 0):
            lost = (1 - share + share * lost) ** b
        roots = sum(math.comb(trees, j) * math.comb(N_HASHES - trees, agree - j) * lost**j for j in range(max(0, agree - N_HASHES + trees), min(trees, agree) + 1))
        total += roots * threshold**agree * (1 - threshold) ** (N_HASHES - agree)
    return total


def roots(threshold: float) -> list[int]:
    """Positions of the roots of as many trees as miss less than MISS."""
    for trees in range(1, N_HASHES + 1):
        if missed(threshold, trees) < MISS:
            return _ROOTS[:trees]
    raise ValueError(f"the threshold {threshold} is too low for {N_HASHES} hashes")


def _similarity(x: np.ndarray, y: np.ndarray, fine: bool) -> np.ndarray:
    """Estimates of Jaccard similarities from rows of sketches, less what agrees by chance."""
    if fine:
        v = x.view(np.uint64) ^ y.view(np.uint64)
        v = (v | v >> np.uint64(1) | v >> np.uint64(2) | v >> np.uint64(3)) & np.uint64(0x1111111111111111)
        p, chance = 1 - np.bitwise_count(v).sum(axis=1, dtype=np.int64) / N_FINE, 1 / 16
    else:
        p, chance = (x == y).sum(axis=1) / N_HASHES, 1 / 256
    return (p - chance) / (1 - chance)


def _compare(least: float, across: bool):
    """Pairs of rows of a node that the sketches don't exclude: of a node a spanning
    forest of the most similar, or (across) all pairs with different labels; of rows
    with a side that isn't 0, those from different sides.

    Rows (node, a, b, side): of a pair node and side are null, a < b; of a dense node (across) come its members that have a pair instead, a with its label b.
    """
    schema = pa.schema([("node", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("side", pa.int32())])

    def pairs(node: np.ndarray, ids: np.ndarray, label: np.ndarray, side: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch | None:
        left, right, score = [], [], []
        k = 1
        while k < len(node):
            i = np.flatnonzero(node[:-k] == node[k:])
            if not len(i):
                break
            i = i[(ids[i] != ids[i + k]) & (((label[i] != label[i + k]) & ((side[i] == 0) | (side[i] != side[i + k]))) if across else True)]
            for lo in range(0, len(i), 20000):
                j = i[lo : lo + 20000]
                est = _similarity(sketch[j], sketch[j + k], across)
                ok = est >= least
                left.append(j[ok])
                right.append(j[ok] + k)
                score.append(est[ok])
            k += 1
        if not left:
            return None
        i, j, est = np.concatenate(left), np.concatenate(right), np.concatenate(score)
        dense = np.zeros(0, np.int64)
        if across and len(i):
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(node))))
            has = np.zeros(len(node), bool)
            has[i] = has[j] = True
            many = np.bincount(of[i], minlength=len(first)) > DENSE * np.bincount(of[has], minlength=len(first))
            dense = np.flatnonzero(has & many[of])
            i, j = i[~many[of[i]]], j[~many[of[i]]]
        elif not across:
            keep = _forest(ids, i, j, np.argsort(-est, kind="stable"))
            i, j = i[keep], j[keep]
        x = np.unique(np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])], axis=1), axis=0)
        if not len(x) and not len(dense):
            return None
        n, m = len(x), len(dense)
        null = np.arange(n + m) < n
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([np.zeros(n, np.int64), node[dense]]), mask=null), pa.array(np.concatenate([x[:, 0], ids[dense]])), pa.array(np.concatenate([x[:, 1], label[dense]])),
            pa.array(np.concatenate([np.zeros(n, np.int32), side[dense].astype(np.int32)]), mask=null),
        ], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = N_FINE // 2 if across else N_HASHES
        for rows in _by_node(batches, ("id", "label", "side"), width):
            out = pairs(*rows)
            if out is not None:
                yield out

    return run


def _forest(label: np.ndarray, i: np.ndarray, j: np.ndarray, order: np.ndarray) -> list[int]:
    """Of the links (i, j) of rows, taken in an order, those that join what no link before joins; rows with the same label are joined."""
    up, keep = {}, []

    def find(x):
        while x in up:
            up[x] = x = up.get(up[x], up[x])
        return x

    for e in order.tolist():
        a, b = find(int(label[i[e]])), find(int(label[j[e]]))
        if a != b:
            up[max(a, b)] = min(a, b)
            keep.append(e)
    return keep


def _by_node(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], width: int) -> Iterator[list[np.ndarray]]:
    """The columns (node, the named ones, bytes of sketches) of whole nodes, some at a time, from rows in order of their node."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column("sketch")
        bits = np.frombuffer(col.buffers()[2], np.uint8)[col.offset * width : (col.offset + len(col)) * width].reshape(-1, width)
        rows = [batch.column(c).to_numpy() for c in ("node", *names)] + [bits]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        cut = int(np.searchsorted(rows[0], rows[0][-1], "left"))
        held = [x[cut:] for x in rows]
        if cut:
            yield [x[:cut] for x in rows]
    if held is not None:
        yield held


def _common(sets: list[np.ndarray], many: int = 32) -> np.ndarray:
    """Sizes of the intersections of all pairs of the sets: of elements of few sets by their pairs, of elements of more than ``many`` as a matrix product."""
    m, of = len(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(number, kind="stable")
    of, number = of[order], number[order]
    out = np.zeros((m, m), np.float32)
    some = (count > 1) & (count <= many)
    p, q = of[some[number]], number[some[number]]
    for k in range(1, many):
        same = np.flatnonzero(q[:-k] == q[k:]) if k < len(q) else q[:0]
        if not len(same):
            break
        at = np.bincount(p[same] * m + p[same + k], minlength=m * m).reshape(m, m)
        out += at + at.T
    some = count > many
    p, q = of[some[number]], (np.cumsum(some) - 1)[number[some[number]]]
    for lo in range(0, int(some.sum()), 4096):
        x, y = np.searchsorted(q, (lo, lo + 4096))
        has = np.zeros((m, 4096), np.float32)
        has[p[x:y], q[x:y] - lo] = 1
        out += has @ has.T
    return out


def _whole_links(n: int, threshold: float):
    """Of dense nodes, rows (node, id, label, side, text) in order of their node: a spanning forest of the links, on full shingle sets."""
    per_mille, schema = round(threshold * 1000), pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, label, side, sets = (list(x) for x in zip(*rows, strict=True))
        ids, label, side, size = np.array(ids), np.array(label), np.array(side), np.array([len(x) for x in sets])
        common = _common(sets)
        total = size[:, None] + size - common
        ok = (1000 * common.astype(np.int64) >= per_mille * total) & (label[:, None] != label) & ((side[:, None] == 0) | (side[:, None] != side))
        i, j = np.nonzero(np.triu(ok))
        keep = _forest(label, i, j, np.arange(len(i)))
        if keep:
            a, b = ids[i[keep]], ids[j[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for part, data, offs in grid.pieces(batches, "text"):
            sets = _shingle_sets(data, offs, n)
            for node, *row, own in zip(*(part.column(c).to_pylist() for c in ("node", "id", "label", "side")), sets, strict=True):
                if node != now:
                    if rows:
                        yield from links(rows)
                    now, rows = node, []
                rows.append((*row, own))
        if rows:
            yield from links(rows)

    return run


def _with_texts(docs: DataFrame, wants: DataFrame) -> DataFrame:
    """The rows of ``wants`` (id, ...) with the texts of the ids. The join is a shuffle at every size: the ids grow with the corpus, so they aren't for broadcast."""
    return docs.select(F.col("doc_id").alias("id"), "text").join(wants.hint("shuffle_hash"), "id")


def confirmed(pairs: DataFrame, docs: DataFrame, n: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have ``threshold`` or more in common.

    Pairs are grouped by the one of the two that has more pairs, the centre. The pairs of a centre go to one task with
    its text, or to several if they are many. So most texts move twice: to the pairs that need it, and with them.
    """
    per_mille = round(threshold * 1000)
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    degree = written(ends.groupBy("id").agg(F.count("*").alias("n")), "near-degrees")
    own = lambda c: degree.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"))
    first = F.col("n_a") >= F.col("n_b")
    star = pairs.join(own("a"), "a").join(own("b"), "b").select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("centre"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("id"), F.ceil(F.greatest("n_a", "n_b") / STAR).alias("stars"))
    star = written(star.select("centre", "id", F.xxhash64("centre", F.pmod(F.xxhash64("id"), F.col("stars"))).alias("star")), "near-stars")
    wants = star.select("star", "centre", F.col("centre").alias("id")).distinct().union(star.select("star", "centre", "id"))
    rows = _with_texts(docs, wants).select("star", "centre", "id", "text").repartition("star").sortWithinPartitions("star", "centre", F.col("id") != F.col("centre"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, centres = None, []
        for part, data, offs in grid.pieces(batches, "text"):
            out = []
            for star, c, i, own in zip(*(part.column(x).to_pylist() for x in ("star", "centre", "id")), _shingle_sets(data, offs, n), strict=True):
                if (star, c) != now:
                    now, centres = (star, c), []
                if i == c:
                    centres.append(own)  # more than one where rows repeat an id
                    continue
                for x in centres:
                    common = len(np.intersect1d(x, own, assume_unique=True))
                    if len(own) and 1000 * common >= per_mille * (len(x) + len(own) - common):
                        out.append((min(c, i), max(c, i)))
                        break
            if out:
                x = np.array(out, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], schema=schema)

    out = written(in_batches(rows, run, "a long, b long").distinct(), "near-links")
    discard(degree, star)
    free_shuffles(docs.sparkSession)
    return out


def _step(rows: DataFrame, n_hashes: int, branches: int) -> DataFrame:
    """Children: rows (node, id, label, size, mins) to (parent, node, id, label, size) of the next level; a node's positions are different."""
    first = F.pmod(F.xxhash64("node"), F.lit(n_hashes)).cast("int")
    stride = 2 * F.pmod(F.xxhash64("node", F.lit(1)), F.lit(n_hashes // 2)).cast("int") + 1
    pos = lambda k: F.pmod(first + k * stride, F.lit(n_hashes))
    child = lambda k: F.xxhash64("node", pos(k), F.get("mins", pos(k)))
    return rows.select(F.col("node").alias("parent"), F.explode(F.array(*[child(k) for k in range(branches)])).alias("node"), "id", "label", "size")


def _crossing(rows: DataFrame, *node: str) -> DataFrame:
    """Per node: pairs, how many pairs of its rows have different labels."""
    own = rows.groupBy(*node, "label").agg(F.count("*").alias("c"))
    return own.groupBy(*node).agg(((F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))) / 2).alias("pairs"))


def _nodes(rows: DataFrame, name: str) -> DataFrame:
    """Rows (node, id, label, size) of nodes with more than one label, with their number n, two members and shingles; written.

    The sums are written before the join, so that Spark can split the rows of a node that has many.
    """
    sums = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"), F.sum("size").alias("shingles"), F.min("label").alias("l0"), F.max("label").alias("l1"))
    sums = written(sums.filter("n > 1 and l0 <> l1").drop("l0", "l1"), f"{name}-sums")
    out = written(rows.join(sums, "node"), name)
    discard(sums)
    return out


def _blocks(nodes: DataFrame) -> DataFrame:
    """Rows (node, id, side) of the first level to compare: small nodes as they are, large ones in blocks with two fixed members each."""
    blocks = F.ceil(F.col("n") / LEAF).cast("int")
    block = F.when(F.col("n") <= LEAF, F.lit(0)).otherwise(F.pmod(F.xxhash64("id", "node"), blocks).cast("int"))
    own = nodes.select(F.xxhash64("node", block).alias("block"), "id", "low", "high", "n")
    fixed = own.filter(F.col("n") > LEAF).select("block", "low", "high").distinct().select("block", F.explode(F.array("low", "high")).alias("id"))
    return own.select("block", "id").union(fixed).select(F.col("block").alias("node"), "id", F.lit(0).alias("side"))


def _all_pairs(nodes: DataFrame) -> DataFrame:
    """Rows (node, id, side) to compare all pairs of nodes: one group of rows a node, or one a pair of its blocks."""
    blocks = F.greatest(F.ceil(F.col("n") / WHOLE), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    rows = nodes.withColumn("own", F.pmod(F.xxhash64("id", "node"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return rows.select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), "id", side.alias("side"))


def _candidates(blocks: DataFrame, sketches: DataFrame, labels: DataFrame | None, threshold: float) -> DataFrame:
    """Rows (node, a, b, side) as ``_compare`` returns them. What is 4 standard deviations of the estimate below the threshold is excluded."""
    chance, hashes = (1 / 16, N_FINE) if labels is not None else (1 / 256, N_HASHES)
    p = threshold + (1 - threshold) * chance
    least = threshold - 4 * (p * (1 - p) / hashes) ** 0.5 / (1 - chance)
    rows = blocks.join(sketches, "id")
    rows = rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id")) if labels is not None else rows.withColumn("label", F.col("id"))
    rows = rows.select("node", "id", "label", "side", "sketch").repartition("node").sortWithinPartitions("node")
    return in_batches(rows, _compare(least, labels is not None), "node long, a long, b long, side int")


def _labels(links: DataFrame) -> DataFrame:
    found = components(links)
    out = found.withColumnRenamed("component", "label")
    out._chatloom_path = found._chatloom_path
    return out


def near_duplicates(docs: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are as in ``WORD``, A-Z lower-cased. Linked are documents whose
    Jaccard similarity is ``threshold`` or more; component_id is the smallest
    doc_id that links reach, and the document with that id is kept. Null or
    empty texts have no shingle and are linked with nothing. A row with a null
    doc_id has a null component and is kept. Rows that repeat a doc_id are
    linked as far as their texts are alike, and all rows with the component's
    id are kept. An empty table gives no row. Other columns are ignored.
    """
    spark = docs.sparkSession
    base = with_columns_of(docs, {"doc_id": "long", "text": "string"}).withColumn("text", text_or_empty())
    sigs = written(signatures(base, n), "near-signatures")
    classes = sigs.filter("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("id")).select(F.col("d1").alias("c1"), F.col("d2").alias("c2"), "id")
    classes = written(classes, "near-representatives")
    reps = sigs.join(classes, (F.col("doc_id") == F.col("id")) & (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2"))).dropDuplicates(["doc_id", "d1", "d2"])
    reps = written(reps.select("id", F.col("n_shingles").alias("size"), "mins", "sketch", "fine"), "near-classes")
    thin = written(sigs.select("doc_id", "n_shingles", "d1", "d2"), "near-digests")
    discard(sigs)
    free_shuffles(spark)
    named = base.filter("doc_id is not null")

    at = roots(threshold)
    root = reps.select(F.posexplode(F.array(*[F.get("mins", F.lit(k)) for k in at])).alias("k", "min"), "id", "size")
    first = _nodes(root.select(F.xxhash64("k", "min").alias("node"), "id", F.col("id").alias("label"), "size"), "near-level-1")
    pairs = written(_candidates(_blocks(first), reps.select("id", "sketch"), None, threshold).select("a", "b").distinct(), "near-pairs")
    free_shuffles(spark)
    links = confirmed(pairs, named, n, threshold)
    labels = _labels(links)
    free_shuffles(spark)

    parts, level, frontier, used = [], 1, first.select("node", "id", "size"), [first]
    while True:
        nodes = _nodes(frontier.join(labels, "id", "left").select("node", "id", F.coalesce("label", "id").alias("label"), "size"), f"near-open-{level}")
        used.append(nodes)
        parts.append(_all_pairs(nodes.filter(F.col("n") <= WHOLE)))
        large = nodes.filter(F.col("n") > WHOLE)
        if not branches(threshold):
            parts.append(_all_pairs(large))
            break
        if not large.limit(1).count():
            break
        level += 1
        children = written(_step(large.select("node", "id", "label", "size").join(reps.select("id", "mins"), "id"), N_HASHES, branches(threshold)), f"near-children-{level}")
        below = _crossing(children, "parent", "node").groupBy(F.col("parent").alias("node")).agg(F.sum("pairs").alias("below"))
        down = written(_crossing(large, "node").join(below, "node").filter(F.col("below") <= SHRINK * F.col("pairs")).select("node"), f"near-down-{level}")
        used += [children, down]
        parts.append(_all_pairs(large.join(down, "node", "left_anti")))
        frontier = children.join(down.withColumnRenamed("node", "parent"), "parent", "left_semi").select("node", "id", "size")
    found = written(_candidates(reduce(DataFrame.union, parts), reps.select("id", F.col("fine").alias("sketch")), labels, threshold), "near-more")
    discard(*used, reps)
    free_shuffles(spark)
    more = written(found.filter("node is null").select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti"), "near-pairs")
    new = []
    if more.limit(1).count():
        new.append(confirmed(more, named, n, threshold))
    dense = found.filter("node is not null").select("node", F.col("a").alias("id"), F.col("b").alias("label"), "side")
    if dense.limit(1).count():
        rows = _with_texts(named, dense).repartition("node").sortWithinPartitions("node")
        new.append(written(in_batches(rows, _whole_links(n, threshold), "a long, b long").distinct(), "near-links"))
    new = [x for x in new if x.limit(1).count()]
    if new:
        old, labels = labels, _labels(reduce(DataFrame.union, [links, *new]))
        discard(old)
    discard(pairs, found, more, links, *new)
    free_shuffles(spark)

    own = thin.join(classes.withColumnRenamed("id", "rep"), (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left")
    out = own.join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left").withColumn("component_id", F.coalesce("label", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id, with its columns.

    Of rows that repeat a doc_id one stays: of those with the smallest text, any. Rows with a null doc_id all stay.
    Null and empty texts are like nothing and stay. An empty table gives no row.
    """
    gone = near_duplicates(docs, n, threshold).filter("not kept").select(F.col("doc_id").alias("__gone"))
    plain, key = numbered(docs), F.col(f"c{position(docs, 'doc_id')}").cast("long")
    left = plain.join(gone, key == F.col("__gone"), "left_anti")
    repeated = written(plain.filter(key.isNotNull()).groupBy(key.alias("__twice")).count().filter("count > 1").select("__twice"), "near-repeated")
    if not repeated.limit(1).count():
        discard(repeated)
        return left.toDF(*docs.columns)
    text = F.col(f"c{position(docs, 'text')}")
    one = left.join(repeated, key == F.col("__twice"), "left_semi").groupBy(key.alias("__key")).agg(F.min_by(F.struct(*plain.columns), F.coalesce(text, F.lit(""))).alias("__row")).select("__row.*")
    return left.join(repeated, key == F.col("__twice"), "left_anti").unionByName(one).toDF(*docs.columns)
