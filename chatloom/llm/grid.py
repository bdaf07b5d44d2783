"""Texts of an Arrow column as numpy arrays: words, hashes, windows.

The functions work on the UTF-8 bytes of many texts at once.  The separators
of words are ASCII, so no code point is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)
#: Bytes that are hashed at once.
SPAN = 1 << 20


def _powers(n: int) -> np.ndarray:
    global _POWERS
    while len(_POWERS) < n:
        _POWERS = np.concatenate([_POWERS, _POWERS * (_POWERS[-1:] * _STEP)])
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def pieces(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows whose texts have ``max_bytes`` together (a longer text comes alone),
    with the bytes and the offsets of the texts. A null text is an empty one."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
        _, offs, data = col.buffers()
        offs = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(col):
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1)
            hi = min(hi, len(col), lo + 5000)
            yield batch.slice(lo, hi - lo), data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
            lo = hi


def runs(keep: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``keep`` that no text boundary cuts."""
    n = len(keep)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = keep[:-1]
    starts = np.flatnonzero(keep & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = keep[1:]
    ends = np.flatnonzero(keep & (~after | first[1:])) + 1
    return starts, ends


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words."""
    starts, ends = runs(~_SPACE[data], offs)
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges. Works on SPAN bytes at a time, whatever the ranges' lengths."""
    n, lens = len(starts), ends - starts
    out, cum = np.zeros(n, np.uint64), np.concatenate([[0], np.cumsum(lens)])
    powers, lo = _powers(SPAN), 0
    while lo < n:
        if lens[lo] > SPAN:
            # The polynomial of a long range, from those of its parts.
            total, scale = np.zeros(1, np.uint64), np.ones(1, np.uint64)
            for at in range(int(starts[lo]), int(ends[lo]), SPAN):
                part = _BYTE[data[at : min(at + SPAN, int(ends[lo]))]]
                total += (part * powers[: len(part)]).sum(dtype=np.uint64) * scale
                scale = scale * (powers[SPAN - 1 : SPAN] * _STEP)
            out[lo] = total[0]
            lo += 1
            continue
        hi = max(lo + 1, int(np.searchsorted(cum, cum[lo] + SPAN, "right")) - 1)
        first, size = cum[lo:hi] - cum[lo], lens[lo:hi]
        pos = np.arange(cum[hi] - cum[lo]) - np.repeat(first, size)
        value = _BYTE[data[pos + np.repeat(starts[lo:hi], size)]] * powers[pos]
        out[lo:hi] = np.add.reduceat(value, first)
        lo = hi
    return mix(out + lens.astype(np.uint64))


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z."""
    return _LOWER[data]


def shingles(h: np.ndarray, doc: np.ndarray, n_docs: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles and their text numbers, in text order; a text with
    fewer words has its whole sequence as one shingle, one without words has none."""
    per = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(per)])
    factors = [np.uint64((0x9E3779B97F4A7C15 * (2 * k + 3) ** 5 | 1) % 2**64) for k in range(n)]
    total = len(h)
    out, out_doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if total >= n:
        acc = np.zeros(total - n + 1, np.uint64)
        for k in range(n):
            acc += mix(h[k : total - n + 1 + k] + factors[k]) * factors[k]
        inside = doc[: total - n + 1] == doc[n - 1 :]
        out, out_doc = mix(acc[inside]), doc[: total - n + 1][inside]
    rest = np.flatnonzero((per > 0) & (per < n))
    if len(rest):
        extra = []
        for d in rest:
            acc = np.array([per[d]], np.uint64)
            for x in h[first[d] : first[d + 1]]:
                acc = mix(acc * _STEP + x)
            extra.append(acc[0])
        out, out_doc = np.concatenate([out, np.array(extra, np.uint64)]), np.concatenate([out_doc, rest])
        order = np.argsort(out_doc, kind="stable")
        out, out_doc = out[order], out_doc[order]
    return out, out_doc
