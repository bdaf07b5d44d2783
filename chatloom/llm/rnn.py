"""A bidirectional gated recurrent network with attention pooling, in numpy.

A step's input is a word: its embedding, if the vocabulary has it, beside the
scaled sum of the embeddings of its character 3- and 5-grams.
"""

from __future__ import annotations

import numpy as np

from . import grid

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of runs of letters and figures."""
    starts, ends = grid.runs(_WORD[data], offs)
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def grams_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' 3- and 5-grams with marks at either end, flat, and where each word's begin."""
    lens = ends - starts
    first = np.concatenate([[0], np.cumsum(lens)])
    pos = np.arange(first[-1]) - np.repeat(first[:-1], lens)
    size = np.repeat(lens, lens)
    at = pos + np.repeat(starts, lens)

    def near(k: int) -> np.ndarray:
        inside = (pos + k >= 0) & (pos + k < size)
        return np.where(inside, data[np.clip(at + k, 0, len(data) - 1)], 1 if k < 0 else 2).astype(np.uint64)

    three = (near(-1) << np.uint64(16)) | (near(0) << np.uint64(8)) | near(1)
    five = (near(-2) << np.uint64(32)) | (near(2) << np.uint64(24)) | three | np.uint64(1 << 40)
    both = np.stack([grid.mix(three), grid.mix(five)], axis=1).ravel()
    return (both % np.uint64(buckets)).astype(np.int32), 2 * first[:-1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters in ``p``; ``vocabulary`` holds sorted word hashes, row 0 of the word table is for other words."""

    def __init__(self, vocabulary: np.ndarray, hidden: int = 8, width: int = 8, buckets: int = 16384, seed: int = 3):
        g = np.random.default_rng(seed)
        n = lambda *s, k=0.3: (g.standard_normal(s) * k).astype(np.float32)
        self.vocabulary, self.hidden, self.buckets = vocabulary, hidden, buckets
        h = hidden
        self.p = {"words": np.zeros((len(vocabulary) + 1, width), np.float32), "chars": n(buckets, width, k=0.1), "att": n(2 * h, h), "att_v": n(h), "out": n(2 * h), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"in_{d}": n(2 * width, 3 * h), f"in_bias_{d}": np.zeros(3 * h, np.float32), f"rec_{d}": n(h, 3 * h)}

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of the word table."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def inputs(self, rows: np.ndarray, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        count = np.diff(np.append(first, len(grams)))[:, None]
        return np.concatenate([self.p["words"][rows], np.add.reduceat(self.p["chars"][grams], first) / np.sqrt(count).astype(np.float32)], axis=1)

    def projected(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What the words add to the gates, a row a word and a last one for padding."""
        return {d: np.concatenate([x @ self.p[f"in_{d}"] + self.p[f"in_bias_{d}"], np.zeros((1, 3 * self.hidden), np.float32)]) for d in "fb"}

    def logits(self, gates: dict[str, np.ndarray], ids: np.ndarray, mask: np.ndarray | None = None, keep: dict | None = None) -> np.ndarray:
        """A logit a window; ids has the words of a window in a row, mask what of it isn't padding."""
        p, h, (b, t) = self.p, self.hidden, ids.shape
        states = np.empty((t, b, 2 * h), np.float32)
        for d, steps in (("f", range(t)), ("b", range(t - 1, -1, -1))):
            rec, table, now = p[f"rec_{d}"], gates[d], np.zeros((b, h), np.float32)
            for s in steps:
                x, u = table[ids[:, s]], now @ rec
                zr = 1 / (1 + np.exp(-(x[:, : 2 * h] + u[:, : 2 * h])))
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
                after = new + z * (now - new)
                if mask is not None:
                    after = np.where(mask[:, s, None], after, now)
                if keep is not None:
                    keep[d, s] = (now, z, r, new, u[:, 2 * h :])
                now = after
                if d == "f":
                    states[s, :, :h] = now
                else:
                    states[s, :, h:] = now
        a = np.tanh(states @ p["att"])
        e = a @ p["att_v"]
        if mask is not None:
            e = np.where(mask.T, e, -1e9)
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        c = (w[:, :, None] * states).sum(axis=0)
        if keep is not None:
            keep |= {"states": states, "a": a, "w": w, "c": c}
        return c @ p["out"] + p["bias"][0]

    def gradients(self, ids: np.ndarray, mask: np.ndarray, x: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Loss, gradients of the dense parameters, and the gradient of the inputs x."""
        p, h, keep = self.p, self.hidden, {}
        gates = self.projected(x)
        prob = _sigmoid(self.logits(gates, ids, mask, keep))
        loss = float(-(weight * np.where(target > 0, np.log(prob + 1e-7), np.log(1 - prob + 1e-7))).sum() / weight.sum())
        d_logit = ((prob - target) * weight / weight.sum()).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("words", "chars")}
        g["out"], g["bias"] = keep["c"].T @ d_logit, d_logit.sum(keepdims=True)
        dc = d_logit[:, None] * p["out"]
        dw = (keep["states"] * dc).sum(axis=2)
        de = keep["w"] * (dw - (keep["w"] * dw).sum(axis=0))
        g["att_v"] = np.einsum("tba,tb->a", keep["a"], de)
        da = de[:, :, None] * p["att_v"] * (1 - keep["a"] ** 2)
        g["att"] = np.einsum("tbs,tba->sa", keep["states"], da)
        ds = keep["w"][:, :, None] * dc + da @ p["att"].T
        dx = np.zeros_like(x)
        t = ids.shape[1]
        flat = ids.T.ravel()
        order = np.argsort(flat, kind="stable")
        words, cuts = np.unique(flat[order], return_index=True)
        for d, steps in (("f", range(t - 1, -1, -1)), ("b", range(t))):
            rec, carry, into = p[f"rec_{d}"], np.zeros((len(ids), h), np.float32), np.empty((t, len(ids), 3 * h), np.float32)
            for s in steps:
                before, z, r, new, u = keep[d, s]
                full = (ds[s, :, :h] if d == "f" else ds[s, :, h:]) + carry
                on = mask[:, s, None]
                dh = np.where(on, full, 0)
                dn = dh * (1 - z) * (1 - new**2)
                dz = dh * (before - new) * z * (1 - z)
                dr = dn * u * r * (1 - r)
                du = np.concatenate([dz, dr, dn * r], axis=1)
                g[f"rec_{d}"] += before.T @ du
                carry = np.where(on, dh * z, full) + du @ rec.T
                into[s] = np.concatenate([dz, dr, dn], axis=1)
            table = np.zeros((len(x) + 1, 3 * h), np.float32)
            table[words] = np.add.reduceat(into.reshape(-1, 3 * h)[order], cuts)
            g[f"in_bias_{d}"] = table[:-1].sum(axis=0)
            g[f"in_{d}"] = x.T @ table[:-1]
            dx += table[:-1] @ p[f"in_{d}"].T
        return loss, g, dx


class Adam:
    """With decoupled decay of the embeddings."""

    def __init__(self, rate: float, decay: float = 0.02):
        self.rate, self.decay, self.m, self.v, self.t = rate, decay, {}, {}, 0

    def step(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, x in g.items():
            m = self.m[k] = 0.9 * self.m.get(k, np.zeros_like(x)) + 0.1 * x
            v = self.v[k] = 0.999 * self.v.get(k, np.zeros_like(x)) + 0.001 * x**2
            if k in ("words", "chars"):
                p[k] *= np.float32(1 - self.rate * self.decay)
            p[k] -= (self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)


def fit(net: Network, ids: np.ndarray, mask: np.ndarray, rows: np.ndarray, grams: np.ndarray, first: np.ndarray, target: np.ndarray, weight: np.ndarray, adam: Adam, batch: int = 128, seed: int = 0) -> float:
    """One pass over the windows. rows, grams and first describe the words that ids names (len(rows) is padding)."""
    order, total = np.random.default_rng(seed).permutation(len(ids)), 0.0
    ends = np.append(first[1:], len(grams))
    for lo in range(0, len(ids), batch):
        pick = order[lo : lo + batch]
        used, local = np.unique(ids[pick], return_inverse=True)
        local, pad = local.reshape(len(pick), -1), used[-1] == len(rows)
        used = used[:-1] if pad else used
        lens = ends[used] - first[used]
        at = np.concatenate([[0], np.cumsum(lens)])
        flat = grams[np.arange(at[-1]) - np.repeat(at[:-1], lens) + np.repeat(first[used], lens)]
        x = net.inputs(rows[used], flat, at[:-1])
        loss, g, dx = net.gradients(local, mask[pick], x, target[pick], weight[pick])
        width = dx.shape[1] // 2
        g["words"], g["chars"] = np.zeros_like(net.p["words"]), np.zeros_like(net.p["chars"])
        np.add.at(g["words"], rows[used], dx[:, :width])
        g["words"][0] = 0
        each = np.repeat(dx[:, width:] / np.sqrt(lens)[:, None], lens, axis=0)
        for k in range(width):
            g["chars"][:, k] = np.bincount(flat, each[:, k], len(g["chars"]))
        adam.step(net.p, g)
        total += loss * len(pick)
    return total / max(1, len(ids))


def windows(doc: np.ndarray, n_docs: int, length: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, sizes and text numbers of all windows over the words: every ``stride``
    words, and one that ends with the text; a text under ``length`` words is one window."""
    per = np.bincount(doc, minlength=n_docs)
    begin = np.concatenate([[0], np.cumsum(per)[:-1]]) if n_docs else np.zeros(0, np.int64)
    count = np.where(per > length, -(-(per - length) // stride) + 1, (per > 0).astype(np.int64))
    of = np.repeat(np.arange(n_docs), count)
    k = np.arange(len(of)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]) if n_docs else count, count)
    start = np.minimum(k * stride, np.maximum(per[of] - length, 0)) + begin[of]
    return start, np.minimum(per[of], length), of


def window_ids(word: np.ndarray, start: np.ndarray, size: np.ndarray, length: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(length)
    mask = at < size[:, None]
    return np.where(mask, word[np.minimum(start[:, None] + at, len(word) - 1)], pad), mask


def score_texts(net: Network, data: np.ndarray, offs: np.ndarray, length: int, stride: int, batch: int = 4096) -> np.ndarray:
    """The largest window logit of every text; -inf without words."""
    data = grid.lower(data)
    starts, ends, doc = tokens(data, offs)
    out = np.full(len(offs) - 1, -np.inf)
    if not len(starts):
        return out
    h, at, word = np.unique(grid.hashes(data, starts, ends), return_index=True, return_inverse=True)
    grams, first = grams_of(data, starts[at], ends[at], net.buckets)
    gates = net.projected(net.inputs(net.rows(h), grams, first))
    start, size, of = windows(doc, len(out), length, stride)
    for full in (True, False):
        sel = np.flatnonzero((size == length) == full)
        for lo in range(0, len(sel), batch):
            k = sel[lo : lo + batch]
            ids, mask = window_ids(word, start[k], size[k], length, len(h))
            np.maximum.at(out, of[k], net.logits(gates, ids, None if full else mask))
    return out
