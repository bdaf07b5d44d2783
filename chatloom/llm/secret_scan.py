"""Secrets by rules and by a character convolutional network.

Three rules give the base findings.  Beside them every run of characters that a
key could have is a candidate: a convolutional network, trained in numpy on
labelled findings, reads the candidate within its surroundings, and candidates
above a threshold are findings too.  Scores are calibrated; the threshold is
the largest that keeps a set recall on labelled findings apart from the fit.

The labelled findings are made by a seeded generator from formats of keys and
from things that resemble them, so that no text of the corpus is needed.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import grid
from .common import in_batches, numbered, position, text_or_empty, with_columns_of

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "net")
HINTS = ("password", "passwd", "secret", "token", "api_key", "apikey")
#: A candidate is a run of these characters, LEAST or more; = only pads its end.
_KEY = np.zeros(256, bool)
_KEY[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_.-"]] = True
LEAST = 12
#: Windows that are scored at a time.
VIEWS = 2048

#: Characters before, within and after a candidate that the network reads at once.
BEFORE, INSIDE, AFTER = 24, 48, 8
WIDTH = BEFORE + INSIDE + AFTER
FILTERS, EMBED, SPAN, DENSE = 24, 10, 5, 16
CLASSES = 97

# Prefixes of public key formats, and words around keys and around other things.
PREFIXES = ("ghp_", "gho_", "xoxb-", "xoxp-", "sk_live_", "rk_live_", "AIza", "glpat-", "npm_", "SG.", "hf_", "ya29.", "dop_v1_", "")
KEY_WORDS = ("key", "access_key", "client_secret", "auth", "bearer", "credential", "pwd", "private_key", "token", "secret", "signature", "apikey")
OTHER_WORDS = ("version", "file", "page", "id", "order", "part", "see", "at", "from", "path", "commit", "isbn", "phone", "the", "of", "article")
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ONSETS, VOWELS, CODAS = ("b", "c", "d", "f", "g", "h", "l", "m", "n", "p", "r", "s", "t", "v", "w", "st", "tr", "ch", "pl", "sch"), ("a", "e", "i", "o", "u", "ei", "ou", "io", "au", "ie", "que", "ja"), ("n", "r", "s", "t", "l", "nd", "ng", "st", "ch", "pf", "tz", "cht")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, of the rules; leftmost and not overlapping within a kind."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    # A run is one match of the rule, so its length can be asked for in the pattern.
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return ordered(out)


def ordered(spans):
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def candidates(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of candidates and their text numbers: every run of LEAST or more key characters, with the = that pad its end."""
    starts, ends = grid.runs(_KEY[data], offs)
    last = offs[np.searchsorted(offs, starts, "right")]
    for _ in range(2):
        pad = (ends < last) & (data[np.minimum(ends, len(data) - 1)] == 61)
        ends = ends + pad
    long = ends - starts >= LEAST
    return starts[long], ends[long], np.searchsorted(offs, starts[long], "right") - 1


class Codes:
    """Character classes of many texts, a number a code point: 1 a space or control character, 96 a character that isn't ASCII."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.first = (data & 0xC0) != 0x80
        lead = data[self.first]
        self.codes = np.where(lead < 127, np.maximum(lead, 32) - 31, 96).astype(np.uint8)
        self._at = np.flatnonzero(self.first).astype(np.int64) if len(lead) != len(data) else None
        self.offs = self.points(offs)

    def points(self, at: np.ndarray) -> np.ndarray:
        """Byte offsets of characters' starts as code point numbers, counted through all texts."""
        return np.searchsorted(self._at, at) if self._at is not None else at

    def views(self, part: np.ndarray, start: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """A row a window: what is before the candidate [start, end), INSIDE of its characters from ``part``, what is after it. Class 0 is nothing;
        the text is [lo, hi)."""

        def read(at: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
            ok = (at >= least[:, None]) & (at < most[:, None])
            return np.where(ok, self.codes[np.clip(at, 0, max(len(self.codes) - 1, 0))], 0)

        before = read(start[:, None] + np.arange(-BEFORE, 0), lo, hi)
        inside = read(part[:, None] + np.arange(INSIDE), part, end)
        return np.concatenate([before, inside, read(end[:, None] + np.arange(AFTER), end, hi)], axis=1).astype(np.int64)


def views(text: str, start: int, end: int) -> np.ndarray:
    """The windows on one candidate of one text, half a window apart; a row each."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    c = Codes(raw, np.array([0, len(raw)]))
    part = np.arange(start, max(start + 1, end - INSIDE // 2), INSIDE // 2) if end - start > INSIDE else np.array([start])
    same = lambda x: np.full(len(part), x)
    return c.views(part, same(start), same(end), same(0), same(len(c.codes)))


class Network:
    """Embedding, convolution with rectifier, the largest value within and around the candidate, two dense layers."""

    def __init__(self, seed: int = 5):
        g = np.random.default_rng(seed)
        n = lambda *s, k: (g.standard_normal(s) * k).astype(np.float32)
        self.p = {"embed": n(CLASSES, EMBED, k=0.3), "conv": n(SPAN * EMBED, FILTERS, k=0.15), "conv_b": np.zeros(FILTERS, np.float32), "dense": n(3 * FILTERS, DENSE, k=0.15), "dense_b": np.zeros(DENSE, np.float32), "out": n(DENSE, k=0.3), "out_b": np.zeros(1, np.float32)}
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, x: np.ndarray):
        p, b = self.p, len(x)
        e = p["embed"][x]
        e = e * (x > 0)[:, :, None]
        pad = np.zeros((b, SPAN // 2, EMBED), np.float32)
        wide = np.concatenate([pad, e, pad], axis=1)
        cols = np.concatenate([wide[:, k : k + WIDTH] for k in range(SPAN)], axis=2)
        pre = cols @ p["conv"] + p["conv_b"]
        act = np.maximum(pre, 0)
        inner = act[:, BEFORE : BEFORE + INSIDE]
        filled = (x[:, BEFORE : BEFORE + INSIDE] > 0)[:, :, None]
        arg_in = np.where(filled, inner, -1).argmax(axis=1)
        outer = np.concatenate([act[:, :BEFORE], act[:, BEFORE + INSIDE :]], axis=1)
        arg_out = outer.argmax(axis=1)
        top_in = np.take_along_axis(inner, arg_in[:, None], axis=1)[:, 0]
        top_out = np.take_along_axis(outer, arg_out[:, None], axis=1)[:, 0]
        mean = (inner * filled).sum(axis=1) / np.maximum(filled.sum(axis=1), 1)
        pooled = np.concatenate([top_in, top_out, mean], axis=1)
        hidden = np.maximum(pooled @ p["dense"] + p["dense_b"], 0)
        return hidden @ p["out"] + p["out_b"][0], (cols, pre, arg_in, arg_out, filled, pooled, hidden)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i : i + 512])[0] for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * self.logits(x) + self.shift)))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, b = self.p, len(x)
        z, (cols, pre, arg_in, arg_out, filled, pooled, hidden) = self._forward(x)
        d = ((1 / (1 + np.exp(-z)) - y) / b).astype(np.float32)
        g = {"out": hidden.T @ d, "out_b": d.sum(keepdims=True)}
        dh = d[:, None] * p["out"] * (hidden > 0)
        g |= {"dense": pooled.T @ dh, "dense_b": dh.sum(axis=0)}
        dp = dh @ p["dense"].T
        da = np.zeros_like(pre)
        da[:, BEFORE : BEFORE + INSIDE] += filled * (dp[:, 2 * FILTERS :] / np.maximum(filled.sum(axis=1), 1))[:, None]
        rows, cells = np.arange(b)[:, None], np.arange(FILTERS)[None]
        da[rows, BEFORE + arg_in, cells] += dp[:, :FILTERS]
        da[rows, np.where(arg_out < BEFORE, arg_out, arg_out + INSIDE), cells] += dp[:, FILTERS : 2 * FILTERS]
        da *= pre > 0
        g |= {"conv": np.tensordot(cols, da, ([0, 1], [0, 1])), "conv_b": da.sum(axis=(0, 1))}
        dc = da @ p["conv"].T
        de = np.zeros((b, WIDTH + SPAN - 1, EMBED), np.float32)
        for k in range(SPAN):
            de[:, k : k + WIDTH] += dc[:, :, k * EMBED : (k + 1) * EMBED]
        de = de[:, SPAN // 2 : SPAN // 2 + WIDTH] * (x > 0)[:, :, None]
        g["embed"] = np.stack([np.bincount(x.ravel(), de[:, :, k].ravel(), CLASSES) for k in range(EMBED)], axis=1).astype(np.float32)
        return g


def labelled(n: int, seed: int = 11) -> tuple[list[tuple[str, int, int]], np.ndarray]:
    """Made findings (text, start, end) and labels: keys in many formats and surroundings, and other runs that look like them."""
    g = np.random.default_rng(seed)
    pick = lambda xs: xs[int(g.integers(len(xs)))]
    draw = lambda alphabet, k: "".join(alphabet[i] for i in g.integers(0, len(alphabet), k))
    letters = LETTERS + LETTERS.upper()
    mixed = letters + "0123456789"

    def word(lo: int = 2, hi: int = 9) -> str:
        """Syllables, as prose has them."""
        n, out = int(g.integers(lo, hi + 1)), ""
        while len(out) < n:
            out += pick(("", *ONSETS)) + pick(VOWELS) + pick(("", "", *CODAS))
        return out[:n]

    def prose() -> str:
        text = " ".join(word() for _ in range(int(g.integers(2, 7))))
        return text + pick((". ", ", ", " ", "\n"))

    def key() -> tuple[str, str]:
        size = int(g.integers(16, 45))
        body = pick((draw(mixed, size), draw(mixed + "+/", size + 8), draw("0123456789abcdef", size + 8), draw("0123456789ABCDEF", size), draw(letters, size), draw(letters, size), draw(mixed, size) + "_" + draw(mixed, size // 2), base64.b64encode(g.bytes(size)).decode()))
        body = pick(PREFIXES) + body
        left = pick((f'{pick(KEY_WORDS)} = "', f"{pick(KEY_WORDS)}: ", f"{pick(KEY_WORDS).upper()}=", f"export {pick(KEY_WORDS).upper()}=", "Authorization: Bearer ", f'"{pick(KEY_WORDS)}": "', ""))
        return left, body

    def other() -> tuple[str, str]:
        body = pick((
            f"{word(5, 12)}-{word(3, 9)}-{g.integers(1, 2100)}", f"{word()}/{word()}/{word(4, 9)}{g.integers(10)}.{pick(('html', 'txt', 'py', 'png', 'md'))}",
            f"{word(4, 8)}.{g.integers(1, 100)}.{word(4, 9)}.example.{pick(('com', 'org', 'net'))}", f"20{g.integers(10, 30)}-{g.integers(10, 13)}-{g.integers(10, 29)}T{g.integers(10, 24)}.{g.integers(10, 60)}",
            f"{word(3, 7)}{g.integers(1, 99)}_{word(3, 9)}_{word(3, 7)}", f"v{g.integers(1, 9)}.{g.integers(10, 99)}.{g.integers(10, 99)}-{word(4, 7)}.{g.integers(1, 9)}", f"{word(12, 20)}{g.integers(1, 99)}", word(12, 26), word(12, 16), word(12, 18).capitalize(), word(12, 26).upper(), word(12, 18).upper(), f"{word(12, 18)}.", f"{word(12, 18)}-{word(2, 9)}", draw("0123456789", int(g.integers(12, 20))), f"{word(3, 8)}.{word(3, 8)}.{word(2, 6)}", f"{word()}/{word()}/{word(3, 9)}",
            pick("-_.=/") * int(g.integers(12, 60)),
            f"{word(4, 9).capitalize()}{word(4, 9).capitalize()}{word(3, 8).capitalize()}{g.integers(10)}", f"{'=' * int(g.integers(4, 20))}{word(3, 8)}{g.integers(10)}{'-' * int(g.integers(4, 12))}",
            f"{g.integers(100, 999)}-{g.integers(100, 999)}-{g.integers(1000, 9999)}.{word(4, 9)}", f"{word(3, 8).upper()}-{g.integers(1000, 99999)}-{word(3, 8).upper()}", "-".join(word(2, 6) for _ in range(4)) + str(g.integers(10)),
            f"{word(2, 6) * 3}{g.integers(100)}",
        ))
        return pick((f"{pick(OTHER_WORDS)} ", f"{pick(OTHER_WORDS)}: ", "(", '"', "")), body

    out, y = [], np.arange(n) % 2
    for label in y:
        left, body = key() if label else other()
        body = body if len(body) >= LEAST else body + "x" * (LEAST - len(body))
        head = prose() + left
        out.append((head + body + pick(('"', " ", ".", "\n", ")", ",")) + prose(), len(head), len(head) + len(body)))
    return out, y.astype(np.float32)


@lru_cache(2)
def trained(n: int = 12_000, recall: float = 0.97, floor: float = 0.6, seed: int = 11, epochs: int = 8) -> Network:
    """Fit on three quarters of ``n`` labelled findings, calibrate on an eighth, and set the threshold to keep ``recall`` on the rest.
    The threshold is ``floor`` or more as long as that keeps the recall."""
    from .rnn import Adam
    from .toxicity import _platt

    found, y = labelled(n, seed)
    x = np.stack([views(*f)[0] for f in found])
    net, cut, rest = Network(), 3 * n // 4, 7 * n // 8
    adam, g = Adam(0.004), np.random.default_rng(seed)
    for _ in range(epochs):
        order = g.permutation(cut)
        for lo in range(0, cut, 64):
            k = order[lo : lo + 64]
            adam.step(net.p, net.gradients(x[k], y[k]))
    net.scale, net.shift = _platt(net.logits(x[cut:rest]), y[cut:rest], np.ones(rest - cut))
    q = np.sort(net.probability(x[rest:][y[rest:] > 0]))
    net.threshold = float(q[int((1 - recall) * len(q))])
    if net.threshold > floor:
        net.threshold = floor if (q >= floor).mean() >= recall else net.threshold
    return net


def scores(data: np.ndarray, offs: np.ndarray, net: Network) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every candidate its start and end in code points of its text, its text number, and the largest probability of its windows.
    Windows are made and scored VIEWS at a time, so memory doesn't grow with a candidate."""
    starts, ends, doc = candidates(data, offs)
    if not len(starts):
        return starts, ends, doc, np.zeros(0)
    c = Codes(data, offs)
    start, end = c.points(starts), c.points(ends)
    count = 1 + np.maximum(0, -(-(end - start - INSIDE) // (INSIDE // 2)))
    upto, best = np.cumsum(count), np.zeros(len(start))
    for lo in range(0, int(upto[-1]), VIEWS):
        k = np.arange(lo, min(lo + VIEWS, int(upto[-1])))
        of = np.searchsorted(upto, k, "right")
        part = start[of] + (k - (upto[of] - count[of])) * (INSIDE // 2)
        q = net.probability(c.views(part, start[of], end[of], c.offs[doc[of]], c.offs[doc[of] + 1]))
        np.maximum.at(best, of, q)
    return start - c.offs[doc], end - c.offs[doc], doc, best


def scan(data: np.ndarray, offs: np.ndarray, net: Network) -> list[tuple[list, list]]:
    """Of every text the base spans and the network's spans, in code points; a span of the network that lies within one of the rules is left out."""
    start, end, doc, q = scores(data, offs, net)
    base = [base_spans(data[offs[i] : offs[i + 1]].tobytes().decode("utf-8", "replace")) for i in range(len(offs) - 1)]
    added: list[list] = [[] for _ in base]
    held, at, upto = -1, [], []
    for i in np.flatnonzero(q >= net.threshold).tolist():
        d, a, b = int(doc[i]), int(start[i]), int(end[i])
        if d != held:
            held, at = d, [s for _, s, _ in base[d]]
            upto = list(accumulate((e for _, _, e in base[d]), max))
        k = bisect_right(at, a) - 1
        if k < 0 or upto[k] < b:
            added[d].append(("net", a, b))
    return list(zip(base, added, strict=True))


def findings(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, n_net, base_sha256, spans.

    Spans are kind:start:end in code points, the end exclusive, by start and then
    kind, comma-joined; base_sha256 is of the base spans so joined. An added span
    lies within no base span, but may overlap one. Null texts are empty ones and
    have none. An empty table gives no row; repeated rows are rows of their own.
    Other columns are ignored, whatever their names.
    """
    net = net or trained()
    base = with_columns_of(docs, {"doc_id": "long", "text": "string"}).withColumn("text", text_or_empty())
    names = [f"n_{k}" for k in KINDS]
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in names), ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in grid.pieces(batches, "text"):
            found = scan(data, offs, net)
            counts = [[sum(s[0] == k for s in (*b, *a)) for b, a in found] for k in KINDS]
            digest = [hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found]
            spans = [joined(ordered([*b, *a])) for b, a in found]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest, pa.string()), pa.array(spans, pa.string())], schema=schema)

    return in_batches(base, run, "doc_id long, " + "".join(f"{n} long, " for n in names) + "base_sha256 string, spans string")


def redacted(docs: DataFrame, net: Network | None = None, mask: str = "[SECRET]") -> DataFrame:
    """The rows of ``docs``, whole, with every finding of their text replaced by ``mask``; n_chars, if there is one, is the new length of
    a changed text. Null texts stay null, and repeated rows and rows with a null id are rows of their own."""
    net = net or trained()
    text, n_chars = position(docs, "text"), position(docs, "n_chars") if any(c.lower() == "n_chars" for c in docs.columns) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in grid.pieces(batches, f"c{text}"):
            old, changed = part.column(text), {}
            for i, (b, a) in enumerate(scan(data, offs, net)):
                if not b and not a:
                    continue
                t, out, at = old[i].as_py(), [], 0
                for s, e in sorted((s, e) for _, s, e in (*b, *a)):
                    if s >= at:
                        out += [t[at:s], mask]
                    at = max(at, e)
                changed[i] = "".join(out) + t[at:]
            if changed:
                part = _with_values(part, text, changed)
                if n_chars is not None:
                    part = _with_values(part, n_chars, {i: len(t) for i, t in changed.items()})
            yield part

    plain = numbered(docs)
    return in_batches(plain, run, plain.schema).toDF(*docs.columns)


def _with_values(part: pa.RecordBatch, at: int, values: dict[int, object]) -> pa.RecordBatch:
    """The batch with some values of a column replaced."""
    field, rows = part.schema.field(at), sorted(values)
    mask = np.zeros(part.num_rows, bool)
    mask[rows] = True
    return part.set_column(at, field, pc.replace_with_mask(part.column(at), pa.array(mask), pa.array([values[i] for i in rows], field.type)))
