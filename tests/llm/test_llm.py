"""The operators of the subpackage against brute force, and on odd tables."""

import base64
import binascii
import hashlib
import math
import random
import re
import textwrap
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chatloom.llm import decontaminate, grid, language, licenses, lm, mixing, neardup, quality, secret_scan, toxicity, warc
from chatloom.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size string, bin int"


def words(n, seed, of=400):
    g = random.Random(seed)
    return " ".join(f"w{g.randrange(of)}" for _ in range(n))


def odd_rows():
    a, b = words(60, 1), words(40, 2)
    texts = {1: a, 2: a, 3: a.replace("w", "W"), 4: None, 5: "", 6: "  \n ", 7: "one", 8: a + " tail", 9: words(3000, 3), 10: b, 11: "café Ünïcode ñandú " + b, 12: "a\tb\x0bc", 13: words(30, 5) + "\n" + words(30, 5)}
    rows = [(i, t, "en", "s" if i % 3 else None, None, True, "x", 1) for i, t in texts.items()]
    return [*rows, rows[0], (None, a, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, None), (8, 1, 1), (8, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_word_grid():
    texts = ["a bb\tccc", "", "  ", "é ü", "x" * 300, "last one"]
    data, offs = toxicity._joined(texts)
    s, e, d = grid.words(data, offs)
    got = [[data[a:b].tobytes().decode() for a, b, k in zip(s, e, d) if k == i] for i in range(len(texts))]
    assert got == [WORD.findall(t) for t in texts]
    h = grid.hashes(data, s, e)
    assert len(set(h.tolist())) == len({x for t in texts for x in WORD.findall(t)})


def jaccard_components(rows, n, per_mille):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    sets = {}
    for i, t in rows:
        w = WORD.findall(low(t))
        sets.setdefault(i, []).append(frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else []))
    up = {i: i for i in sets}

    def find(x):
        return x if up[x] == x else find(up[x])

    for i in sets:
        for j in sets:
            if i < j and any(x and y and 1000 * len(x & y) >= per_mille * len(x | y) for x in sets[i] for y in sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def test_near_duplicates(spark, odd, none):
    g = random.Random(8)
    rows = [(r[0], r[1]) for r in odd_rows() if r[0] is not None]
    base = words(120, 77).split()
    for k in range(70):  # a group of near copies larger than a small node
        w = list(base)
        for _ in range(k % 6):
            w[g.randrange(len(w))] = f"z{k}{g.random()}"
        rows.append((100 + k, " ".join(w)))
    d = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, label string")
    got = neardup.near_duplicates(d, 3, 0.85).collect()
    want = jaccard_components(rows, 3, 850)
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    null = neardup.near_duplicates(odd.filter("doc_id is null or doc_id = 4")).collect()
    assert {(r["doc_id"], r["n_shingles"] > 0, r["kept"]) for r in null} == {(None, True, True), (4, False, True)}
    assert neardup.near_duplicates(none).count() == 0
    assert neardup.deduplicated(odd).columns == odd.columns


def test_near_copies_within_a_large_template(spark, monkeypatch):
    """Texts alike by a template, but under the threshold, and a near copy of each: every pair is found, also by nodes that descend and by pairs of blocks."""
    for name, value in (("LEAF", 2), ("WHOLE", 16), ("BLOCK", 64)):
        monkeypatch.setattr(neardup, name, value, raising=False)
    g, shared, rows = random.Random(4), [f"t{i}" for i in range(84)], []
    for k in range(300):
        own = [f"o{k}x{i}" for i in range(16)]
        rows += [(2 * k, " ".join(shared + own)), (2 * k + 1, " ".join(g.sample(shared, 76) + own[:11] + [f"p{k}", f"q{k}"]))]
    out = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n=1, threshold=0.85).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == {i: i - i % 2 for i, _ in rows}


def test_near_duplicate_paths():
    for threshold in (0.3, 0.5, 0.8, 0.85, 0.95):
        at = neardup.roots(threshold)
        assert len(set(at)) == len(at) and neardup.missed(threshold, len(at)) < neardup.MISS
    with pytest.raises(ValueError):
        neardup.roots(0.05)


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(30)] + [(50, 51), (51, 51), (None, 3), (50, 51)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert got == {k: 0 for k in range(31)} | {50: 50, 51: 50}


def test_warc(spark):
    rows = [(1, "http://a b", "x" * 50), (2, None, "x" * 50), (3, "u", None), (4, "u", ""), (5, "u", "é\r\n\r\nWARC/1.1\r\n"), (None, "u", "x" * 50), (6, "u", "y" * 300_000)]
    pages = spark.createDataFrame([(*r, 9) for r in rows], "page_id long, url string, html string, record_type int")
    raw, listed = warc.write_archives(pages)
    folder, files = warc.normalise(raw, listed)
    got = {r["page_id"]: r for r in warc.read_archives(folder, files, with_payload=True).collect()}
    assert len(got) == len(rows)
    for i, _, html in rows:
        p = (html or "").encode()
        assert got[i]["payload_bytes"] == len(p) and got[i]["payload_digest"] == base64.b32encode(hashlib.sha1(p).digest()).decode()
        if got[i]["record_type"] == "response":
            assert bytes(got[i]["payload"] or b"") == p
    assert [(i, got[i]["record_type"], got[i]["refers_to"]) for i in (1, 2, 3, 4)] == [(1, "revisit", 2), (2, "response", None), (3, "revisit", 4), (4, "response", None)]
    assert got[None]["refers_to"] == 2
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_mixing(spark, odd, none):
    got = mixing.mix_sources(odd).collect()
    sizes = {}
    for r in odd_rows():
        sizes[r[3]] = sizes.get(r[3], 0) + len(WORD.findall(r[1] or ""))
    assert len(got) == len(odd_rows()) and {r["source"]: r["source_size"] for r in got} == sizes
    assert sum({r["source"]: r["target"] for r in got}.values()) == pytest.approx(sum(sizes.values()))
    assert all(r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in got)
    for s in sizes:
        taken = sum(r["taken"] for r in got if r["source"] == s)
        assert abs(taken - next(r["target"] for r in got if r["source"] == s)) <= max(r["size"] for r in got if r["source"] == s)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(odd.repartition(3)).collect()))
    assert mixing.mix_sources(none).count() == 0


def test_targets_stop_at_the_cap(spark):
    d = spark.createDataFrame([("a", 100), ("b", 1), ("c", 2), (None, 10)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(d).collect()}
    # Weights 1, 2, 3, 1: b and c stop at 3 and 6, null at 30; the rest goes to a.
    assert got == {"a": 74.0, "b": 3.0, "c": 6.0, None: 30.0}


def test_targets_of_several_sources_below_the_cap(spark):
    def shared(sizes):  # the contract's rounds, one after another
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        w, done = {s: k % 3 + 1 for k, s in enumerate(order)}, {}
        while rest := [s for s in order if s not in done]:
            part = Fraction(sum(sizes.values()) - sum(done.values()), sum(w[s] for s in rest))
            over = [s for s in rest if w[s] * part > 3 * sizes[s]]
            done |= {s: 3 * sizes[s] for s in over} if over else {s: w[s] * part for s in rest}
        return {s: float(t) for s, t in done.items()}

    g = random.Random(6)
    tables = [{"a": 100, "b": 100, "c": 100}, {f"s{k}": 1000 + k for k in range(20)}, {"a": 0, "b": 0}]
    tables += [{s: g.choice([0, 1, 7, 50, 900]) for s in [*"abcdefg"[: g.randrange(1, 8)], None, "\uffee", "\U0001f600"]} for _ in range(6)]
    for sizes in tables:
        got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
        assert got == shared(sizes)
    assert shared(tables[0]) == {"a": 50.0, "b": 100.0, "c": 150.0}


def test_decontamination(spark, odd, none):
    item = words(40, 2)
    bench = spark.createDataFrame([(1, item, 0), (2, "one", 0), (3, None, 0), (4, "", 0), (5, words(30, 99), 0), (6, " ".join(words(3000, 3).split()[500:530]), 0)], "item_id long, text string, n int")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(odd, bench).collect()}
    assert got == {(10, 1), (11, 1), (7, 2), (9, 6)}
    left = decontaminate.without_contaminated(odd, bench)
    assert left.columns == odd.columns and left.count() == len(odd_rows()) - 4
    assert decontaminate.contaminated(none, bench).count() == 0 and decontaminate.contaminated(odd, bench.limit(0)).count() == 0


def test_licenses(spark, none):
    bsd = ". ".join(licenses.SENTENCES[k] for k in ("bsd-0", "bsd-1", "bsd-2", "bsd-3"))
    rows = [(1, f"Code. {bsd}. End"), (2, "x\nReleased under the MIT License.\nReleased### under the mit LICENSE.!! more"), (3, None), (4, "license"), (5, ". ".join(licenses.SENTENCES[k] for k in ("bsd-1", "bsd-0", "bsd-2")))]
    got = {(r["doc_id"], r["license"], r["matches"]) for r in licenses.license_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "BSD-3-Clause", 1), (2, "MIT", 2)}
    anchors = licenses.anchors_of(licenses.SENTENCES)
    assert len(anchors) < 12 and all(re.search("|".join(anchors), s.lower()) for s in licenses.SENTENCES.values())
    assert licenses.license_rows(none).count() == 0


def test_every_license_rule_fires_on_its_own_text(spark):
    rules = list(enumerate(licenses.RULES))
    rows = [(i, "Code.\n" + ".\n".join(licenses.SENTENCES[k] for k in ids) + ".\nEnd") for i, (_, ids) in rules]
    got = {(r["doc_id"], r["license"], r["rule"], r["matches"]) for r in licenses.license_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(i, name, " ".join(ids), 1) for i, (name, ids) in rules}


def test_wrapped_licenses(spark):
    """Every rule on its own text, hard-wrapped behind comment marks."""
    rules, rows = list(enumerate(licenses.RULES)), []
    for mark in ("", "# ", " * ", "// "):
        for i, (_, ids) in rules:
            text = ". ".join(licenses.SENTENCES[k] for k in ids) + "."
            rows.append((len(rows), "Code.\n" + "\n".join(mark + x for x in textwrap.wrap(text, 40)) + "\nEnd"))
    got = {(r["doc_id"], r["license"], r["rule"], r["matches"]) for r in licenses.license_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(i + len(rules) * m, name, " ".join(ids), 1) for m in range(4) for i, (name, ids) in rules}


def test_language(spark, odd, none):
    lex = {"en": "the and of with that this".split(), "de": "der und von mit dass dieser".split()}
    g = random.Random(3)
    rows = [(k, " ".join(g.choice(lex[x]) for _ in range(30)), x) for k in range(80) for x in (("en", "de")[k % 2],)]
    rows += [(900, None, "en"), (901, "123 !!", "en"), (902, " ".join(lex["de"] * 2 + lex["en"] * 9), None)]
    got = {r["doc_id"]: r for r in language.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[k]["lang_pred"] == x for k, _, x in rows[:80])
    assert (got[900]["lang_pred"], got[901]["lang_pred"], got[900]["score"]) == ("und", "und", 0)
    assert got[902]["lang_pred"] == "en" and 0.6 < got[902]["score"] < 0.95
    assert language.languages(none).count() == 0 and language.languages(odd).count() == len(odd_rows())


def test_secrets(spark, odd, none):
    hexes, key = "deadbeef" * 3, "AKIA" + "ABCDEFGH12345678"
    text = f'é password = "hunter2hunter2" x{hexes}y {key} secret: token: abcdefghijklmnop 0123456789abcdef token=short'
    d = spark.createDataFrame([(1, text), (2, None), (3, "clean prose only")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in secret_scan.findings(d).collect()}
    assert (got[1]["n_assign"], got[1]["n_access"], got[1]["n_hex"]) == (1, 1, 2)
    base = secret_scan.base_spans(text)
    assert got[1]["base_sha256"] == hashlib.sha256(secret_scan.joined(base).encode()).hexdigest()
    assert text[base[0][1] : base[0][2]] == 'password = "hunter2hunter2'
    assert got[2]["base_sha256"] == got[3]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redacted(d).collect()}
    assert hexes not in clean[1] and key not in clean[1] and clean[3] == "clean prose only" and clean[2] is None
    assert secret_scan.findings(none).count() == 0 and secret_scan.redacted(odd).count() == len(odd_rows())


def test_secret_network():
    net = secret_scan.trained()
    found, y = secret_scan.labelled(600, 1234)
    q = net.probability(np.stack([secret_scan.views(*f)[0] for f in found]))
    assert (q[y > 0] >= net.threshold).mean() > 0.95 and (q[y == 0] >= net.threshold).mean() < 0.03


def quality_by_loops(text):
    """The base columns by plain counting."""
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered |= set(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def test_quality(spark, odd, labels, none):
    got = quality.quality(odd, labels).collect()
    assert len(got) == len(odd_rows())
    assert next(r for r in got if r["doc_id"] == 13)["n_dup_lines"] == 1
    assert quality.quality(none, labels).count() == 0 and quality.quality(odd, labels.limit(0)).count() == len(odd_rows())


def test_quality_against_loops(spark):
    p = words(12, 9)
    texts = [r[1] for r in odd_rows()] + [p + " " + p, "\n".join([p] * 4), "a # b * c $%&|<>\n\n \na # b * c $%&|<>", " ".join("x" for _ in range(40)), words(50, 1) + " " + words(9, 7) + " " + words(90, 3) + " " + words(9, 7), "\r\n".join(["é ñ", "é ñ", ""])]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lab = d.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    got = quality.quality(d, lab).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r["doc_id"]: tuple(r[n] for n in names) for r in got} == {i: quality_by_loops(t) for i, t in enumerate(texts)}
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_quality_threshold_is_of_all_trusted_texts(spark):
    scored = spark.createDataFrame([(i, 30, i / 1000) for i in range(1000)], "doc_id long, n_words long, ratio double")
    trusted = spark.createDataFrame([(i,) for i in range(500, 1000)], "doc_id long")
    assert quality.threshold_of(scored, trusted, 0.98, 0.0) == pytest.approx(0.51, abs=0.01)
    assert quality.threshold_of(scored, trusted.limit(0)) == -np.inf


def crc_mod(i, n):
    return binascii.crc32(str(i).encode()) % n


def lm_tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


def lm_by_loops(rows, order, weights):
    """n_tokens, n_known, train_tokens, base_score and score by plain counting, with given weights by bucket."""
    counts, contexts = [Counter() for _ in range(order)], [Counter() for _ in range(order)]
    grams = lambda t, i, k: tuple(["<s>"] * max(0, k - 1 - i) + t[max(0, i - k + 1) : i + 1])
    texts = {i: lm_tokens(t) for i, t in rows}
    for i, t in texts.items():
        if crc_mod(i, 7) != 2:
            for j in range(len(t)):
                for k in range(1, order + 1):
                    counts[k - 1][grams(t, j, k)] += 1
                    contexts[k - 1][grams(t, j, k)[:-1]] += 1
    total, known = sum(counts[0].values()), len(counts[0])
    out = {}
    for i, t in texts.items():
        base = sum(math.log10((counts[0][(w,)] + 1) / (total + known + 1)) for w in t)
        score = 0.0
        for j in range(len(t)):
            f, bucket = [counts[0][(t[j],)] / total], 0
            for k in range(2, order + 1):
                g = grams(t, j, k)
                # What stands before a first word has been seen at every text's start; before another, as often as it was a context or an end.
                c = contexts[k - 1][g[:-1]] if j == 0 else counts[k - 2][g[:-1]]
                f.append(min(counts[k - 1][g] / c, 1.0) if c else 0.0)
                if c:
                    bucket = 1 + (k - 2) * lm.WIDTH + min(int(math.log2(c)), lm.WIDTH - 1)
            w = weights[bucket]
            score += math.log10(w[0] / (known + 1) + sum(a * b for a, b in zip(w[1:], f)))
        out[i] = (len(t), sum((w,) in counts[0] for w in t), total, base, score)
    return out


@pytest.mark.parametrize("bits, cell_keys, block_bytes", [(8, 1_500_000, 8 << 20), (2, 300, 3000)])
def test_language_model_against_loops(spark, monkeypatch, bits, cell_keys, block_bytes):
    """Also with so small cells that there are several levels of groups."""
    order, g = 3, np.random.default_rng(1)
    weights = g.dirichlet(np.ones(order + 1), 1 + lm.WIDTH * (order - 1))
    monkeypatch.setattr(lm, "learned", lambda *a, **k: weights)
    rows = [(i, words(3 + i % 40, i, 60)) for i in range(120)] + [(500, None), (501, ""), (502, "W1 w1 zz " + words(50, 3, 60)), (503, words(300, 503, 60))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = lm_by_loops(rows, order, weights)
    got = lm.score(d, order, bits=bits, cell_keys=cell_keys, block_bytes=block_bytes).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (n, known, total, crc_mod(r["doc_id"], 7) == 2)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score)


def test_language_model(spark, odd, none):
    got = {(r["doc_id"], r["n_tokens"]): r for r in lm.score(odd).collect()}
    for r in odd_rows():
        x = got[r[0], len(WORD.findall(r[1] or "")) + 1]
        assert x["score"] < 0 and x["n_known"] <= x["n_tokens"]
    # Texts that weren't learned from: what is like the others scores higher than what isn't.
    held = [i for i in range(1000, 1100) if crc_mod(i, 7) == 2]
    small = spark.createDataFrame([(k, "a b" if k % 2 else "b a a") for k in range(90)] + [(held[0], "a b"), (held[1], "b b"), (held[2], "q b")], "doc_id long, text string")
    s = {r["doc_id"]: r["score"] for r in lm.score(small).collect()}
    assert s[held[0]] > s[held[1]] > s[held[2]]
    assert lm.score(none).count() == 0


def test_language_model_weights(spark, monkeypatch):
    """Weights sum to 1, and orders whose context isn't known have none."""
    kept = []
    learned = lm.learned
    monkeypatch.setattr(lm, "learned", lambda *a, **k: kept.append(learned(*a, **k)) or kept[-1])
    lm.score(spark.createDataFrame([(i, words(30, i, 80)) for i in range(80)], "doc_id long, text string"), 3)
    (w,) = kept
    assert w.sum(axis=1) == pytest.approx(1) and (w >= 0).all()
    assert (w[0, 2:] == 0).all() and (w[1 : 1 + lm.WIDTH, 3] == 0).all() and (w[1 + lm.WIDTH :, 3] > 0).all()


def test_toxicity(spark, odd, labels, none):
    g = random.Random(5)
    rows = [(k, " ".join((["vile"] if k % 2 and i in (3, 9) else [f"w{g.randrange(90)}"])[0] for i in range(40)), k % 2) for k in range(240)]
    d = spark.createDataFrame(rows, "doc_id long, text string, x int")
    lab = d.select("doc_id", F.col("x").alias("toxic"))
    got = toxicity.toxicity(d, lab).collect()
    held = [r for r in got if r["held_out"]]
    assert held and np.mean([r["predicted"] == rows[r["doc_id"]][2] for r in held]) > 0.9
    r = {x["doc_id"]: x["score"] for x in toxicity.toxicity(odd, labels).collect()}
    assert r[4] == r[5] == 0 and all(0 <= v <= 1 for v in r.values())
    assert toxicity.toxicity(none, labels).count() == 0
    assert toxicity.without_toxic(odd, labels).columns == odd.columns


def test_pipeline(spark):
    import os

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, d)
        assert sorted(out.columns) == sorted(docs.columns), name
    assert {"doc_id", "size", "taken"} <= set(corpus_pipeline.STAGES[-1][1](spark, docs, d).columns)
