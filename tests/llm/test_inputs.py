"""Odd inputs for all operators: columns that differ in case alone, missing columns, a very long text; and the pipeline as a whole."""

import binascii
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chatloom.llm import common, decontaminate, language, licenses, lm, mixing, neardup, quality, secret_scan, toxicity, warc


def words(n, seed, of=400):
    g = random.Random(seed)
    return " ".join(f"w{g.randrange(of)}" for _ in range(n))


def operators(docs, labels, bench, pages):
    """Every operator with its rows, and whether it returns a row for each of its input's."""
    return {
        "near-duplicates": (lambda: neardup.near_duplicates(docs), True), "warc": (lambda: warc.archive_pages(pages), True), "mixing": (lambda: mixing.mix_sources(docs), True),
        "decontamination": (lambda: decontaminate.contaminated(docs, bench), False), "language": (lambda: language.languages(docs), True), "secrets": (lambda: secret_scan.findings(docs), True),
        "quality": (lambda: quality.quality(docs, labels), True), "licenses": (lambda: licenses.license_rows(docs), False), "lm": (lambda: lm.score(docs), True), "toxicity": (lambda: toxicity.toxicity(docs, labels), True),
    }


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, words(30, 4), "x")], "item_id long, text string, Text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2, "x") for i in range(40)], "doc_id long, quality int, toxic int, Toxic string")


def test_columns_that_differ_in_case(spark, labels, bench):
    text = [words(30 + i, 100 + i) if i % 5 else words(30, 4) for i in range(40)]
    docs = spark.createDataFrame([(i, f"no{i}", t, "other", "en", "s", "S", i) for i, t in enumerate(text)], "doc_id long, DOC_ID string, text string, TEXT string, lang string, source string, Source string, kept long")
    pages = spark.createDataFrame([(i, "x", "u", t, "y") for i, t in enumerate(text)], "page_id long, Page_ID string, url string, html string, HTML string")
    for name, (run, whole) in operators(docs, labels, bench, pages).items():
        rows = run().collect()
        assert len(rows) == 40 if whole else True, name
    assert decontaminate.contaminated(docs, bench).count() == 8
    sizes = {r["doc_id"]: r["size"] for r in mixing.mix_sources(docs).collect()}
    assert sizes == {i: len(t.split()) for i, t in enumerate(text)}
    names = docs.columns
    for kept in (toxicity.without_toxic(docs, labels), neardup.deduplicated(docs), decontaminate.without_contaminated(docs, bench), secret_scan.redacted(docs)):
        assert kept.columns == names and kept.count() <= 40
    assert neardup.deduplicated(docs).count() == 33 and decontaminate.without_contaminated(docs, bench).count() == 32


def test_missing_columns_are_errors(spark, labels, bench):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, texts string")
    pages = spark.createDataFrame([(1, "a b")], "page_id long, body string")
    for name, (run, _) in operators(docs, labels, bench, pages).items():
        with pytest.raises(ValueError, match="no column"):
            run().collect()
    for run in (toxicity.without_toxic, decontaminate.without_contaminated):
        with pytest.raises(ValueError, match="no column"):
            run(docs, labels if run is toxicity.without_toxic else bench).collect()
    for run in (neardup.deduplicated, secret_scan.redacted):
        with pytest.raises(ValueError, match="no column"):
            run(docs).collect()


def test_a_very_long_text(spark, bench, labels):
    """30 MB: prose with a benchmark item, a licence and a key deep inside, 8 MB of key characters in one run, and 200,000 line ends."""
    prose = "\n".join(words(2000, k, 5000) for k in range(1400))
    item = words(30, 4)
    run, key = "aZ9/" * 2_000_000, "ghp_" + "".join(random.Random(1).choices("abcdefghijkLMNOPQRST0123456789", k=36))
    text = prose + "\n" * 200_000 + f"Released under the MIT License.\n{item}\n" + run + f" key = {key} " + prose[: 30_000_000 - len(prose) - len(run)]
    docs = spark.createDataFrame([(1, text, "en", "a"), (2, words(60, 2), "en", "a"), (3, None, None, None)], "doc_id long, text string, lang string, source string").repartition(2)
    pages = spark.createDataFrame([(1, "u", text), (2, "u", "small")], "page_id long, url string, html string")
    n = len(text.split())
    got = {name: {r[0]: r for r in f().collect()} for name, (f, _) in operators(docs, labels, bench, pages).items()}
    assert got["mixing"][1]["size"] == got["quality"][1]["n_words"] == n and got["lm"][1]["n_tokens"] == n + 1
    assert got["decontamination"][1]["item_id"] == 1 and got["licenses"][1]["license"] == "MIT"
    assert got["warc"][1]["payload_bytes"] == len(text.encode()) and got["language"][1]["lang_pred"] == "en"
    # Shingles of five words; at places of the text that are equal they are too.
    assert 2_000_000 < got["near-duplicates"][1]["n_shingles"] <= n
    at = text.index(key)
    assert f"net:{at}:{at + len(key)}" in got["secrets"][1]["spans"].split(",")
    assert 0 <= got["toxicity"][1]["score"] <= 1


def test_no_local_folder_on_a_cluster():
    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(Session)


def test_language_rules(spark):
    """held_out and und as the contract has them, for every row."""
    rows = [(i, ["un deux", "", None, "12 !", "日本", "ß", "x"][i % 7], "fr" if i % 3 else None) for i in range(200)]
    got = {r["doc_id"]: r for r in language.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for i, t, _ in rows:
        assert got[i]["held_out"] == (binascii.crc32(str(i).encode()) % 4 == 2)
        assert got[i]["lang_pred"] == ("fr" if t and any(c.isalpha() for c in t) else "und") and 0 <= got[i]["score"] <= 1


def test_secret_base_rules_by_loops(spark):
    """Base spans by a search at every place, on texts made of pieces of the rules."""
    import hashlib

    g = random.Random(31)
    pieces = ["password", "Passwd", "SECRET", "token", "api_key", "ApiKey", '"', "'", " ", "  ", "\t", ":", "=", "abcdEFGH", "1234567890", "x-y/z+", "AKIA", "ABCDEFGHIJKLMN", "deadbeef", "cafe0123", "é", ".", "\n", "g"]
    texts = ["".join(g.choice(pieces) for _ in range(g.randrange(1, 40))) for _ in range(400)]
    keys = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")

    def assign(t, at):
        low = t.lower()
        for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if low[at : at + len(name)] == name and t[at : at + len(name)].isascii():
                k = at + len(name)
                # One quote may stand or not, before and after the sign; the first way that leads to a key counts.
                for k1 in ([k + 1] if t[k : k + 1] in ('"', "'") and t[k : k + 1] else []) + [k]:
                    k2 = k1
                    while t[k2 : k2 + 1] == " ":
                        k2 += 1
                    if t[k2 : k2 + 1] not in (":", "=") or not t[k2 : k2 + 1]:
                        continue
                    k2 += 1
                    while t[k2 : k2 + 1] == " ":
                        k2 += 1
                    k2 += t[k2 : k2 + 1] in ('"', "'") and bool(t[k2 : k2 + 1])
                    end = k2
                    while end < len(t) and t[end] in keys:
                        end += 1
                    if end > k2:
                        return end, end - k2
        return None

    def spans(t):
        out, at = [], 0
        while at < len(t):
            m = assign(t, at)
            if m:
                out += [("assign", at, m[0])] if m[1] >= 12 else []
                at = m[0]
            else:
                at += 1
        for kind, head, inner, least in (("access", "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 18), ("hex", "", set("0123456789abcdef"), 16)):
            at = 0
            while at < len(t):
                end = at + len(head) if t.startswith(head, at) else len(t) + 1
                first = end
                while end < len(t) and t[end] in inner:
                    end += 1
                if first < end <= len(t):
                    out += [(kind, at, end)] if end - at >= least else []
                    at = end
                else:
                    at += 1
        return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))

    got = {r["doc_id"]: r for r in secret_scan.findings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum(len(spans(t)) for t in texts) > 150
    for i, t in enumerate(texts):
        want = spans(t)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[0] == k for s in want) for k in ("assign", "access", "hex")]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(got[i]["spans"].split(","))


def test_keys_outside_the_rules_are_found():
    """Keys that no rule knows, letters alone among them, put into prose; and prose itself."""
    g, net = random.Random(7), secret_scan.trained()
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    kinds = [lambda: "ghp_" + "".join(g.choices(letters + "0123456789", k=36)), lambda: "".join(g.choices(letters, k=30)), lambda: "".join(g.choices(letters + "0123456789", k=32)), lambda: "sk_live_" + "".join(g.choices(letters, k=24))]
    prose = "the river runs under an old bridge where extraordinarily quiet fishermen wait for responsibilities to end, "
    texts, places = [], []
    for i in range(200):
        key, head = kinds[i % 4](), prose * g.randrange(1, 4) + g.choice(("key = ", "auth: ", "GH_PAT=", ""))
        texts.append(head + key + " and " + prose)
        places.append((len(head), len(head) + len(key)))
    found = secret_scan.scan(*toxicity._joined(texts), net)
    assert np.mean([("net", *p) in a for p, (_, a) in zip(places, found)]) >= 0.9
    assert np.mean([len(a) > 1 for _, a in found]) <= 0.05


def test_a_family_of_near_copies(spark):
    """600 texts that are 0.78 alike, linked with nothing, and 100 that are near copies of some: the components are those of a search through all pairs."""
    g = random.Random(3)
    base = [f"w{g.randrange(5000)}" for _ in range(200)]
    rows = []
    for k in range(700):
        w = list(base if k < 600 else rows[g.randrange(600)])
        for i in g.sample(range(200), 4):
            w[i] = f"z{k}_{i}"
        rows.append(w)
    sets = [frozenset(hash(tuple(w[k : k + 3])) for k in range(198)) for w in rows]
    up = list(range(700))

    def find(x):
        return x if up[x] == x else find(up[x])

    for i in range(700):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    got = neardup.near_duplicates(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string"), 3, 0.85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: find(i) for i in range(700)}


def test_dense_blocks_by_pairs():
    g = np.random.default_rng(5)
    sets = [np.unique(g.integers(0, 60 if i % 2 else 5000, g.integers(1, 80))).astype(np.uint64) for i in range(70)]
    common = neardup._common(sets, many=8)
    for i in range(70):
        for j in range(70):
            if i != j:
                assert common[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_the_whole_pipeline(spark):
    """run() is what the five stages give one after another, each on the written result of the one before."""
    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    docs, kept = spark.read.parquet(f"{d}/documents.parquet"), []
    first = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = common.written(stage(spark, docs, d), "test-stage")
        kept.append(docs.count())
        if name != "mixing":
            assert docs.columns == first, name
    assert kept == sorted(kept, reverse=True) and kept[-1] == kept[-2] > 100
    want = sorted(map(str, docs.collect()))
    assert sorted(map(str, corpus_pipeline.run(spark, d).collect())) == want
