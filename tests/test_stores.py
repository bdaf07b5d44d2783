"""Small documents: runs, ratings, verdicts, annotations, dumps, probes, tokenizers; readers of lines; the state of a workspace."""

import json

import pytest
from pyspark.sql import functions as F

from chatloom.functions import ids, judging
from chatloom.operators import balance, dedup, elo, merge, probe, status, tokens
from chatloom.plans import more
from chatloom.sources import records, stores


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text if isinstance(text, str) else json.dumps(text))
    return str(path)


def test_runs(spark, tmp_path):
    path = stores.save_run(spark, {"run_id": "r1", "scores": {"a.x": 1, "deep": {"y": 0.5, "z": "no", "t": True}, "s": [1]}}, str(tmp_path))
    assert stores.resolve_runs(spark, ["r1", path], str(tmp_path)) == [path, path]
    assert stores.load_run(spark, path)["run_id"] == "r1"
    with pytest.raises(FileNotFoundError):
        stores.resolve_runs(spark, ["r2"], str(tmp_path))
    with pytest.raises(ValueError):
        stores.save_run(spark, {"scores": {}}, str(tmp_path))
    assert records.read_runs(spark, path).head()["scores"] == {"a.x": 1.0, "deep.y": 0.5, "deep.t": 1.0}


def test_ratings_verdicts_annotations(spark, tmp_path):
    path = str(tmp_path / "deep" / "elo.json")
    assert stores.read_ratings(spark, path).count() == 0
    rows = spark.createDataFrame([("g", "a", 1510.0, 0.75, "t"), ("g", "b", 1490.0, None, "t"), ("h", "a", 1500.0, 0.5, "t")], stores.RATING)
    stores.write_ratings(spark, rows, path)
    assert sorted(map(tuple, stores.read_ratings(spark, path).collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert json.loads(open(path).read())["groups"]["g"]["ranked_run_ids"] == ["a", "b"]
    stores.write_ratings(spark, rows.filter("gkey = 'h'"), path)
    assert stores.read_ratings(spark, path).count() == 1 and [p.name for p in (tmp_path / "deep").iterdir() if p.suffix == ".json"] == ["elo.json"]
    put(tmp_path / "broken.json", "{nope")
    assert stores.read_ratings(spark, str(tmp_path / "broken.json")).count() == 0

    old = put(tmp_path / "votes.json", {"comparisons": {"c": {"verdicts": {"s1": {"v": "rejected"}}, "votes": {"s1": "v", "s2": "w"}}, "d": 5}})
    v = stores.read_verdicts(spark, old)
    assert {(r["sample_key"], r["variant_id"], r["verdict"]) for r in v.collect()} == {("s1", "v", "rejected"), ("s2", "w", "accepted")}
    stores.write_verdicts(spark, merge.apply_verdict(v, spark.createDataFrame([("c", "s2", "w", "neutral"), ("c", "s3", "w", "accepted")], stores.VERDICT)), old)
    assert {r["sample_key"]: r["verdict"] for r in stores.read_verdicts(spark, old).collect()} == {"s1": "rejected", "s3": "accepted"}

    notes = str(tmp_path / "notes.json")
    stores.write_annotations(spark, spark.createDataFrame([("r", " best ", None), (" ", "x", "y")], stores.ANNOTATION), notes)
    runs = spark.createDataFrame([("r",), ("q",)], "run_id string")
    assert {r["run_id"]: (r["alias"], r["notes"]) for r in stores.annotated(runs, stores.read_annotations(spark, notes)).collect()} == {"r": ("best", ""), "q": ("", "")}


def test_dumps(spark, tmp_path):
    lines = lambda *refs, **more: "\n".join(json.dumps({"persona_id": "p", "reference": r, "generated": "g"} | more) for r in refs)
    a, b = put(tmp_path / "raw/a/g.jsonl", lines("x", "y")), put(tmp_path / "raw/b/g.jsonl", lines("y", "x") + "\nbroken")
    c = put(tmp_path / "raw/c/g.jsonl", lines("x", eval_val_sha256="abc"))
    for run, path in (("a", a), ("b", b), ("c", "/nowhere")):
        put(tmp_path / f"runs/{run}.json", {"run_id": run, "created_utc": run, "persona": {"generations_path": path}})
    put(tmp_path / "runs/bad.json", "{")
    saved = stores.grouped_dumps(spark, stores.saved_dumps(spark, str(tmp_path)))
    (g,) = stores.groups(saved).collect()
    assert g["members"] == ["a", "b"] and g["gkey"].startswith("evalset") and g["title"].endswith("2 runs")
    listed = stores.grouped_dumps(spark, stores.listed_dumps(spark, [a, f" {c} ", "/nowhere"], [str(tmp_path / "runs/a.json"), None]))
    assert {r["run_id"]: r["gkey"].split("\x1f")[0] for r in listed.collect()} == {"a": "evalset", "c": "valsha"}
    assert stores.run_beside(spark, a) == str(tmp_path / "runs/a.json") and stores.run_beside(spark, "/x/y.jsonl") is None
    groups = stores.groups(saved)
    assert tuple(merge.smallest_superset(groups, ["b"]).head()) == (g["gkey"], True)
    key, found = merge.smallest_superset(groups, ["b", "z"]).head()
    assert not found and key == merge_fallback(["z", "b"])
    meta = merge.variant_metadata(spark.createDataFrame([("/d/x.jsonl", 0, None), ("/d/x.jsonl", 1, "l")], "path string, source int, label string")).collect()
    assert {r["label"] for r in meta} == {"x.jsonl", "l"} and len({r["variant_id"] for r in meta}) == 2


def merge_fallback(labels):
    import hashlib

    return "checkpoint\x1f" + hashlib.sha256("|".join(sorted(labels)).encode()).hexdigest()[:24]


def test_provenance(spark):
    same = spark.createDataFrame([(" v ", "h"), ("v", "i")], "eval_val_jsonl string, eval_val_sha256 string")
    assert tuple(merge.provenance(same).head()) == ("path", "v")
    with pytest.raises(Exception, match="differ in their validation hash"):
        merge.provenance(same, by_hash=True).collect()
    with pytest.raises(Exception, match="has no validation path"):
        merge.provenance(same.withColumn("eval_val_jsonl", F.lit(""))).collect()


def test_lines(spark, tmp_path):
    good, bad = put(tmp_path / "good.jsonl", '{"a": 1}\n\n{"a": 2}\n'), put(tmp_path / "bad.jsonl", '{"a": 1}\n\n[3]\n{"a": 4}\nnope')
    assert [r["a"] for r in records.read_strict(spark, good, "a INT").collect()] == [1, 2]
    with pytest.raises(ValueError, match=r"bad\.jsonl:3"):
        records.read_strict(spark, bad, "a INT")
    assert [r["a"] for r in records.head_rows(spark, bad, "a INT", 2).collect()] == [1, 4]
    rows, error = records.read_generations_checked(spark, bad)
    assert rows.count() == 0 and "bad.jsonl:3" in error
    rows, error = records.read_generations_checked(spark, put(tmp_path / "g.jsonl", '{"persona_id": "p"}'))
    assert rows.count() == 1 and error is None
    assert records.read_generations_checked(spark, str(tmp_path / "absent.jsonl"))[1]
    assert records.read_comparisons(spark, str(tmp_path / "absent.jsonl")).count() == 0
    ok, broken = records.tolerant(spark, bad, "a INT")
    assert [r["a"] for r in ok.collect()] == [1, 4] and ok.count() == 2 and {r[0] for r in broken.collect()} == {"[3]", "nope"} and broken.count() == 2
    assert records.file_hash(spark, good).head()["length"] == 19


def test_results(spark, tmp_path):
    put(tmp_path / "m/results_1.json", {"results": {"t": {"acc,none": 0.5, "alias": "t", "samples": 3, "name": "x"}}})
    put(tmp_path / "m/results_1_samples_t.json", {"results": {"u": {"acc": 1}}})
    found = records.flatten_results(records.newest_results(spark, str(tmp_path)))
    assert [tuple(r) for r in found.collect()] == [("t.acc.none", 0.5)]


def test_probes(spark, tmp_path):
    put(tmp_path / "one/gradient_norms.json", {"config_path": "conf/wide.yaml", "lora": {"r": 8, "alpha": 16}})
    put(tmp_path / "two/gradient_norms_b.json", {"lora": {"r": 4}})
    put(tmp_path / "two/other.json", {})
    assert [r["label"] for r in stores.probes(spark, str(tmp_path)).collect()] == ["wide-r8-a16", "two-r4"]
    marks = spark.createDataFrame([([9, 7, 7, 1, 2, 3, 8, 1, 4, 9, 9], [1] * 10 + [0]), ([], [])], "ids array<bigint>, mask array<int>")
    got = probe.supervised_tokens(marks, [8], [7, 1]).collect()
    assert got[0]["labels"] == [-100, -100, -100, -100, 2, 3, -100, -100, -100, -100, -100] and [r["supervised"] for r in got] == [2, 0]


def test_tokenizer_documents(spark, tmp_path):
    a = {"model": {"type": "BPE", "vocab": {"a": 0, "b": 1, "ab": 2}, "merges": ["a b", "b a"]}, "added_tokens": [{"content": "<s>", "id": 3}], "normalizer": {"type": "NFC", "x": 1}}
    b = {"model": {"type": "BPE", "vocab": {"a": 0, "ab": 1, "c": 2}, "merges": ["a b"]}, "added_tokens": [{"id": 4, "content": "<s>"}, {"content": "</s>"}], "normalizer": {"x": 1, "type": "NFC"}, "decoder": {"type": "Byte"}}
    da, db = (tokens.read_config(spark, put(tmp_path / f"{n}.json", x)) for n, x in (("a", a), ("b", b)))
    r = tokens.compare_configs(da, db).head().asDict()
    assert (r["size_a"], r["size_b"], r["shared"], r["id_mismatches"], r["only_a"], r["only_b"], r["first_difference"]) == (3, 3, 2, 1, 1, 1, 1)
    assert (r["merges_a"], r["merges_b"], r["first_merge_difference"], r["added_only_b"], r["added_mismatches"]) == (2, 1, 1, 1, 1)
    assert r["normalizer_equal"] and not r["decoder_equal"] and r["padding_equal"] and r["model_type_equal"]
    assert tokens.config_summary(db).head().asDict() == {"model_type": "BPE", "vocab_size": 3, "merges": 1, "added_tokens": 2, "normalizer": "NFC", "pre_tokenizer": None, "post_processor": None, "decoder": "Byte"}
    unigram = tokens.read_config(spark, put(tmp_path / "u.json", {"model": {"vocab": [["x", -1.5], ["y", -2]]}}))
    assert {tuple(x) for x in tokens.vocab_of(unigram).collect()} == {("x", 0), ("y", 1)}
    p = tokens.probe_tokenization(spark.createDataFrame([("go now",)], "probe string"), {"w": lambda s: ["\u0120" + x for x in s.split()], "c": list}).head()
    assert p["w_pieces"] == ["go", "now"] and p["c_count"] == 6


def test_workspace(spark, tmp_path):
    assert status.completion({}) == {"completed": 0, "total": 5, "fraction": 0.0, "next": "ingest", "chain_broken": False}
    assert status.completion({"curate": True, "sft": True})["chain_broken"] is False and status.completion({"curate": True, "sft": True})["completed"] == 3
    assert status.completion({"ingest": True, "sft": True})["chain_broken"] is True
    put(tmp_path / "messages/f/x.parquet", "x")
    put(tmp_path / "sft/profiles.json", {"personas": {"a": {}, "b": {}}})
    s = status.snapshot(spark, str(tmp_path))
    assert s["flags"] == {"ingest": True, "curate": False, "sft": False, "fingerprint": True, "evals": False}
    assert s["pipeline"]["completed"] == 4 and s["profiles"]["personas"] == 2 and s["curate_report"] is None
    runs = spark.createDataFrame([("a", "2024-01-02", "x"), ("b", "2024-01-01", "y")], "run_id string, created_utc string, label string")
    assert status.runs_summary(runs).head()["latest"]["run_id"] == "a"


def test_chain_of_near_duplicates(spark):
    """Every second of a chain stays, however long it is, by one task or by rounds alone."""
    for n, last in ((300, 1000), (12, 0)):
        nodes = spark.createDataFrame([("s", i, 1000 - i) for i in range(n)], "scope string, id long, priority long")
        pairs = spark.createDataFrame([("s", i, i + 1) for i in range(n - 1)], "scope string, a long, b long")
        got = {r["id"]: r["kept"] for r in dedup.greedy_keep(nodes, pairs, last).collect()}
        assert got == {i: i % 2 == 0 for i in range(n)}


def test_copies_make_no_pairs(spark):
    rows = [("s", i, "one two three four five six") for i in range(400)] + [("s", 400, "one two three four five six seven"), ("s", 401, "")]
    texts = spark.createDataFrame(rows, "scope string, id long, text string").withColumn("priority", F.col("id"))
    members, sets = dedup.shingle_classes(texts)
    assert members.count() == 401 and sets.count() == 2
    pairs = dedup.similar_pairs(texts, 0.5)
    assert [(r["a"], r["b"], r["common"], r["union"]) for r in pairs.collect()] == [(0, 400, 2, 3)]
    kept = {r["id"] for r in dedup.near_dedup(texts, 0.5).filter("kept").collect()}
    assert kept == {400, 401} == {r["id"] for r in dedup.near_dedup(texts, 0.5, pairs_of=dedup.lsh_pairs).filter("kept").collect()}


def test_small_parts(spark):
    x = spark.createDataFrame([('{"a": 1.5, "b": "x", "c": "2", "d": null}', '{"tone": 3}', 'see {x} then {"tone": 4} end'), ("[]", "no", None)], "m string, j string, k string")
    r = x.select(elo.rating_map(F.col("m")).alias("m"), judging.first_object("j").alias("j"), judging.first_object(F.col("k")).alias("k")).collect()
    assert r[0]["m"] == {"a": 1.5, "c": 2.0} and (r[0]["j"], r[0]["k"], r[1]["j"], r[1]["k"]) == ('{"tone": 3}', '{"tone": 4}', None, None)
    assert balance.sweep_lists({"a": 2, "b": 0.5}, {"a": "2, 3", "b": None}) == {"a": [2, 3], "b": [0.5]}
    with pytest.raises(ValueError):
        balance.sweep_lists({"a": 2}, {"a": " , "})


def test_byte_labels(spark):
    x = spark.createDataFrame([(n,) for n in (0, 1023, 1024, 1280, 1024**2 - 1, 1024**2, 3 * 1024**3)], "n long")
    assert [r["b"] for r in x.select(ids.bytes_label(F.col("n")).alias("b")).collect()] == ["0 B", "1023 B", "1.0 KB", "1.2 KB", "1024.0 KB", "1.0 MB", "3.00 GB"]
    assert [r["b"] for r in x.select(ids.bytes_label(F.col("n"), "MB").alias("b")).collect()][-2:] == ["1.0 MB", "3072.0 MB"]


def test_identifiers_of_large_keys(spark, tmp_path):
    """The query's SQL writes KB from 1024 bytes on, whatever the size."""
    keys = [1, 28339, 28340, 28342, 29_020_049, 6_000_000_000]
    spark.createDataFrame([(k, "view") for k in keys], "event_id long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    got = {r["event_id"]: r["bytes"] for r in more.QUERIES["identifiers"](spark, str(tmp_path)).collect()}
    assert got == {k: f"{k * 37 / 1024:.1f} KB" if k > 27 else f"{k * 37} B" for k in keys}
