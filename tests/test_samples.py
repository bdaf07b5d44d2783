"""Samples, balancing, profiles, ratings and comparisons."""

import random

import pytest
from pyspark.sql import functions as F

from chatloom.functions import judging, prompts
from chatloom.operators import balance, elo, evals, merge, profiles, sft, stylometry, template, tokens


def turn_rows(spark, sessions):
    rows = [("f", s, k, a, a.lower(), f"2025-01-01 00:{k:02d}:00", t, [f"{a}-{k}"]) for s, turns in sessions.items() for k, (a, t) in enumerate(turns)]
    d = spark.createDataFrame(rows, "folder string, session_id string, turn_idx int, author_id string, author_name string, at string, text string, source_ids array<string>")
    return d.withColumn("start_ts", F.to_timestamp("at")).withColumn("end_ts", F.col("start_ts")).drop("at")


def test_samples(spark):
    s = {r["persona_id"]: r for r in sft.samples(turn_rows(spark, {"s": [("A", "one"), ("B", "two"), ("A", "three"), ("A", "more"), ("B", "four")]}), window_turns=4).collect()}
    assert [(t["from"], t["value"]) for t in s["A"]["conversations"]] == [("user", "two"), ("assistant", "three\nmore")]
    assert s["B"]["system"] == "You are b chatting with a, continue the discord conversation."
    assert s["B"]["meta"]["counterparty_ids"] == ["A"] and s["B"]["meta"]["end_source_ids"] == ["B-4"]


def test_windows_match_a_search(spark):
    g = random.Random(9)
    sessions = {f"s{k}": [(g.choice("ABC"), "x") for _ in range(g.randrange(1, 14))] for k in range(40)}

    def blocks(turns, st, end, p):
        roles = [a == p for a, _ in turns[st : end + 1]]
        n = 1 + sum(x != y for x, y in zip(roles, roles[1:]))
        return n - roles[0]

    want = {}
    for s, turns in sessions.items():
        for p in {a for a, _ in turns}:
            end = max(i for i, (a, _) in enumerate(turns) if a == p)
            ok = [st for st in range(max(0, end - 7), end + 1) if 2 <= blocks(turns, st, end, p) <= 4]
            if ok:
                best = max(ok, key=lambda st: (blocks(turns, st, end, p), -st))
                want[s, p] = (end, best)
    got = {(r["session_id"], r["persona_id"]): (r["end_idx"], r["start_idx"]) for r in sft.windows(turn_rows(spark, sessions), None, 8, 2, 4).collect()}
    assert got == want


def test_balance_and_split(spark):
    rows = [(f"{p}{s}{k}", f"{p}{s}", p, 8 if k else 2) for p, n in (("A", 30), ("B", 5), ("C", 5)) for s in range(n) for k in range(1)]
    d = spark.createDataFrame(rows, "key string, session string, persona string, num_turns int")
    n = {r["persona"]: r["count"] for r in balance.balance(d).groupBy("persona").count().collect()}
    assert n == {"A": 8, "B": 5, "C": 5}
    assert balance.balance(d, "none").count() == 40
    s = balance.split(d, 0.2).groupBy("session").agg(F.countDistinct("split").alias("n")).agg(F.max("n")).head()[0]
    assert s == 1 and balance.split(d, 0.2).filter("split = 'val'").count() == 8
    one = balance.split(d.filter("session = 'B0'"), 0.1)
    assert one.head()["split"] == "val"
    with pytest.raises(ValueError):
        balance.parse_policy("most")


def test_turn_mix(spark):
    rows = [(str(k), str(k), "A", 8 if k < 40 else 2) for k in range(44)]
    out = balance.balance_turns(spark.createDataFrame(rows, "key string, session string, persona string, num_turns int"), "uniform")
    assert {r["num_turns"]: r["count"] for r in out.groupBy("num_turns").count().collect()} == {2: 4, 8: 4}


def test_token_stats(spark):
    d = spark.createDataFrame([("a", 10), ("b", 20)], "persona_id string, tokens long")
    r = tokens.token_stats(d).head()
    assert (r["n"], r["total"], r["mean"], r["p50"], r["max"]) == (2, 30, 15.0, 15.0, 20)
    v = spark.createDataFrame([("a", t) for t in ("hi", "bye", "lol", "imma")] + [("b", t) for t in ("hi", "bye", "lmao", "ngl")], "name string, token string")
    o = tokens.vocab_overlap(v).head()
    assert (o["n_common"], o["n_union"], o["jaccard"]) == (2, 6, 2 / 6)


def test_heuristics_and_profiles(spark):
    d = spark.createDataFrame([("A", "Hi! there", "hey you"), ("A", "imma go", "ok then yes")], "persona_id string, generated string, reference string")
    r = profiles.style_heuristics(d, F.array(F.lit("imma"))).head()
    assert (r["exclamation_rate"], r["caps_rate"], r["filler_rate"], r["avg_length_diff"]) == (0.5, 0.5, 0.5, 0.5)
    t = spark.createDataFrame([("A", w, k) for k, w in enumerate(["imma eat", "imma go", "imma run", "imma nap"])] + [("B", w, k) for k, w in enumerate(["we eat", "we go", "we run", "we nap"])], "persona_id string, text string, seq int")
    p = profiles.build_profiles(t)
    assert p.filter("persona_id = 'A'").head()["top_fillers"]["1gram"][0]["token"] == "imma"
    x = profiles.drift(t.withColumn("persona_name", F.lit("n")), p).collect()
    assert all(r["mean_words_delta"] == 0 and r["warning"] is None for r in x)
    f = stylometry.features(spark.createDataFrame([("a b a b, a!",), ("",)], "text string")).collect()
    assert f[0]["word_repeat_rate"] == pytest.approx(0.6) and f[0]["dup_bigram_rate"] == 1.0 and f[1]["avg_word_len"] == 0


def test_compare(spark):
    d = spark.createDataFrame([("base", "ifeval.acc", 0.8), ("base", "gsm8k.em", 0.6), ("lora", "ifeval.acc", 0.72), ("lora", "gsm8k.em", 0.3), ("base", "z", 0.0), ("lora", "z", 0.5), ("lora", "persona.x", 1.0)], "run_id string, metric string, value double")
    r = {x["metric"]: x for x in evals.compare_runs(d, ["base", "lora"], "base").collect()}
    assert r["ifeval.acc"]["delta_1"] == pytest.approx(-0.08) and r["gsm8k.em"]["forgetting_1"] == pytest.approx(0.5)
    assert r["z"]["forgetting_1"] is None and r["z"]["delta_1"] == 0.5 and "persona.x" not in r
    assert [x["metric"] for x in evals.compare_runs(d, ["base", "lora"], "base", ["ifeval.*"]).collect()] == ["ifeval.acc"]


def test_answers(spark):
    table = {"Answer: A": "A", "x\nanswer: b": "B", "B": "B", "I pick b here": "B", "assistant": None, "": None, "Answer: A\nAnswer: B": "B", "Apple": "A"}
    d = spark.createDataFrame([(k,) for k in table], "x string")
    assert {r[0]: r[1] for r in d.select("x", judging.pairwise_answer(F.col("x"))).collect()} == table
    j = spark.createDataFrame([('```json\n{"vocabulary": 4.5, "tone": 9, "length": 1, "authentic_persona": 3}\n```',), ("none",)], "x string")
    r = j.select(judging.rating(judging.first_object("x")).alias("r")).collect()
    assert r[0]["r"]["tone"] == 5 and r[0]["r"]["vocabulary"] == 4 and r[0]["r"]["overall"] == 3 and r[1]["r"] is None


def test_elo(spark):
    g = random.Random(2)
    games = [(0, k, *g.sample("abcd", 2)) for k in range(50)]
    want = dict.fromkeys("abcd", 1500.0)
    for _, _, w, l in games:
        e = 1 / (1 + 10 ** ((want[l] - want[w]) / 400))
        want[w], want[l] = want[w] + 32 * (1 - e), want[l] - 32 * (1 - e)
    start = spark.createDataFrame([(0, x, 1500.0) for x in "abcd"], "scope int, label string, rating double")
    got = {r["label"]: r["rating"] for r in elo.fold(spark.createDataFrame(games, "scope int, ord int, winner_label string, loser_label string"), start).collect()}
    assert got == pytest.approx(want)
    two = spark.createDataFrame([("k", 0, 1, False, "a", "b")] * 3 + [("k", 0, 1, False, "b", "a")], "sample_key string, i int, j int, swap boolean, winner_label string, loser_label string")
    r = {x["label"]: x["rating"] for x in elo.replay(two).collect()}
    assert r["a"] - r["b"] == pytest.approx(400 * 0.47712125) and r["a"] + r["b"] == pytest.approx(3000)


def test_games_and_starts_meet_where_both_are_dealt_by_scope(spark):
    g = random.Random(4)
    games = [(f"s{k % 300:03d}", f"{k:05d}", 0, 1, False, k, "2025-01-01 00:00:00", *g.sample(["one", "two", "three", "four"], 2)) for k in range(12_000)]
    rows = spark.createDataFrame(games, "scope string, sample_key string, i int, j int, swap boolean, line int, mtime string, winner_label string, loser_label string")
    # Sort-merge joins, and partitions of the starts that are merged while those of the games aren't: what a large table leads to.
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30000b", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}
    old = {c: spark.conf.get(c, None) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        got = {(r["scope"], r["label"]): r["rating"] for r in elo.replay_groups(rows, chronological=True).collect()}
    finally:
        for c, v in old.items():
            spark.conf.set(c, v) if v is not None else spark.conf.unset(c)
    want = {}
    for scope, *_, a, b in games:
        x, y = want.get((scope, a), 1500.0), want.get((scope, b), 1500.0)
        won = 1 / (1 + 10 ** ((y - x) / 400))
        want[scope, a], want[scope, b] = x + 32 * (1 - won), y - 32 * (1 - won)
    assert got == pytest.approx(want)


def test_merge_and_votes(spark):
    rows = spark.createDataFrame([(0, "x", 1, "g1"), (0, "x", 2, "g2"), (1, "x", 1, "h"), (1, "y", 1, "i")], "source int, key string, place int, generated string")
    m = merge.merge_sources(rows, ["generated"], 2).collect()
    assert len(m) == 1 and m[0]["base"]["generated"] == "g2"
    v = spark.createDataFrame([("c", "x", "v", "rejected")], "comparison string, sample_key string, variant_id string, verdict string")
    legacy = spark.createDataFrame([("c", "x", "v"), ("c", "y", "v")], "comparison string, sample_key string, variant_id string")
    assert {r["sample_key"]: r["verdict"] for r in merge.verdicts(v, legacy).collect()} == {"x": "rejected", "y": "accepted"}


def test_template(spark):
    s = spark.createDataFrame([("sys", [("user", "hi"), ("assistant", "yo")]), ("", [("user", "a"), ("assistant", "b")])], "system string, conversations array<struct<`from`:string,value:string>>")
    c = template.checked(s)
    assert template.summary(c).head()["samples_passed"] == 2
    bad = template.checked(s, F.lit("<|im_start|>user\nhi<|im_start|>assistant\nyo"))
    assert "user_blocks" in bad.head()["issues"]
    spans = s.select(prompts.supervised_spans(prompts.chatml(prompts.chat_messages(F.col("system"), F.col("conversations"))))).collect()
    assert spans[1][0][0]["length"] == len("b<|im_end|>\n")
    p = s.select(prompts.baseline_prompt("style", F.lit("Ann"), minimal=F.lit("You are Ann."))).head()[0]
    assert p.startswith("You are Ann.\n\nMatch a casual Discord DM style:")
