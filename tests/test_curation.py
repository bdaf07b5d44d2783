"""Ingest, curation and near-duplicates on hand-made messages."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from chatloom import schemas
from chatloom.functions import text as T
from chatloom.operators import dedup
from chatloom.plans.curate import Options, curate, sweep
from chatloom.sources import exports, records

T0 = datetime(2025, 7, 2, 12, tzinfo=timezone.utc)
PLAIN = Options(near_dedup_threshold=None)


def raw(i, at, author="A", content="hi", **more):
    return {"id": str(i), "timestamp": (T0 + timedelta(seconds=at)).isoformat(), "content": content, "type": 0, "author": {"id": author, "username": author.lower(), "global_name": None}, "attachments": [], "embeds": []} | more


def pages(tmp_path, **by_page):
    folder = tmp_path / "chat"
    folder.mkdir()
    for page, rows in by_page.items():
        (folder / f"chat-page-{page[1:]}.json").write_text(json.dumps(rows))
    return str(tmp_path)


def messages(spark, rows):
    data = []
    for k, (at, author, content, *more) in enumerate(rows):
        m = {"id": str(k + 1), "ts": T0 + timedelta(seconds=at), "author_id": author, "author_name": author, "content": content, "edited_ts": None, "attachments": [], "num_embeds": 0, "type": 0, "referenced_id": None, "reply_to_preview": None, "reply_to_author_id": None, "reply_to_author_name": None, "reply_to_missing": False, "folder": "f"}
        data.append(m | (more[0] if more else {}))
    names = [c.strip().split()[0] for c in schemas.MESSAGE.replace("\n", " ").split(",")]
    return exports.ordered(spark.createDataFrame([tuple(m[n] for n in names) for m in data], schemas.MESSAGE))


def test_pages_are_sorted_and_deduplicated(spark, tmp_path):
    root = pages(tmp_path, p1=[raw(3, 3), raw(2, 2, content="first")], p2=[raw(2, 2, content="second"), raw(1, 1)], p10=[raw(10, 10), "stray", 5], p11=[raw(11, 11)])
    got = exports.ordered(exports.read_messages(spark, root)).orderBy("seq").collect()
    assert [r["id"] for r in got] == ["1", "2", "3", "10", "11"]
    assert got[1]["content"] == "first" and got[0]["folder"] == "chat" and got[0]["author_name"] == "a"


def test_replies(spark, tmp_path):
    reply = {"type": 19, "referenced_message": {"id": "1", "content": "by the lake", "author": {"id": "B", "username": "ida", "global_name": "Ida"}}, "message_reference": {"message_id": "1"}}
    gone = {"type": 19, "referenced_message": None, "message_reference": {"message_id": "999"}}
    got = {r["id"]: r for r in exports.read_messages(spark, pages(tmp_path, p1=[raw(2, 2, **reply), raw(3, 3, **gone)])).collect()}
    assert (got["2"]["referenced_id"], got["2"]["reply_to_preview"], got["2"]["reply_to_author_name"], got["2"]["reply_to_missing"]) == ("1", "by the lake", "Ida", False)
    assert (got["3"]["referenced_id"], got["3"]["reply_to_missing"]) == ("999", True)


def turns(c):
    return [(r["author_id"], r["text"]) for r in c.turns.orderBy("folder", "session_no", "turn_idx").collect()]


def test_burst_merge(spark):
    c = curate(messages(spark, [(0, "A", "tea is ready"), (12, "A", "come down"), (20, "B", "coming"), (35, "A", "bring cups")]), Options(monologue_max_share=1.0, near_dedup_threshold=None))
    assert turns(c) == [("A", "tea is ready\ncome down"), ("B", "coming"), ("A", "bring cups")]


def test_session_split(spark):
    rows = [(0, "A", "a b"), (30, "B", "c d"), (60, "A", "e f"), (10800, "B", "g h"), (10805, "A", "i j"), (10810, "B", "k l")]
    c = curate(messages(spark, rows), Options(session_gap_min=120, near_dedup_threshold=None))
    assert sorted(r["n_turns"] for r in c.sessions.collect()) == [3, 3]


def test_filters_and_counters(spark):
    rows = [(0, "A", "hello"), (20, "B", "", {"type": 19, "reply_to_missing": True}), (40, "B", "x", {"type": 6}), (60, "B", "!help me"), (80, "B", "ok fine"), (99, "B", "  ")]
    r = curate(messages(spark, rows), PLAIN).report.head()
    assert (r["dropped_deleted_ref"], r["dropped_system_type"], r["dropped_bot_command"], r["dropped_empty"], r["sessions_kept"]) == (1, 1, 1, 1, 1)


def test_monologue(spark):
    rows = [(0, "A", "one two three four five six seven eight"), (40, "A", "one two three four five six seven"), (80, "A", "a b c d e"), (120, "B", "ok")]
    r = curate(messages(spark, rows), PLAIN).report.head()
    assert (r["dropped_monologue"], r["sessions_kept"]) == (1, 0)


def test_reply_is_quoted_unless_it_is_next(spark):
    ref = {"type": 19, "referenced_id": "1", "reply_to_preview": "where is the key", "reply_to_author_name": "Ida"}
    c = curate(messages(spark, [(0, "B", "where is the key"), (40, "A", "other"), (90, "A", "under the mat", ref)]), PLAIN)
    assert turns(c)[-1][1] == "> Ida: where is the key\nunder the mat"
    c = curate(messages(spark, [(0, "B", "where is the key"), (90, "A", "under the mat", ref)]), PLAIN)
    assert turns(c)[-1][1] == "under the mat"


def test_exact_turns(spark):
    rows = [(0, "A", "raining again"), (130, "B", "still"), (260, "A", "raining again"), (390, "B", "all week")]
    one = curate(messages(spark, rows), Options(merge_gap_sec=60, near_dedup_threshold=None))
    assert one.report.head()["dropped_exact_turn_dup"] == 1 and len(turns(one)) == 3
    assert len(turns(curate(messages(spark, rows), Options(merge_gap_sec=60, near_dedup_threshold=None, dedupe_exact_turns=False)))) == 4
    with pytest.raises(ValueError):
        curate(messages(spark, rows), Options(exact_turn_dup_cap=0))


def test_language_hook(spark):
    rows = [(0, "A", "the tea"), (40, "B", "the cup"), (9000, "A", "le thé"), (9040, "B", "la tasse"), (18000, "A", "1"), (18040, "B", "2")]
    told = lambda x: F.when(x.contains("the "), "en").when(x.contains("th\u00e9"), "fr")
    r = curate(messages(spark, rows), Options(lang="en", near_dedup_threshold=None), told).report.head()
    assert (r["sessions_built"], r["dropped_lang"], r["sessions_kept"]) == (3, 1, 2)
    assert curate(messages(spark, rows), Options(lang="en", near_dedup_threshold=None)).report.head()["dropped_lang"] == 0
    points = sweep(messages(spark, rows), Options(lang="en"), language=told, min_turns=[2, 3]).collect()
    assert [(p["dropped_lang"], p["dropped_short_session"], p["sessions_kept"]) for p in points] == [(1, 0, 2), (0, 3, 0)]


def test_sweep_is_curate_at_every_point(spark):
    """The counters of each point of a grid are those of a run of its own, near-duplicates and exact repeats included."""
    g, rows, at = random.Random(6), [], 0
    talk = [[(who, " ".join(g.choice("tea cup lake hill road bird snow moon".split()) for _ in range(9))) for who in "ABAB"] for _ in range(4)]
    for k in range(14):
        for who, text in talk[k % 4] if k % 3 else [("A", "hm"), ("A", "hm"), ("B", f"note {k}")]:
            rows.append((at, who, text if g.random() > 0.05 else text + " indeed"))
            at += g.choice((20, 50, 400))
        at += 4000
    m = messages(spark, rows)
    lists = {"min_turns": [2, 4], "merge_gap_sec": [30, 60], "session_gap_min": [5, 60], "monologue_max_share": [0.6, 1.0]}
    names = ("messages_in", "turns_built", "dropped_exact_turn_dup", "sessions_built", "dropped_short_session", "dropped_single_author", "dropped_monologue", "dropped_near_dup", "sessions_kept")
    for p in sweep(m, Options(near_dedup_threshold=0.7), **lists).collect():
        o = Options(near_dedup_threshold=0.7, **{k: p["params"][k] for k in lists})
        if p["params"]["session_gap_min"] == 60 or p["params"]["min_turns"] == 4:
            want = curate(m, o).report.head()
            assert [p[n] for n in names] == [want[n] for n in names], o


def test_text_functions(spark):
    x = spark.createDataFrame([("write ida@lake.net or 212-680-1479 <@1> <@!2> <#9> <a:owl:12>  end\n\n\n\nnow",)], "x string")
    got = x.select(T.normalize(F.col("x"), F.create_map(F.lit("1"), F.lit("Ann")))).head()[0]
    assert got == "write [email] or [phone] @Ann @user :owl: end\n\nnow"
    y = spark.createDataFrame([("é" * 3 + " b",), ("",), (None,), (" \n ",)], "x string")
    assert [r[0] for r in y.select(T.word_count("x")).collect()] == [2, 0, 0, 0]
    assert x.select(T.shorten(F.lit("a" * 200))).head()[0] == "a" * 119 + "..."


def test_repaired_time_and_record_round_trip(spark):
    c = curate(messages(spark, [(0, "A", "hello"), (40, "B", "there")]), PLAIN)
    rec = records.session_records(c.turns)
    assert rec.head()["authors"] == ["A", "B"]
    back = records.turns_of(rec)
    assert back.count() == 2
    t = spark.createDataFrame([("2021)03-05T07:08:09.250000+00:00",)], "x string")
    assert t.select(F.year(records.repaired_ts(F.col("x")))).head()[0] == 2021


def test_near_duplicates_match_a_loop(spark):
    g = random.Random(4)
    rows = []
    for k in range(60):
        base = [f"w{g.randrange(12)}" for _ in range(25)] if k % 3 == 0 or not rows else rows[-1][2].split()
        words = [w if g.random() > 0.02 else "z" for w in base]
        rows.append(("f", k, " ".join(words), len(words) + g.randrange(3)))
    rows += [("f", 100, "", 0), ("g", 101, rows[0][2], 30)]
    got = {(r["scope"], r["id"]): r["kept"] for r in dedup.near_dedup(spark.createDataFrame(rows, "scope string, id long, text string, priority int"), 0.6).collect()}

    def sh(t):
        w = t.lower().split()
        return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({" ".join(w)} if w else set())

    kept: list = []
    for s, k, t, _ in sorted(rows, key=lambda r: (-r[3], r[1])):
        a = sh(t)
        if not any(s == s2 and a and b and len(a & b) / len(a | b) >= 0.6 for s2, b in kept):
            kept.append((s, a))
            assert got[s, k], k
        else:
            assert not got[s, k], k
