"""The command line on a small export, from pages to samples, profiles and ratings."""

import json
import random
from datetime import datetime, timedelta, timezone

import pytest

from chatloom import cli

WORDS = "tea boat window garden seven quiet river paper morning lamp stone letter green winter corner".split()


@pytest.fixture(scope="module")
def work(spark, tmp_path_factory):
    """An export of two folders: talks of two people on several days, of which one is there twice."""
    root, g = tmp_path_factory.mktemp("work"), random.Random(12)
    start = datetime(2024, 3, 1, 9, tzinfo=timezone.utc)
    for folder, people in (("north", ("10", "20")), ("south", ("10", "30"))):
        rows, n = [], 0
        for day in range(8):
            for turn in range(8):
                n += 1
                text = " ".join(WORDS[(turn * 5 + k) % len(WORDS)] for k in range(9)) if day in (2, 3) else " ".join(g.choice(WORDS) for _ in range(4 + turn % 4))
                who = people[turn % 2]
                rows.append({"id": f"{folder}{n:03d}", "timestamp": (start + timedelta(days=day, minutes=2 * turn)).isoformat(), "content": text, "type": 0, "author": {"id": who, "username": f"user{who}", "global_name": None}, "attachments": [], "embeds": []})
        at = root / "export" / folder
        at.mkdir(parents=True)
        (at / f"{folder}-page-1.json").write_text(json.dumps(rows[:30]))
        (at / f"{folder}-page-2.json").write_text(json.dumps(rows[28:]))
    return root


@pytest.fixture(scope="module")
def run(spark):
    def call(*words):
        a = cli.parser().parse_args([str(w) for w in words])
        a.func(spark, a)

    return call


def test_from_export_to_samples(work, run, capsys):
    run("ingest", work / "export", work / "messages")
    assert sorted(capsys.readouterr().out.split()) == sorted(["north", "64", "south", "64"])
    run("ingest", work / "export", work / "lines", "--format", "jsonl")
    assert "64" in capsys.readouterr().out

    run("curate", work / "export", work / "curated")
    report = json.loads(capsys.readouterr().out)
    assert report["messages_in"] == 128 and report["sessions_built"] == 16 and report["dropped_near_dup"] == 2 and report["sessions_kept"] == 14
    assert json.loads((work / "curated/curate_report.json").read_text()) == report

    run("curate-sweep", work / "export", work / "sweep", "--sweep-min-turns", "2,9", "--sweep-session-gap-min", "60,5000")
    points = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert [(p["min_turns"], p["gap_min"], p["sessions_built"], p["sessions_kept"]) for p in points] == [(2, 60, 16, 14), (9, 60, 16, 0), (2, 5000, 2, 2), (9, 5000, 2, 2)]

    run("build-sft", work / "curated/sessions", work / "sft", "--val-frac", "0.2")
    out = json.loads(capsys.readouterr().out)
    assert out["train"] + out["val"] == sum(out["balance"]["counts_after"].values()) and out["val"] >= 1
    assert set(out["balance"]["cap_per_persona"]) == {"10", "20", "30"}

    run("stats", work / "sft/train", "--tokenizer", "words")
    assert json.loads(capsys.readouterr().out)["n"] == out["train"]
    run("validate-chat-template", work / "sft/train")
    assert json.loads(capsys.readouterr().out)["samples_failed"] == 0
    run("fingerprint", work / "sft/train", work / "sft/profiles.json")
    profiles = json.loads((work / "sft/profiles.json").read_text())["personas"]
    assert set(profiles) <= {"10", "20", "30"} and all(p["length"]["n"] > 0 for p in profiles.values())


def dump(path, label, answers, sha="s1"):
    path.parent.mkdir(parents=True, exist_ok=True)
    rows = [{"persona_id": "10", "reference": f"ref {i}", "generated": x, "context_turns": [{"from": "user", "value": f"q{i}"}], "context": "", "eval_val_sha256": sha, "eval_val_jsonl": "v"} for i, x in enumerate(answers)]
    path.write_text("\n".join(json.dumps(r) for r in rows))
    return path


def test_runs_and_ratings(work, run, capsys, spark):
    a, b = dump(work / "ev/raw/one/g.jsonl", "one", ["ref a, b", "ref c", "yes"]), dump(work / "ev/raw/two/g.jsonl", "two", ["NO!!!", "what?!", "hm"])
    for name, path in (("one", a), ("two", b)):
        run("eval-run", path, work / "ev", "--model", f"Model {name}", "--label", name, "--stamp", "2024-05-06T07-08-09Z")
        assert json.loads(open(capsys.readouterr().out.strip()).read())["run_id"] == f"2024-05-06T07-08-09Z__model-{name}__{name}"
    run("eval-list", work / "ev/runs")
    runs = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert len(runs) == 2 and all(r["n_scores"] == 4 for r in runs)
    ids = [r["run_id"] for r in runs]
    run("eval-compare", work / "ev/runs", *ids, "--include-persona-metrics", "--format", "markdown")
    assert capsys.readouterr().out.count("\n") == 6

    checks = work / "ev/style_rank_checkpoints"
    checks.mkdir()
    row = lambda k, w, l: json.dumps({"sample_key": k, "i": 0, "j": 1, "swap": False, "choice": "A", "winner_label": w, "loser_label": l})
    (checks / "c1.jsonl").write_text("\n".join([row(f"k{i}", ids[0], ids[1]) for i in range(3)] + ["broken {", json.dumps({"checkpoint_kind": "error", "sample_key": "x", "i": 0, "j": 1, "error": "late"})]))
    run("eval-backfill", work / "ev")
    (out,) = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert out["hint"] == "discovered_group" and out["n_comparisons"] == 3 and out["gkey"] == "valsha\x1fs1"
    store = json.loads((work / "ev/style_rank_group_elo.json").read_text())["groups"]["valsha\x1fs1"]
    assert store["elo"][ids[0]] > store["elo"][ids[1]] and store["win_rate"][ids[0]] == 1.0

    judged = work / "judged.jsonl"
    judged.write_text("\n".join(row(f"k{i}", "one", "two") for i in range(3)))
    run("eval-rank-style", work / "ranked", "--generations", a, b, "--label", "one", "two", "--comparisons", judged)
    first, second = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert first["label"] == "one" and first["rating"] > second["rating"] and first["combined"] > second["combined"]
    report = json.loads((work / "ranked/report.json").read_text())
    assert report["n_merged_samples"] == 3 and report["n_comparisons"] == 3 and not report["errors_truncated"]
    with pytest.raises(Exception, match="differ"):
        run("eval-rank-style", work / "ranked2", "--generations", a, dump(work / "ev/raw/three/g.jsonl", "three", ["x"], "s2"), "--use-val-hash")

    answers = work / "answers.jsonl"
    answers.write_text("\n".join(json.dumps({"persona_id": p, "answer": json.dumps({"vocabulary": v, "tone": 3, "length": 3, "authentic_persona": 3})}) for p, v in (("10", 1), ("10", 5), (None, 4))))
    run("eval-judge-persona", answers, "--out", work / "judge.json")
    report = json.loads(capsys.readouterr().out)
    assert report["overall"]["n_rated"] == 3 and {r["persona_id"]: r["vocabulary"] for r in report["personas"]} == {"10": 3.0, None: 4.0}

    run("eval-heuristics", _lines(work / "g.txt", ["Hello there!", "fine"]), _lines(work / "r.txt", ["hi", "ok then"]), "--profile", work / "sft/profiles.json", "--persona", "10")
    assert json.loads(capsys.readouterr().out)["exclamation_rate"] == 0.5


def _lines(path, rows):
    path.write_text("\n".join(rows) + "\n")
    return path
