"""Streaming forms against the batch ones."""

import json
import os

from pyspark.sql import functions as F

from chatloom import streaming
from chatloom.operators import elo


def feed(spark, tmp_path, name, files, schema):
    at = tmp_path / name
    at.mkdir()
    for i, rows in enumerate(files):
        (at / f"{i}.json").write_text("\n".join(map(json.dumps, rows)))
        os.utime(at / f"{i}.json", (1_700_000_000 + 10 * i,) * 2)  # files come in order of their time
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(at)), spark.read.schema(schema).json(str(at))


def drained(spark, frame, name, tmp_path, mode):
    q = frame.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"{name}-checkpoint")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    return spark.table(name).collect()


def test_sessions(spark, tmp_path):
    row = lambda folder, minute, who: {"folder": folder, "ts": f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z", "author_id": who}
    files = [[row("f", 0, "a"), row("f", 20, "b"), row("g", 5, "a")], [row("f", 70, "b"), row("f", 200, "c")], [row("f", 600, "a"), row("g", 600, "a")], [row("f", 1200, "z")]]
    stream, _ = feed(spark, tmp_path, "messages", files, "folder string, ts timestamp, author_id string")
    got = {(r["folder"], r["first_ts"].hour * 60 + r["first_ts"].minute): (r["n_messages"], r["n_authors"]) for r in drained(spark, streaming.live_sessions(stream), "sessions", tmp_path, "append")}
    assert got == {("f", 0): (3, 2), ("g", 5): (1, 1), ("f", 200): (1, 1), ("f", 600): (1, 1), ("g", 600): (1, 1)}


def test_win_rates(spark, tmp_path):
    row = lambda w, l: {"winner_label": w, "loser_label": l}
    stream, batch = feed(spark, tmp_path, "games", [[row("a", "b"), row("a", "c")], [row("b", "a")]], "winner_label string, loser_label string")
    got = drained(spark, streaming.live_win_rates(stream), "wins", tmp_path, "complete")
    assert sorted(map(tuple, got)) == sorted(map(tuple, elo.win_rates(batch).collect()))
    assert batch.filter(F.col("winner_label") == "a").count() == 2
