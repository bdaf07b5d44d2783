"""Streaming forms of batch operators; an addition, as exports come in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def live_sessions(messages: DataFrame, gap: str = "60 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of a stream of messages (folder, ts, author_id), by gap.

    With a merge gap not above the session gap these are the batch sessions. A
    session is given out once the watermark has passed its end by the gap. The state of an open session
    has the set of its authors, so that their number is exact.
    """
    s = messages.withWatermark("ts", late).groupBy("folder", F.session_window("ts", gap).alias("w"))
    out = s.agg(F.count("*").alias("n_messages"), F.size(F.collect_set("author_id")).cast("long").alias("n_authors"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return out.select("folder", "first_ts", "last_ts", "n_messages", "n_authors")


def live_win_rates(comparisons: DataFrame) -> DataFrame:
    """Wins and games by label over a stream of comparison rows."""
    from ..operators.elo import win_rates

    return win_rates(comparisons)
