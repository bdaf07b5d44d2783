"""Validation of rendered chat templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import END, START, chat_messages, chatml
from ..functions.text import falsy

CHECKS = ("user_turns", "assistant_turns", "user_blocks", "assistant_blocks", "im_end", "unfinished")


def _count(text, mark: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark)).cast("int")


def checked(samples: DataFrame, text: Column | None = None) -> DataFrame:
    """``samples`` with rendered text, counts and ``issues``. ``text`` is a rendering of another template."""
    s = samples.withColumn("rendered", text if text is not None else chatml(chat_messages(F.col("system"), F.col("conversations"))))
    role = lambda r: F.size(F.filter("conversations", lambda t: t["from"] == r))
    block = lambda r: F.regexp_count("rendered", F.lit(r"(?s)\Q" + START + r + "\n" + r"\E.*?\Q" + END + r"\E"))
    s = s.withColumns({
        "expected_user": role("user"), "expected_assistant": role("assistant"), "expected_messages": F.size("conversations") + falsy("system").isNotNull().cast("int"),
        "rendered_user": _count("rendered", START + "user\n"), "rendered_assistant": _count("rendered", START + "assistant\n"), "rendered_im_end": _count("rendered", END),
    })
    c = F.col
    found = {
        "user_turns": c("rendered_user") != c("expected_user"), "assistant_turns": c("rendered_assistant") != c("expected_assistant"),
        "user_blocks": block("user") != c("expected_user"), "assistant_blocks": block("assistant") != c("expected_assistant"),
        "im_end": c("rendered_im_end") < c("expected_messages"), "unfinished": F.rtrim(F.regexp_replace("rendered", r"\s+$", "")).endswith(START + "assistant"),
    }
    return s.withColumn("issues", F.array_compact(F.array(*[F.when(found[k], F.lit(k)) for k in CHECKS])))


def summary(checks: DataFrame) -> DataFrame:
    """One row: samples checked, passed and failed, pass rate, and the counters."""
    bad = F.size("issues") > 0
    return checks.agg(
        F.count("*").alias("samples_checked"), F.count_if(~bad).alias("samples_passed"), F.count_if(bad).alias("samples_failed"), F.coalesce(F.avg((~bad).cast("double")), F.lit(0.0)).alias("pass_rate"),
        *[F.coalesce(F.sum(k), F.lit(0)).cast("long").alias(k) for k in ("expected_user", "expected_assistant", "rendered_user", "rendered_assistant", "rendered_im_end")],
    )


def errors(checks: DataFrame, order: str, n: int = 20) -> DataFrame:
    return checks.filter(F.size("issues") > 0).orderBy(order).limit(n).select(order, "issues", F.substring("rendered", 1, 400).alias("preview"))
