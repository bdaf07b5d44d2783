"""Answers and ratings of judges, as columns."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import strip

#: A rating's axes; all weigh the same.
AXES = ("vocabulary", "tone", "length", "authentic_persona")


def pairwise_answer(x) -> Column:
    """A or B of a judge's text: its last line ``Answer: A``, else its first line that is a letter alone,
    else the first letter a or b that is a word, else by its first letter; null if none."""
    low = F.lower(strip(F.coalesce(x, F.lit(""))))
    lines = F.transform(F.split(low, r"\r\n|[\n\r\u000b\f]"), strip)
    stated = F.filter(F.transform(lines, lambda s: F.regexp_extract(s, r"^answer:\s*([ab])$", 1)), lambda s: s != "")
    bare = F.filter(lines, lambda s: s.isin("a", "b"))
    word = F.nullif(F.regexp_extract(low, r"(?U)(?<!\w)([ab])(?!\w)", 1), F.lit(""))
    first = F.when(low.startswith("a") & ~low.startswith("assistant"), F.lit("a")).when(low.startswith("b"), F.lit("b"))
    return F.upper(F.coalesce(F.try_element_at(stated, F.lit(-1)), F.try_element_at(bare, F.lit(1)), word, first))


def first_object(text) -> Column:
    """The first JSON object of a text, without fences and what else is around it; null if there is none.

    Texts that are an object are taken as they are; only others go to the scan in Python.
    """
    x = strip(F.col(text) if isinstance(text, str) else text)
    whole = x.startswith("{") & x.endswith("}") & F.from_json(x, "map<string,string>").isNotNull()
    return F.coalesce(F.when(whole, x), _scan(F.when(~F.coalesce(whole, F.lit(False)), x)))


@F.pandas_udf(StringType())
def _scan(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The first object that a JSON decoder reads from a brace on, in Arrow batches."""
    import json

    def one(s):
        if s is None:
            return None
        decoder, at = json.JSONDecoder(), s.find("{")
        while at >= 0:
            try:
                return json.dumps(decoder.raw_decode(s, at)[0], ensure_ascii=False)
            except ValueError:
                at = s.find("{", at + 1)
        return None

    for x in texts:
        yield x.map(one)


def rating(parsed) -> Column:
    """A struct of axis scores 1 to 5, ``overall`` and ``reasoning`` from a JSON object; null if an axis isn't a number."""
    raw = F.from_json(parsed, "vocabulary double, tone double, length double, authentic_persona double, reasoning string")
    axis = [F.greatest(F.lit(1), F.least(F.lit(5), F.bround(raw[a]).cast("int"))) for a in AXES]
    total = sum(axis[1:], axis[0])
    overall = F.greatest(F.lit(1), F.least(F.lit(5), F.floor((total + len(AXES) // 2) / len(AXES)).cast("int")))
    whole = F.struct(*[a.alias(k) for a, k in zip(axis, AXES, strict=True)], overall.alias("overall"), strip(F.coalesce(raw["reasoning"], F.lit(""))).alias("reasoning"))
    return F.when(~sum([raw[a].isNull().cast("int") for a in AXES[1:]], raw[AXES[0]].isNull().cast("int")).cast("boolean"), whole)
