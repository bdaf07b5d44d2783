"""Stylometric features of a text, all within its row, and cosine similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import spread
from .profiles import FILLERS

#: Features in vector order.
FEATURES = ("avg_sentence_len", "avg_word_len", "filler_rate", "punct_comma", "punct_period", "punct_excl", "punct_q", "word_repeat_rate", "dup_bigram_rate")


def features(texts: DataFrame, text: str = "text", fillers: list[str] | None = None) -> DataFrame:
    """``texts`` with a column a feature; all 0 for a blank text."""
    picks = F.array(*map(F.lit, fillers or FILLERS))
    x = spread(texts).withColumn("__t", T.strip(F.coalesce(text, F.lit("")))).withColumn("__w", T.style_words(F.col("__t")))
    x = x.withColumns({"__s": T.sentences(F.col("__t")), "__c": F.filter(F.transform(F.split("__t", "\n\n"), T.strip), lambda c: c != ""), "__b": F.array_sort(T.grams(F.col("__w"), 2))})
    n, nw = F.greatest(F.length("__t"), F.lit(1)), F.size("__w")
    total = lambda a, f: F.aggregate(a, F.lit(0), lambda acc, y: acc + f(y))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    count = lambda c: (F.length("__t") - F.length(F.replace("__t", F.lit(c), F.lit("")))) / n
    # Sorted bigrams: a kind occurs more than once where the next is equal and the one before isn't.
    at = lambda i: F.get("__b", i)
    places = F.when(F.size("__b") > 0, F.sequence(F.lit(0), F.size("__b") - 1)).otherwise(F.array().cast("array<int>"))
    twice = F.size(F.filter(places, lambda i: at(i).eqNullSafe(at(i + 1)) & ~at(i).eqNullSafe(at(i - 1))))
    out = {
        "avg_sentence_len": ratio(total("__s", lambda s: F.size(T.style_words(s))), F.size("__s")),
        "avg_word_len": ratio(total("__w", lambda w: F.length(w)), nw),
        "filler_rate": ratio(F.size(F.filter("__c", lambda c: T.contains_any(c, picks))), F.size("__c")),
        "punct_comma": count(","), "punct_period": count("."), "punct_excl": count("!"), "punct_q": count("?"),
        "word_repeat_rate": F.when(nw > 1, 1.0 - F.size(F.array_distinct("__w")) / nw).otherwise(F.lit(0.0)),
        "dup_bigram_rate": ratio(twice, F.size(F.array_distinct("__b"))),
    }
    return x.withColumns(out).drop("__t", "__w", "__s", "__c", "__b")


def vector() -> Column:
    return F.array(*[F.coalesce(F.col(k).cast("double"), F.lit(0.0)) for k in FEATURES])


def cosine(a: Column, b: Column) -> Column:
    """0 if either has no length; different lengths raise."""
    dot = lambda p, q: F.aggregate(F.zip_with(p, q, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)
    value = F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))
    return F.when(F.size(a) != F.size(b), F.raise_error(F.lit("vector length mismatch")).cast("double")).otherwise(value)
