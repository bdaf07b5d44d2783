"""Keys, slugs and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(x) -> Column:
    """Lower-case letters, figures and dashes; x if nothing is left."""
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9-]+", "-"), "^-+|-+$", ""), F.lit("")), F.lit("x"))


def run_id(model, stamp, label=None) -> Column:
    """Time, model and, unless null or empty, label."""
    parts = [stamp, slug(model)] + ([F.when(F.coalesce(label, F.lit("")) != "", slug(label))] if label is not None else [])
    return F.concat_ws("__", *parts)


def session_id(folder, first_ts) -> Column:
    return F.concat(folder, F.lit("#"), F.date_format(first_ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def iso(ts) -> Column:
    """ISO form with offset; microseconds only if there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.concat(whole, F.when(micros > 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit("")), F.lit("+00:00"))


def stable_session_id(folder, first_ts) -> Column:
    return F.concat(folder, F.lit("#"), F.substring(F.sha1(F.concat(folder, F.lit("|"), iso(first_ts)).cast("binary")), 1, 10))


def _json_text(x) -> Column:
    """A string as JSON writes it; null is null."""
    return F.coalesce(F.regexp_extract(F.to_json(F.struct(x.cast("string").alias("v"))), r'(?s)^\{"v":(.*)\}$', 1), F.lit("null")) if x is not None else F.lit("null")


def sample_key(persona_id, context_turns, reference) -> Column:
    """Key of a prompt: the hash of a JSON object of context_turns (an array of from and value, or null), persona_id and reference, keys in order."""
    quoted = lambda x: F.when(x.isNull(), F.lit("null")).otherwise(_json_text(x))
    turn = lambda t: F.concat(F.lit('{"from": '), quoted(t["from"]), F.lit(', "value": '), quoted(t["value"]), F.lit("}"))
    turns = F.when(context_turns.isNull(), F.lit("null")).otherwise(F.concat(F.lit("["), F.array_join(F.transform(context_turns, turn), ", "), F.lit("]")))
    whole = F.concat(F.lit('{"context_turns": '), turns, F.lit(', "persona_id": '), _json_text(F.coalesce(persona_id, F.lit(""))), F.lit(', "reference": '), _json_text(F.coalesce(reference, F.lit(""))), F.lit("}"))
    return F.sha2(whole.cast("binary"), 256)


def stable_order(seed: int, *parts) -> Column:
    """A deterministic pseudo-random order that SQL engines share: the md5 of seed and parts."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))


def variant_id(path, source_index) -> Column:
    """Of a dump: the hash of its path and place."""
    return F.substring(F.sha2(F.concat_ws("#", path, source_index.cast("string")).cast("binary"), 256), 1, 12)


def comparison_id(paths) -> Column:
    """Of an array of dumps' paths, whatever their order."""
    return F.substring(F.sha2(F.array_join(F.array_sort(paths), "\n").cast("binary"), 256), 1, 20)


def group_key(kind, value) -> Column:
    return F.concat(kind, F.lit("\u001f"), value)


def bytes_label(n, largest: str = "GB") -> Column:
    """B, KB, MB or GB, whichever suits the size, but no unit beyond ``largest``."""
    n = n.cast("double")
    units = [("KB", 1024, 1), ("MB", 1024**2, 1), ("GB", 1024**3, 2)]
    units = units[: [u for u, _, _ in units].index(largest) + 1]
    shown = [F.format_string(f"%.{digits}f {unit}", F.bround(n / size, digits)) for unit, size, digits in units]
    out = F.when(n < 1024, F.concat(n.cast("long").cast("string"), F.lit(" B")))
    for label, (_, size, _) in zip(shown, units[1:]):
        out = out.when(n < size, label)
    return out.otherwise(shown[-1])


def display_label(alias, label, run, width: int = 24) -> Column:
    from .text import falsy, truncate_display

    return falsy(alias, label, truncate_display(run, width))
