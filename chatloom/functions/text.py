"""Text normalisation and measures, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What str.strip() strips of ASCII.
BLANK = " \t\n\r\f\u000b"

# Patterns of chat markup and personal data.
CUSTOM_EMOJI = r"<a?:([A-Za-z0-9_]+):\d+>"
MENTION = r"<@!?(\d+)>"
ROLE, CHANNEL, STAMP = r"<@&\d+>", r"<#\d+>", r"<t:\d+(?::[a-zA-Z])?>"
URL = r"(?i)https?://\S+"
EMAIL = r"\b[\w.%+-]+@[\w.-]+\.[A-Za-z]{2,}\b"
PHONE = r"(?:(?:\+?\d{1,3}[\s.-]?)?(?:\(\d{3}\)|\d{3})[\s.-]?\d{3}[\s.-]?\d{4})"
LONG_NUMBER = r"\b\d{13,19}\b"
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]"
SHORTCODE = r":[A-Za-z0-9_]+:"
WORD = r"[A-Za-z']+"
BOT_COMMAND = r"^[!?/][A-Za-z][\w-]*(?:\s|$)"


def falsy(*cols) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c if isinstance(c, Column) else F.col(c), F.lit("")) for c in cols])


def strip(x) -> Column:
    return F.btrim(x, F.lit(BLANK))


def rstrip(x) -> Column:
    return F.rtrim(x, F.lit(BLANK))


def strip_custom_emojis(x) -> Column:
    return F.regexp_replace(x, CUSTOM_EMOJI, ":$1:")


def replace_mentions(x, names) -> Column:
    """Every ``<@id>`` to @name by the map ``names``, or @user. The text is cut at the mentions and sewn up again."""
    x = F.coalesce(x if isinstance(x, Column) else F.col(x), F.lit(""))
    parts = F.split(x, MENTION, -1)
    ids = F.regexp_extract_all(x, F.lit(MENTION), F.lit(1))
    table = F.coalesce(names, F.create_map().cast("map<string,string>"))
    name = lambda i: F.coalesce(F.concat(F.lit("@"), F.try_element_at(table, i)), F.lit("@user"))
    sewn = F.zip_with(parts, ids, lambda p, i: F.when(i.isNull(), p).otherwise(F.concat(p, name(i))))
    return F.when(F.size(ids) == 0, x).otherwise(F.array_join(sewn, ""))


def strip_markup(x) -> Column:
    for pattern in (ROLE, CHANNEL, STAMP):
        x = F.regexp_replace(x, pattern, "")
    return x


def strip_urls(x) -> Column:
    return F.regexp_replace(x, URL, "")


def scrub_pii(x, unicode: bool = True) -> Column:
    """E-mail addresses, then phone numbers, then long numbers; the order decides what a long number becomes."""
    flag = "(?U)" if unicode else ""
    x = F.regexp_replace(x, flag + EMAIL, "[email]")
    x = F.regexp_replace(x, flag + PHONE, "[phone]")
    return F.regexp_replace(x, flag + LONG_NUMBER, "[num]")


def collapse_whitespace(x) -> Column:
    x = F.regexp_replace(x, "[ \\t\u00a0]+", " ")
    return strip(F.regexp_replace(x, r"\n{3,}", "\n\n"))


def normalize(x, names=None, url_strip: bool = False, pii_scrub: bool = True) -> Column:
    """Emoji, mentions, markup, links (if asked for), personal data (unless told not to), white space. Null is empty."""
    x = strip_custom_emojis(F.coalesce(x, F.lit("")))
    x = replace_mentions(x, names if names is not None else F.lit(None).cast("map<string,string>"))
    x = strip_markup(x)
    if url_strip:
        x = strip_urls(x)
    if pii_scrub:
        x = scrub_pii(x)
    return collapse_whitespace(x)


def split_words(x) -> Column:
    """Runs of what isn't white space."""
    return F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(r"(\S+)"), F.lit(1))


def word_count(x) -> Column:
    return F.regexp_count(F.coalesce(x, F.lit("")), F.lit(r"\S+"))


def let(value: Column, f) -> Column:
    """f of a value that is computed once, though lambdas in f use it for every element."""
    return F.element_at(F.transform(F.array(value), f), 1)


def grams(tokens: Column, n: int) -> Column:
    """Runs of n tokens, space-joined; an empty array if there are fewer."""
    return let(tokens, lambda t: _grams(t, n))


def _grams(tokens: Column, n: int) -> Column:
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def shingles(x, n: int = 5) -> Column:
    """The set of n-word shingles; of fewer words, all as one; of none, the empty set."""
    return let(split_words(F.lower(x)), lambda t: _shingles(t, n))


def _shingles(tokens: Column, n: int) -> Column:
    few = F.when(F.size(tokens) > 0, F.array(F.array_join(tokens, " "))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.when(F.size(tokens) >= n, _grams(tokens, n)).otherwise(few))


def style_words(x) -> Column:
    """Lower-case words of ASCII letters and apostrophes."""
    return F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))


def sentences(x) -> Column:
    return F.filter(F.transform(F.split(x, r"[\n.!?]+"), strip), lambda s: s != "")


def emoji_count(x) -> Column:
    return F.regexp_count(F.coalesce(x, F.lit("")), F.lit(EMOJI))


def shortcode_count(x) -> Column:
    return F.regexp_count(F.coalesce(x, F.lit("")), F.lit(SHORTCODE))


def lowercase_start(x) -> Column:
    return F.coalesce(x, F.lit("")).rlike(r"^\s*\p{Ll}")


def line_count(x) -> Column:
    x = F.coalesce(x, F.lit(""))
    return F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit(""))) + 1


def strip_space_marker(piece) -> Column:
    """A vocabulary piece without the marks of a leading space."""
    return F.regexp_replace(F.regexp_replace(piece, "^\u2581+", ""), "^\u0120+", "")


def readable(piece) -> Column:
    x = strip_space_marker(piece)
    return F.length(x).between(2, 24) & x.rlike(r"^(?U)[\p{L}\p{N}'_-]+$")


def shorten(x, n: int = 120) -> Column:
    """One line; beyond n characters, the first n-1 and three dots."""
    x = strip(F.replace(F.coalesce(x, F.lit("")), F.lit("\n"), F.lit(" ")))
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n - 1), F.lit("..."))).otherwise(x)


def truncate_display(x, limit: int) -> Column:
    return F.when(F.length(x) > limit, F.concat(F.substring(x, 1, limit - 1), F.lit("\u2026"))).otherwise(x)


def contains_any(x, fillers: Column) -> Column:
    """Whether a filler occurs in the lower-cased text, as a substring."""
    return let(F.lower(x), lambda low: F.exists(fillers, lambda f: F.contains(low, f)))


def as_float(x) -> Column:
    """A number, or null for what isn't one and for NaN."""
    v = x.try_cast("double")
    return F.when(~F.isnan(v), v)


def as_int(x) -> Column:
    """The nearest whole number, of two the even one; null for what isn't a number."""
    return F.bround(as_float(x)).try_cast("bigint")
