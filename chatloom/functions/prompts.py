"""System prompts and conversation rendering, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import falsy, rstrip, strip

#: Fillers where no profile says otherwise.
STYLE_FILLERS = ("lol", "ngl", "tbh", "fr", "lowkey", "bro")
START, END = "<|im_start|>", "<|im_end|>"


def system_prompt(persona, others: Column) -> Column:
    """Fixed wording of a sample's system line."""
    who = F.when(F.size(others) > 0, F.array_join(others, ", ")).otherwise(F.lit("someone"))
    return F.concat(F.lit("You are "), persona, F.lit(" chatting with "), who, F.lit(", continue the discord conversation."))


def header(persona, others=None, minimal=None) -> Column:
    who = F.coalesce(F.nullif(F.array_join(others, ", "), F.lit("")), F.lit("someone")) if others is not None else F.lit("someone")
    own = F.concat(F.lit("You are "), persona, F.lit(" chatting with "), who, F.lit(", continue the conversation."))
    return F.coalesce(rstrip(falsy(minimal)), own) if minimal is not None else own


def _tier(x, steps, last: str) -> Column:
    out = None
    for test, name in steps:
        out = F.when(test(x), F.lit(name)) if out is None else out.when(test(x), F.lit(name))
    return out.otherwise(F.lit(last))


def length_word(words) -> Column:
    le = lambda n: lambda x: x <= n
    return F.coalesce(_tier(words, [(lambda x: x.isNull(), "short"), (le(4), "ultra-brief"), (le(8), "very short"), (le(14), "short"), (le(24), "medium")], "long-form"))


def lowercase_word(rate) -> Column:
    ge = lambda n: lambda x: x >= n
    return _tier(rate, [(ge(0.85), "almost always"), (ge(0.65), "usually"), (ge(0.40), "about half the time"), (ge(0.20), "occasionally")], "rarely")


def emoji_word(total) -> Column:
    ge = lambda n: lambda x: x >= n
    return _tier(total, [(ge(0.80), "high"), (ge(0.35), "moderate"), (ge(0.12), "light"), (lambda x: x > 0, "rare")], "minimal")


def burst_word(rate) -> Column:
    ge = lambda n: lambda x: x >= n
    return _tier(rate, [(ge(2.40), "frequent multi-line bursts"), (ge(1.70), "regular multi-line bursts"), (ge(1.20), "occasional multi-line bursts")], "mostly single-line replies")


def _quoted(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.concat(F.lit('"'), w, F.lit('"'))), ", ")


def style_bullets(persona) -> Column:
    """Fixed wording of the generic style guidance."""
    fillers = ", ".join(f'"{f}"' for f in STYLE_FILLERS)
    text = (
        "\n\nMatch a casual Discord DM style:\n"
        "- Keep replies short: usually one sentence or a few words. When you do reply longer, burst several short lines separated "
        'by "\\n" rather than one paragraph.\n'
        "- Start messages lowercase. Minimal punctuation; typos and missing apostrophes are fine.\n"
        f"- Use informal fillers when they fit naturally ({fillers}); do not force them.\n"
        "- Natural emoji usage when the tone calls for it, including custom :shortcode: emotes.\n"
        '- No disclaimers, no "As an AI", no bullet lists or headings in the reply itself. Just the message body.\n'
    )
    return F.concat(F.lit(text + "- Reply only with "), persona, F.lit("'s next message. Do not narrate actions, repeat earlier turns, or include multiple speakers."))


def top_fillers(profile, n: int = 8, flat=None) -> Column:
    """1-gram fillers of a profile struct, lower-cased, the first n and of those the distinct ones.

    ``flat`` is an array of fillers from the older, flat form; it fills up what the profile lacks.
    """
    grams = F.coalesce(profile["top_fillers"]["1gram"]["token"], F.array().cast("array<string>"))
    words = grams if flat is None else F.concat(grams, F.coalesce(flat, F.array().cast("array<string>")))
    words = F.filter(F.transform(words, lambda t: F.lower(strip(t))), lambda t: F.coalesce(t, F.lit("")) != "")
    return F.array_distinct(F.slice(words, 1, n))


def profile_bullets(persona, profile, flat=None) -> Column:
    """Fixed wording of the guidance from a profile: struct of length, lowercase_start_rate, emoji, burst_rate and top_fillers, as
    ``operators.profiles.build_profiles`` returns them. What is null is left out."""
    length, emoji, low, burst = profile["length"], profile["emoji"], profile["lowercase_start_rate"], profile["burst_rate"]
    p50, p95 = F.bround(length["p50"].cast("double")).cast("int"), F.bround(length["p95"].cast("double")).cast("int")
    parts = F.concat_ws(
        ", ",
        F.concat(F.lit("~"), F.format_string("%.0f", F.bround(length["mean_words"])), F.lit(" words on average")),
        F.concat(F.lit("median "), p50.cast("string")),
        F.concat(F.lit("95th percentile "), p95.cast("string")),
    )
    known = top_fillers(profile, flat=flat)
    fillers = F.when(F.size(known) > 0, _quoted(known)).otherwise(_quoted(F.array(*map(F.lit, STYLE_FILLERS))))
    total = F.coalesce(emoji["unicode_per_turn"], F.lit(0.0)) + F.coalesce(emoji["custom_per_turn"], F.lit(0.0))
    density = F.concat_ws("; ", F.concat(F.format_string("%.2f", emoji["unicode_per_turn"]), F.lit(" unicode emoji/turn")), F.concat(F.format_string("%.2f", emoji["custom_per_turn"]), F.lit(" :custom: emotes/turn")))
    some = F.coalesce(emoji["unicode_per_turn"], emoji["custom_per_turn"]).isNotNull()
    return F.concat_ws(
        "\n",
        F.lit("\n"),
        F.concat(F.lit("Match "), persona, F.lit("'s documented writing style:")),
        F.when(parts != "", F.concat(F.lit("- Turn length: "), length_word(F.coalesce(p50.cast("double"), length["mean_words"])), F.lit(", "), parts, F.lit(". Keep replies at that scale; err short."))),
        F.when(low.isNotNull(), F.concat(F.lit("- Starts messages lowercase "), lowercase_word(low), F.lit(" (~"), F.bround(low * 100).cast("int").cast("string"), F.lit("% of the time). Capitalise only when the real person would."))),
        F.concat(F.lit("- Typical short fillers: "), fillers, F.lit(". Use when natural; do not force them.")),
        F.when(some, F.concat(F.lit("- Emoji density: "), emoji_word(total), F.lit(" ("), density, F.lit(")."))),
        F.when(burst > 1.05, F.concat(F.lit("- Message cadence: "), burst_word(burst), F.lit(" (~"), F.format_string("%.1f", burst), F.lit(' separate lines per turn); split bursts with "\\n".'))),
        F.lit('- No "As an AI", no disclaimers, no markdown headings, no bullet lists in the reply itself. Just the message body.'),
        F.concat(F.lit("- Reply only with "), persona, F.lit("'s next message. Do not narrate actions or repeat earlier turns.")),
    )


def baseline_prompt(mode: str, persona, others=None, minimal=None, profile=None, flat_fillers=None) -> Column:
    """minimal, style or profile; a null profile falls back to style."""
    if mode not in ("minimal", "style", "profile"):
        raise ValueError(f"unknown baseline prompt mode {mode!r}")
    head = header(persona, others, minimal)
    if mode == "minimal":
        return head
    generic = F.concat(head, style_bullets(persona))
    if mode == "style" or profile is None:
        return generic
    return F.when(profile.isNull(), generic).otherwise(F.concat(head, profile_bullets(persona, profile, flat_fillers)))


def role_lines(turns) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("["), F.coalesce(t["from"], F.lit("user")), F.lit("] "), F.coalesce(t["value"], F.lit("")))), "\n")


def user_prompt(context, turns) -> Column:
    """The context, if it isn't blank, else the turns as lines."""
    return F.coalesce(F.nullif(strip(F.coalesce(context, F.lit(""))), F.lit("")), role_lines(F.coalesce(turns, F.array())))


def sample_text(system, conversations) -> Column:
    """System (unless empty) and values, a line each."""
    return F.array_join(F.concat(F.array_compact(F.array(falsy(system))), F.transform(conversations, lambda t: F.coalesce(t["value"], F.lit("")))), "\n")


def chat_messages(system, conversations, strict: bool = True) -> Column:
    """Role and content; an unknown role raises, or becomes user if not strict."""
    bad = lambda t: F.raise_error(F.concat(F.lit("unknown role "), t["from"])).cast("string") if strict else F.lit("user")
    role = lambda t: F.when(t["from"].isin("user", "assistant", "system"), t["from"]).otherwise(bad(t))
    turns = F.transform(conversations, lambda t: F.struct(role(t).alias("role"), t["value"].alias("content")))
    head = F.when(falsy(system).isNotNull(), F.array(F.struct(F.lit("system").alias("role"), system.alias("content")))).otherwise(F.array().cast("array<struct<role:string,content:string>>"))
    return F.concat(head, turns)


def chatml(messages) -> Column:
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit(START), m["role"], F.lit("\n"), m["content"], F.lit(END + "\n"))), "")


def supervised_spans(text, user: str = START + "user\n", assistant: str = START + "assistant\n") -> Column:
    """Spans (start, length) that training learns from: after an assistant mark up to the next user mark or the end.

    The text is cut at user marks; in each piece it begins after the first assistant mark.
    """
    pieces = F.split(text, _literal(user), -1)
    folded = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p) + len(user)).alias("at"),
            F.when(F.instr(p, assistant) > 0, F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.instr(p, assistant) - 1 + len(assistant)).cast("int").alias("start"), (F.length(p) - F.instr(p, assistant) + 1 - len(assistant)).cast("int").alias("length"))))).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    return folded["spans"]


def _literal(s: str) -> str:
    return "\\Q" + s + "\\E"
