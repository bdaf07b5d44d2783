"""Registered queries over the test tables, each with the SQL that an independent engine can run.

The tables hold no chat exports, so events stand in for messages, conversations
for sessions and turns, documents for texts of personas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import prompts as P
from ..functions import text as T
from ..operators import balance, dedup, elo, evals, merge, messages, probe, profiles, sessionize, sft, status, stylometry, template, tokens
from . import curate

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# -- stand-ins ---------------------------------------------------------------------------------------------


def event_messages(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").filter("user_id is not null")
    kind = F.when(F.col("event_id") % 11 == 0, 6).when(F.col("event_id") % 7 == 0, 19).otherwise(0)
    m = e.select(
        F.col("event_id").cast("string").alias("id"), F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 10).cast("string").alias("folder"), F.col("user_id").cast("string").alias("author_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("author_name"), F.concat(F.when(F.col("event_id") % 13 == 0, "!").otherwise(""), "event_type", F.lit(" "), F.coalesce("props", F.lit(""))).alias("content"),
        kind.alias("type"), F.when(kind == 19, (F.col("event_id") - 1).cast("string")).alias("referenced_id"), F.when((kind == 19) & (F.col("event_id") % 3 != 0), F.col("event_type")).alias("reply_to_preview"),
        F.lit(None).cast("string").alias("reply_to_author_id"), F.lit(None).cast("string").alias("reply_to_author_name"), ((kind == 19) & (F.col("event_id") % 3 == 0)).alias("reply_to_missing"),
        F.array().cast("array<string>").alias("attachments"), F.lit(0).alias("num_embeds"), F.col("event_id").alias("seq"),
    )
    w = Window.partitionBy("folder").orderBy("ts", "id")
    return m.withColumn("seq", F.row_number().over(w).cast("long"))


MESSAGES = """m AS (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY ts, id) AS seq FROM (
  SELECT CAST(event_id AS VARCHAR) AS id, event_id, ts, CAST(user_id % 10 AS VARCHAR) AS folder, CAST(user_id AS VARCHAR) AS author_id, event_type,
    concat(CASE WHEN event_id % 13 = 0 THEN '!' ELSE '' END, event_type, ' ', coalesce(props, '')) AS content,
    CASE WHEN event_id % 11 = 0 THEN 6 WHEN event_id % 7 = 0 THEN 19 ELSE 0 END AS type FROM events WHERE user_id IS NOT NULL))"""


def turn_sql(merge_s: int, gap_s: int, source: str = "m") -> str:
    return f"""g AS (SELECT *, epoch_us(ts) - lag(epoch_us(ts)) OVER w AS dt, lag(author_id) OVER w AS pa FROM {source} WINDOW w AS (PARTITION BY folder ORDER BY seq)),
f AS (SELECT *, CASE WHEN pa = author_id AND dt BETWEEN 0 AND {merge_s * 1000000} THEN 0 ELSE 1 END AS nt FROM g),
s AS (SELECT *, CASE WHEN nt = 1 AND (dt IS NULL OR dt > {gap_s * 1000000}) THEN 1 ELSE 0 END AS ns FROM f),
x AS (SELECT *, sum(nt) OVER w AS turn_no, sum(ns) OVER w AS session_no FROM s WINDOW w AS (PARTITION BY folder ORDER BY seq ROWS UNBOUNDED PRECEDING)),
t AS (SELECT folder, session_no, turn_no, min_by(author_id, seq) AS author_id, min(epoch_us(ts)) AS start_us, max(epoch_us(ts)) AS end_us, count(*) AS n_messages, string_agg(content, chr(10) ORDER BY seq) AS text FROM x GROUP BY ALL)"""


def conversation_turns(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    at = F.timestamp_micros(F.col("turn").cast("long") * 1_000_000)
    return c.select(
        F.lit("c").alias("folder"), F.col("conv_id").cast("string").alias("session_id"), F.col("conv_id").alias("session_no"), F.col("turn").cast("int").alias("turn_idx"), F.col("role").alias("author_id"),
        F.col("role").alias("author_name"), at.alias("start_ts"), at.alias("end_ts"), F.coalesce("text", F.lit("")).alias("text"), F.array(F.concat_ws("-", "conv_id", "turn")).alias("source_ids"),
    ).withColumn("words", T.word_count("text"))


def persona_texts(spark: SparkSession, d: str, by: str = "source") -> DataFrame:
    return table(spark, d, "documents").select(F.col(by).alias("persona_id"), "text", F.col("doc_id").alias("seq"))


WORDS = r"regexp_extract_all(coalesce({}, ''), '\S+')"


# -- sessions ----------------------------------------------------------------------------------------------


def _micros(t: DataFrame) -> DataFrame:
    return t.select("folder", F.col("session_no").cast("long").alias("session_no"), F.col("turn_no").cast("long").alias("turn_no"), "author_id", F.unix_micros("start_ts").alias("start_us"), F.unix_micros("end_ts").alias("end_us"), F.size("source_ids").cast("long").alias("n_messages"))


@query(f"WITH {MESSAGES}, {turn_sql(1800, 3600)} SELECT folder, session_no::BIGINT AS session_no, count(*) AS n_turns, count(DISTINCT author_id) AS n_authors, min(start_us) AS first_us, max(end_us) AS last_us FROM t GROUP BY ALL")
def session_split(spark, d):
    t = sessionize.merged(sessionize.with_turns(event_messages(spark, d).withColumn("text", F.col("content")), 1800, 60))
    return t.groupBy("folder", F.col("session_no").cast("long").alias("session_no")).agg(F.count("*").alias("n_turns"), F.countDistinct("author_id").alias("n_authors"), F.min(F.unix_micros("start_ts")).alias("first_us"), F.max(F.unix_micros("end_ts")).alias("last_us"))


@query(f"WITH {MESSAGES}, {turn_sql(1800, 3600)} SELECT folder, session_no::BIGINT AS session_no, turn_no::BIGINT AS turn_no, author_id, start_us, end_us, n_messages FROM t")
def burst_turns(spark, d):
    return _micros(sessionize.merged(sessionize.with_turns(event_messages(spark, d).withColumn("text", F.col("content")), 1800, 60)))


_GATES = f"""{MESSAGES}, {turn_sql(1800, 3600)},
a AS (SELECT folder, session_no, author_id, count(*) AS n, sum(len({WORDS.format('text')})) AS words FROM t GROUP BY ALL),
z AS (SELECT folder, session_no, sum(n)::BIGINT AS n_turns, count(*) AS n_authors, sum(words)::BIGINT AS n_words, max(words)::DOUBLE / greatest(sum(words), 1)::DOUBLE AS share FROM a GROUP BY ALL),
r AS (SELECT *, CASE WHEN n_turns < 2 THEN 'short_session' WHEN n_authors < 2 THEN 'single_author' WHEN share > 0.5 THEN 'monologue' END AS drop_reason FROM z)"""


def _summaries(spark, d):
    t = sessionize.burst_merge(event_messages(spark, d).withColumn("text", F.col("content")), 1800, 60)
    return sessionize.session_summary(t).withColumn("drop_reason", sessionize.gate(2, 2, 0.5))


@query(f"WITH {_GATES} SELECT folder, session_no::BIGINT AS session_no, n_turns, n_authors, n_words, round(share, 6) AS top_share, drop_reason FROM r")
def session_gates(spark, d):
    return _summaries(spark, d).select("folder", F.col("session_no").cast("long").alias("session_no"), "n_turns", "n_authors", F.col("n_words").cast("long").alias("n_words"), F.round("top_share", 6).alias("top_share"), "drop_reason")


_FILTER = r"""CASE WHEN type NOT IN (0, 19) THEN 'system_type' WHEN type = 19 AND event_id % 3 = 0 THEN 'deleted_ref' WHEN regexp_matches(trim(content), '^[!?/][A-Za-z][A-Za-z0-9_-]*(\s|$)') THEN 'bot_command' END"""


_CURATED = f"""{MESSAGES}, fm AS (SELECT *, {_FILTER} AS drop_reason FROM m), km AS (SELECT * FROM fm WHERE drop_reason IS NULL), {turn_sql(1800, 3600, 'km')},
td AS (SELECT *, row_number() OVER (PARTITION BY folder, session_no, author_id, text ORDER BY turn_no) > 1 AS dup FROM t),
a AS (SELECT folder, session_no, author_id, count(*) AS n, sum(len({WORDS.format('text')})) AS words FROM td WHERE NOT dup GROUP BY ALL),
z AS (SELECT folder, session_no, sum(n)::BIGINT AS n_turns, count(*) AS n_authors, max(words)::DOUBLE / greatest(sum(words), 1)::DOUBLE AS share FROM a GROUP BY ALL),
r AS (SELECT *, CASE WHEN n_turns < 2 THEN 'short_session' WHEN n_authors < 2 THEN 'single_author' WHEN share > 0.5 THEN 'monologue' END AS drop_reason FROM z)"""
_N = "count(*) FILTER (WHERE drop_reason = '{0}') AS dropped_{0}"


@query(f"""WITH {_CURATED}, mx AS (SELECT count(*) AS messages_in, {', '.join(_N.format(k) for k in ('system_type', 'deleted_ref', 'bot_command', 'empty'))} FROM fm),
ty AS (SELECT count(*) FILTER (WHERE dup) AS dropped_exact_turn_dup, count(*) AS turns_built FROM td),
sv AS (SELECT count(*) AS sessions_built, {', '.join(_N.format(k) for k in ('short_session', 'single_author', 'monologue', 'lang', 'near_dup'))}, count(*) FILTER (WHERE drop_reason IS NULL) AS sessions_kept FROM r) SELECT * FROM mx, ty, sv""")
def curate_report(spark, d):
    m = event_messages(spark, d).withColumns({"text": F.col("content"), "drop_reason": messages.drop_reason()})
    return curate.from_normalized(m, curate.Options(1800, 60, monologue_max_share=0.5, near_dedup_threshold=None)).report




@query(f"WITH {MESSAGES} SELECT id, {_FILTER} AS drop_reason FROM m")
def bot_and_type_filter(spark, d):
    return event_messages(spark, d).select("id", messages.drop_reason().alias("drop_reason"))


@query(f"""WITH {MESSAGES}, k AS (SELECT *, lag(id) OVER (PARTITION BY folder ORDER BY seq) AS before FROM (SELECT *, {_FILTER} AS drop_reason FROM m) WHERE drop_reason IS NULL)
SELECT id, CASE WHEN type = 19 AND before IS DISTINCT FROM CAST(event_id - 1 AS VARCHAR) THEN concat('> user: ', event_type, chr(10)) ELSE '' END AS prefix FROM k""")
def reply_prev_lag(spark, d):
    m = messages.with_reply_prefix(event_messages(spark, d).withColumn("drop_reason", messages.drop_reason()))
    return m.filter("drop_reason is null").select("id", "prefix")


@query(f"WITH {MESSAGES} SELECT folder, author_id AS id, concat('u', author_id) AS name FROM m GROUP BY ALL")
def mention_table(spark, d):
    return messages.mention_table(event_messages(spark, d)).select("folder", "id", "name")


_DUP = "SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn) AS r FROM conversations"


@query(f"SELECT CAST(conv_id AS VARCHAR) AS session_id, count(*) FILTER (WHERE r <= 1) AS kept_1, count(*) FILTER (WHERE r <= 2) AS kept_2 FROM ({_DUP}) GROUP BY ALL")
def exact_turn_dedup(spark, d):
    t = conversation_turns(spark, d)
    one, two = sessionize.dedup_exact_turns(t, 1), sessionize.dedup_exact_turns(t, 2)
    c = lambda x, n: x.groupBy("session_id").agg(F.count_if(~F.col("dup")).alias(n))
    return c(one, "kept_1").join(c(two, "kept_2"), "session_id")


# -- text --------------------------------------------------------------------------------------------------

_PII = r"""regexp_replace(regexp_replace(regexp_replace({}, '\b[A-Za-z0-9_.%+-]+@[A-Za-z0-9_.-]+\.[A-Za-z]{{2,}}\b', '[email]', 'g'), '((\+?[0-9]{{1,3}}[ \t\n.-]?)?(\([0-9]{{3}}\)|[0-9]{{3}})[ \t\n.-]?[0-9]{{3}}[ \t\n.-]?[0-9]{{4}})', '[phone]', 'g'), '\b[0-9]{{13,19}}\b', '[num]', 'g')"""


@query(f"SELECT doc_id, md5({_PII.format('text')}) AS scrubbed FROM documents")
def pii_scrub(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.scrub_pii(F.col("text"), unicode=False).cast("binary")).alias("scrubbed"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))) AS collapsed FROM documents")
def normalize_ws(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.collapse_whitespace(F.col("text")).cast("binary")).alias("collapsed"))


@query(r"SELECT event_id, regexp_replace(concat('<a:', event_type, ':', CAST(event_id AS VARCHAR), '> x'), '<a?:([A-Za-z0-9_]+):[0-9]+>', ':\1:', 'g') AS text FROM events")
def custom_emoji(spark, d):
    x = F.concat(F.lit("<a:"), "event_type", F.lit(":"), F.col("event_id").cast("string"), F.lit("> x"))
    return table(spark, d, "events").select("event_id", T.strip_custom_emojis(x).alias("text"))


@query("SELECT event_id, CASE WHEN user_id % 2 = 0 THEN concat('hi @n', CAST(user_id AS VARCHAR), ' and @user!') ELSE 'hi @user and @user!' END AS text FROM events WHERE user_id IS NOT NULL")
def replace_mentions(spark, d):
    e = table(spark, d, "events").filter("user_id is not null")
    u = F.col("user_id").cast("string")
    names = F.when(F.col("user_id") % 2 == 0, F.create_map(u, F.concat(F.lit("n"), u))).otherwise(F.create_map(F.lit("x"), F.lit("y")))
    return e.select("event_id", T.replace_mentions(F.concat(F.lit("hi <@"), u, F.lit("> and <@!999999999>!")), names).alias("text"))


@query(f"SELECT doc_id, CAST(len({WORDS.format('text')}) AS BIGINT) AS words FROM documents")
def word_counts(spark, d):
    return table(spark, d, "documents").select("doc_id", T.word_count("text").cast("long").alias("words"))


# -- near-duplicates ---------------------------------------------------------------------------------------

_SETS = f"""w AS (SELECT doc_id AS id, lang AS scope, regexp_extract_all(lower(text), '\\S+') AS w FROM documents),
s0 AS (SELECT DISTINCT scope, id, array_to_string(list_slice(w, i, i + 4), ' ') AS x FROM (SELECT scope, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
k AS (SELECT scope, id, md5(string_agg(x, '|' ORDER BY x)) AS digest, count(*) AS size FROM s0 GROUP BY ALL),
members AS (SELECT scope, id, size, min(id) OVER (PARTITION BY scope, digest) AS rep FROM k),
s AS (SELECT s0.* FROM s0 JOIN members m ON s0.id = m.id AND s0.scope = m.scope WHERE m.id = m.rep),
n AS (SELECT scope, id, size FROM members WHERE id = rep),
c AS (SELECT p.scope, p.id AS a, q.id AS b, count(*) AS common FROM s p JOIN s q ON p.scope = q.scope AND p.x = q.x AND p.id < q.id GROUP BY ALL),
pairs AS (SELECT c.scope, a, b, common, na.size + nb.size - common AS total FROM c JOIN n na ON na.id = a AND na.scope = c.scope JOIN n nb ON nb.id = b AND nb.scope = c.scope WHERE common::DOUBLE / (na.size + nb.size - common)::DOUBLE >= 0.85)"""


def _doc_texts(spark, d):
    t = table(spark, d, "documents")
    return t.select(F.col("lang").alias("scope"), F.col("doc_id").alias("id"), "text", T.word_count("text").alias("priority"))


@query(f"WITH {_SETS} SELECT scope, a, b, common, total FROM pairs")
def shingle_jaccard_pairs(spark, d):
    p = dedup.similar_pairs(_doc_texts(spark, d), 0.85)
    return p.select("scope", "a", "b", F.col("common").cast("long").alias("common"), F.col("union").cast("long").alias("total"))


@query(f"WITH {_SETS} SELECT scope, id, rep FROM members")
def shingle_classes(spark, d):
    return dedup.shingle_classes(_doc_texts(spark, d))[0].select("scope", "id", "rep")


# The greedy choice, class by class in order: a list of who is kept grows, and a class joins it if no similar one is in it.
@query(f"""WITH RECURSIVE {_SETS}, p AS (SELECT doc_id AS id, CAST(len({WORDS.format('text')}) AS BIGINT) AS priority FROM documents),
f AS (SELECT m.scope, m.rep, m.id, row_number() OVER (PARTITION BY m.scope, m.rep ORDER BY p.priority DESC, m.id) AS place, p.priority FROM members m JOIN p ON p.id = m.id),
o AS (SELECT scope, rep, row_number() OVER (ORDER BY priority DESC, id) AS i FROM f WHERE place = 1 AND (rep IN (SELECT a FROM pairs) OR rep IN (SELECT b FROM pairs))),
e AS (SELECT o.i, o.rep, list(CASE WHEN pairs.a = o.rep THEN pairs.b ELSE pairs.a END) AS others FROM o JOIN pairs ON pairs.a = o.rep OR pairs.b = o.rep GROUP BY ALL),
g AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS kept UNION ALL SELECT e.i, CASE WHEN len(list_intersect(g.kept, e.others)) = 0 THEN list_append(g.kept, e.rep) ELSE g.kept END FROM g JOIN e ON e.i = g.i + 1),
z AS (SELECT kept FROM g ORDER BY i DESC LIMIT 1)
SELECT d.lang AS scope, d.doc_id AS id, coalesce(f.place = 1 AND (f.rep NOT IN (SELECT rep FROM e) OR list_contains((SELECT kept FROM z), f.rep)), true) AS kept FROM documents d LEFT JOIN f ON f.id = d.doc_id""")
def near_dup_keep(spark, d):
    return dedup.near_dedup(_doc_texts(spark, d), 0.85).select("scope", "id", "kept")


# -- samples -----------------------------------------------------------------------------------------------


def _starts(persona: str) -> str:
    return f"""
e{persona} AS (SELECT conv_id, max(turn) AS last FROM conversations WHERE role = '{persona}' GROUP BY ALL),
b{persona} AS (SELECT c.conv_id, e.last, c.turn AS st, c.role = '{persona}' AS mine,
   coalesce(sum(CASE WHEN c.role = '{persona}' THEN 1 ELSE 0 END) OVER w, 0) AS z,
   CASE WHEN (c.role = '{persona}') <> (lead(c.role) OVER (PARTITION BY c.conv_id ORDER BY c.turn) = '{persona}') AND c.turn < e.last THEN 1 ELSE 0 END AS ch
   FROM conversations c JOIN e{persona} e ON c.conv_id = e.conv_id AND c.turn <= e.last AND c.turn > e.last - 16 WINDOW w AS (PARTITION BY c.conv_id ORDER BY c.turn)),
k{persona} AS (SELECT *, sum(ch) OVER (PARTITION BY conv_id ORDER BY st DESC ROWS UNBOUNDED PRECEDING) + 1 - CASE WHEN mine THEN 1 ELSE 0 END AS blocks FROM b{persona}),
r{persona} AS (SELECT CAST(conv_id AS VARCHAR) AS session_id, '{persona}' AS persona_id, last AS end_idx, min(st) FILTER (WHERE blocks <= 8) AS start_idx, max(blocks) FILTER (WHERE blocks <= 8) AS blocks FROM k{persona} GROUP BY ALL)"""


@query("WITH " + ",".join(_starts(p).strip() for p in ("user", "assistant", "system")) + " SELECT session_id, persona_id, CAST(end_idx AS BIGINT) AS end_idx, CAST(start_idx AS BIGINT) AS start_idx, CAST(blocks AS BIGINT) AS blocks FROM (SELECT * FROM ruser UNION ALL SELECT * FROM rassistant UNION ALL SELECT * FROM rsystem) WHERE start_idx IS NOT NULL AND blocks >= 2")
def sft_windows(spark, d):
    w = sft.windows(conversation_turns(spark, d))
    return w.select("session_id", "persona_id", F.col("end_idx").cast("long").alias("end_idx"), F.col("start_idx").cast("long").alias("start_idx"), F.col("blocks").cast("long").alias("blocks"))


@query("SELECT role AS persona_id, upper(role) AS persona_name, count(DISTINCT conv_id) AS n_sessions, count(*) AS n_samples FROM conversations GROUP BY ALL")
def persona_counts(spark, d):
    meta = F.struct(F.col("author_id").alias("persona_id"), F.upper("author_name").alias("persona_name"), "session_id", F.lit("").alias("first_ts"))
    return sft.perspective_counts(conversation_turns(spark, d).select(meta.alias("meta"))).select("persona_id", "persona_name", "n_sessions", "n_samples")


@query(f"WITH n AS (SELECT len({WORDS.format('text')}) % 5 AS k FROM conversations) SELECT CASE WHEN k = 4 THEN 'other' ELSE CAST(k AS VARCHAR) END AS num_turns, count(*) AS n FROM n GROUP BY ALL")
def turn_hist(spark, d):
    k = F.col("words") % 5
    return balance.turn_histogram(conversation_turns(spark, d).withColumn("num_turns", F.when(k != 4, k)))


def _balance_rows(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("key"), F.col("o_custkey").cast("string").alias("session"), F.col("o_orderpriority").alias("persona"), (F.col("o_orderkey") % 5 * 2).alias("num_turns"))


_BALANCE = "b AS (SELECT o_orderkey AS key, CAST(o_custkey AS VARCHAR) AS session, o_orderpriority AS persona, o_orderkey % 5 * 2 AS num_turns FROM orders)"
_ROBIN = "SELECT *, row_number() OVER (PARTITION BY {g}, session ORDER BY md5('0|' || CAST(key AS VARCHAR)), key) AS turn_no, md5('0|' || session) AS sh FROM {t}"


@query(f"WITH {_BALANCE} SELECT CAST(round_even(median(n) * 0.9, 0) AS BIGINT) AS cap FROM (SELECT persona, count(*) AS n FROM b GROUP BY ALL)")
def balance_caps(spark, d):
    return balance.cap_of(_balance_rows(spark, d).groupBy("persona").agg(F.count("*").alias("n")), "median", 0.9)


@query(f"WITH {_BALANCE}, r AS ({_ROBIN.format(g='persona', t='b')}), k AS (SELECT *, row_number() OVER (PARTITION BY persona ORDER BY turn_no, sh, session) AS rk FROM r) SELECT key, session, persona FROM k WHERE rk <= 200")
def stratified_sample(spark, d):
    return balance.balance(_balance_rows(spark, d), "cap:200").select("key", "session", "persona")


@query(f"""WITH {_BALANCE}, w AS (SELECT num_turns, CASE WHEN num_turns IN (2, 4, 6, 8) THEN 0.25 END AS w, count(*) AS n FROM b GROUP BY ALL), al AS (SELECT min(n / w) AS alpha FROM w WHERE w IS NOT NULL),
r AS ({_ROBIN.format(g='num_turns', t='b')}), k AS (SELECT *, row_number() OVER (PARTITION BY num_turns ORDER BY turn_no, sh, session) AS rk FROM r)
SELECT key, num_turns FROM k, al WHERE num_turns NOT IN (2, 4, 6, 8) OR rk <= floor(alpha * 0.25 + 1e-9)""")
def turn_mix(spark, d):
    return balance.balance_turns(_balance_rows(spark, d), "uniform").select("key", "num_turns")


_SPLIT = f"{_BALANCE}, v AS (SELECT session, row_number() OVER (ORDER BY md5('0|' || session), session) AS rk, count(*) OVER () AS n FROM (SELECT DISTINCT session FROM b)), sp AS (SELECT session, CASE WHEN rk <= greatest(1, floor(n * 0.1)) THEN 'val' ELSE 'train' END AS split FROM v)"


@query(f"WITH {_SPLIT} SELECT key, split FROM b JOIN sp USING (session)")
def train_val_split(spark, d):
    return balance.split(_balance_rows(spark, d), 0.1).select("key", "split")


@query(f"WITH {_SPLIT}, c AS (SELECT split, CAST(num_turns AS VARCHAR) AS num_turns, count(*) AS n FROM b JOIN sp USING (session) GROUP BY ALL) SELECT split, num_turns, n, round(n::DOUBLE / (sum(n) OVER (PARTITION BY split))::DOUBLE, 6) AS fraction FROM c")
def split_breakdown(spark, d):
    return balance.split_breakdown(balance.split(_balance_rows(spark, d), 0.1))


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def split_semi(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def split_anti(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti").select("doc_id")


# -- tokens ------------------------------------------------------------------------------------------------

_TOK = f"k AS (SELECT coalesce(source, 'unknown') AS persona_id, CAST(len({WORDS.format('text')}) AS BIGINT) AS tokens FROM documents)"


def _tokens(spark, d):
    return table(spark, d, "documents").select(F.coalesce("source", F.lit("unknown")).alias("persona_id"), T.word_count("text").cast("long").alias("tokens"))


@query(f"WITH {_TOK} SELECT count(*) AS n, CAST(sum(tokens) AS BIGINT) AS total, round(avg(tokens), 6) AS mean, round(quantile_cont(tokens, 0.5), 6) AS p50, round(quantile_cont(tokens, 0.95), 6) AS p95, round(quantile_cont(tokens, 0.99), 6) AS p99, max(tokens) AS max FROM k")
def token_stats(spark, d):
    s = tokens.token_stats(_tokens(spark, d))
    return s.select("n", "total", *[F.round(c, 6).alias(c) for c in ("mean", "p50", "p95", "p99")], "max")


@query(f"WITH {_TOK} SELECT persona_id, CAST(sum(tokens) AS BIGINT) AS tokens, count(*) AS samples FROM k GROUP BY ALL")
def tokens_by_persona(spark, d):
    return tokens.tokens_by_persona(_tokens(spark, d))


def _vocab(spark, d):
    words = lambda t: t.select(F.explode(T.style_words(F.col("text"))).alias("token")).distinct()
    return words(table(spark, d, "documents")), words(table(spark, d, "benchmark"))


_VOC = "a AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[A-Za-z'']+')) AS token FROM documents), b AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[A-Za-z'']+')) AS token FROM benchmark)"


@query(f"WITH {_VOC}, j AS (SELECT a.token AS x, b.token AS y FROM a FULL JOIN b ON a.token = b.token) SELECT 'a' AS a, 'b' AS b, count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS n_common, count(*) AS n_union, count(*) FILTER (WHERE y IS NULL) AS n_only_a, count(*) FILTER (WHERE x IS NULL) AS n_only_b, round((count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL))::DOUBLE / count(*)::DOUBLE, 6) AS jaccard FROM j")
def vocab_overlap(spark, d):
    a, b = _vocab(spark, d)
    v = tokens.vocab_overlap(a.withColumn("name", F.lit("a")).unionByName(b.withColumn("name", F.lit("b"))))
    return v.withColumn("jaccard", F.round("jaccard", 6))


@query(f"WITH {_VOC} SELECT token FROM b WHERE token NOT IN (SELECT token FROM a) AND length(token) BETWEEN 2 AND 24 ORDER BY length(token), lower(token), token LIMIT 50")
def unique_tokens(spark, d):
    a, b = _vocab(spark, d)
    return tokens.unique_tokens(b, a).select("token")


@query(f"WITH {_VOC}, i AS (SELECT token FROM a INTERSECT SELECT token FROM b), u AS (SELECT token FROM a UNION SELECT token FROM b), x AS (SELECT token FROM a EXCEPT SELECT token FROM b) SELECT (SELECT count(*) FROM i) AS n_intersect, (SELECT count(*) FROM u) AS n_union, (SELECT count(*) FROM x) AS n_except")
def set_ops(spark, d):
    a, b = _vocab(spark, d)
    one = lambda x, n: x.agg(F.count("*").alias(n))
    return one(a.intersect(b), "n_intersect").join(one(a.union(b).distinct(), "n_union"), F.lit(True)).join(one(a.subtract(b), "n_except"), F.lit(True))


# -- profiles ----------------------------------------------------------------------------------------------

_LEN = f"l AS (SELECT source AS persona_id, len({WORDS.format('text')}) AS w FROM documents), q AS (SELECT persona_id, count(*) AS n, avg(w) AS mean_words, CAST(trunc(median(w)) AS INTEGER) AS p50, list_sort(list(w)) AS ws FROM l WHERE w > 0 GROUP BY ALL)"


@query(f"WITH {_LEN} SELECT persona_id, n, round(mean_words, 6) AS mean_words, p50, CAST(ws[CAST(greatest(1, n * 95 // 100) AS INTEGER)] AS INTEGER) AS p95 FROM q")
def length_stats(spark, d):
    return profiles.length_stats(persona_texts(spark, d)).withColumn("mean_words", F.round("mean_words", 6))


@query(r"""SELECT source AS persona_id, round(coalesce(avg(CASE WHEN text <> '' THEN CASE WHEN regexp_matches(text, '^\s*\p{Ll}') THEN 1.0 ELSE 0.0 END END), 0), 6) AS lowercase_start_rate,
round(avg(len(regexp_extract_all(coalesce(text, ''), '[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]'))), 6) AS unicode_per_turn, round(avg(len(regexp_extract_all(coalesce(text, ''), ':[A-Za-z0-9_]+:'))), 6) AS custom_per_turn, round(sum(CASE WHEN text <> '' THEN length(text) - length(replace(text, chr(10), '')) + 1 ELSE 0 END)::DOUBLE / count(*)::DOUBLE, 6) AS burst_size FROM documents GROUP BY ALL""")
def style_rates(spark, d):
    s = profiles.style_rates(persona_texts(spark, d))
    return s.select("persona_id", *[F.round(c, 6).alias(c) for c in ("lowercase_start_rate", "unicode_per_turn", "custom_per_turn", "burst_size")])


_GRAM = "t AS (SELECT doc_id, lang AS persona_id, regexp_extract_all(lower(text), '[A-Za-z'']+') AS w FROM documents), g AS (SELECT persona_id, array_to_string(list_slice(w, i, i + 1), ' ') AS token FROM (SELECT persona_id, w, unnest(range(1, len(w))) AS i FROM t WHERE len(w) >= 2)), c AS (SELECT persona_id, token, count(*) AS yp FROM g GROUP BY ALL)"


@query(f"WITH {_GRAM} SELECT persona_id, token, yp AS count FROM c")
def ngram_counts(spark, d):
    return profiles.ngram_counts(persona_texts(spark, d, "lang"), 2)


@query(f"""WITH {_GRAM}, e AS (SELECT token, sum(yp) AS yg FROM c GROUP BY ALL), k AS (SELECT count(*) AS v, sum(yg) AS ng FROM e), p AS (SELECT persona_id, sum(yp) AS np FROM c GROUP BY ALL),
j AS (SELECT c.persona_id, c.token, yp::DOUBLE AS yp, greatest(yg - yp, 0)::DOUBLE AS yn, np::DOUBLE AS np, ng::DOUBLE - np::DOUBLE AS nn, 0.01 * v::DOUBLE AS a0 FROM c JOIN e USING (token) JOIN p USING (persona_id), k WHERE yp >= 3),
z AS (SELECT persona_id, token, CAST(yp AS BIGINT) AS count, (ln((yp + 0.01) / (np + a0 - yp - 0.01)) - ln((yn + 0.01) / (nn + a0 - yn - 0.01))) / sqrt(1 / (yp + 0.01) + 1 / greatest(yn + 0.01, 1e-9)) AS z FROM j WHERE np + a0 - yp - 0.01 > 0 AND nn + a0 - yn - 0.01 > 0)
SELECT persona_id, token, count, round(z, 4) AS z FROM (SELECT *, row_number() OVER (PARTITION BY persona_id ORDER BY z DESC, token) AS rk FROM z) WHERE rk <= 10""")
def log_odds_top(spark, d):
    t = profiles.characteristic(persona_texts(spark, d, "lang"), 2, top_k=10)
    return t.select("persona_id", "token", F.col("count").cast("long").alias("count"), F.round("z", 4).alias("z"))


_HEUR = """h AS (SELECT source AS persona_id, trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) AS g, trim(concat(lang, ' ', text, ' ', source), ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) AS r FROM documents)"""


@query(f"""WITH {_HEUR} SELECT persona_id, count(*) AS n, round(abs(avg(CASE WHEN g <> '' THEN len({WORDS.format('g')}) END) - avg(CASE WHEN r <> '' THEN len({WORDS.format('r')}) END)), 6) AS avg_length_diff,
round(avg(CASE WHEN contains(g, '!') THEN 1.0 ELSE 0.0 END), 6) AS exclamation_rate, round(avg(CASE WHEN g <> '' THEN CASE WHEN regexp_matches(g, '^\\p{{Lu}}') THEN 1.0 ELSE 0.0 END END), 6) AS caps_rate,
round(avg(CASE WHEN contains(lower(g), 'lol') OR contains(lower(g), 'bro') OR contains(lower(g), 'ngl') OR contains(lower(g), 'tbh') OR contains(lower(g), 'fr') OR contains(lower(g), 'lowkey') THEN 1.0 ELSE 0.0 END), 6) AS filler_rate FROM h GROUP BY ALL""")
def style_heuristics(spark, d):
    t = table(spark, d, "documents").select(F.col("source").alias("persona_id"), F.col("text").alias("generated"), F.concat(F.coalesce("lang", F.lit("")), F.lit(" "), F.coalesce("text", F.lit("")), F.lit(" "), F.coalesce("source", F.lit(""))).alias("reference"))
    h = profiles.style_heuristics(t)
    return h.select("persona_id", "n", *[F.round(c, 6).alias(c) for c in ("avg_length_diff", "exclamation_rate", "caps_rate", "filler_rate")])


@query(f"""WITH l AS (SELECT source AS persona_id, (doc_id // 20) % 2 AS half, len({WORDS.format('text')}) AS w FROM documents), a AS (SELECT persona_id, avg(w) AS m, count(*) AS n FROM l WHERE w > 0 AND half = 0 GROUP BY ALL), b AS (SELECT persona_id, avg(w) AS m FROM l WHERE w > 0 AND half = 1 GROUP BY ALL)
SELECT a.persona_id, a.n AS n_generated, round(abs(a.m - b.m), 6) AS mean_words_delta, round(b.m, 6) AS profile_mean_words FROM a JOIN b USING (persona_id)""")
def profile_drift(spark, d):
    t = persona_texts(spark, d).filter("text <> ''")
    p = profiles.build_profiles(t.filter("(seq div 20) % 2 = 1"), top_k=5, sizes=(1,))
    x = profiles.drift(t.filter("(seq div 20) % 2 = 0").withColumn("persona_name", F.lit("")), p).filter("warning is null")
    return x.select("persona_id", "n_generated", F.round("mean_words_delta", 6).alias("mean_words_delta"), F.round("profile_mean_words", 6).alias("profile_mean_words"))


_STYLE = r"""t AS (SELECT doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) AS t FROM documents), w AS (SELECT doc_id, t, regexp_extract_all(lower(t), '[A-Za-z'']+') AS w, list_filter(list_transform(regexp_split_to_array(t, '[\n.!?]+'), lambda s: trim(s, ' ' || chr(9) || chr(10) || chr(13))), lambda s: s <> '') AS s FROM t)"""


@query(f"""WITH {_STYLE} SELECT doc_id, round(CASE WHEN len(s) > 0 THEN list_sum(list_transform(s, lambda x: len(regexp_extract_all(lower(x), '[A-Za-z'']+'))))::DOUBLE / len(s)::DOUBLE ELSE 0 END, 6) AS avg_sentence_len,
round(CASE WHEN len(w) > 0 THEN list_sum(list_transform(w, lambda x: length(x)))::DOUBLE / len(w)::DOUBLE ELSE 0 END, 6) AS avg_word_len,
round((length(t) - length(replace(t, ',', '')))::DOUBLE / greatest(length(t), 1)::DOUBLE, 6) AS punct_comma,
round(CASE WHEN len(w) > 1 THEN 1.0 - len(list_distinct(w))::DOUBLE / len(w)::DOUBLE ELSE 0 END, 6) AS word_repeat_rate FROM w""")
def stylometry_features(spark, d):
    x = stylometry.features(table(spark, d, "documents").select("doc_id", "text"))
    return x.select("doc_id", *[F.round(c, 6).alias(c) for c in ("avg_sentence_len", "avg_word_len", "punct_comma", "word_repeat_rate")])


@query("""WITH u AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings), c AS (SELECT label, i, avg(v) AS m FROM u GROUP BY ALL),
j AS (SELECT vec_id, u.label, sum(v * m) AS dot, sqrt(sum(v * v)) AS a, sqrt(sum(m * m)) AS b FROM u JOIN c ON u.label = c.label AND u.i = c.i GROUP BY ALL) SELECT vec_id, round(CASE WHEN a * b = 0 THEN 0 ELSE dot / (a * b) END, 5) AS similarity FROM j""")
def cosine_centroid(spark, d):
    e = table(spark, d, "embeddings")
    x = e.select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    c = x.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m")))["m"].alias("center"))
    return e.join(c, "label").select("vec_id", F.round(stylometry.cosine(F.col("embedding"), F.col("center")), 5).alias("similarity"))


# -- runs --------------------------------------------------------------------------------------------------

_SCORES = "s AS (SELECT CAST(user_id % 4 AS VARCHAR) AS run_id, event_type AS metric, avg(value) AS value FROM events GROUP BY ALL)"


def _scores(spark, d):
    e = table(spark, d, "events")
    return e.groupBy((F.col("user_id") % 4).cast("string").alias("run_id"), F.col("event_type").alias("metric")).agg(F.avg("value").alias("value"))


@query(f"""WITH {_SCORES}, p AS (SELECT metric, max(value) FILTER (WHERE run_id = '0') AS v0, max(value) FILTER (WHERE run_id = '1') AS v1, max(value) FILTER (WHERE run_id = '2') AS v2 FROM s GROUP BY ALL)
SELECT metric, round(v0, 6) AS value_0, round(v1, 6) AS value_1, round(v2, 6) AS value_2, round(v1 - v0, 6) AS delta_1, round(v2 - v0, 6) AS delta_2, round((v0 - v1) / nullif(v0, 0), 6) AS forgetting_1, round((v0 - v2) / nullif(v0, 0), 6) AS forgetting_2 FROM p""")
def runs_compare(spark, d):
    c = evals.compare_runs(_scores(spark, d), ["0", "1", "2"], "0")
    return c.select("metric", *[F.round(x, 6).alias(x) for x in ("value_0", "value_1", "value_2", "delta_1", "delta_2", "forgetting_1", "forgetting_2")])


@query(f"WITH {_SCORES} SELECT metric, round(stddev_pop(value), 6) AS spread FROM s GROUP BY metric ORDER BY stddev_pop(value) DESC, metric LIMIT 3")
def top_delta_metrics(spark, d):
    return evals.top_by_spread(_scores(spark, d), 3).select("metric", F.round("spread", 6).alias("spread"))


@query(f"WITH {_SCORES} SELECT run_id, metric, round(value, 6) AS value FROM s WHERE metric LIKE 'c%' OR metric LIKE 'p%'")
def metric_globs(spark, d):
    return evals.match_metrics(_scores(spark, d), ["c*", "p*"]).select("run_id", "metric", F.round("value", 6).alias("value"))


@query("WITH s AS (SELECT CAST(user_id % 4 AS VARCHAR) AS run_id, event_type AS metric, strftime(ts, '%Y-%m') AS created_utc, avg(value) AS value FROM events GROUP BY ALL) SELECT created_utc, run_id, round(max(value) FILTER (WHERE metric = 'click'), 6) AS click, round(max(value) FILTER (WHERE metric = 'view'), 6) AS view FROM s WHERE metric IN ('click', 'view') GROUP BY ALL")
def timeline_pivot(spark, d):
    e = table(spark, d, "events")
    month = F.date_format("ts", "yyyy-MM")
    s = e.groupBy((F.col("user_id") % 4).cast("string").alias("run"), F.col("event_type").alias("metric"), month.alias("created_utc")).agg(F.avg("value").alias("value")).withColumn("run_id", F.concat_ws("@", "created_utc", "run"))
    p = evals.timeline(s.select("run_id", "metric", "value"), s.select("run_id", "created_utc").distinct(), ["click", "view"])
    run = F.nullif(F.substring_index("run_id", "@", -1), F.col("created_utc"))
    return p.select("created_utc", run.alias("run_id"), F.round("click", 6).alias("click"), F.round("view", 6).alias("view"))


def _dumps(spark, d):
    e = table(spark, d, "events")
    return e.select((F.col("event_id") % 3).alias("source"), F.concat_ws("-", "user_id", "event_type").alias("key"), F.col("event_id").alias("place"), F.round("value", 6).alias("generated"))


@query("""WITH e AS (SELECT event_id % 3 AS source, concat(CAST(user_id AS VARCHAR), '-', event_type) AS key, event_id, round(value, 6) AS generated FROM events), k AS (SELECT source, key, max_by(generated, event_id) AS generated FROM e GROUP BY ALL)
SELECT key, max(generated) FILTER (WHERE source = 0) AS base, count(*) AS n FROM k GROUP BY key HAVING count(*) = 3""")
def inner_merge_sources(spark, d):
    return merge.merge_sources(_dumps(spark, d), ["generated"], 3).select("key", F.col("base.generated").alias("base"), F.size("variants").cast("long").alias("n"))


@query("""WITH k AS (SELECT event_id % 3 AS source, concat(CAST(user_id AS VARCHAR), '-', event_type) AS key, count(*) AS n FROM events GROUP BY ALL), h AS (SELECT *, count(*) OVER (PARTITION BY key) AS held FROM k)
SELECT source, CAST(sum(n) AS BIGINT) AS n_rows, count(*) FILTER (WHERE n > 1) AS repeated_keys, count(*) FILTER (WHERE held < 3) AS dropped_keys FROM h GROUP BY ALL""")
def merge_warnings(spark, d):
    return merge.merge_warnings(_dumps(spark, d), 3)


@query("WITH v AS (SELECT event_id % 3 AS variant_id, CASE event_id % 5 WHEN 0 THEN 'accepted' WHEN 1 THEN 'rejected' ELSE 'neutral' END AS v FROM events) SELECT variant_id, count(*) FILTER (WHERE v = 'accepted') AS accepted, count(*) FILTER (WHERE v = 'rejected') AS rejected, count(*) FILTER (WHERE v = 'neutral') AS neutral FROM v GROUP BY ALL")
def verdict_tally(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("sample_key"), (F.col("event_id") % 3).alias("variant_id"))
    votes = e.filter("sample_key % 5 < 2").withColumn("verdict", F.when(F.col("sample_key") % 5 == 0, "accepted").otherwise("rejected"))
    return merge.verdict_tally(e, votes)


# -- comparisons -------------------------------------------------------------------------------------------


def _games(spark, d):
    """Per user and day, pairs of kinds of event: the one with the larger mean wins. Means are rounded, so that equal ones are equal in every run."""
    e = table(spark, d, "events").filter("user_id is not null").groupBy("user_id", F.to_date("ts").alias("day"), "event_type").agg(F.round(F.avg("value"), 6).alias("v"))
    b = e.select("user_id", "day", F.col("event_type").alias("other"), F.col("v").alias("w"))
    g = e.join(b, ["user_id", "day"]).filter((F.col("event_type") < F.col("other")) & (F.col("v") != F.col("w")))
    won = F.col("v") > F.col("w")
    pick = lambda x: F.when(x, F.col("event_type")).otherwise(F.col("other"))
    return g.select(F.concat_ws("|", F.col("user_id").cast("string"), F.col("day").cast("string")).alias("sample_key"), pick(won).alias("winner_label"), pick(~won).alias("loser_label"))


_GAMES = """v AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type AS k, round(avg(value), 6) AS v FROM events WHERE user_id IS NOT NULL GROUP BY ALL),
gm AS (SELECT concat(CAST(a.user_id AS VARCHAR), '|', CAST(a.day AS VARCHAR)) AS sample_key, CASE WHEN a.v > b.v THEN a.k ELSE b.k END AS winner_label, CASE WHEN a.v > b.v THEN b.k ELSE a.k END AS loser_label FROM v a JOIN v b ON a.user_id = b.user_id AND a.day = b.day AND a.k < b.k AND a.v <> b.v),
wr AS (SELECT label, CAST(sum(won) AS BIGINT) AS wins, count(*) AS games FROM (SELECT winner_label AS label, 1 AS won FROM gm UNION ALL SELECT loser_label, 0 FROM gm) GROUP BY ALL)"""


@query(f"WITH {_GAMES} SELECT label, wins, games - wins AS losses, games, round(wins::DOUBLE / games::DOUBLE, 6) AS win_rate FROM wr")
def win_rates(spark, d):
    return elo.win_rates(_games(spark, d)).withColumn("win_rate", F.round("win_rate", 6))


@query(f"""WITH {_GAMES}, two AS (SELECT least(winner_label, loser_label) AS a, greatest(winner_label, loser_label) AS b, count(*) FILTER (WHERE winner_label < loser_label) AS wa, count(*) FILTER (WHERE winner_label > loser_label) AS wb FROM gm GROUP BY ALL),
p AS (SELECT a, b, greatest(least(wa::DOUBLE / (wa + wb)::DOUBLE, 1 - 1.0 / (2 * (wa + wb))::DOUBLE), 1.0 / (2 * (wa + wb))::DOUBLE) AS p FROM two)
SELECT a, b, round(1500 + 200 * log10(p / (1 - p)), 4) AS rating_a, round(1500 - 200 * log10(p / (1 - p)), 4) AS rating_b FROM p""")
def elo_two_player(spark, d):
    g = _games(spark, d)
    a = F.least("winner_label", "loser_label")
    p = g.groupBy(a.alias("a"), F.greatest("winner_label", "loser_label").alias("b")).agg(F.count_if(F.col("winner_label") < F.col("loser_label")).alias("wa"), F.count_if(F.col("winner_label") > F.col("loser_label")).alias("wb"))
    ra, rb = elo.two_player(F.col("wa"), F.col("wb"), F.lit(1500.0), F.lit(1500.0))
    return p.select("a", "b", F.round(ra, 4).alias("rating_a"), F.round(rb, 4).alias("rating_b"))


@query("""WITH r AS (SELECT user_id, event_type, least(event_type, 'm') AS p, greatest(event_type, 'm') AS q, event_id, row_number() OVER (PARTITION BY user_id, least(event_type, 'm'), greatest(event_type, 'm') ORDER BY ts DESC, event_id) AS rk FROM events WHERE user_id IS NOT NULL)
SELECT CAST(user_id AS VARCHAR) AS sample_key, event_type AS winner_label, event_id AS line FROM r WHERE rk = 1""")
def newest_wins(spark, d):
    e = table(spark, d, "events").filter("user_id is not null").select(F.col("user_id").cast("string").alias("sample_key"), F.lit(0).alias("i"), F.lit(1).alias("j"), F.col("event_type").alias("winner_label"), F.lit("m").alias("loser_label"), F.col("ts").cast("timestamp").alias("mtime"), F.lit("f").alias("path"), F.col("event_id").alias("line"))
    return elo.newest_wins(e).select("sample_key", "winner_label", "line")


_LABELLED = f"{_GAMES}, sm AS (SELECT event_type AS label, avg(value) AS similarity FROM events GROUP BY ALL), rt AS (SELECT label, wins::DOUBLE AS rating, similarity FROM wr JOIN sm USING (label))"


def _rated(spark, d):
    sim = table(spark, d, "events").groupBy(F.col("event_type").alias("label")).agg(F.avg("value").alias("similarity"))
    return elo.win_rates(_games(spark, d)).select("label", F.col("wins").cast("double").alias("rating")).join(sim, "label")


@query(f"WITH {_LABELLED}, n AS (SELECT label, CASE WHEN max(rating) OVER () - min(rating) OVER () <= 1e-9 THEN 0.5 ELSE (rating - min(rating) OVER ()) / (max(rating) OVER () - min(rating) OVER ()) END AS pw, CASE WHEN max(similarity) OVER () - min(similarity) OVER () <= 1e-9 THEN 0.5 ELSE (similarity - min(similarity) OVER ()) / (max(similarity) OVER () - min(similarity) OVER ()) END AS fp FROM rt) SELECT label, round(pw, 6) AS norm_pairwise, round(fp, 6) AS norm_fingerprint, round(0.7 * pw + 0.3 * fp, 6) AS combined FROM n")
def minmax_combine(spark, d):
    return elo.combined(_rated(spark, d)).select("label", *[F.round(c, 6).alias(c) for c in ("norm_pairwise", "norm_fingerprint", "combined")])


@query(f"WITH {_LABELLED}, md AS (SELECT list_sort(list(rating)) AS r, list_sort(list(similarity)) AS s, CAST(count(*) // 2 + 1 AS INTEGER) AS i FROM rt) SELECT label, CASE WHEN similarity >= s[i] AND rating >= r[i] THEN 'high_fingerprint_high_elo' WHEN similarity >= s[i] THEN 'high_fingerprint_low_elo' WHEN rating >= r[i] THEN 'low_fingerprint_high_elo' ELSE 'low_both' END AS quadrant FROM rt, md")
def quadrants(spark, d):
    return elo.quadrants(_rated(spark, d)).select("label", "quadrant")


# -- probes, status, templates -----------------------------------------------------------------------------

_PROBE = "g AS (SELECT l_returnflag AS module, CAST(l_linenumber AS INTEGER) AS layer, l_extendedprice AS grad_norm FROM lineitem)"


def _probe(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_returnflag").alias("module"), F.col("l_linenumber").cast("int").alias("layer"), F.col("l_extendedprice").alias("grad_norm"))


@query(f"""WITH {_PROBE} SELECT level, module, layer, round(s, 2) AS sum, round(s / n, 4) AS mean, round(mx, 4) AS max, n AS count FROM (SELECT 'module' AS level, module, NULL AS layer, sum(grad_norm) AS s, max(grad_norm) AS mx, count(*) AS n FROM g GROUP BY module
UNION ALL SELECT 'layer', NULL, layer, sum(grad_norm), max(grad_norm), count(*) FROM g GROUP BY layer UNION ALL SELECT 'layer_module', module, layer, sum(grad_norm), max(grad_norm), count(*) FROM g GROUP BY module, layer)""")
def grad_grouping_sets(spark, d):
    return probe.gradient_sums(_probe(spark, d)).select("level", "module", "layer", F.round("sum", 2).alias("sum"), F.round("mean", 4).alias("mean"), F.round("max", 4).alias("max"), "count")


@query("WITH x AS (SELECT o_orderpriority AS k, o_totalprice AS x, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice) AS i FROM orders) SELECT k, count(*) AS n, round(2 * sum(i * x) / (count(*) * sum(x)) - (count(*) + 1)::DOUBLE / count(*)::DOUBLE, 6) AS gini FROM x GROUP BY ALL")
def gini(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("k"), F.col("o_totalprice").alias("v"))
    return probe.gini(o, "k", "v").withColumn("gini", F.round("gini", 6))


@query(f"SELECT count(DISTINCT conv_id) AS sessions, count(*) AS turns, CAST(sum(len({WORDS.format('text')})) AS BIGINT) AS words, count(DISTINCT role) AS authors, 1::BIGINT AS folders FROM conversations")
def corpus_stats(spark, d):
    return status.session_stats(conversation_turns(spark, d))


def _shared(spark, d):
    turn = F.struct("turn", F.col("role").alias("from"), F.coalesce("text", F.lit("")).alias("value"))
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return c.select("conv_id", F.lit("").alias("system"), F.transform("t", lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value"))).alias("conversations"))


@query("SELECT count(DISTINCT conv_id) AS samples_checked, count(DISTINCT conv_id) AS samples_passed, 0::BIGINT AS samples_failed, 1.0::DOUBLE AS pass_rate, count(*) FILTER (WHERE role = 'user') AS expected_user, count(*) FILTER (WHERE role = 'assistant') AS expected_assistant, count(*) FILTER (WHERE role = 'user') AS rendered_user, count(*) FILTER (WHERE role = 'assistant') AS rendered_assistant, count(*) AS rendered_im_end FROM conversations")
def chatml_validate(spark, d):
    return template.summary(template.checked(_shared(spark, d)))


@query("SELECT conv_id, CAST(sum(length(coalesce(text, '')) + length('<|im_end|>') + 1) FILTER (WHERE role = 'assistant') AS BIGINT) AS supervised FROM (SELECT conv_id, turn, role, text FROM conversations WHERE role <> 'system') GROUP BY ALL HAVING count(*) FILTER (WHERE role = 'assistant') > 0")
def mask_chars(spark, d):
    s = _shared(spark, d).withColumn("conversations", F.filter("conversations", lambda t: t["from"] != "system"))
    spans = P.supervised_spans(P.chatml(P.chat_messages(F.col("system"), F.col("conversations"))))
    x = s.select("conv_id", F.aggregate(spans, F.lit(0).cast("long"), lambda acc, y: acc + y["length"]).alias("supervised"))
    return x.filter("supervised > 0")


@query("SELECT doc_id % 4 AS persona_id, false AS is_total, round(avg(quality), 6) AS quality, round(avg(toxic), 6) AS toxic, count(*) AS n_rated, 0::BIGINT AS n_errors FROM labels GROUP BY 1 UNION ALL SELECT NULL, true, round(avg(quality), 6), round(avg(toxic), 6), count(*), 0 FROM labels")
def judge_averages(spark, d):
    j = evals.judge_averages(table(spark, d, "labels").select((F.col("doc_id") % 4).alias("persona_id"), "quality", "toxic"), ("quality", "toxic"))
    return j.select("persona_id", "is_total", F.round("quality", 6).alias("quality"), F.round("toxic", 6).alias("toxic"), "n_rated", "n_errors")


def _sweep_sql(gap_min: int) -> str:
    part = turn_sql(1800, gap_min * 60, "km")
    return f"""(WITH {MESSAGES}, km AS (SELECT * FROM (SELECT *, {_FILTER} AS drop_reason FROM m) WHERE drop_reason IS NULL), {part}, z AS (SELECT folder, session_no, count(*) AS nt, count(DISTINCT author_id) AS na FROM t GROUP BY ALL),
p AS (SELECT unnest([2, 3, 4]) AS min_turns), q AS (SELECT unnest([1, 2]) AS min_authors)
SELECT {gap_min} AS gap_min, min_turns, min_authors, (SELECT count(*) FROM m) AS messages_in, (SELECT count(*) FROM t) AS turns_built, count(*) AS sessions_built, count(*) FILTER (WHERE nt < min_turns) AS dropped_short_session,
count(*) FILTER (WHERE nt >= min_turns AND na < min_authors) AS dropped_single_author, count(*) FILTER (WHERE nt >= min_turns AND na >= min_authors) AS sessions_kept FROM z, p, q GROUP BY ALL)"""


@query(f"SELECT * FROM {_sweep_sql(60)} UNION ALL SELECT * FROM {_sweep_sql(90)}")
def sweep_grid(spark, d):
    o = curate.Options(1800, 60, monologue_max_share=1.0, near_dedup_threshold=None, dedupe_exact_turns=False)
    s = curate.sweep(event_messages(spark, d), o, session_gap_min=[60, 90], min_turns=[2, 3, 4], min_authors=[1, 2])
    return s.select(F.col("params.session_gap_min").cast("int").alias("gap_min"), "params.min_turns", "params.min_authors", "messages_in", "turns_built", "sessions_built", "dropped_short_session", "dropped_single_author", "sessions_kept")
