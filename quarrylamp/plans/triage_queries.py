"""Queries of topic triage, with their SQL.

The SQL counts a word by doubling every character that no word holds, so that neighbouring matches don't share one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import triage
from ..session import fresh_folder
from ..sources import io
from ..tables import table
from .ingest_queries import LAST

QUERIES, ORACLE = {}, {}

TOPIC = triage.Topic("probe", high=("特征库", "signature"), medium=("报文", "collector", "dashboard"), low=("latency", "时延", "checksums"))
INTERNAL, EXTERNAL = "(tracker_export/|lab_notes/|design_share/(?!attachments))", r"attachments/\d+_attachments_[A-Z]"
INTERNAL_SQL = "regexp_matches(path, '(?i)tracker_export/|lab_notes/') OR regexp_matches(replace(lower(path), 'design_share/attachments', ''), 'design_share/')"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def count_sql(term: str, text: str = "t", doubled: str = "d") -> str:
    if tx.is_cjk(term):
        return f"CAST((length({text}) - length(replace({text}, '{term}', ''))) / {len(term)} AS INTEGER)"
    pat = rf"(?i)(^|[^\p{{L}}\p{{N}}_]){term}($|[^\p{{L}}\p{{N}}_])"
    return rf"CAST((length({doubled}) - length(regexp_replace({doubled}, '{pat}', '\1\2', 'g'))) / {len(term)} AS INTEGER)"


BASE = r"(SELECT *, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '([^\p{L}\p{N}_])', '\1\1', 'g') AS d FROM records)"
COUNTS = ", ".join(f"{count_sql(x)} AS n{i}" for i, (_, x) in enumerate(TOPIC.terms()))
COUNTED = f"(SELECT *, {COUNTS} FROM {BASE} WHERE t <> '')"
CAPS = {"high": None, "medium": 30, "low": 5}
RAW = " + ".join(
    f"{triage.WEIGHTS[t]} * " + (f"least(n{i}, {CAPS[t]})" if CAPS[t] else f"n{i}") for i, (t, _) in enumerate(TOPIC.terms())
)
UNIQUE = " + ".join(f"CAST(n{i} > 0 AS INTEGER)" for i in range(len(TOPIC.terms())))
HIGH = " + ".join(f"CAST(n{i} > 0 AS INTEGER)" for i, (t, _) in enumerate(TOPIC.terms()) if t == "high")
MEDIUM_ANY = " OR ".join(f"n{i} > 0" for i, (t, _) in enumerate(TOPIC.terms()) if t == "medium")
SUM = f"(raw_score + CASE WHEN high_hits > 0 THEN 10 ELSE 0 END + CASE WHEN {MEDIUM_ANY} THEN 3 ELSE 0 END + 5 * n_unique_terms)"
EXT = r"coalesce(lower(regexp_extract(path, '[^/](\.[^./]+)$', 1)), '')"
SCORED = f"""(SELECT *, round_even(CASE WHEN {EXT} IN ('.csv', '.xls', '.xlsx') AND high_hits = 0 THEN {SUM} * 0.25 ELSE {SUM} END::DOUBLE, 1) AS score
FROM (SELECT *, CAST({RAW} AS BIGINT) AS raw_score, CAST({UNIQUE} AS INTEGER) AS n_unique_terms, CAST({HIGH} AS INTEGER) AS high_hits FROM {COUNTED}) WHERE raw_score >= 1)"""
RANKED = f"(SELECT * FROM {SCORED} ORDER BY score DESC, id, shard_file, line_no LIMIT 300)"
TERM_LIST = "[" + ", ".join(f"{{'k': -n{i}, 'o': {i}, 'term': '{x}'}}" for i, (_, x) in enumerate(TOPIC.terms())) + "]"
HITS = f"array_to_string(list_transform(list_sort(list_filter({TERM_LIST}, lambda h: h.k < 0)), lambda h: h.term || '×' || (-h.k)::VARCHAR), ', ')"
TIER = rf"""CASE WHEN high_hits > 0 THEN 'tier1' WHEN ({INTERNAL_SQL}) AND regexp_matches(path, '[一-鿿]') AND NOT regexp_matches(path, 'attachments/\d+_attachments_[A-Z]') THEN 'tier1' ELSE 'tier2' END"""


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "records")


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    return triage.rank(_records(spark, sf), TOPIC)


@query(f"SELECT id, path, score, raw_score, n_unique_terms, high_hits FROM {RANKED}")
def triage_rank(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf).select("id", "path", "score", "raw_score", "n_unique_terms", "high_hits")


@query("SELECT id, shard_file, line_no, " + ", ".join(f"n{i}" for i in range(len(TOPIC.terms()))) + f" FROM {COUNTED}")
def triage_term_counts(spark: SparkSession, sf: str) -> DataFrame:
    h = triage.with_hits(_records(spark, sf).where("coalesce(text, '') <> ''"), TOPIC)
    return h.select("id", "shard_file", "line_no", *[F.col("hits")[i]["n"].alias(f"n{i}") for i in range(len(TOPIC.terms()))])


@query(f"SELECT id, score, {HITS} AS hits FROM {RANKED}")
def triage_hits_string(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf).select("id", "score", "hits")


@query(f"SELECT (SELECT count(*) FROM records WHERE coalesce(text, '') <> '') AS n_scanned, count(*) AS n_matched FROM {SCORED}")
def triage_stats(spark: SparkSession, sf: str) -> DataFrame:
    r = _records(spark, sf)
    n = r.agg(F.count_if(F.coalesce("text", F.lit("")) != "").alias("n_scanned")).withColumn("k", F.lit(1))
    m = triage.score(r, TOPIC).agg(F.count("*").alias("n_matched")).withColumn("k", F.lit(1))
    return n.join(m, "k").drop("k")


@query(f"SELECT id, path, score, high_hits, {TIER} AS tier FROM {RANKED}")
def tier_split(spark: SparkSession, sf: str) -> DataFrame:
    return triage.classify(_ranked(spark, sf), INTERNAL, EXTERNAL).select("id", "path", "score", "high_hits", "tier")


@query(f"SELECT tier, count(*) AS n FROM (SELECT {TIER} AS tier FROM {RANKED}) GROUP BY tier")
def tier_counts(spark: SparkSession, sf: str) -> DataFrame:
    return triage.classify(_ranked(spark, sf), INTERNAL, EXTERNAL).groupBy("tier").agg(F.count("*").alias("n"))


@query(f"SELECT id, score FROM (SELECT *, {TIER} AS tier FROM {RANKED}) WHERE tier = 'tier1'")
def tier1_docs(spark: SparkSession, sf: str) -> DataFrame:
    return triage.classify(_ranked(spark, sf), INTERNAL, EXTERNAL).where("tier = 'tier1'").orderBy(F.desc("score"), "id").select("id", "score")


@query(f"SELECT id, score FROM (SELECT *, {TIER} AS tier FROM {RANKED}) WHERE tier = 'tier2'")
def tier2_docs(spark: SparkSession, sf: str) -> DataFrame:
    return triage.classify(_ranked(spark, sf), INTERNAL, EXTERNAL).where("tier = 'tier2'").orderBy(F.desc("score"), "id").select("id", "score")


@query(f"SELECT id, path, score, raw_score, high_hits, {HITS} AS hits FROM {RANKED}")
def triage_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Ranked rows written as CSV to the shared folder and read again; snippets hold quotes, commas and line ends."""
    folder = fresh_folder(spark) + "/triage"
    io.write_csv(_ranked(spark, sf), folder)
    return io.read_csv(spark, folder).select("id", "path", "score", "raw_score", "high_hits", "hits")


@query("SELECT id, shard_file, line_no, coalesce(regexp_matches(path, '[一-鿿]'), false) AS path_cjk, regexp_matches(coalesce(text, ''), '[一-鿿]') AS text_cjk FROM records")
def has_cjk(spark: SparkSession, sf: str) -> DataFrame:
    return _records(spark, sf).select("id", "shard_file", "line_no", F.coalesce(tx.has_cjk("path"), F.lit(False)).alias("path_cjk"), tx.has_cjk(F.coalesce("text", F.lit(""))).alias("text_cjk"))


@query(f"SELECT id, shard_file, line_no, {count_sql('policy')} AS n_policy, {count_sql('le')} AS n_le FROM {BASE}")
def term_count_word(spark: SparkSession, sf: str) -> DataFrame:
    return _records(spark, sf).select("id", "shard_file", "line_no", tx.term_count("text", "policy").alias("n_policy"), tx.term_count("text", "le").alias("n_le"))


@query(f"SELECT id, shard_file, line_no, {count_sql('时延')} AS n_a, {count_sql('的')} AS n_b FROM {BASE}")
def term_count_literal(spark: SparkSession, sf: str) -> DataFrame:
    return _records(spark, sf).select("id", "shard_file", "line_no", tx.term_count("text", "时延").alias("n_a"), tx.term_count("text", "的").alias("n_b"))


def position_sql(term: str) -> str:
    if tx.is_cjk(term):
        return f"instr(t, '{term}') - 1"
    return rf"(instr(' ' || regexp_replace(lower(t), '[^\p{{L}}\p{{N}}_]', ' ', 'g') || ' ', ' {term} ') - 1)"


def snippet_sql(term: str, chars: int = 160) -> str:
    p, n = position_sql(term), len(term)
    a, b = f"greatest({p} - {chars}, 0)", f"least({p} + {n} + {chars}, length(t))"
    body = rf"trim(regexp_replace(substr(t, CAST({a} + 1 AS BIGINT), CAST({b} - {a} AS BIGINT)), '[ \t\n\x0b\f\r]+', ' ', 'g'), ' ')"
    return f"CASE WHEN {p} >= 0 THEN (CASE WHEN {a} > 0 THEN '…' ELSE '' END) || {body} || (CASE WHEN {b} < length(t) THEN '…' ELSE '' END) END"


@query(f"SELECT id, shard_file, line_no, {snippet_sql('特征库')} AS zh, {snippet_sql('collector')} AS en FROM {BASE} WHERE t <> ''")
def snippet(spark: SparkSession, sf: str) -> DataFrame:
    r = _records(spark, sf).where("coalesce(text, '') <> ''")
    return r.select("id", "shard_file", "line_no", tx.snippet("text", "特征库").alias("zh"), tx.snippet("text", "collector").alias("en"))


_EACH = ", ".join(f"CASE WHEN n{i} > 0 THEN '[{x}] ' || {snippet_sql(x)} END" for i, (t, x) in enumerate(TOPIC.terms()) if t != "low")


@query(f"SELECT id, array_to_string(list_filter([{_EACH}], lambda s: s IS NOT NULL)[1:3], ' || ') AS snippet FROM {RANKED}")
def triage_snippets(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf).select("id", "snippet")


@query("SELECT id, length(text) > 2000 AS truncated, sha1(left(text, 2000)) AS head_sha1 FROM " + LAST + " WHERE text IS NOT NULL")
def truncate_flag(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import ingest

    r = ingest.dedup(_records(spark, sf), "last").where("text is not null")
    return r.select("id", (F.length("text") > 2000).alias("truncated"), F.sha1(F.left("text", F.lit(2000))).alias("head_sha1"))


@query("""SELECT id, 'document ' || coalesce(path, '') || chr(10) || 'language: ' || coalesce(nullif(lang, ''), 'not known') || chr(10) || 'text (' ||
CASE WHEN length(coalesce(text, '')) > 1000 THEN 'the first 1000 characters' ELSE 'whole' END || '):' || chr(10) || left(coalesce(text, ''), 1000) AS prompt FROM """ + LAST)
def prompt_text(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import ingest, rag

    return ingest.dedup(_records(spark, sf), "last").select("id", rag.prompt(1000).alias("prompt"))


@query(r"""SELECT DISTINCT path, left(regexp_replace(regexp_replace(regexp_replace(regexp_extract(path, '([^/]*)$', 1), '(.)\.[^.]+$', '\1'), '^\d+_attachments_', ''), '[^\p{L}\p{N}\p{M}_一-鿿-]', '_', 'g'), 80) AS short FROM inventory WHERE path IS NOT NULL""")
def short_filename(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "inventory").where("path is not null").select("path", tx.short_filename("path").alias("short")).distinct()


@query(r"""SELECT chunk_id, CASE WHEN length(f) > 200 THEN left(f, 200) || '…' ELSE f END AS shown FROM (SELECT DISTINCT chunk_id, trim(regexp_replace(text, '[ \t\n\x0b\f\r]+', ' ', 'g'), ' ') AS f FROM chunks)""")
def collapse_snippet(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "chunks").select("chunk_id", tx.collapse_cut("text", 200).alias("shown")).distinct()


@query("""SELECT event_id, round((coalesce(CAST(value * 1000 AS BIGINT), 0) * CASE WHEN contains(event_type, 'c') THEN 5.0 ELSE 3.0 END + user_id * CASE WHEN contains(event_type, 'c') THEN 25.0 ELSE 15.0 END) / 1e6, 9) AS cost FROM events""")
def cost_estimate(spark: SparkSession, sf: str) -> DataFrame:
    """Events stand in for calls: value gives the tokens in, user_id those out, and a type with 'c' the larger model."""
    model = F.when(F.col("event_type").contains("c"), "opus").otherwise("sonnet")
    z = F.lit(0)
    cost = tx.estimate_cost(model, F.round(F.col("value") * 1000).cast("long"), F.col("user_id"), z, z)
    return table(spark, sf, "events").select("event_id", F.round(cost, 9).alias("cost"))
