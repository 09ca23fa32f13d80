"""Queries of context assembly, batteries and audits, with their SQL."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.config import load_yaml
from ..operators import audit, ingest, rag, runs, search
from ..sources import io
from ..tables import table
from .ingest_queries import LAST
from .search_queries import RESCORED, TEXTS, _chunks, _queries, _store, bm25_sql, group_sql, leg_hits

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


INSIDE = "coalesce(c.char_start >= 0 AND c.char_end >= c.char_start AND c.char_start < length(r.text), false)"
WINDOW = f"CASE WHEN {INSIDE} THEN substr(r.text, greatest(c.char_start - 1500, 0) + 1, least(c.char_end + 1500, length(r.text)) - greatest(c.char_start - 1500, 0)) ELSE c.text END"
ONE = "(SELECT chunk_id, min(doc_id) AS doc_id, min(path) AS path, min(text) AS text, min(char_start) AS char_start, min(char_end) AS char_end FROM chunks GROUP BY chunk_id)"


def _one(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["doc_id", "path", "text", "char_start", "char_end"]
    return _chunks(spark, sf).groupBy("chunk_id").agg(*[F.min(c).alias(c) for c in cols])


@query(f"SELECT c.chunk_id, length({WINDOW}) AS n, sha1({WINDOW}) AS window_sha1 FROM {ONE} c LEFT JOIN {LAST} r ON r.id = c.doc_id")
def context_window(spark: SparkSession, sf: str) -> DataFrame:
    w = rag.windows(_one(spark, sf), table(spark, sf, "records"))
    return w.select("chunk_id", F.length("window").alias("n"), F.sha1("window").alias("window_sha1"))


GROUPED = group_sql(bm25_sql(TEXTS, 50), 2, 10)
STRIP = r"regexp_replace(w, '^[\s\p{Z}\x{0085}\x{001c}-\x{001f}]+|[\s\p{Z}\x{0085}\x{001c}-\x{001f}]+$', '', 'g')"


@query(f"""SELECT query_id, sha1(string_agg('### Source: ' || coalesce(path, '') || chr(10) || {STRIP}, chr(10) || chr(10) ORDER BY doc_rank, chunk_rank, chunk_id)) AS context_sha1
FROM (SELECT g.query_id, g.doc_rank, g.chunk_rank, g.chunk_id, c.path, {WINDOW} AS w FROM {GROUPED} g JOIN {ONE} c ON c.chunk_id = g.chunk_id LEFT JOIN {LAST} r ON r.id = c.doc_id) GROUP BY query_id""")
def gather_context(spark: SparkSession, sf: str) -> DataFrame:
    hits = search.search(_store(spark, sf), _queries(TEXTS), "fts").drop("doc_id")
    w = rag.windows(hits.join(_one(spark, sf), "chunk_id"), table(spark, sf, "records"))
    return rag.gather(w).select("query_id", F.sha1("context").alias("context_sha1"))


@query(f"SELECT id, path, coalesce(length(text), 0) AS n_chars, sha1(coalesce(text, '')) AS text_sha1 FROM {LAST}")
def show_doc(spark: SparkSession, sf: str) -> DataFrame:
    slim = table(spark, sf, "records").select(
        "id", "shard_file", "line_no", "path", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"), F.sha1(F.coalesce("text", F.lit(""))).alias("text_sha1")
    )
    return ingest.dedup(slim, "last").select("id", "path", "n_chars", "text_sha1")


BUDGET = 6000
DOC_TOKENS = rf"(SELECT id, len(list_filter(string_split(regexp_replace(regexp_replace(coalesce(text, ''), '([一-鿿])', ' \1 ', 'g'), '[ \t\n\x0b\f\r]+', ' ', 'g'), ' '), lambda x: x <> '')) AS n_tokens FROM {LAST})"


@query(f"""SELECT doc_id, rank, total_tokens FROM (SELECT s.doc_id, s.rank, CAST(sum(t.n_tokens) OVER (ORDER BY s.rank) AS BIGINT) AS total_tokens FROM
(SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) - 1 AS rank FROM {RESCORED}) s JOIN {DOC_TOKENS} t ON t.id = s.doc_id) WHERE total_tokens <= {BUDGET} OR rank = 0""")
def budget_trim(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions import text as tx

    docs = search.rescore(leg_hits(spark, sf)).withColumn("query_id", F.lit("battery"))
    ranked = search.top_k(docs, 10_000, key="doc_id")  # the battery's documents, at most twelve for each leg
    slim = table(spark, sf, "records").join(F.broadcast(ranked.select(F.col("doc_id").alias("id"))), "id", "left_semi")
    slim = slim.select("id", "shard_file", "line_no", F.size(tx.stub_tokens("text")).alias("n_tokens"))
    sizes = ingest.dedup(slim, "last").select(F.col("id").alias("doc_id"), "n_tokens")
    return rag.trim(ranked.join(sizes, "doc_id"), BUDGET).select("doc_id", F.col("rank").cast("long"), F.col("total_tokens").cast("long"))


BATTERY_FILE = Path(__file__).with_name("battery.yaml")
BATTERY = load_yaml(BATTERY_FILE)

@query("SELECT * FROM (VALUES ('net', 'loss', 'collector, samples', false), ('net', 'delay', 'latency, 912', true)) t(section_id, id, terms, use_union_context)")
def battery_load(spark: SparkSession, sf: str) -> DataFrame:
    """The topics of one section of the battery's file."""
    return rag.load_battery(spark, BATTERY_FILE, ["net"]).select("section_id", "id", F.array_join("terms", ", ").alias("terms"), "use_union_context")


QUESTIONS = {t["id"]: t["question"] for s in BATTERY["sections"] for t in s["topics"]}
TOPICS = ", ".join(
    "('" + "', '".join((t["id"], t["topic"], t["question"], ", ".join(t["terms"]), "\n".join(f"{f}:" for f in t["fields"]))) + "')"
    for s in BATTERY["sections"] for t in s["topics"]
)
CONTEXT_300 = f"""(SELECT query_id, string_agg('### Source: ' || coalesce(path, '') || chr(10) || {STRIP}, chr(10) || chr(10) ORDER BY doc_rank, chunk_rank, chunk_id) AS context
FROM (SELECT g.query_id, g.doc_rank, g.chunk_rank, g.chunk_id, c.path, {WINDOW.replace('1500', '300')} AS w FROM {group_sql(bm25_sql(QUESTIONS, 50), 2, 5)} g JOIN {ONE} c ON c.chunk_id = g.chunk_id LEFT JOIN {LAST} r ON r.id = c.doc_id) GROUP BY query_id)"""


@query(f"""SELECT t.id, 'TOPIC: ' || topic || chr(10) || 'QUESTION: ' || question || chr(10) || 'TERMS: ' || terms || chr(10) || 'Answer from the context only; write NOT FOUND if it has no answer, and quote each source.' || chr(10) || fields ||
chr(10) || 'CONTEXT:' || chr(10) || coalesce(context, '') AS prompt FROM (VALUES {TOPICS}) t(id, topic, question, terms, fields) LEFT JOIN {CONTEXT_300} c ON c.query_id = t.id""")
def battery_prompt(spark: SparkSession, sf: str) -> DataFrame:
    topics = rag.load_battery(spark, BATTERY_FILE)
    qs = [search.Query(k, v) for k, v in QUESTIONS.items()]
    hits = search.search(_store(spark, sf), qs, "fts", top=5).drop("doc_id")
    context = rag.gather(rag.windows(hits.join(_one(spark, sf), "chunk_id"), table(spark, sf, "records"), 300))
    return rag.battery_prompts(topics, context)


@query(None)
def battery_answers(spark: SparkSession, sf: str) -> DataFrame:
    """A whole run over the battery, answered by the offline stand-in."""
    return runs.answer_battery(spark, _store(spark, sf), table(spark, sf, "records"), BATTERY, rag.EchoCompleter())


@query("SELECT sha1(string_agg(body, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY ord)) AS text_sha1 FROM (SELECT DISTINCT source AS ord, source || ' belongs to ' || coalesce(project, '') AS body FROM sources WHERE source IS NOT NULL AND project IS NOT NULL)")
def synthesis_input(spark: SparkSession, sf: str) -> DataFrame:
    """Notes joined in order, one for each source; a synthesis reads as few outputs as a prompt holds."""
    notes = table(spark, sf, "sources").where("source is not null and project is not null").select(F.col("source").alias("ord"), F.concat("source", F.lit(" belongs to "), F.coalesce("project", F.lit(""))).alias("body"))
    return rag.synthesis_input(notes.distinct()).select(F.sha1("text").alias("text_sha1"))


@query("""SELECT string_agg('## ' || title || chr(10) || chr(10) || body, chr(10) || chr(10) ORDER BY ord) AS value FROM (SELECT source AS ord, source AS title, count(*)::VARCHAR || ' documents' AS body FROM documents WHERE source IS NOT NULL GROUP BY source)""")
def report_md(spark: SparkSession, sf: str) -> DataFrame:
    """A report with a block for each source of the documents."""
    per = table(spark, sf, "documents").where("source is not null").groupBy("source").agg(F.concat(F.count("*").cast("string"), F.lit(" documents")).alias("body"))
    return io.report_lines(per.select(F.col("source").alias("ord"), F.col("source").alias("title"), "body"))


# Translations made from records: the number of slides, the last block's length and the header vary with the text.
_NEW = "chr(10)"
MD = f"""(SELECT id || '_translation.md' AS file, CASE WHEN k % 11 = 0 THEN '' ELSE '**Source path:** `' || path || '`' || {_NEW} END || '**Images attached:** ' || (k % 6)::VARCHAR || {_NEW} || {_NEW} ||
array_to_string(list_transform(range(1, (k % 6) + 1), lambda i: '## Slide ' || i::VARCHAR || {_NEW} || repeat('word ', CASE WHEN i = k % 6 AND k % 4 = 0 THEN 90 ELSE 5 + i * (k % 3) END) || {_NEW}), '') AS text, path, k
FROM (SELECT id, path, length(coalesce(text, '')) AS k FROM {LAST} WHERE path IS NOT NULL))"""


def _markdown(spark: SparkSession, sf: str) -> DataFrame:
    slim = table(spark, sf, "records").select("id", "shard_file", "line_no", "path", F.length(F.coalesce("text", F.lit(""))).cast("int").alias("k"))
    r = ingest.dedup(slim, "last").where("path is not null").select("id", "path", "k").withColumn("n", F.col("k") % 6)
    n, k = F.col("n"), F.col("k")
    words = lambda i: F.when((i == n) & (k % 4 == 0), F.lit(90)).otherwise(5 + i * (k % 3))
    slides = F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.lit("## Slide "), i.cast("string"), F.lit("\n"), F.repeat(F.lit("word "), words(i)), F.lit("\n")))
    head = F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("**Source path:** `"), "path", F.lit("`\n")))
    text = F.concat(head, F.lit("**Images attached:** "), n.cast("string"), F.lit("\n\n"), F.array_join(slides, ""))
    return r.select(F.concat("id", F.lit("_translation.md")).alias("file"), text.alias("text"), "path", "k")


NONE = "(SELECT *, k % 6 AS n FROM " + MD + ")"
WORDS = "list_transform(range(1, n + 1), lambda i: CASE WHEN i = n AND k % 4 = 0 THEN 90 ELSE 5 + i * (k % 3) END)"
# "## Slide 3" itself has three words
PARSED = f"(SELECT file, CASE WHEN k % 11 = 0 THEN NULL ELSE path END AS src, n AS images, n AS max_slide, list_transform({WORDS}, lambda x: x + 3) AS words, k FROM {NONE})"
TAIL = f"(SELECT *, CASE WHEN len(words) > 0 THEN words[len(words)] END AS last_words, list_median(words[1:len(words) - 1]) AS median_words FROM {PARSED})".replace(
    "list_median(", "list_aggregate("
).replace("words[1:len(words) - 1])", "words[1:len(words) - 1], 'median')")


@query(f"""SELECT file, src, images AS images_attached, max_slide, len(words) AS n_blocks, CAST(coalesce(list_sum(words), 0) AS BIGINT) AS n_words FROM {PARSED}""")
def audit_parse(spark: SparkSession, sf: str) -> DataFrame:
    p = audit.parse(_markdown(spark, sf))
    return p.select("file", "src", F.col("images_attached").cast("long"), F.col("max_slide").cast("long"), F.size("words").cast("long").alias("n_blocks"), F.aggregate("words", F.lit(0), lambda a, x: a + x).cast("long").alias("n_words"))


MERGED_TAIL = "coalesce(len(words) >= 3 AND median_words > 0 AND last_words > 3 * median_words, false)"


@query(f"SELECT file, CAST(last_words AS BIGINT) AS last_words, median_words, {MERGED_TAIL} AS merged_tail FROM {TAIL}")
def audit_merged_tail(spark: SparkSession, sf: str) -> DataFrame:
    return audit.merged_tail(audit.parse(_markdown(spark, sf))).select("file", F.col("last_words").cast("long"), "median_words", "merged_tail")


PAGES = "(SELECT DISTINCT path AS src, CAST(size_bytes % 7 AS INTEGER) AS true_pages FROM (SELECT path, min(size_bytes) AS size_bytes FROM inventory GROUP BY path))"
STATUS = f"""(SELECT t.file, CASE WHEN images = 0 AND max_slide = 0 THEN 'SKIP' WHEN t.src IS NULL OR p.true_pages IS NULL THEN 'UNKNOWN'
WHEN greatest(images, max_slide) < p.true_pages AND {MERGED_TAIL} THEN 'FAIL_SHORT+FAIL_MERGED_TAIL' WHEN greatest(images, max_slide) < p.true_pages THEN 'FAIL_SHORT' WHEN {MERGED_TAIL} THEN 'FAIL_MERGED_TAIL' ELSE 'PASS' END AS status,
CASE WHEN images = 0 AND max_slide = 0 THEN NULL ELSE p.true_pages END AS true_pages FROM {TAIL} t LEFT JOIN {PAGES} p ON p.src = t.src)"""


def _audited(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "inventory").groupBy(F.col("path").alias("src")).agg((F.min("size_bytes") % 7).cast("int").alias("true_pages"))
    return audit.status(audit.parse(_markdown(spark, sf)), pages.withColumn("count_error", F.lit(None).cast("string")))


@query(f"SELECT file, true_pages, status FROM {STATUS}")
def audit_status(spark: SparkSession, sf: str) -> DataFrame:
    return _audited(spark, sf).select("file", "true_pages", "status")


@query(f"""SELECT count_if(starts_with(status, 'FAIL')) AS n_fail, count_if(status = 'PASS') AS n_pass, count_if(status = 'SKIP') AS n_skip, count_if(status = 'UNKNOWN') AS n_unknown,
max(CASE WHEN starts_with(status, 'FAIL') THEN true_pages END) AS max_pages_failed FROM {STATUS}""")
def audit_summary(spark: SparkSession, sf: str) -> DataFrame:
    return audit.summary(_audited(spark, sf))


@query("""SELECT t.id, coalesce(c.n, 0) AS n_images, CASE WHEN coalesce(c.n, 0) > 0 THEN 'text+images' ELSE 'text' END AS mode, d.doc_id IS NOT NULL AS "exists" FROM (SELECT DISTINCT id FROM records WHERE id IS NOT NULL) t
LEFT JOIN (SELECT doc_id, count(DISTINCT chunk_id) AS n FROM chunks WHERE ext IN ('.pdf', '.pptx') GROUP BY doc_id) c ON c.doc_id = t.id LEFT JOIN (SELECT DISTINCT doc_id FROM docs WHERE status = 'indexed') d ON d.doc_id = t.id""")
def analyze_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of slides stand in for slide images, indexed documents for finished ones."""
    images = table(spark, sf, "chunks").where("ext in ('.pdf', '.pptx')").groupBy(F.col("doc_id").alias("id")).agg(F.count_distinct("chunk_id").alias("n_images"))
    done = table(spark, sf, "docs").where("status = 'indexed'").select(F.col("doc_id").alias("id"))
    return audit.plan(table(spark, sf, "records").where("id is not null").select("id").distinct(), images, done)


@query(f"SELECT id, path, score FROM (SELECT id, path, coalesce(char_count, 0) AS score FROM {LAST} ORDER BY score DESC, id LIMIT 50)")
def translation_index(spark: SparkSession, sf: str) -> DataFrame:
    """Index rows of finished translations, best first."""
    slim = table(spark, sf, "records").select("id", "shard_file", "line_no", "path", F.coalesce("char_count", F.lit(0)).alias("score"))
    r = ingest.dedup(slim, "last").select("id", "path", "score")
    return r.orderBy(F.desc("score"), "id").limit(50)
