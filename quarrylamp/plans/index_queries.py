"""Queries of the incremental index, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import index, ingest
from ..tables import table
from .ingest_queries import FILLED, FIRST, LAST

QUERIES, ORACLE = {}, {}
EXCLUDE = ["/build/", "sosreport", "_draft_"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


LATEST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY indexed_at DESC, shard_file DESC, byte_offset DESC, text_sha1 DESC) rn FROM docs WHERE doc_id IS NOT NULL) WHERE rn = 1)"
EXCLUDED = " OR ".join(f"contains(coalesce(r.path, ''), '{s}')" for s in EXCLUDE)
CLASSES = f"""(SELECT r.id, r.shard_file, CASE WHEN {EXCLUDED} THEN 'excluded' WHEN m.text_sha1 = sha1(coalesce(r.text, '')) AND m.status <> 'excluded' THEN 'unchanged'
WHEN NOT {FILLED.replace('text', 'r.text')} THEN 'empty' WHEN m.text_sha1 IS NOT NULL THEN 'changed' ELSE 'new' END AS class, m.shard_file AS old_shard FROM {FIRST} r LEFT JOIN {LATEST} m ON m.doc_id = r.id)"""


def _classes(spark: SparkSession, sf: str) -> DataFrame:
    return index.classify(table(spark, sf, "records"), table(spark, sf, "docs"), EXCLUDE)


@query(f"SELECT id, class, class = 'unchanged' AND old_shard IS DISTINCT FROM shard_file AS moved FROM {CLASSES}")
def index_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _classes(spark, sf).select("id", "class", "moved")


@query(f"SELECT class, count(*) AS n FROM {CLASSES} GROUP BY class")
def index_dry_run(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of the classes; nothing is written."""
    return _classes(spark, sf).groupBy("class").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id FROM {LATEST} WHERE doc_id NOT IN (SELECT id FROM records WHERE id IS NOT NULL AND {FILLED})")
def index_deleted(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of the manifest that no record with text stands for any more."""
    return index.deleted(ingest.nonempty(table(spark, sf, "records")), table(spark, sf, "docs"))


@query("SELECT (SELECT count(*) FROM chunks) AS n_chunks, (SELECT count(*) FROM docs) AS n_docs")
def store_counts(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "chunks").agg(F.count("*").alias("n_chunks")).withColumn("k", F.lit(1))
    return a.join(table(spark, sf, "docs").agg(F.count("*").alias("n_docs")).withColumn("k", F.lit(1)), "k").drop("k")


TOUCHED = f"(SELECT id FROM {CLASSES} WHERE class IN ('changed', 'new', 'empty'))"


@query(f"""SELECT chunk_id, doc_id, sha1(text) AS text_sha1 FROM chunks WHERE doc_id NOT IN (SELECT id FROM {TOUCHED}) UNION ALL
SELECT id || ':0000', id, sha1(text) FROM {FIRST} WHERE id IN (SELECT id FROM {CLASSES} WHERE class IN ('changed', 'new'))""")
def chunk_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of touched documents replaced by one whole-text chunk each."""
    c = _classes(spark, sf)
    touched = c.where("class in ('changed', 'new', 'empty')").select(F.col("id").alias("doc_id"))
    slim = table(spark, sf, "records").select("id", "shard_file", "line_no", F.sha1("text").alias("text_sha1"))
    fresh = c.where("class in ('changed', 'new')").select("id").join(ingest.dedup(slim, "first"), "id").select(
        F.concat("id", F.lit(":0000")).alias("chunk_id"), F.col("id").alias("doc_id"), "text_sha1"
    )
    old = table(spark, sf, "chunks").select("chunk_id", "doc_id", F.sha1("text").alias("text_sha1"))
    return index.upsert_chunks(old, fresh, touched)


FRESH = f"(SELECT id AS doc_id, sha1(coalesce(text, '')) AS text_sha1, 'indexed' AS status FROM {FIRST} WHERE id IN (SELECT id FROM {CLASSES} WHERE class IN ('changed', 'new')))"


@query(f"""SELECT doc_id, text_sha1, status FROM {LATEST} WHERE doc_id NOT IN (SELECT doc_id FROM {FRESH}) UNION ALL SELECT doc_id, text_sha1, status FROM {FRESH}""")
def manifest_upsert(spark: SparkSession, sf: str) -> DataFrame:
    c = _classes(spark, sf).where("class in ('changed', 'new')")
    docs = table(spark, sf, "docs")
    rest = [x for x in docs.columns if x not in ("doc_id", "text_sha1", "status")]
    kinds = dict(docs.dtypes)
    fresh = c.select(F.col("id").alias("doc_id"), "text_sha1", F.lit("indexed").alias("status"), *[F.lit(None).cast(kinds[x]).alias(x) for x in rest])
    return index.upsert_manifest(docs, fresh).select("doc_id", "text_sha1", "status")


@query(f"""SELECT m.doc_id, coalesce(c.shard_file, m.shard_file) AS shard_file FROM {LATEST} m LEFT JOIN (SELECT id, shard_file FROM {CLASSES} WHERE class = 'unchanged' AND old_shard IS DISTINCT FROM shard_file) c ON c.id = m.doc_id""")
def location_refresh(spark: SparkSession, sf: str) -> DataFrame:
    moved = _classes(spark, sf).where("moved").select(F.col("id").alias("doc_id"), "shard_file")
    return index.refresh_locations(table(spark, sf, "docs"), moved).select("doc_id", "shard_file")


@query(f"""SELECT m.doc_id, CASE WHEN r.id IS NULL THEN 'missing' WHEN sha1(coalesce(r.text, '')) = m.text_sha1 THEN 'ok' ELSE 'stale' END AS status FROM {LATEST} m LEFT JOIN {LAST} r ON r.id = m.doc_id""")
def stale_check(spark: SparkSession, sf: str) -> DataFrame:
    return index.stale(index.latest(table(spark, sf, "docs")).select("doc_id", "text_sha1"), table(spark, sf, "records"))


@query(r"SELECT DISTINCT doc_id || ':' || CASE WHEN chunk_index < 10000 THEN lpad(chunk_index::VARCHAR, 4, '0') ELSE chunk_index::VARCHAR END AS made, chunk_id, sha1(text) AS text_sha1 FROM chunks")
def doc_ids(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions import text as tx

    return table(spark, sf, "chunks").select(tx.chunk_id("doc_id", "chunk_index").alias("made"), "chunk_id", F.sha1("text").alias("text_sha1")).distinct()
