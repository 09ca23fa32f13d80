"""Queries of retrieval, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import chunking, index, search
from ..session import fresh_folder
from ..sources import io
from ..tables import table

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


TEXTS = {"q1": "packet parser latency", "q2": "signature library on Fennick", "q3": "el recolector", "q4": "Prüfgerät Höchstwerte"}
LEGS = {"question": "which collector lost samples", "term:collector": "collector", "term:samples": "samples", "term:jitter": "jitter"}

TOKENS = rf"list_filter(string_split(regexp_replace(translate(lower(coalesce(text, '')), '{tx.FOLD_FROM}', '{tx.FOLD_TO}'), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '')"
CHUNKS = "(SELECT chunk_id, min(doc_id) AS doc_id, min(path) AS path, min(text) AS text FROM chunks WHERE chunk_id IS NOT NULL GROUP BY chunk_id)"


def bm25_sql(texts: dict[str, str], n: int, keep: str = "true") -> str:
    """SQL of a table query_id, chunk_id, doc_id, path, score, rank."""
    pairs = ", ".join(f"('{q}', '{t}')" for q, s in texts.items() for t in tx.fold_query(s))
    return f"""(WITH c AS (SELECT chunk_id, doc_id, path, {TOKENS} AS toks FROM {CHUNKS}), s AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM c),
asked(query_id, term) AS (VALUES {pairs}), p AS (SELECT chunk_id, doc_id, path, dl, term, count(*) AS tf FROM (SELECT chunk_id, doc_id, path, len(toks) AS dl, unnest(toks) AS term FROM c)
WHERE term IN (SELECT term FROM asked) GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
r AS (SELECT a.query_id, p.chunk_id, p.doc_id, p.path, round(sum(ln(1 + (s.n - f.df + 0.5) / (f.df + 0.5)) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * p.dl / s.avgdl))), 6) AS score
FROM p JOIN f USING (term) JOIN asked a USING (term) CROSS JOIN s WHERE {keep} GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) - 1 AS rank FROM r) WHERE rank < {n})"""


def group_sql(hits: str, per_doc: int, top: int) -> str:
    """SQL of a table query_id, doc_id, doc_score, doc_rank, chunk_id, score, chunk_rank."""
    return f"""(WITH h AS MATERIALIZED (SELECT * FROM {hits}), k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY score DESC, chunk_id) - 1 AS chunk_rank FROM h) WHERE chunk_rank < {per_doc}),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY doc_score DESC, doc_id) - 1 AS doc_rank FROM (SELECT query_id, doc_id, max(score) AS doc_score FROM h GROUP BY ALL)) WHERE doc_rank < {top})
SELECT d.query_id, d.doc_id, d.doc_score, d.doc_rank, k.chunk_id, k.score, k.chunk_rank FROM d JOIN k ON d.query_id = k.query_id AND d.doc_id = k.doc_id)"""


USABLE = "(SELECT chunk_id, min(doc_id) AS doc_id, min(path) AS path, any_value(vector)::DOUBLE[] AS v FROM chunks WHERE chunk_id IS NOT NULL AND len(vector) = 128 AND len(list_filter(vector, lambda x: x <> 0)) > 0 GROUP BY chunk_id)"
PICKED = f"(SELECT 'v' || (row_number() OVER (ORDER BY chunk_id))::VARCHAR AS query_id, v AS q FROM (SELECT * FROM {USABLE} ORDER BY chunk_id LIMIT 3))"


def dense_sql(n: int, keep: str = "true") -> str:
    return f"""(SELECT query_id, chunk_id, doc_id, path, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) - 1 AS rank FROM
(SELECT query_id, chunk_id, doc_id, path, round(list_cosine_similarity(v, q), 6) AS score FROM {USABLE}, {PICKED} WHERE {keep})) WHERE rank < {n})"""


def _queries(texts: dict[str, str]) -> list[search.Query]:
    return [search.Query(k, v) for k, v in texts.items()]


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "chunks")


_stores: dict[tuple[str, str], index.Store] = {}


def _store(spark: SparkSession, sf: str) -> index.Store:
    """The stored index of the chunk table, built in the shared folder by the first query of a session that asks."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stores:
        _stores[key] = index.build(spark, fresh_folder(spark), _chunks(spark, sf))
    return _stores[key]


def _vector_queries(spark: SparkSession, sf: str, texts: list[str] | None = None) -> list[search.Query]:
    """The three smallest ids with a usable vector ask for what is like them."""
    usable = (F.size("vector") == 128) & F.exists("vector", lambda x: x != 0)
    rows = _chunks(spark, sf).where(usable).groupBy("chunk_id").agg(F.first("vector").alias("v")).orderBy("chunk_id").limit(3).collect()
    return [search.Query(f"v{i + 1}", (texts or [""] * 3)[i], tuple(r.v)) for i, r in enumerate(rows)]


@query("SELECT chunk_id, len(list_filter(string_split(regexp_replace(regexp_replace(text, '([一-鿿])', ' \\1 ', 'g'), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'), ' '), lambda x: x <> '')) AS n_tokens FROM (SELECT DISTINCT chunk_id, text FROM chunks)")
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks(spark, sf).select("chunk_id", F.size(tx.stub_tokens("text")).alias("n_tokens"), F.sha1("text").alias("_h")).distinct().drop("_h")


@query(f"SELECT term, count(*) AS df FROM (SELECT DISTINCT chunk_id, unnest({TOKENS}) AS term FROM {CHUNKS}) GROUP BY term")
def bm25_stats(spark: SparkSession, sf: str) -> DataFrame:
    return search.bm25_stats(_chunks(spark, sf))


@query(f"SELECT query_id, chunk_id, score, rank FROM {bm25_sql(TEXTS, 50)}")
def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    return search.bm25(_store(spark, sf), _queries(TEXTS), 50).select("query_id", "chunk_id", "score", F.col("rank").cast("long"))


@query(f"SELECT query_id, chunk_id, score, rank FROM {bm25_sql(TEXTS, 50)}")
def bm25_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The same without an index, by a scan of the chunks."""
    return search.bm25(_chunks(spark, sf), _queries(TEXTS), 50).select("query_id", "chunk_id", "score", F.col("rank").cast("long"))


@query(f"SELECT query_id, chunk_id, score, rank FROM {bm25_sql({'id': 'v1.18.38 LAB-21'}, 20)}")
def fts_exact_identifier(spark: SparkSession, sf: str) -> DataFrame:
    return search.bm25(_store(spark, sf), [search.Query("id", "v1.18.38 LAB-21")], 20).select("query_id", "chunk_id", "score", F.col("rank").cast("long"))


@query(f"SELECT chunk_id, doc_id, path FROM {CHUNKS} WHERE contains(' ' || array_to_string({TOKENS}, ' ') || ' ', ' packet parser ')")
def fts_phrase(spark: SparkSession, sf: str) -> DataFrame:
    return search.phrase(_chunks(spark, sf), "packet parser")


@query(f"SELECT query_id, chunk_id, score, rank FROM {bm25_sql(TEXTS, 30, keep='starts_with(p.path, $$tracker_export/$$)')}")
def search_prefilter(spark: SparkSession, sf: str) -> DataFrame:
    hits = search.bm25(_store(spark, sf), _queries(TEXTS), 30, search.where(["tracker_export/"]))
    return hits.select("query_id", "chunk_id", "score", F.col("rank").cast("long"))


@query("""SELECT query_id, vec_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) - 1 AS rank FROM
(SELECT q.vec_id::VARCHAR AS query_id, e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0)) WHERE rank < 10""")
def dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The ten nearest embeddings of every one whose id is divisible by 50, exactly."""
    e = table(spark, sf, "embeddings")
    qs = [search.Query(str(r.vec_id), "", tuple(r.embedding)) for r in e.where("vec_id % 50 = 0").orderBy("vec_id").collect()]
    hits = search.dense(e, qs, 10, key="vec_id", vector="embedding", carry=())
    return hits.select("query_id", "vec_id", "score", F.col("rank").cast("long"))


@query(f"SELECT query_id, chunk_id, score, rank FROM {dense_sql(20, keep='starts_with(path, $$wiki_mirror/$$)')}")
def dense_prefilter(spark: SparkSession, sf: str) -> DataFrame:
    hits = search.dense(_chunks(spark, sf), _vector_queries(spark, sf), 20, search.where(["wiki_mirror/"]))
    return hits.select("query_id", "chunk_id", "score", F.col("rank").cast("long"))


@query(None)
def ann_ivf_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The ten nearest of every embedding whose id is divisible by 50, by a stored inverted file. These vectors are close
    to random, so 0.7 of the cells must be probed for a recall above 0.9."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    qs = [search.Query(str(r.vec_id), "", tuple(r.embedding)) for r in e.where("vec_id % 50 = 0").orderBy("vec_id").collect()]
    folder = fresh_folder(spark)
    search.build_ivf(e, folder, "vec_id", "embedding", least=0)
    return search.ann(spark, folder, qs, 10, 0.7, "vec_id")


@query("""SELECT query_id, vec_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) - 1 AS rank FROM
(SELECT q.vec_id::VARCHAR AS query_id, e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score FROM embeddings e, embeddings q WHERE q.vec_id % 50 = 0)) WHERE rank < 10""")
def ann_small(spark: SparkSession, sf: str) -> DataFrame:
    """The same below the size from which cells are made: exact."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    qs = [search.Query(str(r.vec_id), "", tuple(r.embedding)) for r in e.where("vec_id % 50 = 0").orderBy("vec_id").collect()]
    folder = fresh_folder(spark)
    search.build_ivf(e, folder, "vec_id", "embedding")
    hits = search.ann(spark, folder, qs, 10, 1, "vec_id")
    return hits.select("query_id", "vec_id", "score", F.col("rank").cast("long"))


VTEXT = ["packet parser", "latency", "collector"]
VTEXTS = {f"v{i + 1}": t for i, t in enumerate(VTEXT)}
BOTH = f"(SELECT * FROM {bm25_sql(VTEXTS, 50)} UNION ALL BY NAME SELECT * FROM {dense_sql(50)})"
FUSED = f"(SELECT query_id, chunk_id, min(doc_id) AS doc_id, round(sum(1 / (60 + rank + 1)), 6) AS score FROM {BOTH} GROUP BY query_id, chunk_id)"


@query(f"SELECT query_id, chunk_id, score FROM {FUSED}")
def rrf_fuse(spark: SparkSession, sf: str) -> DataFrame:
    c, qs = _chunks(spark, sf), _vector_queries(spark, sf, VTEXT)
    cols = ["query_id", "chunk_id", "rank"]
    return search.fuse(search.bm25(_store(spark, sf), qs, 50).select(*cols).unionByName(search.dense(c, qs, 50).select(*cols)))


@query(f"SELECT query_id, doc_id, doc_score, doc_rank, chunk_id, score, chunk_rank FROM {group_sql(FUSED, 2, 10)}")
def hybrid_search(spark: SparkSession, sf: str) -> DataFrame:
    out = search.search(_store(spark, sf), _vector_queries(spark, sf, VTEXT), "hybrid")
    return out.withColumns({c: F.col(c).cast("long") for c in ("doc_rank", "chunk_rank")})


@query(f"SELECT query_id, doc_id, doc_score, doc_rank, chunk_id, score, chunk_rank FROM {group_sql(bm25_sql(TEXTS, 50), 2, 10)}")
def group_by_doc(spark: SparkSession, sf: str) -> DataFrame:
    out = search.search(_store(spark, sf), _queries(TEXTS), "fts")
    return out.withColumns({c: F.col(c).cast("long") for c in ("doc_rank", "chunk_rank")})


LEG_HITS = group_sql(bm25_sql(LEGS, 100), 6, 12)


def leg_hits(spark: SparkSession, sf: str) -> DataFrame:
    return search.search(_store(spark, sf), _queries(LEGS), "fts", top=12, per_doc=6, fetch_k=100)


@query(f"SELECT query_id, doc_id, doc_score, doc_rank, chunk_id, score, chunk_rank FROM {LEG_HITS}")
def multi_leg_search(spark: SparkSession, sf: str) -> DataFrame:
    """A question and each of its terms as legs of their own, in one job."""
    return leg_hits(spark, sf).withColumns({c: F.col(c).cast("long") for c in ("doc_rank", "chunk_rank")})


MERGED = f"""(WITH h AS MATERIALIZED (SELECT * FROM {LEG_HITS}), c AS (SELECT doc_id, chunk_id, max(score) AS score FROM h GROUP BY ALL), d AS (SELECT doc_id, max(doc_score) AS doc_score FROM h GROUP BY ALL)
SELECT k.doc_id, k.chunk_id, k.score, k.chunk_rank, d.doc_score FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, chunk_id) - 1 AS chunk_rank FROM c) k JOIN d USING (doc_id) WHERE chunk_rank < 6)"""


@query(f"SELECT doc_id, chunk_id, score, chunk_rank, doc_score FROM {MERGED}")
def merge_hits(spark: SparkSession, sf: str) -> DataFrame:
    return search.merge_hits(leg_hits(spark, sf), 6).withColumn("chunk_rank", F.col("chunk_rank").cast("long"))


RESCORED = f"(SELECT doc_id, round(sum(1 / (60 + doc_rank + 1)), 6) AS score FROM (SELECT DISTINCT query_id, doc_id, doc_rank FROM {LEG_HITS}) GROUP BY doc_id)"


@query(f"SELECT doc_id, score FROM {RESCORED}")
def rrf_rescore(spark: SparkSession, sf: str) -> DataFrame:
    return search.rescore(leg_hits(spark, sf))


@query(f"SELECT doc_id, doc_score FROM (SELECT doc_id, max(doc_score) AS doc_score FROM {LEG_HITS} GROUP BY doc_id ORDER BY doc_score DESC, doc_id LIMIT 40)")
def union_context(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import rag

    return rag.union_context(leg_hits(spark, sf))


@query(f"SELECT query_id, doc_id, min(rank) AS best_rank FROM {bm25_sql(LEGS, 100)} GROUP BY query_id, doc_id")
def term_rank_probe(spark: SparkSession, sf: str) -> DataFrame:
    hits = search.bm25(_store(spark, sf), _queries(LEGS), 100)
    return search.term_ranks(hits).withColumn("best_rank", F.col("best_rank").cast("long"))


NUMBER = "CASE WHEN x = floor(x) THEN x::BIGINT::VARCHAR || '.0' ELSE x::VARCHAR END"


def _number(c: str) -> str:
    return NUMBER.replace("x", c)


@query(f"""SELECT query_id, doc_rank, '{{"doc_id":"' || doc_id || '","score":' || {_number('doc_score')} || ',"chunks":[' || string_agg('{{"chunk_rank":' || chunk_rank || ',"chunk_id":"' || chunk_id || '","score":' || {_number('score')} || '}}', ',' ORDER BY chunk_rank) || ']}}' AS value
FROM {group_sql(bm25_sql(TEXTS, 50), 2, 10)} GROUP BY query_id, doc_rank, doc_id, doc_score""")
def search_json(spark: SparkSession, sf: str) -> DataFrame:
    return io.json_hits(search.search(_store(spark, sf), _queries(TEXTS), "fts")).withColumn("doc_rank", F.col("doc_rank").cast("long"))


@query(f"""SELECT doc_id AS id, doc_score AS score, doc_rank AS rank FROM (SELECT DISTINCT query_id, doc_id, doc_score, doc_rank FROM {group_sql(bm25_sql(TEXTS, 50), 2, 10)}) WHERE query_id = 'q1'""")
def search_to_triage(spark: SparkSession, sf: str) -> DataFrame:
    """Hits of one query in the shape of triage rows."""
    hits = search.search(_store(spark, sf), _queries(TEXTS), "fts").where("query_id = 'q1'")
    return hits.select(F.col("doc_id").alias("id"), F.col("doc_score").alias("score"), F.col("doc_rank").cast("long").alias("rank")).distinct()


@query(None)
def embed_hash(spark: SparkSession, sf: str) -> DataFrame:
    return search.hash_encode(_chunks(spark, sf).select("chunk_id", "text")).select("chunk_id", "vector")


DOCS = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY shard_file DESC, line_no DESC) rn FROM records WHERE id IS NOT NULL) WHERE rn = 1)"
STUB = r"list_filter(string_split(regexp_replace(regexp_replace(coalesce(text, ''), '([一-鿿])', ' \1 ', 'g'), '[ \t\n\x0b\f\r]+', ' ', 'g'), ' '), lambda x: x <> '')"


@query(f"""SELECT id, i AS chunk_index, len(w) AS n_tokens, sha1(array_to_string(w, ' ')) AS tokens_sha1 FROM (SELECT id, i, toks[i * 85 + 1 : i * 85 + 100] AS w FROM
(SELECT id, toks, unnest(range(greatest(CAST(ceil((len(toks) - 100) / 85.0) AS BIGINT), 0) + 1)) AS i FROM (SELECT id, {STUB} AS toks FROM {DOCS}) WHERE len(toks) > 0))""")
def chunk_fixed(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import ingest

    w = chunking.fixed_windows(ingest.dedup(table(spark, sf, "records"), "last"), 100, 15)
    return w.select("id", F.col("chunk_index").cast("long"), F.col("n_tokens").cast("long"), F.sha1(F.array_join("tokens", " ")).alias("tokens_sha1"))


def _greedy(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import ingest

    return chunking.chunk_documents(ingest.dedup(table(spark, sf, "records"), "last"), target=120, most=150, overlap=25)


@query(None)
def chunk_docs(spark: SparkSession, sf: str) -> DataFrame:
    return _greedy(spark, sf)


@query(f"SELECT 0 AS n_bad_text, 0 AS n_bad_order, count_if(regexp_matches(coalesce(text, ''), '[^ \\t\\n\\x0b\\f\\r]')) AS n_docs FROM {DOCS}")
def chunk_roundtrip_check(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks whose text isn't the record's slice, and gaps in a record's numbering: none; and records with chunks: all
    that hold a token."""
    from ..operators import ingest

    r = ingest.dedup(table(spark, sf, "records"), "last").select("id", F.col("text").alias("doc"))
    c = _greedy(spark, sf).join(r, "id")
    bad = F.col("text") != F.substring("doc", F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))
    a = c.agg(F.count_if(bad).cast("int").alias("n_bad_text")).withColumn("k", F.lit(1))
    n = c.groupBy("id").agg(F.count("*").alias("n"), F.max("chunk_index").alias("m"), F.min("chunk_index").alias("z"))
    b = n.agg(F.count_if((F.col("m") + 1 != F.col("n")) | (F.col("z") != 0)).cast("int").alias("n_bad_order"), F.count("*").alias("n_docs")).withColumn("k", F.lit(1))
    return a.join(b, "k").drop("k")


@query(f"SELECT 0 AS n_gaps, CAST(sum(greatest(CAST(ceil((len(toks) - 100) / 85.0) AS BIGINT), 0)) AS BIGINT) AS n_joints FROM (SELECT {STUB} AS toks FROM {DOCS}) WHERE len(toks) > 0")
def chunk_overlap_check(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed windows that don't share their overlap with the one before: none, of all that have one before."""
    from pyspark.sql import Window

    from ..operators import ingest

    w = chunking.fixed_windows(ingest.dedup(table(spark, sf, "records"), "last"), 100, 15)
    prev = F.lag("tokens").over(Window.partitionBy("id").orderBy("chunk_index"))
    bad = prev.isNotNull() & (F.slice(prev, -15, 15) != F.slice("tokens", 1, 15))
    w = w.withColumns({"bad": bad, "joint": F.when(prev.isNotNull(), 1)})
    return w.agg(F.count_if("bad").cast("int").alias("n_gaps"), F.count("joint").alias("n_joints"))
