"""Retrieval: predicates, BM25 and vector legs, rank fusion, grouping by document, multi-leg merge.

A search is a list of Query rows that the caller states; queries are few and given, so they are literals of the plan.
All legs of all queries run in one job over the corpus. Scores are rounded before ranking and ties go by id, so any
partitioning gives the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import spread
from .index import Store

K1, B, RRF_K = 1.2, 0.75, 60
MODES = ("fts", "dense", "hybrid")
#: Queries of one vector search at most; more are run block by block.
QUERY_BLOCK = 4096


@dataclass(frozen=True)
class Query:
    query_id: str
    text: str = ""
    vector: tuple[float, ...] | None = None


def fetch_size(top_k: int, fetch_k: int | None = None) -> int:
    return fetch_k or max(50, 5 * top_k)


def where(prefixes: list[str] | None = None, lang: str | None = None, raw: str | None = None) -> Column | None:
    """Any of the path prefixes (literally), and the language, and a raw SQL predicate (from trusted callers only);
    None if nothing is asked."""
    parts = []
    if prefixes:
        some = F.lit(False)
        for p in prefixes:
            some = some | F.col("path").startswith(p)
        parts.append(some)
    if lang:
        parts.append(F.col("lang") == lang)
    if raw:
        parts.append(F.expr(raw))
    out = None
    for p in parts:
        out = p if out is None else out & p
    return out


def _tokens(chunks: DataFrame) -> DataFrame:
    return spread(chunks.where(F.col("chunk_id").isNotNull())).select(
        "*", F.explode(F.array(tx.search_tokens("text"))).alias("_tokens")  # a generator of one row: tokens are made once
    )


def bm25_stats(chunks: DataFrame) -> DataFrame:
    """term, df of all search terms; chunks of one id count once."""
    each = _tokens(chunks).select("chunk_id", F.explode(F.array_distinct("_tokens")).alias("term")).distinct()
    return each.groupBy("term").agg(F.count("*").alias("df"))


def _scanned(chunks: DataFrame, terms: list[str], condition: Column | None) -> tuple[DataFrame, DataFrame]:
    """(postings of the terms, totals) of a chunk table without an index. Only counts of query terms leave the scan."""
    toks = _tokens(chunks)
    keep = condition if condition is not None else F.lit(True)
    base = toks.groupBy("chunk_id").agg(
        F.max(F.size("_tokens")).alias("dl"),
        F.first(F.filter("_tokens", lambda x: x.isin(terms))).alias("met"),
        F.max(F.coalesce(keep, F.lit(False))).alias("keep"),
        F.min("doc_id").alias("doc_id"),
        F.min("path").alias("path"),
    )
    totals = base.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"))
    key = ["chunk_id", "doc_id", "path", "dl", "keep"]
    return base.select(*key, F.explode("met").alias("term")).groupBy(*key, "term").agg(F.count("*").alias("tf")), totals


def bm25(chunks: DataFrame | Store, queries: list[Query], fetch_k: int, condition: Column | None = None, spark: SparkSession | None = None) -> DataFrame:
    """query_id, chunk_id, doc_id, path, score, rank (from 0) of each query's best chunks by Okapi BM25, with
    idf = ln(1 + (N - df + 0.5) / (df + 0.5)) over all chunks. The condition applies before the cut; statistics are of the
    whole corpus.

    Of a Store only the postings of the query terms are read, and the condition may speak of doc_id, path, lang and ext;
    a DataFrame is scanned whole."""
    terms = sorted({t for q in queries for t in tx.fold_query(q.text)})
    if isinstance(chunks, Store):
        spark = spark or SparkSession.active()
        posts = chunks.postings(spark, terms)
        keep = F.coalesce(condition, F.lit(False)) if condition is not None else F.lit(True)
        posts, totals = posts.withColumn("keep", keep), chunks.totals(spark)
    else:
        spark = chunks.sparkSession
        posts, totals = _scanned(chunks, terms, condition)
    dfs = posts.groupBy("term").agg(F.count("*").alias("df"))
    pairs = sorted({(q.query_id, t) for q in queries for t in tx.fold_query(q.text)})
    asked = spark.createDataFrame(pairs or [("", "")], "query_id string, term string").where("term <> ''")
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    scored = (
        posts.where("keep").withColumn("_k", F.lit(1))
        .join(F.broadcast(dfs), "term")  # no more rows than the queries have terms
        .join(F.broadcast(totals.withColumn("_k", F.lit(1))), "_k")  # one row
        .join(F.broadcast(asked), "term")
        .groupBy("query_id", "chunk_id", "doc_id", "path")
        .agg(F.round(F.sum(weight), 6).alias("score"))
    )
    return top_k(scored, fetch_k)


def top_k(scored: DataFrame, k: int, by: str = "query_id", key: str = "chunk_id") -> DataFrame:
    """The k best rows of each query, with rank from 0; ties go to the smaller key."""
    w = Window.partitionBy(by).orderBy(F.desc("score"), key)
    return scored.withColumn("rank", F.row_number().over(w) - 1).where(F.col("rank") < k)


def phrase(chunks: DataFrame, text: str) -> DataFrame:
    """chunk_id, doc_id, path of chunks that hold the query's tokens next to each other, in order."""
    words = [w for w in tx.fold_query(text)]
    needle = F.lit(" " + " ".join(words) + " ")
    hay = F.concat(F.lit(" "), F.array_join("_tokens", " "), F.lit(" "))
    return _tokens(chunks).where(F.contains(hay, needle)).select("chunk_id", "doc_id", "path").distinct()


def dense(
    vectors: DataFrame, queries: list[Query], fetch_k: int, condition: Column | None = None, key: str = "chunk_id",
    vector: str = "vector", carry: tuple[str, ...] = ("doc_id", "path"),
) -> DataFrame:
    """query_id, key, carried columns, score, rank of each query's nearest rows by cosine. The condition applies before the
    cut. Rows without a usable vector (null, another size, all zero) don't match; repeated rows count once.

    Each task multiplies its vectors with the block of queries and keeps its own best; only those are shuffled."""
    asked = [q for q in queries if q.vector is not None]
    spark = vectors.sparkSession
    cols = [key, *carry]
    rows = vectors.where(condition) if condition is not None else vectors
    field = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = "query_id string, " + ", ".join(f"{c} {field[c]}" for c in cols) + ", score double"
    out = None
    for s in range(0, len(asked), QUERY_BLOCK):
        part = asked[s : s + QUERY_BLOCK]
        q = np.array([p.vector for p in part], np.float64)
        norm = np.linalg.norm(q, axis=1)
        q /= np.where(norm == 0, 1, norm)[:, None]
        shared = spark.sparkContext.broadcast(([p.query_id for p in part], q))
        dim = q.shape[1]
        usable = rows.where((F.size(vector) == dim) & F.exists(vector, lambda x: x != 0) & F.col(key).isNotNull()).select(*cols, F.col(vector).cast("array<float>").alias("_v"))
        found = usable.mapInArrow(_nearest(shared, dim, fetch_k, cols, schema), schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], schema + ", rank int")
    return top_k(out.distinct(), fetch_k, key=key)


def _nearest(shared, dim: int, k: int, cols: list[str], schema: str):
    def run(batches):
        names, q = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            flat = b.column(len(cols)).flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(-1, dim).astype(np.float64)
            x /= np.linalg.norm(x, axis=1)[:, None]
            sims = np.round(q @ x.T, 6)
            _, first = np.unique(b.column(0).to_numpy(zero_copy_only=False), return_index=True)
            again = np.ones(sims.shape[1], bool)
            again[first] = False  # repeated rows must hold no places
            sims[:, again] = -9
            take = min(k, sims.shape[1])
            best = np.argpartition(-sims, take - 1, axis=1)[:, :take]
            # all rows as good as the last one taken stay in, so ties are cut by key, not by chance
            edge = np.take_along_axis(sims, best, 1).min(axis=1)
            qi, xi = np.nonzero((sims >= edge[:, None]) & ~again)
            idx = pa.array(xi)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in qi], pa.string()), *[b.column(c).take(idx) for c in range(len(cols))], pa.array(sims[qi, xi])],
                names=["query_id", *cols, "score"],
            )

    return run


def fuse(legs: DataFrame, k: int = RRF_K, key: str = "chunk_id") -> DataFrame:
    """query_id, key, score: reciprocal rank fusion, the sum of 1 / (k + rank + 1) over the legs that found it."""
    return legs.groupBy("query_id", key).agg(F.round(F.sum(1 / (k + F.col("rank") + 1)), 6).alias("score"))


def group_by_doc(hits: DataFrame, per_doc: int, top: int) -> DataFrame:
    """query_id, doc_id, doc_score, doc_rank, chunk_id, score, chunk_rank: documents by their best chunk, with at most
    `per_doc` chunks each."""
    w = Window.partitionBy("query_id", "doc_id").orderBy(F.desc("score"), "chunk_id")
    kept = hits.withColumn("chunk_rank", F.row_number().over(w) - 1).where(F.col("chunk_rank") < per_doc)
    docs = hits.groupBy("query_id", "doc_id").agg(F.max("score").alias("doc_score"))
    d = Window.partitionBy("query_id").orderBy(F.desc("doc_score"), "doc_id")
    docs = docs.withColumn("doc_rank", F.row_number().over(d) - 1).where(F.col("doc_rank") < top)
    return docs.join(kept.select("query_id", "doc_id", "chunk_id", "score", "chunk_rank"), ["query_id", "doc_id"])


def search(
    chunks: DataFrame | Store, queries: list[Query], mode: str = "hybrid", top: int = 10, per_doc: int = 2, rrf_k: int = RRF_K,
    fetch_k: int | None = None, condition: Column | None = None,
) -> DataFrame:
    """Grouped hits of every query, in a chunk table or a stored index. fts never looks at vectors; another mode than fts, dense and hybrid raises."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    n = fetch_size(top, fetch_k)
    legs = []
    if mode != "dense":
        legs.append(bm25(chunks, queries, n, condition))
    if mode != "fts":
        vectors = chunks.chunks(SparkSession.active()) if isinstance(chunks, Store) else chunks
        legs.append(dense(vectors, queries, n, condition))
    cols = ["query_id", "chunk_id", "doc_id", "path", "score", "rank"]
    if len(legs) == 1:
        hits = legs[0].select(*cols)
    else:
        both = legs[0].select(*cols).unionByName(legs[1].select(*cols))
        docs = both.groupBy("query_id", "chunk_id").agg(F.min("doc_id").alias("doc_id"))
        hits = fuse(both, rrf_k).join(docs, ["query_id", "chunk_id"])
    return group_by_doc(hits, per_doc, top)


def merge_hits(hits: DataFrame, per_doc: int) -> DataFrame:
    """Hits of several searches as one list: a chunk's best score, a document's best score, the best chunks of each."""
    chunk = hits.groupBy("doc_id", "chunk_id").agg(F.max("score").alias("score"))
    doc = hits.groupBy("doc_id").agg(F.max("doc_score").alias("doc_score"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("score"), "chunk_id")
    kept = chunk.withColumn("chunk_rank", F.row_number().over(w) - 1).where(F.col("chunk_rank") < per_doc)
    return kept.join(doc, "doc_id")


def rescore(hits: DataFrame, k: int = RRF_K) -> DataFrame:
    """doc_id, score: documents fused over the legs (query_id) by their rank in each."""
    docs = hits.select("query_id", "doc_id", F.col("doc_rank").alias("rank")).distinct()
    return docs.groupBy("doc_id").agg(F.round(F.sum(1 / (k + F.col("rank") + 1)), 6).alias("score"))


def term_ranks(hits: DataFrame) -> DataFrame:
    """query_id, doc_id, best_rank: each leg's best rank of a document, to see which term found it."""
    return hits.groupBy("query_id", "doc_id").agg(F.min("rank").alias("best_rank"))


#: Vectors from which an inverted file pays, sampled rows on which its cells are fitted and cells, both at most.
IVF_ROWS, IVF_SAMPLE, IVF_CELLS = 50_000, 20_000, 4_096


def fit_cells(vectors: DataFrame, key: str, vector: str, seed: int = 11) -> np.ndarray:
    """Unit centroids of about the square root of n cells, by k-means on a bounded sample picked by the hash of the key."""
    n = vectors.count()
    share = min(1.0, 1.2 * IVF_SAMPLE / max(n, 1))
    rows = vectors.where(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int(share * (1 << 20))).select(vector).limit(IVF_SAMPLE).collect()
    x = np.array([r[0] for r in rows], np.float32).reshape(len(rows), -1)
    x /= np.maximum(np.linalg.norm(x, axis=1), 1e-12)[:, None]
    rng = np.random.default_rng(seed)
    cells = min(max(1, int(n**0.5)), IVF_CELLS, len(x))
    c = x[rng.choice(len(x), cells, replace=False)] if cells else x[:0]
    for _ in range(8 if cells else 0):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1)
        c = np.where(norm[:, None] > 1e-9, total / np.maximum(norm, 1e-9)[:, None], c)
    return c


def build_ivf(vectors: DataFrame, folder: str, key: str, vector: str, least: int = IVF_ROWS) -> None:
    """Writes usable vectors (key, vector) under their cell, a folder each, and the centroids last. With fewer
    than `least` vectors there is one cell, so a search is exact."""
    spark = vectors.sparkSession
    usable = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & F.exists(vector, lambda x: x != 0))
    dim = usable.groupBy(F.size(vector).alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    usable = usable.where(F.size(vector) == (dim[0].dim if dim else 0)).select(key, F.col(vector).cast("array<float>").alias("v"))
    c = fit_cells(usable, key, "v") if usable.count() >= least else np.zeros((1, dim[0].dim if dim else 0), np.float32)
    shared = spark.sparkContext.broadcast(c)

    def assign(batches):
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                x = x / np.linalg.norm(x, axis=1)[:, None]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array((x @ shared.value.T).argmax(axis=1), pa.int32())], names=[key, "v", "cell"])

    placed = usable.mapInArrow(assign, f"{key} {dict(usable.dtypes)[key]}, v array<float>, cell int")
    placed.repartition("cell").write.mode("overwrite").partitionBy("cell").parquet(f"{folder}/cells")
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(c)]
    spark.createDataFrame(rows, "cell int, centroid array<float>").coalesce(1).write.mode("overwrite").parquet(f"{folder}/centroids")


def ann(spark: SparkSession, folder: str, queries: list[Query], k: int, probes: float, key: str) -> DataFrame:
    """query_id, key, score, rank: the k nearest rows of each query among those of its `probes` nearest cells (below 1: that
    share of all cells), by exact cosine. Only the folders of cells that some query probes are read; each task multiplies
    a cell's rows with the queries that probe it and keeps its own best."""
    rows = spark.read.parquet(f"{folder}/centroids").orderBy("cell").collect()
    c = np.array([r.centroid for r in rows], np.float32).reshape(len(rows), -1)
    asked = [q for q in queries if q.vector is not None and len(q.vector) == c.shape[1]]
    cells = spark.read.parquet(f"{folder}/cells")
    schema = f"query_id string, {key} {dict(cells.dtypes)[key]}, score double"
    if not asked:
        return spark.createDataFrame([], schema + ", rank int")
    q = np.array([p.vector for p in asked], np.float64)
    q /= np.maximum(np.linalg.norm(q, axis=1), 1e-12)[:, None]
    most = int(np.ceil(probes * len(c))) if probes < 1 else min(int(probes), len(c))
    near = np.argsort(-(q @ c.T), axis=1, kind="stable")[:, :most]
    by_cell = {int(j): np.flatnonzero((near == j).any(axis=1)) for j in np.unique(near)}
    shared = spark.sparkContext.broadcast(([p.query_id for p in asked], q, by_cell))
    kind = pa.string() if dict(cells.dtypes)[key] == "string" else None

    def run(batches):
        names, vectors, wanted = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.float64)
            x /= np.linalg.norm(x, axis=1)[:, None]
            cell = b.column(2).to_numpy(zero_copy_only=False)
            for j in np.unique(cell):
                rows, ask = np.flatnonzero(cell == j), wanted[int(j)]
                sims = np.round(vectors[ask] @ x[rows].T, 6)
                edge = -np.partition(-sims, min(k, len(rows)) - 1, axis=1)[:, min(k, len(rows)) - 1]
                qi, xi = np.nonzero(sims >= edge[:, None])
                ids = b.column(0).take(pa.array(rows[xi]))
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in ask[qi]], pa.string()), ids if kind is None else ids.cast(kind), pa.array(sims[qi, xi])], names=["query_id", key, "score"])

    found = cells.where(F.col("cell").isin(list(by_cell))).select(key, "v", "cell").mapInArrow(run, schema)
    return top_k(found.distinct(), k, key=key)


def hash_encode(chunks: DataFrame, dim: int = 256, text: str = "text") -> DataFrame:
    """chunks with `vector`: signed feature hashing of stub tokens at length one. A lexical stand-in for an encoder,
    without a model; empty texts give zeros."""
    tokens = tx.stub_tokens(F.lower(text))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chunks.schema if f.name != "vector")
    keep = [c for c in chunks.columns if c != "vector"]
    hashed = chunks.select(*keep, F.transform(tokens, lambda t: F.xxhash64(t)).alias("_h"))

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            h = b.column(len(keep))
            values = h.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(b.num_rows), h.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            v = np.zeros((b.num_rows, dim), np.float32)
            np.add.at(v, (row, values % dim), np.where((values >> 40) & 1, 1.0, -1.0))
            norm = np.linalg.norm(v, axis=1)
            v /= np.where(norm == 0, 1, norm)[:, None]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(list(v), pa.list_(pa.float32()))], names=[*b.schema.names[:-1], "vector"])

    return hashed.mapInArrow(run, schema + ", vector array<float>")
