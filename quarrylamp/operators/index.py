"""Incremental index: change classes, chunk and manifest upserts, location refresh, and the stored index.

A stored index is a folder of parts, one for each commit, that hold what the commit brought: its chunks, their postings
and its manifest rows. A pointer, written last, names the parts in force. Of a document the manifest row of the newest
part counts, and it names the part that holds the document's chunks, so what a commit replaces or empties needs no
rewriting; compact() folds all parts into one. A run that dies before its pointer leaves the version before it in force.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from .ingest import dedup

#: Folders that postings are dealt over by their term; a search opens those of its terms only.
TERM_BUCKETS = 64
#: Parts in force from which a commit of the stream is followed by compact().
COMPACT_FROM = 16
MANIFEST = (
    "doc_id string, path string, ext string, lang string, char_count bigint, text_sha1 string, n_chunks int, shard_file string, "
    "byte_offset bigint, status string, indexed_at timestamp"
)

POSTINGS = "term string, chunk_id string, doc_id string, path string, lang string, ext string, dl int, tf int, bucket int"


def latest(manifest: DataFrame) -> DataFrame:
    """The newest row of each document; rows of one time go by their place."""
    rest = [c for c in manifest.columns if c != "doc_id"]
    order = F.struct("indexed_at", "shard_file", "byte_offset", "text_sha1")
    return (
        manifest.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max_by(F.struct(*rest), order).alias("r"))
        .select("doc_id", *[F.col(f"r.{c}").alias(c) for c in rest])
    )


def excluded(path: Column, substrings: list[str]) -> Column:
    out = F.lit(False)
    for s in substrings:
        out = out | F.coalesce(path, F.lit("")).contains(s)
    return out


def classify(records: DataFrame, manifest: DataFrame, exclude: list[str]) -> DataFrame:
    """id, path, text_sha1, shard_file, class, moved. In this order: excluded (path), unchanged (same text in the
    manifest and not excluded there), empty (blank text), changed (in the manifest), new. The first row of an id counts;
    moved tells that an unchanged text lies elsewhere now.

    Hash and blankness are made in the scan, so no text is shuffled."""
    text = F.coalesce("text", F.lit(""))
    slim = records.select("id", "path", "shard_file", "line_no", F.sha1(text).alias("text_sha1"), text.rlike(r"(?U)\S").alias("_filled"))
    known = latest(manifest).select(
        F.col("doc_id").alias("id"), F.col("text_sha1").alias("_sha"), F.col("shard_file").alias("_shard"), F.col("status").alias("_status")
    )
    joined = dedup(slim, "first").join(known, "id", "left")
    kind = (
        F.when(excluded(F.col("path"), exclude), "excluded")
        .when((F.col("_sha") == F.col("text_sha1")) & (F.col("_status") != "excluded"), "unchanged")
        .when(~F.col("_filled"), "empty")
        .when(F.col("_sha").isNotNull(), "changed")
        .otherwise("new")
    )
    return joined.withColumn("class", kind).select(
        "id", "path", "text_sha1", "shard_file", "class",
        ((F.col("class") == "unchanged") & ~F.col("_shard").eqNullSafe(F.col("shard_file"))).alias("moved"),
    )


def deleted(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """doc_id of manifest rows whose record is gone (opt-in: the reference point is the whole record table)."""
    return latest(manifest).select("doc_id").join(records.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_anti")


def upsert_chunks(chunks: DataFrame, fresh: DataFrame, touched: DataFrame) -> DataFrame:
    """Chunks without those of touched documents (doc_id), and the fresh ones. Touched holds every staged document, so
    one that became empty loses its chunks and a repeated run adds nothing twice."""
    kept = chunks.join(touched.select("doc_id").distinct(), "doc_id", "left_anti").select(*chunks.columns)
    return kept.unionByName(fresh)


def upsert_manifest(manifest: DataFrame, fresh: DataFrame) -> DataFrame:
    """The newest row of each document, replaced where a fresh row exists."""
    old = latest(manifest)
    return old.join(fresh.select("doc_id").distinct(), "doc_id", "left_anti").unionByName(fresh.select(*old.columns))


def refresh_locations(manifest: DataFrame, moved: DataFrame) -> DataFrame:
    """Manifest with the shard of moved documents (doc_id, shard_file) brought up to date; nothing else changes and
    nothing is added."""
    new = moved.groupBy("doc_id").agg(F.max("shard_file").alias("_new"))
    return latest(manifest).join(new, "doc_id", "left").withColumn("shard_file", F.coalesce("_new", "shard_file")).drop("_new")


def stale(rows: DataFrame, records: DataFrame) -> DataFrame:
    """doc_id, status: 'ok', 'stale' (another text is stored now) or 'missing', for stored rows (doc_id, text_sha1)."""
    slim = records.select("id", "shard_file", "line_no", F.sha1(F.coalesce("text", F.lit(""))).alias("_sha"))
    last = dedup(slim, "last").select(F.col("id").alias("doc_id"), "_sha")
    status = F.when(F.col("_sha").isNull(), "missing").when(F.col("_sha") == F.col("text_sha1"), "ok").otherwise("stale")
    return rows.join(last, "doc_id", "left").select("doc_id", status.alias("status"))


# ----------------------------------------------------------------- stored index


@dataclass(frozen=True)
class Store:
    """A version of a stored index: its folder and the parts in force, oldest first."""

    folder: str
    version: int
    parts: tuple[int, ...]

    def _table(self, spark: SparkSession, name: str) -> list[tuple[int, DataFrame]]:
        return [(v, spark.read.parquet(f"{self.folder}/v={v}/{name}")) for v in self.parts]

    def manifest(self, spark: SparkSession) -> DataFrame:
        """One row for each document, that of the newest part; n_tokens is the number of its search tokens, part the one
        that holds its chunks."""
        tables = [df.withColumn("_v", F.lit(v)) for v, df in self._table(spark, "manifest")]
        if len(tables) == 1:
            return tables[0].drop("_v")
        rows = reduce(DataFrame.unionByName, tables)
        rest = [c for c in rows.columns if c not in ("doc_id", "_v")]
        newest = rows.groupBy("doc_id").agg(F.max_by(F.struct(*rest), "_v").alias("r"))
        return newest.select("doc_id", *[F.col(f"r.{c}").alias(c) for c in rest])

    def _in_force(self, spark: SparkSession, tables: list[tuple[int, DataFrame]]) -> DataFrame:
        if len(tables) == 1:
            return tables[0][1]
        held = self.manifest(spark).where("n_chunks > 0").select("doc_id", "part")
        rows = reduce(DataFrame.unionByName, [df.withColumn("part", F.lit(v)) for v, df in tables])
        return rows.join(held, ["doc_id", "part"], "left_semi").drop("part")

    def chunks(self, spark: SparkSession) -> DataFrame:
        return self._in_force(spark, self._table(spark, "chunks"))

    def postings(self, spark: SparkSession, terms: list[str]) -> DataFrame:
        """term, chunk_id, doc_id, path, lang, ext, dl, tf of the terms; no other term's folder is opened."""
        buckets = sorted({term_bucket(t) for t in terms})
        wanted = F.col("bucket").isin(buckets) & F.col("term").isin(terms)
        tables = [(v, spark.read.schema(POSTINGS).parquet(f"{self.folder}/v={v}/postings").where(wanted)) for v in self.parts]
        return self._in_force(spark, tables).drop("bucket")

    def totals(self, spark: SparkSession) -> DataFrame:
        """n (chunks) and avgdl (their mean number of tokens), from the manifest."""
        m = self.manifest(spark).agg(F.sum("n_chunks").alias("n"), F.sum("n_tokens").alias("t"))
        return m.select(F.coalesce("n", F.lit(0)).alias("n"), (F.col("t") / F.nullif(F.col("n"), F.lit(0))).alias("avgdl"))


def term_bucket(term: str) -> int:
    return zlib.crc32(term.encode()) % TERM_BUCKETS


def postings(chunks: DataFrame) -> DataFrame:
    """bucket, term, chunk_id, doc_id, path, lang, ext, dl, tf of all search terms; chunks of one id count once. One
    shuffle, by bucket, serves the counting and the writing; rows lie by term, so files are skipped by it."""
    cols = ["doc_id", "path", "lang", "ext"]
    have = [F.col(c) if c in chunks.columns else F.lit(None).cast("string").alias(c) for c in cols]
    one = chunks.where(F.col("chunk_id").isNotNull()).select("chunk_id", *have, "text").dropDuplicates(["chunk_id"])
    toks = one.select("chunk_id", *cols, tx.search_tokens("text").alias("_t"))
    each = toks.select("chunk_id", *cols, F.size("_t").alias("dl"), F.explode("_t").alias("term"))
    dealt = each.withColumn("bucket", F.pmod(F.crc32(F.encode("term", "UTF-8")), F.lit(TERM_BUCKETS)).cast("int")).repartition("bucket")
    return dealt.groupBy("bucket", "term", "chunk_id", *cols, "dl").agg(F.count("*").cast("int").alias("tf"))


def commit(store: Store | None, folder: str, chunks: DataFrame, manifest: DataFrame, whole: bool = False) -> Store:
    """Adds a part with `chunks` and manifest rows of the touched documents (columns of MANIFEST, and part for a document
    whose chunks stay in an older one), or with `whole` one that takes the place of all before. Writes chunks, postings,
    then the manifest, and last the pointer."""
    spark = manifest.sparkSession
    version = store.version + 1 if store else 1
    parts = (version,) if whole or not store else (*store.parts, version)
    base = f"{folder}/v={version}"
    chunks.write.mode("overwrite").parquet(f"{base}/chunks")
    written = spark.read.parquet(f"{base}/chunks")
    postings(written).sortWithinPartitions("bucket", "term", "chunk_id").write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/postings")
    sizes = written.where(F.col("chunk_id").isNotNull()).select("doc_id", "chunk_id", F.size(tx.search_tokens("text")).alias("t"))
    sizes = sizes.dropDuplicates(["chunk_id"]).groupBy(F.col("doc_id").alias("_doc")).agg(F.count("*").cast("int").alias("_n"), F.sum("t").alias("_t"))
    if "part" not in manifest.columns:
        manifest = manifest.withColumn("part", F.lit(None).cast("int"))
    if "n_tokens" not in manifest.columns:
        manifest = manifest.withColumn("n_tokens", F.lit(None).cast("bigint"))
    here = F.col("part").isNull()
    rows = manifest.join(sizes, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").withColumns(
        {
            "n_chunks": F.when(here, F.coalesce("_n", F.lit(0))).otherwise(F.col("n_chunks")),
            "n_tokens": F.when(here, F.coalesce("_t", F.lit(0))).otherwise(F.col("n_tokens")),
            "part": F.coalesce("part", F.lit(version)),
        }
    )
    rows.drop("_doc", "_n", "_t").write.mode("overwrite").parquet(f"{base}/manifest")
    pointer = spark.createDataFrame([(json.dumps({"version": version, "parts": parts}),)], "value string").coalesce(1)
    pointer.write.mode("overwrite").text(f"{folder}/current-{version}")
    return Store(folder, version, parts)


def open_store(spark: SparkSession, folder: str) -> Store | None:
    """The newest version, by number, None if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/current-*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    versions = [int(f.getPath().getParent().getName().removeprefix("current-")) for f in found or []]
    if not versions:
        return None
    said = json.loads(spark.read.text(f"{folder}/current-{max(versions)}").collect()[0].value)
    return Store(folder, int(said["version"]), tuple(map(int, said["parts"])))


def compact(spark: SparkSession, store: Store) -> Store:
    """The same index in one part, without what later parts have replaced."""
    manifest = store.manifest(spark).withColumn("part", F.lit(None).cast("int")).drop("n_tokens")
    return commit(store, store.folder, store.chunks(spark), manifest, whole=True)


def build(spark: SparkSession, folder: str, chunks: DataFrame) -> Store:
    """An index of a whole chunk table, without a manifest of its own: documents are those of the chunks."""
    kinds = [f.split() for f in MANIFEST.split(", ") if not f.startswith("doc_id")]
    docs = chunks.select("doc_id").distinct().select("doc_id", *[F.lit(None).cast(k).alias(c) for c, k in kinds])
    return commit(open_store(spark, folder), folder, chunks, docs, whole=True)
