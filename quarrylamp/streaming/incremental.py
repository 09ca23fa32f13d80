"""Incremental indexing as a stream: new shards are classified, chunked and committed batch by batch.

The checkpoint folder takes the place of a list of finished files. A shard rewritten in place isn't read again by the
file source; the batch classification over all records stays the authority for that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunking, index
from ..operators.ingest import dedup
from ..sources import io


def index_batch(batch: DataFrame, folder: str, exclude: list[str], **options) -> index.Store:
    """Folds a batch of records into the index at `folder`: chunks of new and changed documents and manifest rows of all
    touched ones make a part of their own, of moved ones the location is brought up to date, and nothing else is
    written. Null columns shard_file, line_no and byte_offset are put in where a batch lacks them."""
    spark = batch.sparkSession
    store = index.open_store(spark, folder)
    manifest = store.manifest(spark) if store else spark.createDataFrame([], index.MANIFEST + ", n_tokens bigint, part int")
    rows = batch
    for name, kind in (("shard_file", "string"), ("line_no", "int"), ("byte_offset", "bigint")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    classes = index.classify(rows, manifest.drop("n_tokens", "part"), exclude)
    touched = classes.where("class <> 'unchanged'")
    staged = touched.select("id", "class", "text_sha1").join(
        dedup(rows.select("id", "path", "ext", "lang", "char_count", "shard_file", "line_no", "byte_offset", "text"), "first"), "id"
    )
    new = staged.where(F.col("class").isin("new", "changed"))
    fresh = chunking.chunk_documents(new, "id", ("path", "ext", "lang"), **options).withColumnRenamed("id", "doc_id")
    status = F.when(F.col("class").isin("new", "changed"), "indexed").otherwise(F.col("class"))
    rows_new = staged.select(
        F.col("id").alias("doc_id"), "path", "ext", "lang", "char_count", "text_sha1", F.lit(0).alias("n_chunks"), "shard_file", "byte_offset",
        status.alias("status"), F.current_timestamp().alias("indexed_at"), F.lit(None).cast("bigint").alias("n_tokens"), F.lit(None).cast("int").alias("part"),
    )
    place = dedup(rows.select("id", "shard_file", "line_no", "byte_offset"), "first").select(F.col("id").alias("doc_id"), F.col("shard_file").alias("_s"), F.col("byte_offset").alias("_o"))
    moved = manifest.join(classes.where("moved").select(F.col("id").alias("doc_id")), "doc_id", "left_semi").join(place, "doc_id")
    moved = moved.withColumns({"shard_file": F.col("_s"), "byte_offset": F.col("_o")}).select(*rows_new.columns)
    store = index.commit(store, folder, fresh, rows_new.unionByName(moved))
    return index.compact(spark, store) if len(store.parts) >= index.COMPACT_FROM else store


def stream_shards(spark: SparkSession, shards: str, folder: str, checkpoint: str, exclude: list[str] | None = None, bad: str | None = None, **options):
    """Runs over all shards that have arrived and stops; call it again for later ones. Lines that can't be read go to the
    folder `bad` (default <folder>/bad_lines) as shard_file, line; they are never records."""
    files = spark.readStream.format("binaryFile").schema(io.BINARY_SCHEMA).option("recursiveFileLookup", "true").load(shards)

    def each(batch: DataFrame, number: int) -> None:
        records, broken = io.parse_lines(io.shard_lines(batch))
        index_batch(records, folder, exclude or [], **options)
        broken.select("shard_file", "line_no", "line").write.mode("overwrite").json(f"{bad or folder + '/bad_lines'}/batch={number}")

    return files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
