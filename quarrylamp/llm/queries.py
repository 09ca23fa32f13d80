"""Queries of this package's operators over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import encoding, languages, mojibake, near_duplicates, neighbours, packing, personal, scan_noise, splitting, token_budget
from .base import table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return scan_noise.noise_kinds(table(spark, sf, "records"))


def p1_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return scan_noise.repaired(table(spark, sf, "records"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates.near_duplicate_pairs(table(spark, sf, "records"))


def p2_members(spark: SparkSession, sf: str) -> DataFrame:
    """Class of equal texts, number of links and group of every id."""
    return near_duplicates.near_duplicate_members(table(spark, sf, "records"))


def p2_class_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Near duplicates among different texts: pairs of classes, their similarity and sizes."""
    return near_duplicates.class_pairs_and_members(table(spark, sf, "records"))[0]


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs = neighbours.expand_copies(table(spark, sf, "chunks"), min_similarity=0.80)
    return pairs.select(
        F.least("id", "neighbour").alias("chunk_id_a"), F.greatest("id", "neighbour").alias("chunk_id_b")
    ).distinct()


def p3_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The ten nearest of every chunk whose number (the checksum of its id) is divisible by 50, against all chunks."""
    chunks = table(spark, sf, "chunks")
    queries = chunks.where(F.crc32("chunk_id") % 50 == 0).select(F.col("chunk_id").alias("id"))
    return neighbours.similar_pairs(chunks, k=10, queries=queries, visits=0.3)


def p3_every(spark: SparkSession, sf: str) -> DataFrame:
    """The ten nearest of every chunk, by its own leaves and 0.3 of the others; see the README for recall and growth."""
    return neighbours.similar_pairs(table(spark, sf, "chunks"), k=10, visits=0.3)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return personal.found_items(table(spark, sf, "records"))


def p4_redacted(spark: SparkSession, sf: str) -> DataFrame:
    return personal.redacted(table(spark, sf, "records"))


def p5_token_budget(spark: SparkSession, sf: str) -> DataFrame:
    return token_budget.token_budget(*(table(spark, sf, t) for t in ("records", "documents", "sources")))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return languages.mislabelled(table(spark, sf, "records"))


def p6_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Language and confidence of each record's text and of each passage in another language."""
    return languages.identify(table(spark, sf, "records"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.oversized(table(spark, sf, "chunks"))


def p7_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return splitting.split_chunks(table(spark, sf, "chunks"))


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.encode_corpus(table(spark, sf, "documents"))


def p9_bins(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), table(spark, sf, "capacities"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return mojibake.garbled_ids(table(spark, sf, "documents"))


def p10_repaired(spark: SparkSession, sf: str) -> DataFrame:
    return mojibake.repair_documents(table(spark, sf, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_repaired, p2_found, p2_members, p2_class_pairs, p3_found, p3_neighbours, p3_every, p4_found, p4_redacted, p5_token_budget, p6_found, p6_segments, p7_found, p7_pieces,
        p8_ids, p9_bins, p10_found, p10_repaired,
    )
}

ORACLE = {
    "p7_found": "SELECT DISTINCT chunk_id FROM chunks WHERE length(text) > 1200",
}
