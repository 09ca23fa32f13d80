"""Inventory, extraction filters, record deduplication, resume and strip, manual ingest, attachment checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

#: Limits that results depend on (fixed values).
MAX_FILE_BYTES = 100 * 1024 * 1024
SNIFF_BELOW = 50_000_000
SYSTEM_STATE = "sosreport"
OCR_EXTS, OCR_MIN_CHARS = [".pdf", ".ppt", ".pptx"], 300
MAX_TEXT_CHARS = 2_000_000
#: Words that tell a language in its first characters.
STOP_WORDS = {
    "en": "the|of|and|from|with|was|were", "fr": "le|la|les|des|une|est|du", "de": "der|die|das|und|ist|mit|den", "es": "el|los|las|una|y|con|del",
}


def inventory_groups(inventory: DataFrame) -> DataFrame:
    """Files and gigabytes of each extension group."""
    return inventory.groupBy(F.col("ext_group")).agg(
        F.count("*").alias("n_files"), (F.sum("size_bytes") / 1e9).alias("gb")
    )


def inventory_totals(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"))


def needs_sniffing(group: Column, size: Column) -> Column:
    """Whether a file's type is looked up by content: only where its extension says little and it isn't huge."""
    return group.isin("other", "data") & (size < SNIFF_BELOW)


def sniff(head: Column) -> Column:
    """Media type by the first bytes of a file ('' if unknown); magic numbers are fixed values."""
    h = F.hex(head)
    out = F.lit("")
    for magic, kind in [
        ("25504446", "application/pdf"), ("504B0304", "application/zip"), ("1F8B", "application/gzip"),
        ("28B52FFD", "application/zstd"), ("89504E47", "image/png"), ("FFD8FF", "image/jpeg"), ("7F454C46", "application/x-executable"),
        ("3C3F786D6C", "text/xml"), ("7B", "application/json"),
    ]:
        out = F.when(h.startswith(magic), F.lit(kind)).otherwise(out)
    return out


def extractable(inventory: DataFrame) -> DataFrame:
    """Files that text is taken from: a known extension, not empty, at most 100 MiB, no system-state dump."""
    return inventory.where(
        F.col("ext").isin(tx.EXTRACTABLE)
        & (F.col("size_bytes") > 0)
        & (F.col("size_bytes") <= MAX_FILE_BYTES)
        & ~F.lower("path").contains(SYSTEM_STATE)
    )


def low_text(records: DataFrame) -> DataFrame:
    """Records to try again with character recognition."""
    return records.where(
        F.col("ext").isin(OCR_EXTS) & ~F.coalesce("ocr", F.lit(False)) & (F.coalesce("char_count", F.lit(0)) < OCR_MIN_CHARS)
    )


def nonempty(records: DataFrame) -> DataFrame:
    return records.where(F.coalesce("text", F.lit("")).rlike(r"(?U)\S"))


def pending(inventory: DataFrame, records: DataFrame) -> DataFrame:
    """Extractable files that no record exists for yet."""
    return extractable(inventory).join(records.select("id").distinct(), "id", "left_anti")


def dedup(records: DataFrame, keep: str = "first") -> DataFrame:
    """One row for each id by its place (shard_file, line_no): the first (indexing) or the last (lookups). Rows with a
    null id are left out."""
    place = F.struct("shard_file", "line_no")
    pick = F.min_by if keep == "first" else F.max_by
    rest = [c for c in records.columns if c != "id"]
    return (
        records.where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(pick(F.struct(*rest), place).alias("r"))
        .select("id", *[F.col(f"r.{c}").alias(c) for c in rest])
    )


def strip_ids(records: DataFrame, stale: DataFrame) -> DataFrame:
    """Records without those of the stale ids; rows without an id (lines that can't be read) stay."""
    return records.join(stale.select("id").distinct(), "id", "left_anti")


def append(records: DataFrame, more: DataFrame) -> DataFrame:
    """All rows of both; a column that one lacks is null there."""
    return records.unionByName(more, allowMissingColumns=True)


def merge_recognised(records: DataFrame, recognised: DataFrame) -> DataFrame:
    """Records with a longer recognised text (id, ocr_text, ocr_error) in place of their own. n_elements counts
    paragraphs of the whole recognised text; an error is only added where there was none."""
    better = F.length("ocr_text") > F.coalesce("char_count", F.lit(0))
    n_paragraphs = F.size(F.split("ocr_text", "\n\n"))
    joined = records.join(recognised.select("id", "ocr_text", "ocr_error"), "id", "left")
    return joined.select(
        *[
            {
                "text": F.when(better, F.left("ocr_text", F.lit(MAX_TEXT_CHARS))).otherwise(F.col("text")).alias("text"),
                "char_count": F.when(better, F.length(F.left("ocr_text", F.lit(MAX_TEXT_CHARS)))).otherwise(F.col("char_count")).cast("long").alias("char_count"),
                "n_elements": F.when(better, n_paragraphs).otherwise(F.col("n_elements")).cast("int").alias("n_elements"),
                "ocr": F.when(better, F.lit(True)).otherwise(F.coalesce("ocr", F.lit(False))).alias("ocr"),
                "error": F.when(
                    (F.coalesce("error", F.lit("")) == "") & F.col("ocr_error").isNotNull(), F.col("ocr_error")
                ).otherwise(F.col("error")).alias("error"),
            }.get(c, F.col(c))
            for c in records.columns
        ]
    )


def manual_candidates(files: DataFrame) -> DataFrame:
    """name, path, size_bytes, reject: why a file of the manual folder isn't taken, null if it is."""
    name = F.element_at(F.split("path", "/"), -1)
    reject = (
        F.when(name.endswith(".Identifier"), F.lit("stream"))
        .when(name.contains(":"), F.lit("stream"))
        .when(~tx.suffix(name).isin(tx.EXTRACTABLE), F.lit("unsupported"))
        .when(F.col("size_bytes") > MAX_FILE_BYTES, F.lit("too large"))
    )
    return files.select(name.alias("name"), "path", "size_bytes", reject.alias("reject"))


def manual_split(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """id, path, state: 'new', or 'present' where a record exists."""
    known = records.select("id", F.lit("present").alias("state")).distinct()
    return (
        candidates.select(tx.sha1_id("path").alias("id"), "path")
        .join(known, "id", "left")
        .select("id", "path", F.coalesce("state", F.lit("new")).alias("state"))
    )


def manual_tier(candidates: DataFrame) -> DataFrame:
    """Tier rows of hand-picked files: they outrank everything."""
    return candidates.select(
        tx.sha1_id("path").alias("id"), "path", F.lit("").alias("lang"), F.lit(0).alias("char_count"),
        F.lit(9999).alias("score"), F.lit(9999).alias("raw_score"), F.lit(0).alias("n_unique_terms"),
        F.lit(1).alias("high_hits"), F.lit("manual").alias("hits"), F.lit("").alias("snippet"), F.lit("tier1").alias("tier"),
    )


def missing_attachments(issues: DataFrame, files: DataFrame) -> DataFrame:
    """issue, attachment_id, filename of attachments that no file (issue, name) exists for, neither under the name
    nor with '+' for its blanks. Two equi joins, not one on a disjunction."""
    wanted = issues.select("issue", F.explode("attachments").alias("a")).select(
        "issue", F.col("a.id").alias("attachment_id"), F.col("a.filename").alias("filename")
    )
    there = files.select("issue", F.col("name").alias("filename")).distinct()
    plus = files.select("issue", F.col("name").alias("_plus")).distinct()
    return (
        wanted.join(there, ["issue", "filename"], "left_anti")
        .withColumn("_plus", F.replace("filename", F.lit(" "), F.lit("+")))
        .join(plus, ["issue", "_plus"], "left_anti")
        .select("issue", "attachment_id", "filename")
    )


def fetch(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Rows with their record's text and error by id, of the last record of an id; `found` tells of misses."""
    asked = records.select("id", "shard_file", "line_no", "text", "error").join(rows.select("id").distinct(), "id", "left_semi")
    last = dedup(asked, "last").select("id", "text", "error", F.lit(True).alias("found"))
    return rows.join(last, "id", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def limit_docs(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first n rows in a stated order, for trial runs."""
    return df.orderBy(*order).limit(n)


def detect_lang(text: Column) -> Column:
    """Language by script and stop words of the first 4,000 characters: '' below 40 characters or without a sign."""
    head = F.left(text, F.lit(4000))
    n = F.length(F.coalesce(text, F.lit("")))
    cjk = F.length(F.regexp_replace(head, "[^\\u4e00-\\u9fff]", ""))
    cyr = F.length(F.regexp_replace(head, "[^\\u0400-\\u04ff]", ""))
    score = {k: F.regexp_count(head, F.lit(rf"(?i)\b({w})\b")) for k, w in STOP_WORDS.items()}
    best = F.greatest(*score.values())
    out = F.when(n < 40, "").when(cjk * 4 > F.length(head), "zh").when(cyr * 4 > F.length(head), "ru").when(best == 0, "")
    for k, s in score.items():
        out = out.when(s == best, k)
    return out.otherwise("")
