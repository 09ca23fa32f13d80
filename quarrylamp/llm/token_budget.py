"""Problem 5: token budget by source, language and domain.

Method: whole documents are hashed and deduplicated, each distinct text is tokenized once, the exact counts are
joined back, and totals follow by source, language and domain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import byte_bpe, has_text, label_lang, map_batches, path_source, source_domains


def count_distinct_texts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """text_hash, n_tokens, n_chars of each distinct text; in: text. The hash is 128 bits wide.

    Copies inside a task meet before the shuffle, so a text that a third of all rows share moves once for each task.
    """
    hashed = docs.where(F.length("text") > 0).select(
        F.struct(F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b")).alias("text_hash"), "text"
    )
    distinct = hashed.groupBy("text_hash").agg(F.first("text").alias("text"))

    def count(batches):
        enc = byte_bpe(tokenizer)
        for b in batches:
            yield {
                "text_hash": b["text_hash"],
                "n_tokens": [len(enc.encode_ordinary(t)) for t in b["text"]],
                "n_chars": [len(t) for t in b["text"]],
            }

    return map_batches(distinct, count, "text_hash struct<a:bigint,b:bigint>, n_tokens bigint, n_chars bigint")


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """`docs` (doc_key, text, …) with n_tokens in place of text; null and '' texts count 0."""
    keyed = docs.withColumn(
        "text_hash", F.struct(F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b"))
    )
    counts = count_distinct_texts(docs.select("text"), tokenizer).select("text_hash", "n_tokens")
    return (
        keyed.drop("text")
        .join(counts, "text_hash", "left")
        .withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0)))
        .drop("text_hash")
    )


def token_budget(
    records: DataFrame, documents: DataFrame, sources: DataFrame, tokenizer: str | None = None
) -> DataFrame:
    """Totals for each (collection, source, lang, domain): n_docs, n_distinct_texts, n_chars, n_tokens,
    n_tokens_distinct, n_estimated.

    Each id counts once, by its row with text. Tokens of a text are counted exactly. A record whose text is missing
    but whose char_count is positive (its text is kept elsewhere) gets char_count times the tokens per character of
    its language in this corpus, and is counted in n_estimated; char_count is used for nothing else, as it may be
    wrong. Labels are taken by the language that they name, '' if none. A null path or source comes out as '',
    likewise a source without a domain. Empty tables give no rows.

    The text itself is shuffled once, after copies in a task have met; all joins after that move hashes and counts.
    """
    def hashed(df: DataFrame) -> DataFrame:
        return df.withColumn("h", F.when(has_text(), F.struct(F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b"))))

    r = hashed(records.where(F.col("id").isNotNull())).select(
        F.lit("records").alias("collection"), F.col("id").alias("key"), path_source("path").alias("source"),
        label_lang("lang").alias("lang"), F.col("char_count").alias("chars"), "h",
    )
    d = hashed(documents.where(F.col("doc_id").isNotNull())).select(
        F.lit("documents").alias("collection"), F.col("doc_id").cast("string").alias("key"), F.col("source"),
        label_lang("lang").alias("lang"), F.lit(None).cast("long").alias("chars"), "h",
    )
    fields = ["source", "lang", "chars", "h"]
    ids = (
        r.unionByName(d)
        .groupBy("collection", "key")
        .agg(F.max_by(F.struct(*fields), F.struct(F.col("h").isNotNull(), F.coalesce("h.a", F.lit(0)), F.coalesce("chars", F.lit(-1)), F.coalesce("source", F.lit("")), "lang")).alias("r"))
        .select("collection", *[F.col(f"r.{c}").alias(c) for c in fields])
    )
    texts = records.where(has_text()).select("text").unionByName(documents.where(has_text()).select("text"))
    counts = count_distinct_texts(texts, tokenizer).withColumnRenamed("text_hash", "h")
    # one row for each (slice, text): multiplicities meet before the join, so copies of a hot text don't
    slices = ids.groupBy("collection", "source", "lang", "h", F.when(F.col("h").isNull(), F.col("chars")).alias("chars")).agg(F.count("*").alias("n"))
    counted = slices.join(counts, "h", "left")
    per = counted.groupBy("collection", "source", "lang").agg(
        F.sum("n").alias("n_docs"),
        F.count("h").alias("n_distinct_texts"),
        F.coalesce(F.sum(F.col("n") * F.col("n_chars")), F.lit(0)).alias("n_chars"),
        F.coalesce(F.sum(F.col("n") * F.col("n_tokens")), F.lit(0)).alias("n_tokens"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens_distinct"),
        F.coalesce(F.sum(F.when(F.col("h").isNull() & (F.col("chars") > 0), F.col("n") * F.col("chars"))), F.lit(0)).alias("open_chars"),
        F.coalesce(F.sum(F.when(F.col("h").isNull() & (F.col("chars") > 0), F.col("n"))), F.lit(0)).alias("n_estimated"),
    )
    rate = F.sum("n_tokens") / F.nullif(F.sum("n_chars"), F.lit(0))
    rates = per.groupBy("lang").agg(rate.alias("rate"))
    per = per.withColumn("_all", F.lit(1))
    overall = per.groupBy("_all").agg(rate.alias("all_rate"))
    extra = F.round(F.col("open_chars") * F.coalesce("rate", "all_rate", F.lit(0.0))).cast("long")
    out = (
        per.join(rates, "lang", "left")
        .join(F.broadcast(overall), "_all", "left")  # one row
        .withColumn("n_tokens", F.col("n_tokens") + extra)
    )
    return out.join(source_domains(sources), "source", "left").select(
        "collection",
        F.coalesce("source", F.lit("")).alias("source"),
        "lang",
        F.coalesce("domain", F.lit("")).alias("domain"),
        "n_docs", "n_distinct_texts", "n_chars", "n_tokens", "n_tokens_distinct", "n_estimated",
    )
