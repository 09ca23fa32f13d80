"""Whole runs with a model: analysis of ranked documents, translation, answers to a question, answers to a battery.

Documents are asked about in parallel, one call each; what is asked once (a synthesis, one answer) is one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rag, search
from .index import Store
from .ingest import fetch

#: Defaults (fixed values): tokens of an analysis, a synthesis and a translation, images and characters of a document.
ANALYSIS_TOKENS, SYNTHESIS_TOKENS, TRANSLATION_TOKENS, MAX_IMAGES, MAX_CHARS = 4000, 8000, 16_000, 30, 200_000
LANGUAGES = {"en": "English", "zh": "Chinese"}


def _with_text(tier: DataFrame, records: DataFrame, images: DataFrame | None, max_docs: int | None, max_images: int) -> DataFrame:
    """Rows of a tier (id, path, score …) in order of their score, with text and images (id, images) of each."""
    best = tier.orderBy(F.desc("score"), "id")
    rows = fetch(best.limit(max_docs) if max_docs else best, records).drop("error")
    if images is None:
        return rows.withColumn("images", F.array().cast("array<string>"))
    return rows.join(images.select("id", F.slice("images", 1, max_images).alias("images")), "id", "left").withColumn("images", F.coalesce("images", F.array().cast("array<string>")))


def analyse(
    tier: DataFrame, records: DataFrame, topic: str, completer: rag.Completer, images: DataFrame | None = None,
    max_docs: int | None = None, max_images: int = MAX_IMAGES, max_chars: int = MAX_CHARS, max_tokens: int = ANALYSIS_TOKENS,
) -> DataFrame:
    """id, path, score, n_images, answer, error: what the model says of each document of a tier. Documents without text and
    images aren't asked about; a failing call is a row with an error."""
    rows = _with_text(tier, records, images, max_docs, max_images).where((F.coalesce("text", F.lit("")) != "") | (F.size("images") > 0))
    asked = rows.select("id", "path", "score", F.size("images").alias("n_images"), "images", F.concat(F.lit(f"What does this document say about {topic}?\n\n"), rag.prompt(max_chars)).alias("prompt"))
    answers = rag.complete_all(asked, completer, max_tokens=max_tokens)
    return asked.drop("images", "prompt").join(answers, "id")


def synthesis(analyses: DataFrame, topic: str, completer: rag.Completer, max_tokens: int = SYNTHESIS_TOKENS) -> DataFrame:
    """id, answer, error: one summary of all analyses that succeeded, best document first. Their texts become one prompt,
    so there must be as few as a prompt holds (analyse has max_docs)."""
    good = analyses.where("error = ''").select(
        F.struct((-F.col("score")).alias("s"), "id").alias("ord"), F.concat(F.lit("# "), F.coalesce("path", "id"), F.lit("\n\n"), "answer").alias("body")
    )
    ask = F.concat(F.lit(f"Sum up what these notes say about {topic}.\n\n"), "text")
    return rag.complete_all(rag.synthesis_input(good).select(F.lit("synthesis").alias("id"), ask.alias("prompt")), completer, max_tokens=max_tokens)


def translate(
    tier: DataFrame, records: DataFrame, completer: rag.Completer, done: DataFrame | None = None, images: DataFrame | None = None,
    max_docs: int | None = None, max_images: int = MAX_IMAGES, max_chars: int = MAX_CHARS, max_tokens: int = TRANSLATION_TOKENS,
) -> DataFrame:
    """id, path, score, target, answer, error: each document in each of LANGUAGES. Documents that `done` (id) has are
    passed over."""
    todo = tier.join(done.select("id").distinct(), "id", "left_anti") if done is not None else tier
    rows = _with_text(todo, records, images, max_docs, max_images)
    targets = F.explode(F.array(*[F.struct(F.lit(k).alias("target"), F.lit(v).alias("name")) for k, v in LANGUAGES.items()])).alias("t")
    asked = rows.select("*", targets).select(
        F.concat_ws("/", "id", "t.target").alias("key"), "id", "path", "score", "t.target", "images",
        F.concat(F.lit("Translate into "), "t.name", F.lit(", slide by slide.\n\n"), rag.prompt(max_chars)).alias("prompt"),
    )
    answers = rag.complete_all(asked.select(F.col("key").alias("id"), "prompt", "images"), completer, max_tokens=max_tokens).withColumnRenamed("id", "key")
    return asked.drop("images", "prompt").join(answers, "key").drop("key")


def translation_index(translations: DataFrame) -> DataFrame:
    """id, path, score, targets of documents whose translations all succeeded, best first."""
    per = translations.groupBy("id", "path", "score").agg(F.sort_array(F.collect_set("target")).alias("targets"), F.max("error").alias("worst"))
    return per.where("worst = ''").drop("worst").orderBy(F.desc("score"), "id")


def _context(hits: DataFrame, chunks: DataFrame, records: DataFrame, chars: int, budget: int | None) -> DataFrame:
    """query_id, context of grouped hits; documents beyond the token budget are left out, the best one never."""
    cols = ["path", "text", "char_start", "char_end"]
    one = chunks.join(F.broadcast(hits.select("chunk_id").distinct()), "chunk_id", "left_semi").groupBy("chunk_id").agg(*[F.min(c).alias(c) for c in cols])
    w = rag.windows(hits.join(one, "chunk_id"), records, chars)
    sizes = w.groupBy("query_id", "doc_id", F.col("doc_rank").alias("rank")).agg(F.sum(F.ceil(F.length("window") / 2)).cast("long").alias("n_tokens"))
    kept = rag.trim(sizes, budget).select("query_id", "doc_id")
    return rag.gather(w.join(kept, ["query_id", "doc_id"], "left_semi"))


def answer(
    index: DataFrame | Store, records: DataFrame, question: search.Query, completer: rag.Completer, mode: str = "fts", top: int = 8,
    per_doc: int = 2, chars: int = rag.CONTEXT_CHARS, num_ctx: int = rag.NUM_CTX, condition=None,
) -> DataFrame:
    """id, answer, error of one question over its best documents; no row where nothing is found."""
    spark = records.sparkSession
    chunks = index.chunks(spark) if isinstance(index, Store) else index
    hits = search.search(index, [question], mode, top, per_doc, condition=condition)
    context = _context(hits, chunks, records, chars, num_ctx - rag.OVERHEAD - rag.RESERVE)
    ask = F.concat(F.lit(f"Question: {question.text}\nAnswer from the sources below only and name them.\n\n"), "context")
    return rag.complete_all(context.select(F.col("query_id").alias("id"), ask.alias("prompt")), completer)


def answer_battery(
    spark: SparkSession, index: DataFrame | Store, records: DataFrame, battery: dict, completer: rag.Completer, top: int = 12, per_doc: int = 6,
    fetch_k: int = 100, union_top: int = 40, num_ctx: int = 65_536, chars: int = rag.CONTEXT_CHARS,
) -> DataFrame:
    """section_name, id, topic, answer, error of every topic. A topic searches its question and each of its terms as legs
    of one job and takes the documents that they agree on; one with use_union_context takes the best documents of all
    topics together."""
    topics = [(s, t) for s in battery["sections"] for t in s["topics"]]
    chunks = index.chunks(spark) if isinstance(index, Store) else index
    legs = [search.Query(f"{t['id']}\x1f{k}", str(q)) for _, t in topics for k, q in enumerate([t["question"], *t["terms"]])]
    found = search.search(index, legs, "fts", top, per_doc, fetch_k=fetch_k).withColumn("topic", F.substring_index("query_id", "\x1f", 1))
    found = found.persist()
    own = found.groupBy("topic", "doc_id", "chunk_id").agg(F.max("score").alias("score"), F.max("doc_score").alias("doc_score"))
    union = rag.union_context(found.select("doc_id", "doc_score"), union_top)
    wide = [str(t["id"]) for _, t in topics if t.get("use_union_context")]
    both = own.where(~F.col("topic").isin(wide))
    if wide:
        shared = found.join(F.broadcast(union.select("doc_id")), "doc_id", "left_semi").groupBy("doc_id", "chunk_id").agg(F.max("score").alias("score"), F.max("doc_score").alias("doc_score"))
        both = both.unionByName(shared.select(F.explode(F.array(*map(F.lit, wide))).alias("topic"), "doc_id", "chunk_id", "score", "doc_score"))
    hits = search.group_by_doc(both.select(F.col("topic").alias("query_id"), "doc_id", "chunk_id", "score"), per_doc, max(top, union_top))
    context = _context(hits, chunks, records, chars, num_ctx - rag.OVERHEAD - rag.RESERVE)
    table = rag.battery(spark, battery)
    answers = rag.complete_all(rag.battery_prompts(table, context), completer)
    return table.select("section_name", "id", "topic").join(answers, "id").select("section_name", "id", "topic", "answer", "error")
