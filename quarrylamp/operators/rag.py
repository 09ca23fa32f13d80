"""Context windows, context assembly, token budget, prompts, battery, and completions through a pluggable model."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.config import load_yaml
from .ingest import dedup

CONTEXT_CHARS, NUM_CTX, OVERHEAD, RESERVE = 1500, 24_576, 800, 1_200


class Completer(Protocol):
    """A model: the answer to a prompt and images (base64), of at most max_tokens."""

    def complete(self, prompt: str, images: Sequence[str] = (), max_tokens: int | None = None) -> str: ...


class EchoCompleter:
    """Offline stand-in: answers with the head of the prompt and the number of images."""

    def __init__(self, chars: int = 80):
        self.chars = chars

    def complete(self, prompt: str, images: Sequence[str] = (), max_tokens: int | None = None) -> str:
        return prompt[: self.chars] + (f" [{len(images)} images]" if images else "")


#: Answer of a call that failed (fixed value, part of the answers' format).
NOT_FOUND = "FOUND: no"


def complete_all(prompts: DataFrame, completer: Completer, attempts: int = 2, max_tokens: int | None = None) -> DataFrame:
    """id, answer, error for prompts (id, prompt and, where there are some, images): an empty answer is asked for again; a
    failing call becomes NOT_FOUND with its error, so one bad row fails no task."""
    seen = "images" in prompts.columns

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for i, p, images in zip(pdf["id"], pdf["prompt"], pdf["images"] if seen else [None] * len(pdf), strict=True):
                extra = {"images": list(images)} if images is not None and len(images) else {}
                if max_tokens:
                    extra["max_tokens"] = max_tokens
                answer, error = "", ""
                for _ in range(attempts):
                    try:
                        if answer := completer.complete(p, **extra):
                            break
                    except Exception as exc:  # noqa: BLE001
                        error = f"{type(exc).__name__}: {exc}"
                out.append((i, answer or NOT_FOUND, "" if answer else error or "empty answer"))
            yield pd.DataFrame(out, columns=["id", "answer", "error"])

    return prompts.select("id", "prompt", *(["images"] if seen else [])).mapInPandas(run, "id string, answer string, error string")


def windows(hits: DataFrame, records: DataFrame, chars: int = CONTEXT_CHARS) -> DataFrame:
    """hits with `window`: the record's text around each chunk, `chars` to either side. Without a record or usable
    offsets it is the chunk's own text."""
    asked = records.select("id", "shard_file", "line_no", "text").join(hits.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi")
    last = dedup(asked, "last").select(F.col("id").alias("doc_id"), F.col("text").alias("_doc"))
    a = F.greatest(F.col("char_start") - chars, F.lit(0))
    b = F.least(F.col("char_end") + chars, F.length("_doc"))
    inside = (F.col("char_start") >= 0) & (F.col("char_end") >= F.col("char_start")) & (F.col("char_start") < F.length("_doc"))
    window = F.when(F.coalesce(inside, F.lit(False)), F.substring("_doc", a + 1, b - a)).otherwise(F.col("text"))
    return hits.join(last, "doc_id", "left").withColumn("window", window).drop("_doc")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def gather(hits: DataFrame) -> DataFrame:
    """query_id, context: blocks '### Source: path' with the trimmed window, documents by rank and chunks by rank."""
    block = F.concat(F.lit("### Source: "), F.coalesce("path", F.lit("")), F.lit("\n"), strip(F.col("window")))
    blocks = F.array_sort(F.collect_list(F.struct("doc_rank", "chunk_rank", "chunk_id", block.alias("b"))))
    return hits.groupBy("query_id").agg(F.array_join(F.transform(blocks, lambda x: x["b"]), "\n\n").alias("context"))


def trim(docs: DataFrame, budget: int | None = None, num_ctx: int = NUM_CTX) -> DataFrame:
    """Documents (query_id, rank, n_tokens) that fit the budget together, best first; the best one always stays."""
    most = num_ctx - OVERHEAD - RESERVE if budget is None else budget
    w = Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    total = docs.withColumn("total_tokens", F.sum("n_tokens").over(w))
    return total.where((F.col("total_tokens") <= most) | (F.col("rank") == 0))


def union_context(hits: DataFrame, most: int = 40) -> DataFrame:
    """doc_id, doc_score, rank of the best documents over all queries so far."""
    docs = hits.groupBy("doc_id").agg(F.max("doc_score").alias("doc_score"))
    return docs.orderBy(F.desc("doc_score"), "doc_id").limit(most)


def prompt(max_chars: int) -> Column:
    """A record's prompt: where it lies, its language label, whether it was cut, and its text."""
    text = F.coalesce("text", F.lit(""))
    label = F.coalesce(F.nullif(F.col("lang"), F.lit("")), F.lit("not known"))
    whole = F.when(F.length(text) > max_chars, F.lit(f"the first {max_chars} characters")).otherwise(F.lit("whole"))
    return F.format_string("document %s\nlanguage: %s\ntext (%s):\n%s", F.coalesce("path", F.lit("")), label, whole, F.left(text, F.lit(max_chars)))


def load_battery(spark: SparkSession, path: str | Path, sections: list[str] | None = None, topics: list[str] | None = None) -> DataFrame:
    """section_id, section_name, id, topic, question, terms, fields, use_union_context of a YAML battery; empty lists
    of ids take all."""
    return battery(spark, load_yaml(path), sections, topics)


def battery(spark: SparkSession, data: dict, sections: list[str] | None = None, topics: list[str] | None = None) -> DataFrame:
    rows = [
        (str(s["id"]), str(s["name"]), str(t["id"]), str(t["topic"]), str(t["question"]), [str(x) for x in t["terms"]],
         [str(x) for x in t["fields"]], bool(t.get("use_union_context", False)))
        for s in data["sections"] for t in s["topics"]
        if (not sections or s["id"] in sections) and (not topics or t["id"] in topics)
    ]
    return spark.createDataFrame(
        rows, "section_id string, section_name string, id string, topic string, question string, terms array<string>, fields array<string>, use_union_context boolean"
    )


def battery_prompts(topics: DataFrame, contexts: DataFrame) -> DataFrame:
    """id, prompt of topics with their context (query_id, context); an unanswered topic has an empty context."""
    fields = F.array_join(F.transform("fields", lambda f: F.concat(f, F.lit(":"))), "\n")
    body = F.concat(
        F.lit("TOPIC: "), "topic", F.lit("\nQUESTION: "), "question", F.lit("\nTERMS: "), F.array_join("terms", ", "),
        F.lit("\nAnswer from the context only; write NOT FOUND if it has no answer, and quote each source.\n"), fields,
        F.lit("\nCONTEXT:\n"), F.coalesce("context", F.lit("")),
    )
    return topics.join(contexts.withColumnRenamed("query_id", "id"), "id", "left").select("id", body.alias("prompt"))


def synthesis_input(docs: DataFrame) -> DataFrame:
    """One text of all per-document outputs (ord, body), in order, divided by rules."""
    rows = F.array_sort(F.collect_list(F.struct("ord", "body")))
    return docs.agg(F.array_join(F.transform(rows, lambda r: r["body"]), "\n\n---\n\n").alias("text"))
