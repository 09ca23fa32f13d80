"""Command lines: python -m quarrylamp <command> --data FOLDER …

Folders below --data: inventory (Parquet), shards (JSON Lines), triage/<topic> (CSV), slides (PNG), index, out. A command
gives 0, or 1 where its input is missing or, in an audit, a deck fails; a search without a query gives 2.
"""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as tx
from .functions.config import load_yaml
from .operators import audit, chunking, index, ingest, rag, runs, search, triage
from .sources import extract, io, tools

INTERNAL, EXTERNAL = "internal/", r"attachments/\d+_attachments_[A-Z]"


class Missing(Exception):
    """An input that a command needs isn't there."""


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _need(spark: SparkSession, path: str) -> str:
    if not _exists(spark, path):
        raise Missing(path)
    return path


def _records(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return io.read_shards(spark, _need(spark, f"{a.data}/shards"))[0]


def _completer(name: str) -> rag.Completer:
    """'echo', or module:Class of a model's client."""
    if name == "echo":
        return rag.EchoCompleter()
    module, _, cls = name.partition(":")
    return getattr(importlib.import_module(module), cls)()


def _show(df: DataFrame, a: argparse.Namespace) -> None:
    for r in df.toLocalIterator():
        print(json.dumps(r.asDict(True), ensure_ascii=False, default=str) if getattr(a, "json", False) else "\t".join("" if v is None else str(v) for v in r))


def inventory(spark: SparkSession, a: argparse.Namespace) -> int:
    io.walk(spark, _need(spark, a.root), sniff=True).write.mode("overwrite").parquet(f"{a.data}/inventory")
    done = spark.read.parquet(f"{a.data}/inventory")
    _show(ingest.inventory_groups(done).orderBy(F.desc("n_files")), a)
    return 0


def extract_text(spark: SparkSession, a: argparse.Namespace) -> int:
    files = spark.read.parquet(_need(spark, f"{a.data}/inventory"))
    shards = f"{a.data}/shards"
    if _exists(spark, shards):
        old, _ = io.read_shards(spark, shards)
        files = ingest.pending(files, old)
    else:
        files = ingest.extractable(files)
    if a.limit:
        files = ingest.limit_docs(files, a.limit, "path")
    rows = extract.extract_records(io.with_content(files.select("id", "path", "ext", "abs_path")))
    io.write_shards(rows.withColumn("lang", ingest.detect_lang(F.col("text"))), shards)
    return 0


def _topic(path: str) -> triage.Topic:
    try:
        topic = triage.Topic.load(path)
    except FileNotFoundError as exc:
        raise Missing(path) from exc
    if not topic.terms():
        raise Missing(f"terms of {path}")
    return topic


def triage_topic(spark: SparkSession, a: argparse.Namespace) -> int:
    best = triage.rank(
        _records(spark, a), _topic(a.topic), a.top, a.snippet_chars, min_score=a.min_score, low_cap=a.low_cap, mid_cap=a.mid_cap,
        data_penalty=a.data_penalty, div_bonus=a.div_bonus,
    )
    io.write_csv(best, f"{a.data}/triage/{Path(a.topic).stem}")
    return 0


def _tiers(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    ranked = io.read_csv(spark, _need(spark, f"{a.data}/triage/{Path(a.topic).stem}"))
    return triage.classify(ranked, a.internal, a.external)


def tier(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = _tiers(spark, a)
    for name in ("tier1", "tier2"):
        io.write_csv(rows.where(F.col("tier") == name).drop("tier"), f"{a.data}/triage/{Path(a.topic).stem}-{name}")
    _show(rows.groupBy("tier").count().orderBy("tier"), a)
    if a.print_tier2:
        _show(rows.where("tier = 'tier2'").orderBy(F.desc("score"), "id").select("id", "score", "path").limit(20), a)
    return 0


def _tier1(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return _tiers(spark, a).where("tier = 'tier1'")


def rasterize(spark: SparkSession, a: argparse.Namespace) -> int:
    kinds = [".pptx", ".ppt", *([".pdf"] if a.include_pdf else [])]
    files = spark.read.parquet(_need(spark, f"{a.data}/inventory")).join(_tier1(spark, a).select("id"), "id", "left_semi")
    files = files.where(tx.last_dot("path").isin(kinds))
    pages = tools.rasterize(io.with_content(files.select("id", tx.last_dot("path").alias("ext"), "abs_path")), tools.OfficeRasterizer(a.work, a.max_slides, a.dpi))
    pages.write.mode("overwrite").parquet(f"{a.data}/slides")
    _show(spark.read.parquet(f"{a.data}/slides").groupBy("error").agg(F.count_distinct("id").alias("n")), a)
    return 0


def _images(spark: SparkSession, a: argparse.Namespace) -> DataFrame | None:
    if not _exists(spark, f"{a.data}/slides"):
        return None
    pages = spark.read.parquet(f"{a.data}/slides").where("error is null and slide <= 50")
    rows = F.array_sort(F.collect_list(F.struct("slide", F.base64("content").alias("b"))))
    return pages.groupBy("id").agg(F.transform(rows, lambda r: r["b"]).alias("images"))


def analyze(spark: SparkSession, a: argparse.Namespace) -> int:
    model = _completer(a.model)
    out = runs.analyse(_tier1(spark, a), _records(spark, a), Path(a.topic).stem, model, _images(spark, a), a.max_docs, a.max_images, a.max_doc_chars)
    if a.dry_run:
        _show(out.select("id", "n_images", "path"), a)
        return 0
    name = f"{a.data}/out/{Path(a.topic).stem}"
    out.write.mode("overwrite").parquet(f"{name}-analyses")
    done = spark.read.parquet(f"{name}-analyses")
    if done.where("error = ''").isEmpty():
        return 1
    runs.synthesis(done, Path(a.topic).stem, model).write.mode("overwrite").json(f"{name}-synthesis")
    return 0


def translate(spark: SparkSession, a: argparse.Namespace) -> int:
    name = f"{a.data}/out/{Path(a.topic).stem}-translations"
    done = spark.read.parquet(name).where("error = ''").select("id") if _exists(spark, name) and not a.force else None
    out = runs.translate(_tier1(spark, a), _records(spark, a), _completer(a.model), done, _images(spark, a), a.max_docs, a.max_images, a.max_doc_chars, a.max_output_tokens)
    if a.dry_run:
        _show(out.select("id", "target", "path"), a)
        return 0
    out.write.mode("overwrite" if a.force else "append").parquet(name)
    _show(runs.translation_index(spark.read.parquet(name)), a)
    return 0


def ingest_manual(spark: SparkSession, a: argparse.Namespace) -> int:
    files = io.walk(spark, _need(spark, a.folder))
    good = ingest.manual_candidates(files).where("reject is null")
    shards = f"{a.data}/shards"
    state = ingest.manual_split(good, _records(spark, a)) if _exists(spark, shards) else good.select(tx.sha1_id("path").alias("id"), "path", F.lit("new").alias("state"))
    todo = files.join(state.where("state = 'new'").select("id") if not a.force else state.select("id"), "id", "left_semi")
    io.write_shards(extract.extract_records(io.with_content(todo.select("id", "path", "ext", "abs_path"))), shards)
    io.write_csv(ingest.manual_tier(good), f"{a.data}/triage/{Path(a.topic).stem}-manual")
    return 0


def audit_slides(spark: SparkSession, a: argparse.Namespace) -> int:
    md = spark.read.text(_need(spark, a.md), wholetext=True).select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.col("value").alias("text")
    )
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_need(spark, a.src)).select("path", "content")
    base = "file:" + a.src.rstrip("/") + "/"
    pages = extract.page_counts(files).withColumn("src", F.replace("src", F.lit(base), F.lit("")))
    done = audit.status(audit.parse(md), pages).persist()
    _show(done if a.all else done.where("status <> 'PASS'"), a)
    return int(not done.where("status like 'FAIL%'").isEmpty())


def attachments(spark: SparkSession, a: argparse.Namespace) -> int:
    issues = io.read_issues(spark, _need(spark, a.folder))
    files = io.walk(spark, a.folder).select(F.element_at(F.split("path", "/"), 1).alias("issue"), F.element_at(F.split("path", "/"), -1).alias("name"))
    _show(ingest.missing_attachments(issues, files), a)
    return 0


def build_index(spark: SparkSession, a: argparse.Namespace) -> int:
    from .streaming.incremental import index_batch

    records = _records(spark, a)
    if a.limit:
        records = ingest.limit_docs(records, a.limit, "id")
    folder = f"{a.data}/index"
    if a.dry_run:
        store = index.open_store(spark, folder)
        known = store.manifest(spark) if store else spark.createDataFrame([], index.MANIFEST)
        _show(index.classify(records, known, a.exclude).groupBy("class").count(), a)
        return 0
    store = index_batch(records, folder, a.exclude, target=a.target_tokens, most=a.max_tokens, overlap=a.overlap_tokens, max_chunks=a.max_chunks_per_doc)
    if a.rebuild:
        index.compact(spark, store)
    return 0


def _opened(spark: SparkSession, a: argparse.Namespace) -> index.Store:
    store = index.open_store(spark, f"{a.data}/index")
    if store is None:
        raise Missing(f"{a.data}/index")
    return store


def query(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.show_doc:
        rows = ingest.dedup(_records(spark, a).where(F.col("id") == a.show_doc), "last").select("id", "path", "text")
        _show(rows, a)
        return int(rows.isEmpty())
    if not a.query:
        return 2
    hits = search.search(_opened(spark, a), [search.Query("q", a.query)], a.mode, a.top_k, a.per_doc, a.rrf_k, condition=search.where(a.path_prefix, a.lang, a.filter))
    if a.json:
        _show(io.json_hits(hits).orderBy("doc_rank").select("value"), argparse.Namespace())
    else:
        _show(hits.orderBy("doc_rank", "chunk_rank"), a)
    return 0


def ask(spark: SparkSession, a: argparse.Namespace) -> int:
    out = runs.answer(_opened(spark, a), _records(spark, a), search.Query("q", a.question), _completer(a.model), a.mode, a.top_k, a.per_doc, condition=search.where(a.path_prefix, a.lang))
    rows = out.collect()  # one answer
    print(rows[0].answer if rows else "nothing found")
    return 0


def battery(spark: SparkSession, a: argparse.Namespace) -> int:
    try:
        data = load_yaml(a.topics_file)
    except FileNotFoundError as exc:
        raise Missing(a.topics_file) from exc
    sections = [{**s, "topics": [t for t in s["topics"] if not a.topic or t["id"] in a.topic]} for s in data["sections"] if not a.section or s["id"] in a.section]
    if not any(s["topics"] for s in sections):
        raise Missing("topics")
    out = runs.answer_battery(spark, _opened(spark, a), _records(spark, a), {"sections": sections}, _completer(a.model), a.top_k, a.per_doc, a.fetch_k, a.union_top_k)
    blocks = out.select(F.col("id").alias("ord"), F.concat_ws(": ", "section_name", "topic").alias("title"), F.col("answer").alias("body"))
    io.report_lines(blocks).write.mode("overwrite").text(a.output or f"{a.data}/out/battery")
    return 0


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quarrylamp", description=__doc__.split("\n", 1)[0])
    subs = p.add_subparsers(dest="command", required=True)

    def command(f, name: str, *args: tuple) -> None:
        s = subs.add_parser(name)
        s.set_defaults(run=f)
        s.add_argument("--data", default="data")
        for flags, options in args:
            s.add_argument(*flags.split(), **options)

    def many(flag: str) -> tuple:
        return flag, {"action": "append", "default": []}

    def flag(name: str) -> tuple:
        return name, {"action": "store_true"}

    def number(name: str, default, kind=int) -> tuple:
        return name, {"type": kind, "default": default}

    topic = ("--topic", {"required": True})
    areas = [("--internal", {"default": INTERNAL}), ("--external", {"default": EXTERNAL})]
    model = ("--model", {"default": "echo"})
    docs = [number("--max-docs", None), number("--max-images", runs.MAX_IMAGES), number("--max-doc-chars", runs.MAX_CHARS), flag("--dry-run")]
    find = [("--mode", {"choices": search.MODES, "default": "fts"}), many("--path-prefix"), ("--lang", {})]
    command(inventory, "inventory", ("root", {}))
    command(extract_text, "extract", number("--limit", 0))
    command(triage_topic, "triage", topic, number("--top", 300), number("--snippet-chars", 160), number("--min-score", 1), number("--low-cap", 5),
            number("--mid-cap", 30), number("--data-penalty", 0.25, float), number("--div-bonus", 5))
    command(tier, "tier", topic, flag("--print-tier2"), *areas)
    command(rasterize, "rasterize", topic, number("--dpi", tools.DPI), number("--max-slides", tools.MAX_SLIDES), flag("--include-pdf"), ("--work", {}), *areas)
    command(analyze, "analyze", topic, model, *docs, *areas)
    command(translate, "translate", topic, model, *docs, flag("--force"), number("--max-output-tokens", runs.TRANSLATION_TOKENS), *areas)
    command(ingest_manual, "ingest", ("folder", {}), topic, flag("--force"))
    command(audit_slides, "audit", ("src", {}), ("md", {}), flag("--all"))
    command(attachments, "attachments", ("folder", {}))
    command(build_index, "index", flag("--rebuild"), flag("--dry-run"), number("--limit", 0), many("--exclude"), number("--target-tokens", chunking.TARGET),
            number("--max-tokens", chunking.MAX_TOKENS), number("--overlap-tokens", chunking.OVERLAP), number("--max-chunks-per-doc", 0))
    command(query, "query", ("query", {"nargs": "?"}), *find, number("--top-k", 10), number("--per-doc", 2), number("--rrf-k", search.RRF_K), ("--filter", {}),
            ("--show-doc", {}), flag("--json"))
    command(ask, "ask", ("question", {}), *find, model, number("--top-k", 8), number("--per-doc", 2))
    command(battery, "battery", ("topics_file", {}), many("--section"), many("--topic"), model, number("--top-k", 12), number("--per-doc", 6), number("--fetch-k", 100),
            number("--union-top-k", 40), ("--output", {}))
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("quarrylamp").getOrCreate()
    try:
        return a.run(spark, a)
    except Missing as exc:
        print(f"missing: {exc}", file=sys.stderr)
        return 1
