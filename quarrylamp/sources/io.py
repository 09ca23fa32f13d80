"""Sources and sinks: file walks, archives, JSON Lines shards, CSV, images, HTML, reports."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..tables import RECORD_SCHEMA, TRIAGE_SCHEMA

#: Folders that a walk passes over (fixed values).
SKIP_DIRS = [".git", "node_modules", "__pycache__", ".venv", "venv"]
SHARD_ROWS = 1000


def walk(spark: SparkSession, root: str, sniff: bool = False) -> DataFrame:
    """Inventory of all files below a folder: id, path, abs_path, ext, ext_group, size_bytes, mtime; contents aren't read.
    With `sniff` also mime: by content for files whose extension says little and that aren't huge, '' for others."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .select(F.col("path").alias("abs_path"), F.col("length").alias("size_bytes"), F.unix_timestamp("modificationTime").alias("mtime"))
    )
    base = "file:" + root.rstrip("/") + "/" if root.startswith("/") else root.rstrip("/") + "/"
    rel = F.when(F.startswith("abs_path", F.lit(base)), F.substring("abs_path", len(base) + 1, 1 << 20)).otherwise(F.col("abs_path"))
    skip = r"(^|/)(" + "|".join(d.replace(".", r"\.") for d in SKIP_DIRS) + ")/"
    inventory = files.select("*", rel.alias("path")).where(~F.col("path").rlike(skip)).select(
        tx.sha1_id("path").alias("id"), "path", "abs_path", tx.suffix("path").alias("ext"), tx.ext_group(tx.suffix("path")).alias("ext_group"), "size_bytes", "mtime"
    )
    return with_mime(spark, inventory) if sniff else inventory


def with_mime(spark: SparkSession, inventory: DataFrame) -> DataFrame:
    """inventory (abs_path, ext_group, size_bytes) with mime. Only the files that are to be looked into are opened, each by
    the task that has its row, and only their first bytes are read."""
    from ..operators.ingest import needs_sniffing, sniff

    want = F.coalesce(needs_sniffing(F.col("ext_group"), F.col("size_bytes")), F.lit(False))

    def run(batches):
        for b in batches:
            out = []
            for path, look in zip(b.column("abs_path").to_pylist(), b.column("_want").to_pylist(), strict=True):
                out.append(_head(path) if look else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "_head"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in inventory.dtypes)
    looked = inventory.withColumn("_want", want).mapInArrow(run, f"{kinds}, _want boolean, _head binary")
    return looked.withColumn("mime", sniff(F.coalesce("_head", F.lit(b"")))).drop("_want", "_head")


def open_uri(path: str) -> pa.NativeFile:
    """A file by the name that Spark gives it; works in tasks, for any file system that Arrow knows."""
    from urllib.parse import quote

    from pyarrow import fs

    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem().open_input_stream("/" + path.removeprefix("file:").lstrip("/"))
    place, name = fs.FileSystem.from_uri(quote(path, safe=":/"))
    return place.open_input_stream(name)


def _head(path: str, size: int = 64) -> bytes:
    """First bytes of a file; nothing if it can't be opened."""
    try:
        with open_uri(path) as f:
            return f.read(size)
    except (OSError, pa.ArrowInvalid):
        return b""


def with_content(rows: DataFrame) -> DataFrame:
    """rows (abs_path …) with content: each file is read by the task that has its row, one at a time."""
    kinds = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)

    def run(batches):
        for b in batches:
            at = b.schema.names.index("abs_path")
            for r in range(b.num_rows):
                one = b.slice(r, 1)
                try:
                    with open_uri(one.column(at)[0].as_py()) as f:
                        data = f.read()
                except (OSError, pa.ArrowInvalid):
                    data = None
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array([data], pa.binary())], names=[*one.schema.names, "content"])

    return rows.mapInArrow(run, f"{kinds}, content binary")


def loose_files(spark: SparkSession, root: str, exts: tuple[str, ...] = ("docx", "pdf", "pptx", "xlsx")) -> DataFrame:
    """Files directly in a folder with one of the extensions, any case: abs_path, size_bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(f"{root}/*.*")
    return files.where(F.lower(F.regexp_extract("path", r"\.([^.]+)$", 1)).isin(*exts)).select(F.col("path").alias("abs_path"), F.col("length").alias("size_bytes"))


#: Archives inside archives are opened down to this depth.
ARCHIVE_DEPTH = 5
_ARCHIVE = (".tar", ".tar.gz", ".tgz", ".tar.xz", ".txz", ".tar.zst", ".tzst", ".zip")


def _members(name: str, stream: BinaryIO, depth: int) -> Iterator[tuple[str, bytes]]:
    """(name, content) of the files of an archive, one after the other; of an archive in it the files of that, named
    <archive>!<member>. A stream is read once and forwards where its format allows."""
    low = name.lower()
    if low.endswith(".zip"):
        whole = stream if stream.seekable() else io.BytesIO(stream.read())
        with zipfile.ZipFile(whole) as z:
            for n in z.namelist():
                if not n.endswith("/"):
                    with z.open(n) as f:
                        yield from _member(n, f, depth)
        return
    if low.endswith("zst"):
        import zstandard

        stream = zstandard.ZstdDecompressor().stream_reader(stream)
    with tarfile.open(fileobj=stream, mode="r|" if low.endswith("zst") else "r|*") as t:
        for m in t:
            if m.isfile():
                yield from _member(m.name, t.extractfile(m), depth)


def _member(name: str, stream: BinaryIO, depth: int) -> Iterator[tuple[str, bytes]]:
    if depth and name.lower().endswith(_ARCHIVE):
        data = stream.read()
        try:
            for n, content in _members(name, io.BytesIO(data), depth - 1):
                yield f"{name}!{n}", content
        except (tarfile.TarError, zipfile.BadZipFile, EOFError):
            yield name, data  # called an archive but none
    else:
        yield name, stream.read()


def expand_archives(archives: DataFrame) -> DataFrame:
    """archive, member, content, error of every file in the archives (path, content): tar (plain, gz, xz, zst) and zip, also
    those inside other archives. Members go on one by one; a broken archive gives a row with an error behind what could be
    read, so it fails no task."""

    def run(batches):
        for pdf in batches:
            for path, raw in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    for name, content in _members(path, io.BytesIO(raw), ARCHIVE_DEPTH):
                        yield pd.DataFrame([(path, name, content, None)], columns=["archive", "member", "content", "error"])
                except Exception as exc:  # noqa: BLE001
                    error = f"{type(exc).__name__}: {exc}"[:200]
                    yield pd.DataFrame([(path, None, None, error)], columns=["archive", "member", "content", "error"])

    return archives.select("path", "content").mapInPandas(run, "archive string, member string, content binary, error string")


BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def shard_lines(files: DataFrame) -> DataFrame:
    """shard_file, line_no, byte_offset, value of the lines of JSON Lines files (path, content) that aren't blank. A shard
    is read as one row: write_shards keeps shards to SHARD_ROWS records, and the source ends at 2 GB."""

    def run(batches):
        for b in batches:
            for path, raw in zip(b.column(0), b.column(1), strict=True):
                name, at = path.as_py().rsplit("/", 1)[-1], 0
                data = raw.as_py() or b""
                numbers, places, values = [], [], []
                for n, line in enumerate(data.split(b"\n")):
                    if line.strip():
                        numbers.append(n)
                        places.append(at)
                        values.append(line.decode("utf-8", "replace"))
                    at += len(line) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(values), pa.string()), pa.array(numbers, pa.int32()), pa.array(places, pa.int64()), pa.array(values, pa.string())],
                    names=["shard_file", "line_no", "byte_offset", "value"],
                )

    return files.select("path", "content").mapInArrow(run, "shard_file string, line_no int, byte_offset bigint, value string")


def parse_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with shard_file, line_no, byte_offset; bad lines) of shard_lines. A line that can't be parsed is no record,
    and missing keys are null."""
    from pyspark.sql import types as T

    schema = T.StructType([*RECORD_SCHEMA.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    place = ["shard_file", "line_no", "byte_offset"]
    parsed = lines.select(*place, "value", F.from_json("value", schema, options).alias("r"))
    good = parsed.where(F.col("r._bad").isNull()).select("r.*", *place).drop("_bad")
    return good, parsed.where(F.col("r._bad").isNotNull()).select(*place, F.col("value").alias("line"))


def read_shards(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """parse_lines of all shards below a folder, or of the files that a pattern names."""
    reader = spark.read.format("binaryFile")
    files = (reader if any(c in path for c in "*?[{") else reader.option("recursiveFileLookup", "true")).load(path)
    return parse_lines(shard_lines(files))


def lookup(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    """rows (doc_id, shard_file, byte_offset) with text and found: the record that stands at the place, if it is still
    that document's. Only the shards asked for are read; rows are few (one search's hits), their shard names are listed."""
    shards = [r.shard_file for r in rows.select("shard_file").where("shard_file is not null").distinct().collect()]
    if not shards:
        return rows.withColumns({"text": F.lit(None).cast("string"), "found": F.lit(False)})
    files = spark.read.format("binaryFile").load([f"{root.rstrip('/')}/{s}" for s in shards])
    wanted = rows.select("shard_file", "byte_offset").distinct()
    lines = shard_lines(files).join(F.broadcast(wanted), ["shard_file", "byte_offset"], "left_semi")
    records, _ = parse_lines(lines)
    there = records.select(F.col("id").alias("doc_id"), "shard_file", "byte_offset", "text", F.lit(True).alias("found"))
    return rows.join(there, ["doc_id", "shard_file", "byte_offset"], "left").withColumn("found", F.coalesce("found", F.lit(False)))


def write_shards(records: DataFrame, path: str, mode: str = "append") -> None:
    records.write.option("maxRecordsPerFile", SHARD_ROWS).option("ignoreNullFields", "true").mode(mode).json(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """One <shard_file>.jsonl for each shard (shard_file, line_no, value), lines in order. Each task writes whole shards
    through the file system of the folder, so a shard's place in it is known."""
    spark = lines.sparkSession
    rows = lines.repartition("shard_file").sortWithinPartitions("shard_file", "line_no").select("shard_file", "value")
    named = f"{path}/_by_shard"
    rows.write.mode("overwrite").partitionBy("shard_file").text(named)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.globStatus(fs_path(f"{named}/shard_file=*/part-*")):
        name = f.getPath().getParent().getName().removeprefix("shard_file=")
        fs.rename(f.getPath(), fs_path(f"{path}/{name}.jsonl"))
    fs.delete(fs_path(named), True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("nullValue", "\\N").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str = TRIAGE_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').option("nullValue", "\\N").option("emptyValue", "").option("multiLine", True).csv(path)


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    """issue, attachments of issue files (one JSON object each)."""
    schema = "fields struct<attachment:array<struct<id:string,filename:string>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^./]+$", 1)
    return rows.select(name.alias("issue"), F.col("fields.attachment").alias("attachments"))


def slide_images(spark: SparkSession, root: str, most: int = 30) -> DataFrame:
    """doc_id, images: the first `most` slides of each document in base64, in order, from <root>/<doc_id>/slide-NN.png."""
    from pyspark.sql import Window

    files = spark.read.format("binaryFile").option("pathGlobFilter", "slide-*.png").option("recursiveFileLookup", "true").load(root)
    f = files.select(F.element_at(F.split("path", "/"), -2).alias("doc_id"), F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    w = Window.partitionBy("doc_id").orderBy("name")
    kept = f.withColumn("n", F.row_number().over(w)).where(F.col("n") <= most)
    rows = F.array_sort(F.collect_list(F.struct("n", F.base64("content").alias("b"))))
    return kept.groupBy("doc_id").agg(F.transform(rows, lambda r: r["b"]).alias("images"))


class _Text(HTMLParser):
    SKIP = {"script", "style", "noscript", "template", "head"}
    BLOCK = {"p", "div", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "blockquote", "pre", "table", "br"}

    def __init__(self):
        super().__init__()
        self.parts: list[str] = [""]
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self.SKIP
        if tag in self.BLOCK and self.parts[-1].strip():
            self.parts.append("")

    def handle_endtag(self, tag):
        self.hidden -= tag in self.SKIP and self.hidden > 0
        if tag in self.BLOCK and self.parts[-1].strip():
            self.parts.append("")

    def handle_data(self, data):
        if not self.hidden:
            self.parts[-1] += data


def extract_html(html: str | None, limit: int = 2_000_000) -> tuple[str, int]:
    """(text, number of elements): the blocks that aren't blank, joined by blank lines and cut at `limit`."""
    p = _Text()
    p.feed(html or "")
    parts = [" ".join(x.split()) for x in p.parts if x.strip()]
    return "\n\n".join(parts)[:limit], len(parts)


def html_records(pages: DataFrame, key: str = "id", html: str = "html") -> DataFrame:
    """key, text, n_elements, char_count, error of HTML pages; a page that fails gives an error and no text."""

    def run(batches):
        for pdf in batches:
            rows = []
            for i, h in zip(pdf[key], pdf[html], strict=True):
                try:
                    t, n = extract_html(h)
                    rows.append((i, t, n, len(t), ""))
                except Exception as exc:  # noqa: BLE001
                    rows.append((i, "", 0, 0, f"{type(exc).__name__}: {exc}"[:200]))
            yield pd.DataFrame(rows, columns=[key, "text", "n_elements", "char_count", "error"])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, text string, n_elements int, char_count int, error string")


def report_lines(blocks: DataFrame) -> DataFrame:
    """One Markdown report (value) of titled blocks (ord, title, body), in order."""
    rows = F.array_sort(F.collect_list(F.struct("ord", "title", "body")))
    text = F.array_join(F.transform(rows, lambda r: F.concat(F.lit("## "), r["title"], F.lit("\n\n"), r["body"])), "\n\n")
    return blocks.agg(text.alias("value"))


def json_hits(hits: DataFrame) -> DataFrame:
    """One JSON object for each document hit, in rank order: query_id, doc_rank, value."""
    chunks = F.array_sort(F.collect_list(F.struct("chunk_rank", "chunk_id", "score")))
    docs = hits.groupBy("query_id", "doc_rank", "doc_id", "doc_score").agg(chunks.alias("chunks"))
    return docs.select("query_id", "doc_rank", F.to_json(F.struct("doc_id", F.col("doc_score").alias("score"), "chunks")).alias("value"))
