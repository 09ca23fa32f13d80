"""Queries over inventory and records: filters, deduplication, resume, manual ingest, round trips; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import ingest
from ..session import fresh_folder
from ..sources import io
from ..tables import table

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


FILLED = r"regexp_matches(coalesce(text, ''), '[^\s\p{Z}\x{0085}\x{001c}-\x{001f}]')"
FIRST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY shard_file, line_no) rn FROM records WHERE id IS NOT NULL) WHERE rn = 1)"
LAST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY shard_file DESC, line_no DESC) rn FROM records WHERE id IS NOT NULL) WHERE rn = 1)"
SUFFIX = r"lower(regexp_extract(path, '[^/](\.[^./]+)$', 1))"
GROUP = "CASE " + " ".join(f"WHEN ext IN {_in(e)} THEN '{g}'" for g, e in tx.EXT_GROUPS.items()) + " ELSE 'other' END"
EXTRACTABLE = f"ext IN {_in(tx.EXTRACTABLE)} AND size_bytes > 0 AND size_bytes <= {ingest.MAX_FILE_BYTES} AND NOT contains(lower(path), 'sosreport')"


@query(f"SELECT path, {SUFFIX} AS ext, substr(sha1(path), 1, 16) AS id FROM inventory WHERE path IS NOT NULL")
def path_ext(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "inventory").where("path is not null").select("path", tx.suffix("path").alias("ext"), tx.sha1_id("path").alias("id"))


@query(f"SELECT id, ext, {GROUP} AS grp FROM inventory")
def inv_ext_group(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "inventory").select("id", "ext", tx.ext_group("ext").alias("grp"))


@query("SELECT ext_group, count(*) AS n_files, sum(size_bytes) / 1e9 AS gb FROM inventory GROUP BY ext_group")
def inv_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.inventory_groups(table(spark, sf, "inventory"))


@query("SELECT count(*) AS n_files, CAST(coalesce(sum(size_bytes), 0) AS BIGINT) AS total_bytes FROM inventory")
def inv_totals(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.inventory_totals(table(spark, sf, "inventory"))


@query("SELECT id, coalesce(ext_group IN ('other', 'data') AND size_bytes < 50000000, false) AS sniff FROM inventory")
def inv_sniff_plan(spark: SparkSession, sf: str) -> DataFrame:
    want = ingest.needs_sniffing(F.col("ext_group"), F.col("size_bytes"))
    return table(spark, sf, "inventory").select("id", F.coalesce(want, F.lit(False)).alias("sniff"))


@query("SELECT id, path, ext, size_bytes, mtime FROM inventory")
def inv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The inventory written to Parquet in the shared folder and read again."""
    folder = fresh_folder(spark)
    table(spark, sf, "inventory").write.parquet(folder)
    return spark.read.parquet(folder).select("id", "path", "ext", "size_bytes", "mtime")


@query(None)
def inv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A walk over the folder of the tables themselves."""
    return io.walk(spark, sf).select("path", "ext", "ext_group")


@query(f"SELECT id, path, size_bytes FROM inventory WHERE {EXTRACTABLE}")
def extractable_filter(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.extractable(table(spark, sf, "inventory")).select("id", "path", "size_bytes")


@query(f"SELECT id, shard_file, line_no FROM records WHERE {FILLED}")
def nonempty_docs(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.nonempty(table(spark, sf, "records")).select("id", "shard_file", "line_no")


@query("SELECT id, shard_file, line_no FROM records WHERE ext IN ('.pdf', '.ppt', '.pptx') AND NOT coalesce(ocr, false) AND coalesce(char_count, 0) < 300")
def low_text_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.low_text(table(spark, sf, "records")).select("id", "shard_file", "line_no")


@query("SELECT id, path, lang FROM records WHERE (starts_with(path, 'tracker_export/') OR starts_with(path, 'wiki_mirror/')) AND lang = 'zh'")
def where_prefix_lang(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import search

    return table(spark, sf, "records").where(search.where(["tracker_export/", "wiki_mirror/"], "zh")).select("id", "path", "lang")


@query("SELECT id, path FROM records WHERE char_count > 500 AND ext = '.pdf'")
def where_raw(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import search

    return table(spark, sf, "records").where(search.where(raw="char_count > 500 AND ext = '.pdf'")).select("id", "path")


@query("SELECT id, path FROM records WHERE contains(coalesce(path, ''), '/build/') OR contains(coalesce(path, ''), 'attachments/') OR contains(coalesce(path, ''), '_final')")
def index_exclude(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import index

    return table(spark, sf, "records").where(index.excluded(F.col("path"), ["/build/", "attachments/", "_final"])).select("id", "path")


@query(rf"SELECT id, path, e AS ext FROM (SELECT id, path, regexp_extract(lower(path), '(\.[^.]+)$', 1) e FROM inventory) WHERE e IN ('.pptx', '.ppt', '.pdf')")
def raster_targets(spark: SparkSession, sf: str) -> DataFrame:
    ext = tx.last_dot("path")
    return table(spark, sf, "inventory").where(ext.isin(".pptx", ".ppt", ".pdf")).select("id", "path", ext.alias("ext"))


@query(r"""SELECT count_if(e IN ('.pptx', '.ppt')) AS n_slides, count_if(e = '.pdf') AS n_pdf FROM (SELECT regexp_extract(lower(path), '(\.[^.]+)$', 1) e FROM inventory)""")
def raster_tally(spark: SparkSession, sf: str) -> DataFrame:
    ext = tx.last_dot("path")
    return table(spark, sf, "inventory").agg(F.count_if(ext.isin(".pptx", ".ppt")).alias("n_slides"), F.count_if(ext == ".pdf").alias("n_pdf"))


@query(f"""SELECT i.id, i.path FROM inventory i WHERE {EXTRACTABLE.replace('ext IN', 'i.ext IN')} AND NOT EXISTS (SELECT 1 FROM records r WHERE r.id = i.id AND {FILLED.replace('text', 'r.text')})""")
def resume_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Files still to extract where only records with text count as done."""
    return ingest.pending(table(spark, sf, "inventory"), ingest.nonempty(table(spark, sf, "records"))).select("id", "path")


def _manual(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "inventory").where("path is not null").select("path", "size_bytes").distinct()


NAME = "regexp_extract(path, '([^/]*)$', 1)"
REJECT = f"""CASE WHEN ends_with(name, '.Identifier') THEN 'stream' WHEN contains(name, ':') THEN 'stream'
 WHEN lower(regexp_extract(name, '[^/](\\.[^./]+)$', 1)) NOT IN {_in(tx.EXTRACTABLE)} THEN 'unsupported' WHEN size_bytes > {ingest.MAX_FILE_BYTES} THEN 'too large' END"""
MANUAL = f"(SELECT DISTINCT path, size_bytes, {NAME} AS name FROM inventory WHERE path IS NOT NULL)"


@query(f"SELECT name, path, size_bytes, {REJECT} AS reject FROM {MANUAL}")
def manual_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.manual_candidates(_manual(spark, sf))


@query(f"""SELECT m.id, m.path, CASE WHEN r.id IS NULL THEN 'new' ELSE 'present' END AS state
FROM (SELECT path, substr(sha1(path), 1, 16) id FROM {MANUAL} WHERE {REJECT} IS NULL) m LEFT JOIN (SELECT DISTINCT id FROM records) r USING (id)""")
def manual_split(spark: SparkSession, sf: str) -> DataFrame:
    good = ingest.manual_candidates(_manual(spark, sf)).where("reject is null")
    return ingest.manual_split(good, table(spark, sf, "records"))


@query(f"""SELECT substr(sha1(path), 1, 16) AS id, path, '' AS lang, 0 AS char_count, 9999 AS score, 9999 AS raw_score, 0 AS n_unique_terms, 1 AS high_hits,
'manual' AS hits, '' AS snippet, 'tier1' AS tier FROM {MANUAL} WHERE {REJECT} IS NULL""")
def manual_tier(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.manual_tier(ingest.manual_candidates(_manual(spark, sf)).where("reject is null"))


def _hashed(spark: SparkSession, sf: str) -> DataFrame:
    """Records by the hash of their text, which so isn't shuffled."""
    return table(spark, sf, "records").select("id", "shard_file", "line_no", F.sha1(F.coalesce("text", F.lit(""))).alias("text_sha1"))


@query(f"SELECT id, shard_file, line_no, sha1(coalesce(text, '')) AS text_sha1 FROM {FIRST}")
def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.dedup(_hashed(spark, sf), "first")


@query(f"SELECT id, shard_file, line_no, sha1(coalesce(text, '')) AS text_sha1 FROM {LAST}")
def dedup_last(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.dedup(_hashed(spark, sf), "last")


@query(f"""SELECT t.id, coalesce(length(r.text), 0) AS n_chars, r.id IS NOT NULL AS found
FROM (SELECT DISTINCT id FROM inventory) t LEFT JOIN {LAST} r ON r.id = t.id""")
def fetch_by_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = ingest.fetch(table(spark, sf, "inventory").select("id").distinct(), table(spark, sf, "records"))
    return rows.select("id", F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"), "found")


@query("SELECT id, shard_file, line_no FROM records WHERE id IS NULL OR id NOT IN (SELECT id FROM records WHERE ext IN ('.pdf', '.ppt', '.pptx') AND NOT coalesce(ocr, false) AND coalesce(char_count, 0) < 300 AND id IS NOT NULL)")
def strip_stale(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "records")
    return ingest.strip_ids(r, ingest.low_text(r)).select("id", "shard_file", "line_no")


@query("""SELECT id, ext, ocr FROM records UNION ALL SELECT substr(sha1(path), 1, 16), ext, CAST(NULL AS BOOLEAN) FROM documents""")
def append_union(spark: SparkSession, sf: str) -> DataFrame:
    more = table(spark, sf, "documents").select(tx.sha1_id("path").alias("id"), "ext")
    return ingest.append(table(spark, sf, "records").select("id", "ext", "ocr"), more)


@query(f"""SELECT id, CASE WHEN better THEN length(ocr_text) ELSE char_count END AS char_count, CASE WHEN better THEN len(string_split(ocr_text, chr(10) || chr(10))) ELSE n_elements END AS n_elements,
CASE WHEN better THEN true ELSE coalesce(ocr, false) END AS ocr FROM (
SELECT l.*, c.ocr_text, coalesce(length(c.ocr_text) > coalesce(l.char_count, 0), false) AS better FROM {LAST} l
LEFT JOIN (SELECT doc_id, max(text) AS ocr_text FROM chunks WHERE chunk_index = 0 GROUP BY doc_id) c ON c.doc_id = l.id)""")
def ocr_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The first chunk's text stands in for a recognised text."""
    seen = table(spark, sf, "chunks").where("chunk_index = 0").groupBy(F.col("doc_id").alias("id")).agg(F.max("text").alias("ocr_text"))
    merged = ingest.merge_recognised(ingest.dedup(table(spark, sf, "records"), "last"), seen.withColumn("ocr_error", F.lit(None).cast("string")))
    return merged.select("id", "char_count", "n_elements", "ocr")


ATT = r"regexp_extract(path, 'attachments/(\d+)_attachments_(.*)$', 2)"


@query(rf"""SELECT issue, attachment_id, filename FROM (SELECT DISTINCT split_part(path, '/', 1) AS issue, regexp_extract(path, 'attachments/(\d+)_attachments_(.*)$', 1) AS attachment_id, {ATT} AS filename
FROM inventory WHERE path LIKE '%attachments/%' AND {ATT} <> '') w WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT split_part(path, '/', 1) AS issue, {ATT} AS name FROM records WHERE {ATT} <> '' AND {FILLED}) f
WHERE f.issue = w.issue AND (f.name = w.filename OR f.name = replace(w.filename, ' ', '+')))""")
def attachment_missing(spark: SparkSession, sf: str) -> DataFrame:
    pat = r"attachments/(\d+)_attachments_(.*)$"
    part = lambda i: F.regexp_extract("path", pat, i)
    # an attachment counts as there once it gave text
    inv = table(spark, sf, "inventory").where(part(2) != "").select(F.substring_index("path", "/", 1).alias("issue"), part(1).alias("id"), part(2).alias("filename")).distinct()
    # one row for each file, so no issue gathers an unbounded list
    issues = inv.select("issue", F.array(F.struct("id", "filename")).alias("attachments"))
    files = ingest.nonempty(table(spark, sf, "records")).where(part(2) != "").select(F.substring_index("path", "/", 1).alias("issue"), part(2).alias("name"))
    return ingest.missing_attachments(issues, files)


@query("SELECT id, path, ext, lang, char_count, sha1(coalesce(text, '')) AS text_sha1 FROM records WHERE id IS NOT NULL")
def shard_write(spark: SparkSession, sf: str) -> DataFrame:
    """Records written as JSON Lines shards to the shared folder and read again."""
    folder = fresh_folder(spark) + "/shards"
    r = table(spark, sf, "records").where("id is not null").drop("shard_file", "line_no")
    io.write_shards(r, folder, "overwrite")
    good, _ = io.read_shards(spark, folder)
    return good.select("id", "path", "ext", "lang", "char_count", F.sha1(F.coalesce("text", F.lit(""))).alias("text_sha1"))


@query("""SELECT shard_file || '.jsonl' AS shard_file, count(*) AS n_records, count_if(error <> '') AS n_errors, 1 AS n_bad, count(DISTINCT line_no) > 0 AS placed FROM records GROUP BY shard_file""")
def shard_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Records written as one file for each shard, with a line that can't be read at its end, and scanned again."""
    folder = fresh_folder(spark) + "/shards"
    r = table(spark, sf, "records")
    line = F.to_json(F.struct(*[c for c in r.columns if c not in ("shard_file", "line_no")]), {"ignoreNullFields": "true"})
    lines = r.select("shard_file", "line_no", line.alias("value"))
    broken = r.select("shard_file").distinct().select("shard_file", F.lit(1 << 30).alias("line_no"), F.lit('{"id": "cut').alias("value"))
    io.write_lines(lines.unionByName(broken), folder)
    good, bad = io.read_shards(spark, folder)
    n = good.groupBy("shard_file").agg(F.count("*").alias("n_records"), F.count_if(F.col("error") != "").alias("n_errors"), (F.count_distinct("byte_offset") == F.count("*")).alias("placed"))
    return n.join(bad.groupBy("shard_file").agg(F.count("*").cast("int").alias("n_bad")), "shard_file")


@query("SELECT id, size_bytes FROM inventory ORDER BY size_bytes DESC, id, mtime LIMIT 100")
def limit_docs(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.limit_docs(table(spark, sf, "inventory").select("id", "size_bytes", "mtime"), 100, F.desc("size_bytes"), "id", "mtime").select("id", "size_bytes")


@query(f"SELECT DISTINCT i.id FROM inventory i WHERE {EXTRACTABLE.replace('ext IN', 'i.ext IN')} AND i.id NOT IN (SELECT doc_id FROM docs WHERE status = 'indexed')")
def skip_existing(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "docs").where("status = 'indexed'").select(F.col("doc_id").alias("id")).distinct()
    return ingest.extractable(table(spark, sf, "inventory")).select("id").distinct().join(done, "id", "left_anti")


_CJK = "length(regexp_replace(left(text, 4000), '[^一-鿿]', '', 'g'))"
_CYR = "length(regexp_replace(left(text, 4000), '[^Ѐ-ӿ]', '', 'g'))"


def _score_sql(words: str) -> str:
    """Whole words counted by doubling what no word holds, so that neighbours don't share it."""
    return rf"len(regexp_extract_all(regexp_replace(head, '([^A-Za-z0-9_])', '\1\1', 'g'), '(?i)(^|[^A-Za-z0-9_])({words})($|[^A-Za-z0-9_])'))"


SCORES = ", ".join(f"{_score_sql(w)} AS s_{k}" for k, w in ingest.STOP_WORDS.items())
BEST = "greatest(" + ", ".join(f"s_{k}" for k in ingest.STOP_WORDS) + ")"


@query(f"""SELECT id, shard_file, line_no, CASE WHEN n < 40 THEN '' WHEN {_CJK.replace('left(text, 4000)', 'head')} * 4 > length(head) THEN 'zh' WHEN {_CYR.replace('left(text, 4000)', 'head')} * 4 > length(head) THEN 'ru'
WHEN {BEST} = 0 THEN '' {' '.join(f"WHEN s_{k} = {BEST} THEN '{k}'" for k in ingest.STOP_WORDS)} ELSE '' END AS lang
FROM (SELECT *, {SCORES} FROM (SELECT id, shard_file, line_no, length(coalesce(text, '')) AS n, left(coalesce(text, ''), 4000) AS head FROM records))""")
def lang_detect(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "records").select("id", "shard_file", "line_no", ingest.detect_lang(F.col("text")).alias("lang"))


_SPACE = r"[\s\p{Z}\x{0085}\x{001c}-\x{001f}]+"
BLOCKS = f"list_filter(list_transform(string_split(coalesce(text, ''), chr(10) || chr(10)), lambda p: trim(regexp_replace(p, '{_SPACE}', ' ', 'g'))), lambda p: p <> '')"


@query(f"SELECT id, array_to_string(b, chr(10) || chr(10)) AS text, len(b) AS n_elements, length(array_to_string(b, chr(10) || chr(10))) AS char_count, '' AS error FROM (SELECT id, {BLOCKS} AS b FROM {LAST})")
def html_extract(spark: SparkSession, sf: str) -> DataFrame:
    """All records' texts made into pages, a paragraph for each block, and extracted again."""
    text = F.coalesce("text", F.lit(""))
    for raw, mark in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\n\n", "</p><p>")):
        text = F.replace(text, F.lit(raw), F.lit(mark))
    pages = ingest.dedup(table(spark, sf, "records").select("id", "shard_file", "line_no", "text"), "last")
    pages = pages.select("id", F.concat(F.lit("<html><head><title>t</title></head><body><p>"), text, F.lit("</p></body></html>")).alias("html"))
    return io.html_records(pages).withColumns({c: F.col(c).cast("long") for c in ("n_elements", "char_count")})
