import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quarrylamp.operators import audit, index, ingest, rag
from quarrylamp.sources import io
from quarrylamp.streaming import incremental

REC = "id string, path string, ext string, lang string, char_count bigint, n_elements int, text string, error string, ocr boolean, shard_file string, line_no int"
MAN = "doc_id string, path string, ext string, lang string, char_count bigint, text_sha1 string, n_chunks int, shard_file string, byte_offset bigint, status string, indexed_at timestamp"


def record(i, text, shard="s0", line=0, path=None):
    return (i, path or f"p/{i}.pdf", ".pdf", "en", len(text or ""), 1, text, "", None, shard, line)


def manifest(i, text, when=1, shard="s0", status="indexed"):
    import hashlib

    return (i, f"p/{i}.pdf", ".pdf", "en", 1, hashlib.sha1((text or "").encode()).hexdigest(), 1, shard, 0, status, dt.datetime(2024, 1, when))


@pytest.fixture(scope="module")
def store(spark):
    recs = [record("same", "one"), record("moved", "two", "s1"), record("chg", "three"), record("new", "four"), record("blank", " \n"), record("exc", "five", path="x/skip/y"),
            record("was_exc", "six"), record("dup", "first", line=1), record("dup", "second", line=2), record(None, "x"), record("nul", None)]
    man = [manifest("same", "one", 2), manifest("same", "old", 1), manifest("moved", "two"), manifest("chg", "before"), manifest("was_exc", "six", status="excluded"), manifest("gone", "z"), manifest("blank", "b")]
    return spark.createDataFrame(recs, REC), spark.createDataFrame(man, MAN)


def test_classes(store):
    got = {r.id: (r["class"], r.moved) for r in index.classify(*store, ["/skip/"]).collect()}
    assert got == {"same": ("unchanged", False), "moved": ("unchanged", True), "chg": ("changed", False), "new": ("new", False), "blank": ("empty", False),
                   "exc": ("excluded", False), "was_exc": ("changed", False), "dup": ("new", False), "nul": ("empty", False)}
    assert [r.doc_id for r in index.deleted(*store).collect()] == ["gone"]
    assert {r.doc_id: r.status for r in index.stale(index.latest(store[1]), store[0]).collect()}["gone"] == "missing"


def test_dedup_and_strip(store):
    r = store[0]
    text = lambda keep: {x.id: x.text for x in ingest.dedup(r, keep).collect()}
    assert text("first")["dup"] == "first" and text("last")["dup"] == "second" and None not in text("last")
    assert ingest.strip_ids(r, r.where("id = 'dup'")).count() == r.count() - 2


def test_upserts_are_idempotent(spark, store):
    chunks = spark.createDataFrame([("same:0000", "same", "one"), ("chg:0000", "chg", "old")], "chunk_id string, doc_id string, text string")
    fresh = spark.createDataFrame([("chg:0000", "chg", "three")], chunks.schema)
    once = index.upsert_chunks(chunks, fresh, fresh)
    assert sorted(index.upsert_chunks(once, fresh, fresh).collect()) == sorted(once.collect()) == [("chg:0000", "chg", "three"), ("same:0000", "same", "one")]
    m = index.refresh_locations(store[1], spark.createDataFrame([("moved", "s9"), ("unknown", "s9")], "doc_id string, shard_file string"))
    assert {r.doc_id: r.shard_file for r in m.collect()}["moved"] == "s9" and m.count() == 6


def test_stream_indexes_and_then_finds_nothing_changed(spark, tmp_path):
    shards, folder, check = (str(tmp_path / x) for x in ("shards", "index", "check"))
    def write(name, rows):
        (tmp_path / "shards").mkdir(exist_ok=True)
        (tmp_path / "shards" / name).write_text("\n".join(rows), encoding="utf-8")
    def run():
        incremental.stream_shards(spark, shards, folder, check).awaitTermination()
        return index.open_store(spark, folder)
    a = {"id": "a", "path": "p/a", "text": "one\n\ntwo"}
    write("shard_00000.jsonl", [json.dumps(a), "{broken", json.dumps({"id": "b", "path": "p/b", "text": ""}), json.dumps({"id": "d", "path": "p/d", "text": "stays é"}), json.dumps(a | {"text": "later"})])
    store = run()
    rows = {r.doc_id: r for r in store.manifest(spark).collect()}
    assert {i: r.status for i, r in rows.items()} == {"a": "indexed", "b": "empty", "d": "indexed"} and rows["d"].byte_offset > 0
    write("shard_00001.jsonl", [json.dumps({"id": "a", "path": "p/a", "text": "three"}), json.dumps({"id": "c", "path": "p/c", "text": "new"}), json.dumps({"id": "d", "path": "p/d", "text": "stays é"})])
    store = run()
    assert store.parts == (1, 2)
    text = lambda st: {r.doc_id: r.text for r in st.chunks(spark).collect()}
    rows = {r.doc_id: r for r in store.manifest(spark).collect()}
    assert text(store) == {"a": "three", "c": "new", "d": "stays é"} and (rows["d"].shard_file, rows["d"].part, rows["a"].part) == ("shard_00001.jsonl", 1, 2)
    assert {(r.term, r.doc_id) for r in store.postings(spark, ["one", "three", "stays"]).collect()} == {("three", "a"), ("stays", "d")}
    assert tuple(store.totals(spark).collect()[0]) == (3, 4 / 3)
    # points to the very line, and tells when another document stands there
    there = store.manifest(spark).where("n_chunks > 0").select("doc_id", "shard_file", "byte_offset")
    assert {r.doc_id: r.text for r in io.lookup(spark, shards, there).collect()} == text(store)
    wrong = there.withColumn("doc_id", F.lit("x"))
    assert not any(r.found for r in io.lookup(spark, shards, wrong).collect())
    write("shard_00002.jsonl", [json.dumps({"id": "c", "path": "p/c", "text": " "})])
    store = run()
    assert text(store) == {"a": "three", "d": "stays é"}
    one = index.compact(spark, store)
    assert one.parts == (4,) and text(one) == text(store) and tuple(one.totals(spark).collect()[0]) == (2, 1.5)
    assert {r.doc_id: (r.status, r.shard_file) for r in one.manifest(spark).collect()} == {r.doc_id: (r.status, r.shard_file) for r in store.manifest(spark).collect()}
    records, bad = io.read_shards(spark, shards)
    assert [(r.line_no, r.line) for r in bad.collect()] == [(1, "{broken")] and records.where("id = 'c'").collect()[0].ocr is None
    assert spark.read.json(f"{folder}/bad_lines/batch=0").collect()[0].line == "{broken"
    newest = records.where("shard_file = 'shard_00001.jsonl' and id <> 'c'")
    assert {r["class"] for r in index.classify(newest, one.manifest(spark), []).collect()} == {"unchanged"}


def test_versions_go_by_number(spark, tmp_path):
    chunks = spark.createDataFrame([("a:0000", "a", "p/a", "x y")], "chunk_id string, doc_id string, path string, text string")
    store = None
    for _ in range(2):
        store = index.build(spark, str(tmp_path / "i"), chunks)
    (tmp_path / "i/current-10").mkdir()
    (tmp_path / "i/current-10/_SUCCESS").write_text("")
    (tmp_path / "i/current-10/part-0.txt").write_text('{"version": 10, "parts": [2]}')
    assert store.version == 2 and index.open_store(spark, str(tmp_path / "i")).version == 10
    assert index.open_store(spark, str(tmp_path / "none")) is None


def test_csv_round_trip(spark, tmp_path):
    rows = [("a", "p,\"q\"", "", 1, 2.5, 3, 1, 1, "x×1, y×2", 'line\nwith "quotes", commas')]
    df = spark.createDataFrame(rows, "id string, path string, lang string, char_count bigint, score double, raw_score bigint, n_unique_terms int, high_hits int, hits string, snippet string")
    io.write_csv(df, str(tmp_path / "c"))
    assert [tuple(r) for r in io.read_csv(spark, str(tmp_path / "c")).collect()] == rows


def test_walk_archives_and_images(spark, tmp_path):
    import io as stdio
    import tarfile
    import zipfile

    import zstandard

    (tmp_path / "t/.git").mkdir(parents=True)
    (tmp_path / "t/.git/x.py").write_text("no")
    (tmp_path / "t/a.PDF").write_text("yes")
    assert [(r.path, r.ext, r.ext_group, r.size_bytes) for r in io.walk(spark, str(tmp_path / "t")).collect()] == [("a.PDF", ".pdf", "doc", 3)]
    assert io.loose_files(spark, str(tmp_path / "t")).count() == 1
    buf, z = stdio.BytesIO(), stdio.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as t:
        info = tarfile.TarInfo("m.txt")
        info.size = 2
        t.addfile(info, stdio.BytesIO(b"hi"))
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("n.txt", "yo")
    rows = [("a.tar.zst", zstandard.compress(buf.getvalue())), ("b.zip", z.getvalue()), ("c.tar", b"broken")]
    out = {r.archive: r for r in io.expand_archives(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert bytes(out["a.tar.zst"].content) == b"hi" and out["b.zip"].member == "n.txt" and out["c.tar"].error
    (tmp_path / "s/d1").mkdir(parents=True)
    for k in (2, 1, 3):
        (tmp_path / f"s/d1/slide-0{k}.png").write_bytes(bytes([k]))
    assert io.slide_images(spark, str(tmp_path / "s"), 2).collect()[0].images == ["AQ==", "Ag=="]


def test_html_and_recognition(spark):
    assert io.extract_html("<head><title>x</title></head><p>One <b>two</b></p><script>no</script><div>three</div>") == ("One two\n\nthree", 2)
    assert io.extract_html(None) == ("", 0)
    r = spark.createDataFrame([record("a", "short"), record("b", "a long enough text")], REC)
    seen = spark.createDataFrame([("a", "much longer\n\ntext", None), ("b", "x", "timeout")], "id string, ocr_text string, ocr_error string")
    out = {x.id: x for x in ingest.merge_recognised(r, seen).collect()}
    assert (out["a"].ocr, out["a"].n_elements, out["a"].char_count) == (True, 2, 17) and out["b"].text == "a long enough text" and out["b"].error == "timeout"


def test_missing_attachments(spark):
    issues = spark.createDataFrame([("i1", [("1", "a b.pdf"), ("2", "c.pdf"), ("3", "gone")]), ("i2", None)], "issue string, attachments array<struct<id:string,filename:string>>")
    files = spark.createDataFrame([("i1", "a+b.pdf"), ("i1", "c.pdf"), ("i2", "gone")], "issue string, name string")
    assert [tuple(r) for r in ingest.missing_attachments(issues, files).collect()] == [("i1", "3", "gone")]


def test_manual_rejects(spark):
    files = spark.createDataFrame([("m/a.pdf", 5), ("m/a.pdf:Zone.Identifier", 1), ("m/x.exe", 1), ("m/big.pdf", 10**9)], "path string, size_bytes bigint")
    assert [r.reject for r in ingest.manual_candidates(files).collect()] == [None, "stream", "unsupported", "too large"]


def test_audit_statuses(spark):
    block = lambda i, n: f"## Slide {i}\n" + "word " * n + "\n"
    head = "**Source path:** `s.pdf`\n**Images attached:** {}\n\n"
    files = [("ok_x.md", head.format(3) + block(1, 5) + block(2, 6) + block(3, 7)), ("skip_x.md", "no header"), ("nohead_x.md", "**Images attached:** 2\n"),
             ("short_x.md", head.format(1) + block(1, 4)), ("tail_x.md", head.format(3) + block(1, 5) + block(2, 5) + block(3, 60)),
             ("both_x.md", head.format(2) + block(1, 5) + block(1, 5) + block(2, 60)), ("lost_x.md", head.format(1).replace("s.pdf", "no.pdf"))]
    pages = spark.createDataFrame([("s.pdf", 3, None)], "src string, true_pages int, count_error string")
    out = {r.doc_id: r.status for r in audit.status(audit.parse(spark.createDataFrame(files, "file string, text string")), pages).collect()}
    assert out == {"ok": "PASS", "skip": "SKIP", "nohead": "UNKNOWN", "short": "FAIL_SHORT", "tail": "FAIL_MERGED_TAIL", "both": "FAIL_SHORT+FAIL_MERGED_TAIL", "lost": "UNKNOWN"}


def test_budget_keeps_the_best(spark):
    df = spark.createDataFrame([("q", f"d{i}", i, n) for i, n in enumerate([900, 50, 60, 10])], "query_id string, doc_id string, rank int, n_tokens int")
    assert [r.doc_id for r in rag.trim(df, 960).orderBy("rank").collect()] == ["d0", "d1"] and rag.trim(df, 5).count() == 1


def test_completions_retry_and_fail_softly(spark):
    class Flaky:
        def __init__(self):
            self.calls = 0

        def complete(self, prompt):
            self.calls += 1
            if "boom" in prompt:
                raise ValueError("no")
            return "" if self.calls == 1 else "yes"

    out = {r.id: (r.answer, r.error) for r in rag.complete_all(spark.createDataFrame([("a", "x"), ("b", "boom")], "id string, prompt string").coalesce(1), Flaky()).collect()}
    assert out["a"] == ("yes", "") and out["b"][0] == "FOUND: no" and "ValueError" in out["b"][1]
