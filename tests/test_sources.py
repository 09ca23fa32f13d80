import io as stdio
import json
import tarfile
import zipfile

import pytest

from quarrylamp.sources import extract, io, tools

W = 'xmlns:w="w" xmlns:a="a"'


def zipped(files):
    buf = stdio.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for n, t in files.items():
            z.writestr(n, t)
    return buf.getvalue()


DOCX = zipped({"word/document.xml": f"<w:d {W}><w:p><w:r><w:t>One </w:t><w:tab/><w:t>two</w:t></w:r></w:p><w:tbl><w:p><w:t>cell</w:t></w:p></w:tbl><w:p/></w:d>"})
PPTX = zipped({f"ppt/slides/slide{k}.xml": f"<s {W}><a:p><a:t>slide {k}</a:t></a:p><a:p><a:t>text</a:t></a:p></s>" for k in (1, 2, 10)})
XLSX = zipped({"xl/sharedStrings.xml": "<sst><si><t>name</t></si><si><r><t>va</t></r><r><t>lue</t></r></si></sst>",
               "xl/worksheets/sheet1.xml": '<w><row><c t="s"><v>0</v></c><c t="s"><v>1</v></c></row><row><c><v>4.5</v></c><c t="inlineStr"><is><t>in</t></is></c></row><row/></w>'})
MAIL = b"Subject: Hi\r\nFrom: a@x.test\r\nContent-Type: multipart/mixed; boundary=B\r\n\r\n--B\r\nContent-Type: text/html\r\n\r\n<p>Body</p>\r\n--B\r\nContent-Disposition: attachment; filename=f.pdf\r\n\r\nx\r\n--B--\r\n"
CASES = [
    (".docx", DOCX, ["One \ttwo", "cell"]), (".pptx", PPTX, ["slide 1\ntext", "slide 2\ntext", "slide 10\ntext"]), (".xlsx", XLSX, ["name | value", "4.5 | in"]),
    (".eml", MAIL, ["Subject: Hi", "From: a@x.test", "Body", "Attachment: f.pdf"]), (".csv", b"a;b\n1;2\n;\n", ["a | b", "1 | 2"]), (".tsv", b"a\tb\n", ["a | b"]),
    (".txt", "é one\r\n\r\ntwo\nthree".encode(), ["é one", "two\nthree"]), (".txt", "中文".encode("gb18030"), ["中文"]), (".json", b'{"a": {"b": [1, {"c": "x"}]}, "d": null}', ["a.b: 1", "a.b.c: x"]),
    (".jsonl", b'{"a": 1}\n\n{"a": 2}\n', ["a: 1", "a: 2"]), (".xml", b"<r><x> one </x><y/>two</r>", ["one", "two"]), (".html", b"<p>One</p><p>Two</p>", ["One", "Two"]), (".txt", b"", []),
    (".odt", zipped({"content.xml": "<d><h>Head</h><p>Text <b>bold</b></p><p/></d>"}), ["Head", "Text bold"]), (".rtf", rb"{\rtf1{\fonttbl{\f0 A;}}\f0 Caf\'e9 one\par two\par}", ["Café one", "two"]),
]


@pytest.mark.parametrize(("ext", "data", "want"), CASES)
def test_elements(ext, data, want):
    assert extract.EXTRACTORS[ext](data) == want


def test_records_and_page_counts(spark):
    rows = [("d", "p/d.docx", ".docx", DOCX), ("bad", "p/b.docx", ".docx", b"no zip"), ("x", "p/x.bin", ".bin", b"1"), ("n", "p/n.txt", ".txt", None), ("n", "p/n.txt", ".txt", None)]
    out = {r.id: r for r in extract.extract_records(spark.createDataFrame(rows, "id string, path string, ext string, content binary"), most=None or 10).collect()}
    assert (out["d"].text, out["d"].n_elements, out["d"].char_count) == ("One \ttwo\n\n", 2, 10) and "BadZipFile" in out["bad"].error
    assert out["x"].error == "LookupError: no extractor" and (out["n"].text, out["n"].error) == ("", "")
    pdf = b"1 0 obj<</Type /Pages /Kids [] /Count 7>>endobj"
    got = {r.src: (r.true_pages, bool(r.count_error)) for r in extract.page_counts(spark.createDataFrame([("a.pptx", PPTX), ("b.pdf", pdf), ("c.pdf", b"x"), ("d.txt", b"")], "path string, content binary")).collect()}
    assert got == {"a.pptx": (3, False), "b.pdf": (7, False), "c.pdf": (None, True), "d.txt": (None, True)}


def test_pages_and_recognition(spark):
    class Pages:
        def __call__(self, data, ext):
            if ext == ".bad":
                raise ValueError("broken")
            return [b"p1", b"p2"]

    class Reads:
        def __call__(self, image):
            if image == b"p2":
                raise TimeoutError("slow")
            return " text \n"

    files = spark.createDataFrame([("a", ".pdf", b"x"), ("b", ".bad", b"x")], "id string, ext string, content binary")
    out = {(r.id, r.slide): r for r in tools.rasterize(files, Pages()).collect()}
    assert out["a", 2].name == "a/slide-02.png" and bytes(out["a", 1].content) == b"p1" and "broken" in out["b", None].error
    seen = {r.id: (r.ocr_text, r.ocr_error) for r in tools.recognise(files, Pages(), Reads()).collect()}
    assert seen["a"] == ("text", None) and seen["b"][0] is None and "broken" in seen["b"][1]
    none = tools.rasterize(files, tools.OfficeRasterizer(renderer="no-such-program")).collect()
    assert all("no-such-program" in r.error for r in none if r.id == "a") and all("folder" in r.error for r in none if r.id == "b")


def test_archives_in_archives(spark):
    inner = zipped({"deep.txt": "deep", "n.zip": zipped({"deeper.txt": "x"})})
    buf = stdio.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as t:
        for name, data in (("a/inner.zip", inner), ("fake.tar", b"not a tar"), ("plain.txt", b"p")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, stdio.BytesIO(data))
    rows = spark.createDataFrame([("o.tar.gz", buf.getvalue()), ("cut.tar.gz", buf.getvalue()[:60]), ("empty.zip", zipped({}))], "path string, content binary")
    out = [(r.archive, r.member, r.content and bytes(r.content), r.error) for r in io.expand_archives(rows).collect()]
    assert {m for a, m, _, _ in out if a == "o.tar.gz"} == {"a/inner.zip!deep.txt", "a/inner.zip!n.zip!deeper.txt", "fake.tar", "plain.txt"}
    assert [bool(e) for a, _, _, e in out if a == "cut.tar.gz"][-1] and not [a for a, *_ in out if a == "empty.zip"]


def test_walk_with_odd_root_and_sniffing(spark, tmp_path):
    root = tmp_path / "r+(1)[x]"
    root.mkdir()
    (root / "blob").write_bytes(b"%PDF-1.7 x")
    (root / "a.txt").write_bytes(b"%PDF no, text")
    (root / "z.bin").write_bytes(b"PK\x03\x04")
    got = {r.path: r.mime for r in io.walk(spark, str(tmp_path), sniff=True).collect()}
    assert got == {"r+(1)[x]/blob": "application/pdf", "r+(1)[x]/a.txt": "", "r+(1)[x]/z.bin": "application/zip"}


def test_issues(spark, tmp_path):
    (tmp_path / "i1.json").write_text(json.dumps({"fields": {"attachment": [{"id": "1", "filename": "a.pdf"}]}}))
    (tmp_path / "i2.json").write_text(json.dumps({"fields": {}}))
    out = {r.issue: r.attachments for r in io.read_issues(spark, str(tmp_path)).collect()}
    assert out["i1"][0].filename == "a.pdf" and out["i2"] is None
