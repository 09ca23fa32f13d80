"""Text of files: an Extractor for each kind of file, and records made with them.

Built in are plain and marked-up text, tables, JSON, mail, HTML and the zipped XML of word processors, sheets and slides,
all by the standard library. Another kind is added by handing over an Extractor for its extension. A file that fails gives
a record with an error and no text, so it fails no task.
"""

from __future__ import annotations

import csv
import email
import email.policy
import io
import json
import re
import zipfile
from collections.abc import Mapping
from typing import Protocol
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.ingest import MAX_TEXT_CHARS
from .io import extract_html


class Extractor(Protocol):
    """Makes the elements (paragraphs, rows, slides) of a file's text from its bytes."""

    def __call__(self, data: bytes) -> list[str]: ...


def decode(data: bytes) -> str:
    """Text by its byte order mark, else UTF-8, else GB18030, else Windows-1252 with nothing lost."""
    for mark, name in ((b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"), (b"\xef\xbb\xbf", "utf-8-sig")):
        if data.startswith(mark):
            return data.decode(name, "replace")
    for name in ("utf-8", "gb18030"):
        try:
            return data.decode(name)
        except UnicodeDecodeError:
            pass
    return data.decode("cp1252", "replace")


def plain_text(data: bytes) -> list[str]:
    return [p.strip("\n") for p in re.split(r"\r?\n(?:[ \t]*\r?\n)+", decode(data)) if p.strip()]


def table_text(data: bytes) -> list[str]:
    """Rows of a delimited file, cells joined by ' | '; the delimiter is the one that the first line holds most of."""
    text = decode(data)
    head = text.split("\n", 1)[0]
    rows = csv.reader(io.StringIO(text), delimiter=max(",;\t", key=head.count))
    return [" | ".join(c.strip() for c in row) for row in rows if any(c.strip() for c in row)]


def _leaves(value: object, path: str = "") -> list[str]:
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in _leaves(v, f"{path}.{k}" if path else str(k))]
    if isinstance(value, list):
        return [x for v in value for x in _leaves(v, path)]
    return [f"{path}: {value}" if path else str(value)] if value not in (None, "") else []


def json_text(data: bytes) -> list[str]:
    """'path: value' of every leaf; of several lines each is a value of its own."""
    text = decode(data)
    try:
        return _leaves(json.loads(text))
    except json.JSONDecodeError:
        return [x for line in text.splitlines() if line.strip() for x in _leaves(json.loads(line))]


def xml_text(data: bytes) -> list[str]:
    return [" ".join(t.split()) for t in ElementTree.fromstring(data).itertext() if t.strip()]


def html_text(data: bytes) -> list[str]:
    text, _ = extract_html(decode(data))
    return text.split("\n\n") if text else []


def mail_text(data: bytes) -> list[str]:
    """Subject, sender, receivers, date, then the body (plain before HTML) and the names of attached files."""
    m = email.message_from_bytes(data, policy=email.policy.default)
    out = [f"{k}: {m[k]}" for k in ("Subject", "From", "To", "Cc", "Date") if m[k]]
    body = m.get_body(("plain", "html"))
    if body is not None:
        content = body.get_content()
        out += html_text(content.encode()) if body.get_content_subtype() == "html" else plain_text(content.encode())
    return out + [f"Attachment: {a.get_filename()}" for a in m.iter_attachments() if a.get_filename()]


def _part(z: zipfile.ZipFile, name: str) -> ElementTree.Element:
    return ElementTree.fromstring(z.read(name))


def _local(e: ElementTree.Element) -> str:
    return e.tag.rsplit("}", 1)[-1]


def _runs(e: ElementTree.Element, leaf: str = "t") -> str:
    """Text of the leaves below an element; tabs and breaks stay."""
    marks = {"tab": "\t", "br": "\n", "cr": "\n"}
    return "".join((x.text or "") if _local(x) == leaf else marks.get(_local(x), "") for x in e.iter())


def document_text(data: bytes) -> list[str]:
    """Paragraphs of a word processor's file, those inside tables too."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return [t for p in _part(z, "word/document.xml").iter() if _local(p) == "p" and (t := _runs(p).strip())]


def _numbered(z: zipfile.ZipFile, pattern: str) -> list[str]:
    found = [(int(m[1]), n) for n in z.namelist() if (m := re.fullmatch(pattern, n))]
    return [n for _, n in sorted(found)]


def slides_text(data: bytes) -> list[str]:
    """One element for each slide: its paragraphs, a line each."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        pages = []
        for name in _numbered(z, r"ppt/slides/slide(\d+)\.xml"):
            lines = [t for p in _part(z, name).iter() if _local(p) == "p" and (t := _runs(p).strip())]
            pages.append("\n".join(lines))
        return [p for p in pages if p]


def sheets_text(data: bytes) -> list[str]:
    """Rows of all sheets, cells joined by ' | '; shared strings are looked up, formulas give their stored value."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = [_runs(si) for si in _part(z, "xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in z.namelist() else []
        out = []
        for name in _numbered(z, r"xl/worksheets/sheet(\d+)\.xml"):
            for row in (r for r in _part(z, name).iter() if _local(r) == "row"):
                cells = []
                for c in row:
                    value = next((x.text or "" for x in c.iter() if _local(x) == "v"), None)
                    cells.append(shared[int(value)] if c.get("t") == "s" and value else _runs(c) if value is None else value)
                if any(x.strip() for x in cells):
                    out.append(" | ".join(x.strip() for x in cells))
        return out


def open_document_text(data: bytes) -> list[str]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return [t for p in _part(z, "content.xml").iter() if _local(p) in ("p", "h") and (t := " ".join("".join(p.itertext()).split()))]


def rich_text(data: bytes) -> list[str]:
    """Text of an RTF file: control words, groups of settings and escapes resolved."""
    text = re.sub(r"\{\\(?:\*|fonttbl|colortbl|stylesheet|info|pict)(?:[^{}]|\{[^{}]*\})*\}", "", data.decode("latin-1"))
    text = re.sub(r"\\u(-?\d+)\??", lambda m: chr(int(m[1]) % 65536), text)
    text = re.sub(r"(?:\\'[0-9a-fA-F]{2})+", lambda m: bytes.fromhex(m.group().replace("\\'", "")).decode("cp1252", "replace"), text)
    text = re.sub(r"\\(?:par|line)\b ?", "\n\n", text)
    return plain_text(re.sub(r"\\[a-zA-Z]+-?\d* ?|[{}]", "", text).encode("utf-8", "surrogatepass"))


_MARKUP = {"html": html_text, "htm": html_text, "xml": xml_text}
_OFFICE = {"docx": document_text, "pptx": slides_text, "xlsx": sheets_text, "odt": open_document_text, "rtf": rich_text}
#: Extractors by extension.
EXTRACTORS: dict[str, Extractor] = {
    **{f".{e}": f for e, f in {**_MARKUP, **_OFFICE, "eml": mail_text, "json": json_text, "jsonl": json_text}.items()},
    **{f".{e}": table_text for e in ("csv", "tsv")},
    **{f".{e}": plain_text for e in ("txt", "md", "yaml", "yml")},
}

_RECORD = "id string, path string, ext string, lang string, char_count bigint, n_elements int, text string, error string, ocr boolean"


def extract_records(files: DataFrame, extractors: Mapping[str, Extractor] | None = None, most: int = MAX_TEXT_CHARS) -> DataFrame:
    """Records of files (id, path, ext, content): elements joined by blank lines, cut at `most` characters; char_count is
    the length of the cut text. Without an extractor for its extension a file gives the error 'no extractor'."""
    known = dict(EXTRACTORS if extractors is None else extractors)

    def run(batches):
        kinds = [(n, t) for n, t in (c.rsplit(" ", 1) for c in _RECORD.split(", "))]
        arrow = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
        for b in batches:
            rows = []
            for i, path, ext, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                text, n, error = "", 0, ""
                try:
                    if ext not in known:
                        raise LookupError("no extractor")
                    parts = known[ext](raw or b"")
                    text, n = "\n\n".join(parts)[:most], len(parts)
                except Exception as exc:  # noqa: BLE001
                    error = f"{type(exc).__name__}: {exc}"[:200]
                rows.append((i, path, ext, "", len(text), n, text, error, False))
            cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, arrow[t]) for c, (_, t) in zip(cols, kinds, strict=True)], names=[n for n, _ in kinds])

    return files.select("id", "path", "ext", "content").mapInArrow(run, _RECORD)


def page_count(data: bytes, ext: str) -> int:
    """Slides of a deck, pages of a PDF. Raises ValueError where they can't be told."""
    if ext == ".pptx":
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            return len(_numbered(z, r"ppt/slides/slide(\d+)\.xml"))
    if ext == ".pdf":
        counts = [int(n) for n in re.findall(rb"/Type\s*/Pages\b[^>]*?/Count\s+(\d+)", data) + re.findall(rb"/Count\s+(\d+)[^>]*?/Type\s*/Pages\b", data)]
        pages = max(counts, default=0) or len(re.findall(rb"/Type\s*/Page\b(?!s)", data))
        if pages:
            return pages
        raise ValueError("pages are in compressed objects")
    raise ValueError(f"no page count for {ext or 'a file without extension'}")


def page_counts(files: DataFrame) -> DataFrame:
    """src, true_pages, count_error of files (path, content)."""

    def run(batches):
        for b in batches:
            src, pages, errors = [], [], []
            for path, ext, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                src.append(path)
                try:
                    pages.append(page_count(raw or b"", ext))
                    errors.append(None)
                except Exception as exc:  # noqa: BLE001
                    pages.append(None)
                    errors.append(f"{type(exc).__name__}: {exc}"[:200])
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.string()), pa.array(pages, pa.int32()), pa.array(errors, pa.string())], names=["src", "true_pages", "count_error"])

    return files.select("path", tx.suffix("path").alias("ext"), F.col("content")).mapInArrow(run, "src string, true_pages int, count_error string")
