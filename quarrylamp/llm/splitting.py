"""Problem 7: cutting oversized items at natural boundaries.

Method: recursive separator hierarchy. A text is split at section, paragraph, line, sentence, word and at last
character ends until every part is at most limit - overlap long; parts are then packed greedily up to the limit,
and each piece after the first begins `overlap` characters before the end of the one before it.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import map_batches

LIMIT, OVERLAP = 1200, 150

#: Ends of natural units, from the largest to the smallest; a unit keeps its own separator.
_LEVELS = [
    re.compile(r"(?:\r?\n[ \t]*){3,}|(?<=\n)(?=#{1,6} )"),
    re.compile(r"\r?\n[ \t]*\r?\n[ \t]*"),
    re.compile(r"\r?\n"),
    re.compile(r"(?<=[.!?…])[\"'”’»)\]]*\s+|(?<=[。！？；])[”’」』）]*"),
    re.compile(r"\s+|(?<=[，、：])"),
]


def _char_cut(text: str, at: int, low: int) -> int:
    """`at`, or the nearest place before it that divides no line end or combined character."""
    p = at
    while p > low and (
        unicodedata.combining(text[p])
        or text[p] in "‍️"
        or text[p - 1] == "‍"
        or (text[p] == "\n" and text[p - 1] == "\r")
    ):
        p -= 1
    return p if p > low else at


def _atoms(text: str, start: int, end: int, size: int, level: int, out: list[int]) -> None:
    """Appends the ends of parts of text[start:end], each at most `size` long."""
    if end - start <= size:
        out.append(end)
        return
    if level == len(_LEVELS):
        while end - start > size:
            start = _char_cut(text, start + size, start)
            out.append(start)
        out.append(end)
        return
    at = start
    for m in _LEVELS[level].finditer(text, start, end):
        if start < m.end() < end and m.end() > at:
            _atoms(text, at, m.end(), size, level + 1, out)
            at = m.end()
    _atoms(text, at, end, size, level + 1, out)


def split_text(text: str | None, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Spans (start, end) of the pieces of `text` in code points. Null and '' give none; a text within the limit
    gives one. Consecutive spans share exactly `overlap` characters and together cover the text."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    if not text:
        return []
    if len(text) <= limit:
        return [(0, len(text))]
    ends: list[int] = []
    _atoms(text, 0, len(text), limit - overlap, 0, ends)
    spans, start, end = [], 0, 0
    for e in ends:
        if e - start > limit:
            spans.append((start, end))
            start = max(0, end - overlap)
        end = e
    spans.append((start, end))
    return spans


def split_chunks(chunks: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of every chunk, at most `limit` code points long.

    In: chunk_id, text, char_start, char_end (other columns are ignored). Repeated rows of a chunk_id count once.
    Out: chunk_id, piece_index, char_start, char_end (in the chunk's text: text[char_start:char_end] is the piece),
    doc_char_start, doc_char_end (in the document; null where the chunk's own offsets are null or don't fit its
    text), text. Null and empty texts give no row; a null chunk_id is kept as its own chunk for each text.

    Only oversized texts go to Python; the others stay in the JVM as one piece. No row depends on another, so a hot
    document costs nothing extra.
    """
    length = F.length("text")
    trusted = (F.col("char_end") - F.col("char_start") == length) & (F.col("char_start") >= 0)
    base = (
        chunks.where(length > 0)
        .select("chunk_id", "text", F.when(trusted, F.col("char_start")).cast("int").alias("_at"))
        .withColumn("_key", F.coalesce("chunk_id", F.concat(F.lit("\0"), F.sha1("text"))))
        .groupBy("_key")
        .agg(F.max_by(F.struct("chunk_id", "text", "_at"), F.coalesce("_at", F.lit(-1))).alias("c"))
        .select("c.*")
    )
    return _split_rows(base, limit, overlap)


def _split_rows(base: DataFrame, limit: int, overlap: int) -> DataFrame:
    out = "chunk_id string, piece_index int, char_start int, char_end int, text string, _at int"

    def cut(batches):
        for b in batches:
            o = {k: [] for k in ("chunk_id", "piece_index", "char_start", "char_end", "text", "_at")}
            for cid, text, at in zip(b["chunk_id"], b["text"], b["_at"], strict=True):
                for i, (s, e) in enumerate(split_text(text, limit, overlap)):
                    for k, v in zip(o, (cid, i, s, e, text[s:e], at), strict=True):
                        o[k].append(v)
            yield o

    long = map_batches(base.where(F.length("text") > limit), cut, out)
    short = base.where(F.length("text") <= limit).select(
        "chunk_id",
        F.lit(0).alias("piece_index"),
        F.lit(0).alias("char_start"),
        F.length("text").alias("char_end"),
        "text",
        "_at",
    )
    return long.unionByName(short).select(
        "chunk_id",
        "piece_index",
        "char_start",
        "char_end",
        (F.col("_at") + F.col("char_start")).alias("doc_char_start"),
        (F.col("_at") + F.col("char_end")).alias("doc_char_end"),
        "text",
    )


def oversized(chunks: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """chunk_id of every chunk that the splitter cuts into more than one piece."""
    base = chunks.where(F.col("chunk_id").isNotNull()).select("chunk_id", "text", F.lit(None).cast("int").alias("_at"))
    return _split_rows(base, limit, overlap).where(F.col("piece_index") == 1).select("chunk_id").distinct()
