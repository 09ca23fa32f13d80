"""Chunking: fixed token windows as built-in expressions, and the greedy paragraph chunker."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

TARGET, MAX_TOKENS, OVERLAP = 800, 1000, 150
Tokenizer = Callable[[str], list[tuple[int, int]]]
_STUB = re.compile(r"[一-鿿]|[^\s一-鿿]+")


def stub_tokenizer(text: str) -> list[tuple[int, int]]:
    """Offsets of one token for each ideograph, else for each run without white space or ideographs."""
    return [m.span() for m in _STUB.finditer(text)]


def fixed_windows(docs: DataFrame, size: int, overlap: int, key: str = "id") -> DataFrame:
    """key, chunk_index, n_tokens, tokens: windows of `size` tokens that step by size - overlap (at least 1); the last
    one reaches the end. Documents without tokens give none."""
    step = max(1, size - overlap)
    t = docs.select(key, tx.stub_tokens("text").alias("_t")).where(F.size("_t") > 0)
    last = F.greatest(F.ceil((F.size("_t") - size) / F.lit(step)), F.lit(0)).cast("int")
    w = t.select(key, "_t", F.explode(F.sequence(F.lit(0), last)).alias("chunk_index"))
    cut = F.slice("_t", F.col("chunk_index") * step + 1, F.lit(size))
    return w.select(key, "chunk_index", cut.alias("tokens")).withColumn("n_tokens", F.size("tokens"))


def _windows(n: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Windows of `size` over n tokens that step by size - overlap, at least 1; the last one reaches the end."""
    step = max(1, size - overlap)
    return ((k * step, min(k * step + size, n)) for k in range(1 + max(0, -(-(n - size) // step))))


def _groups(sizes: list[int], target: int, overlap: int, strict: bool) -> Iterator[tuple[int, int]]:
    """Groups (first, after the last) of neighbouring paragraphs of these sizes, found on their running sums: each reaches
    as far as `target` allows, but beyond the one before it; the next begins where the last `overlap` tokens do."""
    total = [0, *accumulate(sizes)]
    first, least = 0, 1
    while least <= len(sizes):
        last = max(bisect_right(total, total[first] + target) - 1, least)
        yield first, last
        again = max(first, bisect_right(total, total[last] - overlap) - 1)
        # of several paragraphs not all are repeated; a lone one is, unless that is ruled out
        first = again + 1 if again == first and (strict or last - first > 1) else again
        least = last + 1


def chunk_spans(
    text: str, tokenize: Tokenizer = stub_tokenizer, target: int = TARGET, most: int = MAX_TOKENS, overlap: int = OVERLAP,
    max_chunks: int = 0, separator: str = "\n\n", strict_overlap: bool = False,
) -> list[tuple[int, int]]:
    """Spans of the chunks of a text.

    Paragraphs (between separators; blank ones and those without tokens are passed over) are gathered until the next
    one would exceed `target` tokens. A chunk hands its last paragraphs, as many as hold `overlap` tokens, on to the
    next: all of them if it has one only, all but its first if it would be the whole of several. A paragraph of more
    than `most` tokens is cut into windows of its own, which share `overlap` tokens and hand nothing on. With
    strict_overlap a lone paragraph isn't handed on, so no chunk outgrows the target by it. max_chunks 0 is no limit.
    """
    starts = accumulate((len(p) + len(separator) for p in text.split(separator)), initial=0)
    parts = [(at, at + len(p), tokenize(p)) for at, p in zip(starts, text.split(separator), strict=False) if p.strip()]
    spans: list[tuple[int, int]] = []
    for long, run in groupby((p for p in parts if p[2]), key=lambda p: len(p[2]) > most):
        some = list(run)
        if long:
            for at, _, tokens in some:
                spans += [(at + tokens[a][0], at + tokens[z - 1][1]) for a, z in _windows(len(tokens), most, overlap)]
        else:
            sizes = [len(tokens) for _, _, tokens in some]
            spans += [(some[a][0], some[z - 1][1]) for a, z in _groups(sizes, target, overlap, strict_overlap)]
    return spans[:max_chunks] if max_chunks else spans


def chunk_documents(docs: DataFrame, key: str = "id", carry: tuple[str, ...] = (), **options) -> DataFrame:
    """chunk_id, key, chunk_index, char_start, char_end, text and carried columns of every document. Each task cuts its
    own documents; null, empty and blank texts give no chunk."""
    field = {f.name: f.dataType.simpleString() for f in docs.schema}
    cols = [key, *carry]
    schema = "chunk_id string, chunk_index int, char_start int, char_end int, text string, " + ", ".join(f"{c} {field[c]}" for c in cols)

    def run(batches):
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(len(cols)).to_pylist()
            out: tuple[list, ...] = ([], [], [], [], [])
            rows: list[int] = []
            for r, (i, t) in enumerate(zip(ids, texts, strict=True)):
                for n, (s, e) in enumerate(chunk_spans(t or "", **options)):
                    for column, v in zip(out, (f"{i}:{n:04d}", n, s, e, t[s:e]), strict=True):
                        column.append(v)
                    rows.append(r)
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())
            idx = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, k) for c, k in zip(out, kinds, strict=True)), *(b.column(j).take(idx) for j in range(len(cols)))],
                names=["chunk_id", "chunk_index", "char_start", "char_end", "text", *cols],
            )

    return docs.where(F.col(key).isNotNull() & F.col("text").isNotNull()).select(*cols, "text").mapInArrow(run, schema)
