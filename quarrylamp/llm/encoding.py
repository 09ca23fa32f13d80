"""Problem 8: encoding a whole corpus with a public tokenizer.

Method: content-defined chunk reuse. A rolling hash over the characters picks chunk ends, so equal passages of
different documents give equal chunks; each distinct chunk is encoded once, and where two chunks meet the join is
repaired by re-encoding from the last sure token boundary before it to the first one after it, until the ids agree
with those of the joined text.

A sure boundary lies between a letter and a following blank or punctuation mark: no match of the pre-token pattern
holds both. Chunk ends are picked there first; only a long stretch without one is cut elsewhere, and only such joins
need repair.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .base import byte_bpe, map_batches

#: Mean number of sure boundaries in a chunk, length from which any place may end a chunk, and the mean length then.
SPREAD, FORCE_AFTER, FORCE_SPREAD = 160, 8192, 1024
#: Occurrences of a chunk within one batch from which it is frequent; tasks that its rows are dealt over.
HOT, SALT = 8, 64

_WINDOW = 16
_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Marks after which no token goes on when a letter comes before them (fixed value).
_MARKS = np.array(sorted(map(ord, " \n\r\t.,;:!?()[]|/。，；：、（）！？“”")), dtype=np.uint32)
_powers = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, n of each."""
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n, 1 << 16), _MULT, np.uint64))])
    inv = pow(int(_MULT), -1, 1 << 64)
    back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(max(n - 1, 0), np.uint64(inv), np.uint64))])
    return _powers[:n], back[:n]


def _rolling(points: np.ndarray) -> np.ndarray:
    """For each place p, a hash of the _WINDOW code points before p (fewer at the beginning)."""
    n = len(points)
    up, down = _inverse_powers(n + 1)
    with np.errstate(over="ignore"):
        mixed = (points.astype(np.uint64) + np.uint64(0x2545F491)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed * up[:n])])
        low = np.maximum(np.arange(n + 1) - _WINDOW, 0)
        h = (total - total[low]) * down[low] * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def _sure(points: np.ndarray) -> np.ndarray:
    """True at place p (0..n) where a letter comes before p and a blank or mark follows."""
    letter = (
        ((points >= 97) & (points <= 122))
        | ((points >= 65) & (points <= 90))
        | ((points >= 0x4E00) & (points <= 0x9FA5))
        | ((points >= 0x410) & (points <= 0x44F))
    )
    out = np.zeros(len(points) + 1, bool)
    out[1:-1] = letter[:-1] & np.isin(points[1:], _MARKS)
    return out


def chunk_ends(text: str) -> list[tuple[int, bool]]:
    """Ends of the chunks of `text`, each with whether the join after it is sure."""
    n = len(text)
    if n <= FORCE_AFTER // 16:
        return [(n, True)]
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    h, sure = _rolling(points), _sure(points)
    ends, at = [], 0
    for e in [*np.flatnonzero(sure & (h % np.uint64(SPREAD) == 0)).tolist(), n]:
        if e - at > FORCE_AFTER:
            forced = np.flatnonzero(h[at + 1 : e] % np.uint64(FORCE_SPREAD) == 7) + at + 1
            ends += [(p, bool(sure[p])) for p in forced.tolist()]
        if e > at and (not ends or e > ends[-1][0]):
            ends.append((e, True))
        at = e
    return ends


def join_ids(parts: list[np.ndarray], sure: list[bool], encoding) -> np.ndarray:
    """Ids of the joined text from those of its chunks; sure[i] tells that the join after chunk i needs no repair.

    A repair re-encodes from the last sure boundary of the left chunk to the first of the right one; where the right
    chunk has none, the stretch goes on into the next chunk.
    """
    out: list[np.ndarray] = []
    left = parts[0]
    for i in range(1, len(parts)):
        if sure[i - 1]:
            out.append(left)
            left = parts[i]
            continue
        a, b = encoding.decode(left.tolist()), encoding.decode(parts[i].tolist())
        ka = np.flatnonzero(_sure(_points(a)))
        kb = np.flatnonzero(_sure(_points(b)))
        ca = int(ka[-1]) if len(ka) else 0
        cb = int(kb[0]) if len(kb) else len(b)
        keep = len(left) - len(encoding.encode_ordinary(a[ca:]))
        skip = len(encoding.encode_ordinary(b[:cb]))
        middle = np.asarray(encoding.encode_ordinary(a[ca:] + b[:cb]), np.uint16)
        out.append(left[:keep])
        left = np.concatenate([middle, parts[i][skip:]])
    return np.concatenate([*out, left])


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


_REFS = "refs array<struct<doc_id:bigint,key:int,seq:int,of:int,sure:boolean>>"


def _chunk_rows(docs: DataFrame) -> DataFrame:
    """h, salt, chunk, refs: each distinct chunk of a batch with the places it stands at. Those of a frequent chunk are
    dealt over SALT tasks by the partition that they come from."""

    def cut(batches):
        from pyspark import TaskContext

        partition = TaskContext.get().partitionId()
        for b in batches:
            refs, order = defaultdict(list), []
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                at, ends = 0, chunk_ends(text)
                key = zlib.crc32(text.encode()) & 0x7FFFFFFF
                for i, (e, sure) in enumerate(ends):
                    part = text[at:e]
                    if part not in refs:
                        order.append(part)
                    refs[part].append((doc, key, i, len(ends), sure))
                    at = e
            o = {k: [] for k in ("salt", "chunk", "refs")}
            for part in order:
                r = refs[part]
                o["salt"].append(partition % SALT if len(r) >= HOT else 0)
                o["chunk"].append(part)
                o["refs"].append([dict(zip(("doc_id", "key", "seq", "of", "sure"), x, strict=True)) for x in r])
            yield o

    chunks = map_batches(spread(docs), cut, f"salt int, chunk string, {_REFS}")
    return chunks.select(F.xxhash64("chunk").alias("h"), "salt", "chunk", "refs")


def _encoded(chunks: DataFrame, tokenizer: str | None) -> DataFrame:
    """doc_id, key, seq, of, sure, bytes (ids, two bytes each), fresh (whether the chunk was encoded for this row): equal
    chunks of one salt meet in one task, next to each other, where the first is encoded and the others take its ids."""
    met = chunks.repartition("h", "salt").sortWithinPartitions("h", "chunk")

    def encode(batches):
        enc = byte_bpe(tokenizer)
        last, ids = None, b""
        for b in batches:
            o = {k: [] for k in ("doc_id", "key", "seq", "of", "sure", "bytes", "fresh")}
            for chunk, rs in zip(b["chunk"], b["refs"], strict=True):
                fresh = chunk != last
                if fresh:
                    last, ids = chunk, np.asarray(enc.encode_ordinary(chunk), np.uint16).tobytes()
                for r in rs:
                    for k in ("doc_id", "key", "seq", "of", "sure"):
                        o[k].append(r[k])
                    o["bytes"].append(ids)
                    o["fresh"].append(fresh)
                    fresh = False
            yield o

    return map_batches(met.select("chunk", "refs"), encode, "doc_id bigint, key int, seq int, of int, sure boolean, bytes binary, fresh boolean")


def encode_corpus(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Token ids of every document's text by byte_bpe_50k, without special tokens: doc_id, ids.

    Null and empty texts give an empty list; blank texts are encoded as they are; a null doc_id with text is kept as
    a row of its own. Repeated rows of a doc_id give one row each distinct text. Other columns are ignored.

    Two shuffles: chunks by their hash (equal ones meet in one task, where each is encoded once) and ids, two bytes
    each, back by document. A chunk that comes HOT times or more within a batch is dealt over SALT tasks by the partition
    it comes from, so it is encoded at most SALT times and no task gets all of its rows.
    """
    docs = documents.select("doc_id", "text")
    filled = F.length("text") > 0
    empty = docs.where(F.coalesce(~filled, F.lit(True))).select(
        "doc_id", F.array().cast("array<int>").alias("ids")
    ).distinct()
    parts = _encoded(_chunk_rows(docs.where(filled)), tokenizer).drop("fresh")
    parts = parts.repartition("doc_id", "key").sortWithinPartitions("doc_id", "key", "seq")

    def assemble(batches):
        import pyarrow as pa

        enc = byte_bpe(tokenizer)
        held: list[tuple[np.ndarray, bool]] = []
        last = None
        fields = ("doc_id", "key", "seq", "of", "sure", "bytes")
        for b in batches:
            docs, flat, sizes = [], [], []
            for doc, key, seq, of, sure, raw in zip(*(b[k] for k in fields), strict=True):
                if (doc, key, seq) == last:
                    continue  # the same row again
                held.append((np.frombuffer(raw, np.uint16), sure))
                last = (doc, key, seq)
                if len(held) == of:
                    ids = held[0][0] if of == 1 else join_ids([x for x, _ in held], [s for _, s in held], enc)
                    docs.append(doc)
                    flat.append(ids)
                    sizes.append(len(ids))
                    held = []
            values = np.concatenate(flat).astype(np.int32) if flat else np.empty(0, np.int32)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield {
                "doc_id": docs,
                "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)).cast(pa.list_(pa.field("element", pa.int32(), True))),
            }

    return map_batches(parts, assemble, "doc_id bigint, ids array<int>").unionByName(empty)
