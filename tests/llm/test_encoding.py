import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarrylamp.llm import encoding
from quarrylamp.llm.base import byte_bpe


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab 1.,'\n汉字é𠮷 s", min_size=1, max_size=30), min_size=1, max_size=6))
def test_any_cut_is_repaired(parts):
    enc = byte_bpe()
    ids = [np.asarray(enc.encode_ordinary(p), np.uint16) for p in parts]
    got = encoding.join_ids(ids, [False] * len(parts), enc)
    assert got.tolist() == enc.encode_ordinary("".join(parts))


def test_chunks_are_content_defined():
    import random

    rng = random.Random(3)
    words = ["flow", "packet", "特征库", "latency", "报文", "Zentrik-4", "über"]
    body = " ".join(rng.choice(words) + rng.choice(",. ") for _ in range(9000))
    ends = encoding.chunk_ends(body)
    assert ends[-1][0] == len(body) and len(ends) > 5
    moved = encoding.chunk_ends("a new beginning. " + body)
    a = {body[s:e] for (s, _), (e, _) in zip([(0, True), *ends], ends)}
    shifted = "a new beginning. " + body
    b = {shifted[s:e] for (s, _), (e, _) in zip([(0, True), *moved], moved)}
    assert len(a & b) >= len(a) - 2


def test_long_stretch_without_boundary():
    text = "".join(chr(0x4E00 + i * 7 % 5000) for i in range(40_000))
    ends = encoding.chunk_ends(text)
    assert len(ends) > 3
    enc = byte_bpe()
    at, parts = 0, []
    for e, _ in ends:
        parts.append(np.asarray(enc.encode_ordinary(text[at:e]), np.uint16))
        at = e
    assert encoding.join_ids(parts, [s for _, s in ends], enc).tolist() == enc.encode_ordinary(text)


def test_corpus_with_dirt(spark):
    hot = "the same notice everywhere"
    rows = [(i, hot if i % 3 else f"text {i} " * (i * 40), "x") for i in range(200)]
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, " \r\n ", "x"), (5, rows[5][1], "x"), (1003, "<|endoftext|> literally 汉字 𠮷", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    out = {r.doc_id: list(r.ids) for r in encoding.encode_corpus(df).collect()}
    enc = byte_bpe()
    assert len(out) == len({r[0] for r in rows}) == encoding.encode_corpus(df).count()
    for i, t, _ in rows:
        assert out[i] == (enc.encode_ordinary(t) if t else [])
    assert encoding.encode_corpus(df.limit(0)).count() == 0


def test_hot_chunk_is_dealt_over_tasks_and_encoded_once_in_each(spark):
    hot = "the same words again and again. " * 10
    docs = spark.range(0, 800, 1, 8).selectExpr("id AS doc_id", f"'{hot}' AS text")
    rows = encoding._chunk_rows(docs)
    assert rows.select("salt").distinct().count() == 8 and rows.count() == 8
    wide = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "512"}
    old = {k: spark.conf.get(k) for k in wide}
    try:
        for k, v in wide.items():
            spark.conf.set(k, v)
        out = encoding._encoded(rows, None).where("fresh").select(F.spark_partition_id().alias("p")).collect()
        assert len({r.p for r in out}) == len(out) == 8
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    few = spark.range(0, 40, 1, 8).selectExpr("id AS doc_id", f"'{hot}' AS text")
    out = encoding._encoded(encoding._chunk_rows(few), None)
    assert out.where("fresh").count() == 1 and out.count() == 40
    ids = encoding.encode_corpus(few).collect()
    assert len(ids) == 40 and len({tuple(r.ids) for r in ids}) == 1
