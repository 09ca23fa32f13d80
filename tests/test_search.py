import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarrylamp.operators import chunking, search

KIND = "chunk_id string, doc_id string, path string, lang string, text string, vector array<float>, score int, rank int"
DOCS = [
    ("hw", "The unit MX-2041 keeps flow tables."), ("domain", "See portal.acme.test and portal.acme.test for OPS."), ("zh1", "特征库 更新 完成"),
    ("acc", "Le réseau privé est fermé"), ("long", "flow " * 50), ("other", "nothing of the kind"),
]


@pytest.fixture(scope="module")
def chunks(spark):
    rng = np.random.default_rng(1)
    rows = [(f"{i}:0000", i, f"{'in' if k % 2 else 'out'}_a/{i}", "en", t, [float(x) for x in rng.standard_normal(8)], 1, 2) for k, (i, t) in enumerate(DOCS)]
    rows += [rows[0], ("nul:0000", "nul", None, None, None, None, 1, 2), ("zero:0000", "zero", "in_a/z", "en", "", [0.0] * 8, 1, 2), ("bad:0000", "bad", "in_a/b", "en", "x", [1.0], 1, 2)]
    return spark.createDataFrame(rows, KIND)


def ids(df, q="q"):
    return [r.doc_id for r in sorted(df.where(f"query_id = '{q}'").collect(), key=lambda r: r.rank)]


def test_identifiers_and_accents(chunks):
    assert ids(search.bm25(chunks, [search.Query("q", "MX-2041")], 5))[0] == "hw"
    assert ids(search.bm25(chunks, [search.Query("q", "portal.acme.test")], 5)) == ["domain"]
    assert ids(search.bm25(chunks, [search.Query("q", "RESEAU privé")], 5)) == ["acc"]
    assert {r.doc_id for r in search.phrase(chunks, "acme test").collect()} == {"domain"}
    assert search.bm25(chunks, [search.Query("q", "unseen")], 5).count() == 0 and search.bm25(chunks, [], 5).count() == 0


def test_bm25_by_formula(chunks):
    r = search.bm25(chunks, [search.Query("q", "flow")], 5).where("doc_id = 'long'").collect()[0]
    toks = {"hw": 7, "domain": 10, "zh1": 3, "acc": 5, "long": 50, "other": 4, "nul": 0, "zero": 0, "bad": 1}
    n, avg = len(toks), sum(toks.values()) / len(toks)
    want = np.log(1 + (n - 2 + 0.5) / 2.5) * 50 * 2.2 / (50 + 1.2 * (0.25 + 0.75 * 50 / avg))
    assert r.score == pytest.approx(want, abs=1e-6)


def test_where_is_literal_and_prefilters(chunks):
    assert search.where() is None
    hits = search.bm25(chunks, [search.Query("q", "flow unit")], 1, search.where(["out_"]))
    assert all(r.path.startswith("out_") for r in hits.collect()) and hits.count() == 1
    assert chunks.where(search.where(["in_a/", "out_a/"], "en", "length(text) > 30")).count() == chunks.where("length(text) > 30").count()
    assert chunks.where(search.where(["inXa/"])).count() == 0


def test_dense_and_dirt(chunks):
    v = chunks.where("doc_id = 'acc'").collect()[0].vector
    out = search.dense(chunks, [search.Query("q", "", tuple(v))], 3)
    assert ids(out)[0] == "acc" and out.count() == 3 and not {"zero", "bad", "nul"} & set(ids(out))
    assert search.dense(chunks.limit(0), [search.Query("q", "", tuple(v))], 3).count() == 0 and search.dense(chunks, [], 3).count() == 0


def test_modes(chunks):
    v = tuple(chunks.where("doc_id = 'acc'").collect()[0].vector)
    q = [search.Query("q", "flow", v)]
    hybrid = search.search(chunks, q).collect()
    assert {"acc", "long"} <= {r.doc_id for r in hybrid}
    assert search.search(chunks.drop("vector"), q, "fts").count() == 2
    with pytest.raises(ValueError):
        search.search(chunks, q, "magic")


def test_fusion(spark):
    legs = [("q", c, r) for leg in ("xyz", "yxw") for r, c in enumerate(leg)]
    out = {r.chunk_id: r.score for r in search.fuse(spark.createDataFrame(legs, "query_id string, chunk_id string, rank int")).collect()}
    assert out["x"] == out["y"] == pytest.approx(1 / 61 + 1 / 62, abs=1e-6) and out["z"] == out["w"] == pytest.approx(1 / 63, abs=1e-6)


def test_inverted_file_recall(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 16))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    dirt = [(900, None), (901, [0.0] * 16), (902, [1.0]), (None, rows[0][1]), rows[5]]
    df = spark.createDataFrame(rows + dirt, "vec_id int, embedding array<float>")
    qs = [search.Query(str(i), "", tuple(x[i])) for i in range(0, 600, 50)]
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = {q.query_id: set(np.argsort(-(u @ u[int(q.query_id)]))[:10]) for q in qs}
    for least, probes, recall in ((0, 0.5, 0.9), (50_000, 1, 1.0)):
        search.build_ivf(df, str(tmp_path / "i"), "vec_id", "embedding", least)
        out = search.ann(spark, str(tmp_path / "i"), qs, 10, probes, "vec_id").collect()
        assert len(out) == 10 * len(qs) and sum(r.vec_id in want[r.query_id] for r in out) >= recall * len(out)
    plan = search.ann(spark, str(tmp_path / "i"), qs[:1], 10, 1, "vec_id")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan
    assert search.ann(spark, str(tmp_path / "i"), [search.Query("t", "x")], 3, 1, "vec_id").count() == 0
    search.build_ivf(df.limit(0), str(tmp_path / "e"), "vec_id", "embedding")


def test_repeated_ids_hold_no_places(spark):
    rows = [("a", [1.0, 0.0])] * 30 + [("b", [0.9, 0.1]), ("c", [0.8, 0.2])]
    df = spark.createDataFrame([(k, k, "p", v) for k, v in rows], "chunk_id string, doc_id string, path string, vector array<float>").coalesce(1)
    assert ids(search.dense(df, [search.Query("q", "", (1.0, 0.0))], 3)) == ["a", "b", "c"]


def test_hash_encoder_by_hand(spark):
    import xxhash

    df = spark.createDataFrame([("a", "one two two"), ("b", "Two one two"), ("e", ""), ("n", None)], "chunk_id string, text string")
    out = {r.chunk_id: np.array(r.vector) for r in search.hash_encode(df, 32).collect()}
    v = np.zeros(32)
    for t in ("one", "two", "two"):
        h = xxhash.xxh64_intdigest(t.encode(), seed=42)
        h -= (h >> 63) << 64
        v[h % 32] += 1 if (h >> 40) & 1 else -1
    assert np.allclose(out["a"], v / np.linalg.norm(v), atol=1e-6) and np.allclose(out["a"], out["b"]) and not out["e"].any() and not out["n"].any()


def test_index_gives_what_the_scan_gives(spark, chunks, tmp_path):
    from quarrylamp.operators import index

    store = index.build(spark, str(tmp_path / "s"), chunks)
    rows = lambda df: sorted(tuple(r) for r in df.select("query_id", "chunk_id", "doc_id", "path", "score", "rank").collect())
    qs = [search.Query("a", "flow tables"), search.Query("b", "RESEAU privé"), search.Query("c", "unseen"), search.Query("d", "")]
    for condition in (None, search.where(["out_"], "en")):
        assert rows(search.bm25(store, qs, 5, condition)) == rows(search.bm25(chunks, qs, 5, condition))
    plan = store.postings(spark, ["flow"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"({index.term_bucket('flow')})" in plan.replace(" = ", " (").replace("IN ", "") or str(index.term_bucket("flow")) in plan
    assert search.search(store, qs, "fts").count() == search.search(chunks, qs, "fts").count()


PARAGRAPHS = "\n\n".join(f"Paragraph {i} has some words in it" for i in range(40))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab 汉\n𠮷", max_size=200), st.integers(2, 12), st.integers(0, 4))
def test_chunks_are_slices_in_order(text, target, overlap):
    spans = chunking.chunk_spans(text, target=target, most=target + 3, overlap=overlap)
    assert bool(spans) == bool(text.strip())
    assert all(0 <= s < e <= len(text) for s, e in spans) and [s for s, _ in spans] == sorted(s for s, _ in spans)
    kept = set()
    for s, e in spans:
        kept |= {i for i in range(s, e)}
    assert {i for i, c in enumerate(text) if not c.isspace()} <= kept


def test_chunker_rules():
    assert chunking.chunk_spans("") == [] and chunking.chunk_spans(" \n\n ") == []
    assert len(chunking.chunk_spans(PARAGRAPHS, target=20, most=30, overlap=5)) > 1
    spans = chunking.chunk_spans(PARAGRAPHS, target=16, most=24, overlap=8)
    assert any(b[0] < a[1] for a, b in zip(spans, spans[1:]))
    assert len(chunking.chunk_spans("word " * 200, target=40, most=50, overlap=10)) >= 4
    assert len(chunking.chunk_spans(PARAGRAPHS, target=10, most=15, overlap=3, max_chunks=3)) == 3
    lone = "a b c d\n\ne f g h"
    assert chunking.chunk_spans(lone, target=5, most=9, overlap=2) == [(0, 7), (0, 16)]
    assert chunking.chunk_spans(lone, target=5, most=9, overlap=2, strict_overlap=True) == [(0, 7), (9, 16)]


def test_chunk_documents_and_windows(spark):
    df = spark.createDataFrame([("a", PARAGRAPHS, 1), ("b", None, 1), ("c", " ", 1), (None, "x", 1), ("e", "one two", 1)], "id string, text string, chunk_index int")
    out = chunking.chunk_documents(df, target=20, most=30, overlap=5).collect()
    assert {r.id for r in out} == {"a", "e"} and all(PARAGRAPHS[r.char_start : r.char_end] == r.text for r in out if r.id == "a")
    w = chunking.fixed_windows(df, 4, 1).where("id = 'e'").collect()
    assert [r.tokens for r in w] == [["one", "two"]]


def gathered(text, target, most, overlap):
    """The chunker as its description says it, paragraph by paragraph."""
    tokens = lambda a, z: [m for m in chunking.stub_tokenizer(text[a:z])]
    paragraphs, at = [], 0
    for p in text.split("\n\n"):
        paragraphs.append((at, at + len(p)))
        at += len(p) + 2
    out, now = [], []
    for a, z in [p for p in paragraphs if tokens(*p)]:
        weigh = lambda ps: sum(len(tokens(*p)) for p in ps)
        size = weigh([(a, z)])
        if now and (size > most or weigh(now) + size > target):
            out.append((now[0][0], now[-1][1]))
            tail = next((now[k:] for k in range(len(now), -1, -1) if weigh(now[k:]) >= overlap), now)
            now = [] if size > most else tail[1:] if len(tail) == len(now) > 1 else tail
        if size <= most:
            now.append((a, z))
            continue
        step, spans = max(1, most - overlap), tokens(a, z)
        out += [(a + spans[k][0], a + spans[min(k + most, size) - 1][1]) for k in range(0, max(size - most, 0) + step, step)]
    return out + ([(now[0][0], now[-1][1])] if now else [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 14), max_size=9), st.integers(1, 12), st.integers(3, 12), st.integers(0, 6))
def test_chunks_as_described(sizes, target, most, overlap):
    text = "\n\n".join(" ".join("wv"[: 1 + k % 2] for k in range(n)) for n in sizes)
    assert chunking.chunk_spans(text, target=target, most=most, overlap=overlap) == gathered(text, target, most, overlap)
