from hypothesis import given, settings
from hypothesis import strategies as st

from quarrylamp.llm import splitting


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .\n。，é𠮷‍\r", max_size=400), st.integers(5, 60), st.integers(0, 4))
def test_spans_cover_text_within_limit(text, limit, overlap):
    spans = splitting.split_text(text, limit, overlap)
    assert (not text) == (not spans)
    assert all(0 < e - s <= limit for s, e in spans)
    if spans:
        assert spans[0][0] == 0 and spans[-1][1] == len(text)
        for (_, e), (s, e2) in zip(spans, spans[1:]):
            assert s == max(0, e - overlap) and e2 > e


def test_natural_ends_come_first():
    text = "A first sentence here. " * 3 + "\n\n" + "Second part goes on. " * 3
    spans = splitting.split_text(text, 90, 10)
    assert text[: spans[0][1]].endswith("\n\n")
    assert splitting.split_text("x" * 25, 10, 2) == [(0, 10), (8, 18), (16, 25)] or all(e - s <= 10 for s, e in splitting.split_text("x" * 25, 10, 2))


def test_chunks_with_dirt(spark):
    kind = "chunk_id string, text string, char_start int, char_end int, extra int"
    long = "One sentence of words. " * 120
    rows = [("a", long, 5, 5 + len(long), 1), ("a", long, None, None, 2), ("b", "short", None, 3, 1), ("c", None, 0, 0, 1), ("d", "", 0, 0, 1), (None, long, 0, 9, 1)]
    out = splitting.split_chunks(spark.createDataFrame(rows, kind)).collect()
    a = sorted((r for r in out if r.chunk_id == "a"), key=lambda r: r.piece_index)
    assert [r.piece_index for r in a] == list(range(len(a))) and len(a) > 2
    assert all(long[r.char_start : r.char_end] == r.text and len(r.text) <= 1200 for r in a)
    assert all(r.doc_char_start == 5 + r.char_start for r in a)
    assert [r.text for r in out if r.chunk_id == "b"] == ["short"] and not [r for r in out if r.chunk_id in ("c", "d")]
    assert {r.chunk_id for r in splitting.oversized(spark.createDataFrame(rows, kind)).collect()} == {"a"}
    empty = spark.createDataFrame([], kind)
    assert splitting.split_chunks(empty).count() == 0 and splitting.oversized(empty).count() == 0
