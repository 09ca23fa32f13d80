from quarrylamp.llm import token_budget
from quarrylamp.llm.base import byte_bpe


def test_totals_against_brute_force(spark, make_records):
    enc = byte_bpe()
    recs = make_records([("r1", "alpha beta", "EN"), ("r1", "alpha beta", "EN"), ("r2", "alpha beta", "en-US"), ("r3", None, "en"), (None, "lost", "en"), ("r4", "汉字报文", " zh"), ("r5", "", "und")])
    recs = recs.withColumn("char_count", recs.char_count + 100)
    docs = spark.createDataFrame([(1, "alpha beta", "en", "src"), (2, None, "fr", None), (3, "été", "", "other")], "doc_id bigint, text string, lang string, source string")
    sources = spark.createDataFrame([("src", None), ("src", "dom"), (None, "x")], "source string, domain string")
    out = {(r.collection, r.source, r.lang): r for r in token_budget.token_budget(recs, docs, sources).collect()}
    n = len(enc.encode_ordinary("alpha beta"))
    en = out["records", "src", "en"]
    assert (en.n_docs, en.n_distinct_texts, en.domain) == (3, 1, "dom")
    rate = n / len("alpha beta")
    assert en.n_tokens == 2 * n + round(100 * rate) and en.n_estimated == 1 and en.n_tokens_distinct == n
    assert out["records", "src", "zh"].n_tokens == len(enc.encode_ordinary("汉字报文"))
    assert out["documents", "src", "en"].n_tokens == n and out["documents", "other", ""].domain == ""
    assert out["documents", "", "fr"].n_tokens == 0 and out["documents", "", "fr"].n_docs == 1
    empty = token_budget.token_budget(recs.limit(0), docs.limit(0), sources.limit(0))
    assert empty.count() == 0
