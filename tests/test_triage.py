import pytest

from quarrylamp.operators import triage

TOPIC = triage.Topic("t", ("特征库",), ("packet parser", "flow"), ("latency", "flow"))
KIND = "id string, path string, ext string, lang string, char_count bigint, text string, score int"


def rows(spark, *texts, path="a/x.txt"):
    return spark.createDataFrame([(f"d{i}", path, ".txt", "en", None, t, 1) for i, t in enumerate(texts)], KIND)


def test_score_caps_bonus_and_penalty(spark):
    df = rows(spark, "latency " * 9, "Packet  parser, packet parser; 特征库", None, "", "nothing")
    out = {r.id: r for r in triage.score(df, TOPIC).collect()}
    assert set(out) == {"d0", "d1"}
    assert (out["d0"].raw_score, out["d0"].score, out["d0"].high_hits) == (5, 10.0, 0)
    assert (out["d1"].raw_score, out["d1"].n_unique_terms, out["d1"].score) == (13, 2, 13 + 13 + 10.0)
    sheet = {r.id: r for r in triage.score(rows(spark, "latency " * 99, path="a/x.csv"), TOPIC).collect()}
    assert sheet["d0"].score == 2.5


def test_term_in_two_tiers_scores_twice_and_counts_once(spark):
    r = triage.score(rows(spark, "flow"), TOPIC).collect()[0]
    assert r.raw_score == 4 and r.n_unique_terms == 1


def test_rank_ties_hits_and_empty(spark):
    df = rows(spark, "latency latency 特征库", "latency latency 特征库", "flow flow latency")
    out = triage.rank(df, TOPIC, top=2).collect()
    assert [r.id for r in out] == ["d0", "d1"] and out[0].hits == "latency×2, 特征库×1" and out[0].snippet.startswith("[特征库] ")
    assert triage.rank(df.limit(0), TOPIC).count() == 0 and triage.rank(df, triage.Topic("none")).count() == 0


def test_monotone_below_cap(spark):
    out = {r.id: r.score for r in triage.score(rows(spark, *["packet parser " * n for n in range(1, 6)]), TOPIC).collect()}
    assert [out[f"d{i}"] for i in range(5)] == sorted(out.values())


def test_tiers(spark):
    data = [("study/计划.pdf", 0), ("study/attachments/12_attachments_Paper 计划.pdf", 0), ("other/计划.pdf", 0), ("other/x", 2), ("STUDY/计划", None), (None, 0)]
    df = spark.createDataFrame(data, "path string, high_hits int")
    got = [r.tier for r in triage.classify(df, "study/", r"attachments/\d+_attachments_[A-Z]").collect()]
    assert got == ["tier1", "tier2", "tier2", "tier1", "tier1", "tier2"]


def test_topic_file(tmp_path):
    f = tmp_path / "t.yaml"
    f.write_text("topic: probe\nhigh_signal: [特征库, 912]\nlow_signal: []\n", encoding="utf-8")
    t = triage.Topic.load(f)
    assert t.terms() == [("high", "特征库"), ("high", "912")]
    with pytest.raises(FileNotFoundError):
        triage.Topic.load(tmp_path / "no.yaml")


def test_long_term_lists_are_counted_in_blocks(spark):
    words = [f"w{i:03d}" for i in range(300)]
    topic = triage.Topic("long", high=tuple(words[:100]), medium=tuple(words[100:200]), low=tuple(words[200:]))
    text = " ".join(words[i] for i in (0, 0, 150, 250, 250, 299))
    df = spark.createDataFrame([("a", "p/a", ".txt", "en", 1, text), ("b", "p/b", ".txt", "en", 1, None)], "id string, path string, ext string, lang string, char_count bigint, text string")
    r = triage.score(df, topic).collect()
    assert len(r) == 1 and r[0].raw_score == 2 * 10 + 3 + 3 and r[0].n_unique_terms == 4 and [(h.term, h.n) for h in r[0].hits] == [("w000", 2), ("w150", 1), ("w250", 2), ("w299", 1)]
