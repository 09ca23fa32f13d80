import pytest

from quarrylamp.llm import scan_noise as sn

CLEAN = "The collector stored every packet before the session table was rebuilt by the night shift. "


@pytest.fixture(scope="module")
def corpus(make_records):
    rows = [(f"c{i}", CLEAN * 3 + "计数器恢复，文档组时延正常，请备份规则。" * 2) for i in range(30)]
    bodies = ["The collector stored every\npacket before the session\ntable was rebuilt by the", "night shift. It stored the\ntable before it was\nrebuilt by the collector", "shift. Every session\nwas stored by night."]
    pages = "\n".join(f"Head Works | Plan\n{b}\nPage {k} of 9\n" for k, b in enumerate(bodies, 3))
    rows += [
        ("hy", "The collec-\ntor stored every packet."), ("hy2", "The sess\xad\nion table was rebuilt."), ("comp", "The second-\nline packet stored."),
        ("gl", "The co1lector st0red every packct."), ("cjk", "计数器恢复，文档纽吋延正常。"), ("pg", pages), ("wrap", "The collector stored\nevery packet before\nthe session."),
        ("tab", "packet;12\n55\ncollector;7\nsession;9"), ("seq", "packet one\n7\nsession two\nmore\n8\ntable\nrows here\n9"),
        ("null", None), ("blank", " "), (None, "c0llector"), ("gl", "The co1lector st0red every packct."),
    ]
    return make_records(rows)


def test_kinds(corpus):
    got = {}
    for r in sn.noise_kinds(corpus).collect():
        got.setdefault(r.id, set()).add(r.noise)
    assert got == {"hy": {"hyphen"}, "hy2": {"hyphen"}, "gl": {"glyph"}, "cjk": {"glyph"}, "pg": {"header", "pageno"}, "seq": {"pageno"}}


def test_repair(corpus):
    out = {r.id: r.text for r in sn.repaired(corpus).collect()}
    assert out["hy"] == "The collector stored every packet." and out["hy2"] == "The session table was rebuilt."
    assert out["comp"] == "The second- line packet stored." or "second-" in out["comp"]
    assert out["gl"] == "The collector stored every packet." and out["cjk"] == "计数器恢复，文档组时延正常。"
    assert out["wrap"] == "The collector stored every packet before the session."
    assert "Head Works" not in out["pg"] and "Page" not in out["pg"] and "rebuilt by the night shift. It stored" in out["pg"]
    assert out["tab"].count("\n") == 3 and out["null"] is None


def test_empty(corpus):
    assert sn.noise_kinds(corpus.limit(0)).count() == 0 and sn.repaired(corpus.limit(0)).count() == 0


def test_distance_and_index():
    assert sn.distance("co1lector", "collector") == pytest.approx(0.3)
    assert sn.distance("fragrnents", "fragments") == pytest.approx(0.3) and sn.distance("hbrary", "library") == pytest.approx(0.3)
    assert sn.distance("casual", "formal") > sn.MAX_DISTANCE
    for read, word in (("co1lector", "collector"), ("fragrnents", "fragments"), ("hbrary", "library"), ("слабьіе", "слабые")):
        assert sn.deletions(read) & sn.deletions(word)


def test_frequent_misreading_is_no_word(make_records):
    rows = [(f"c{i}", CLEAN * 3) for i in range(60)] + [(f"g{i}", "The collector stored every packct.") for i in range(sn.MIN_COUNT + 2)]
    df = make_records(rows)
    assert {(r.id, r.noise) for r in sn.noise_kinds(df).collect()} == {(f"g{i}", "glyph") for i in range(sn.MIN_COUNT + 2)}
    assert {r.text for r in sn.repaired(df).collect() if r.id[0] == "g"} == {"The collector stored every packet."}


def test_broken_compound_proves_nothing(make_records):
    rows = [(f"c{i}", CLEAN * 3) for i in range(30)] + [(f"k{i}", "The second-\nline packet stored.") for i in range(2 * sn.MIN_COUNT)]
    rows += [("u", "The second-line packet stored."), ("typo", "The secondline packet stored."), ("one", "The gateway stored."), ("hy", "The gate-\nway stored."), ("mis", "The co1lec-\ntor stored.")]
    df = make_records(rows)
    assert {(r.id, r.noise) for r in sn.noise_kinds(df).collect()} == {("hy", "hyphen"), ("mis", "hyphen"), ("mis", "glyph")}
    out = {r.id: r.text for r in sn.repaired(df).collect()}
    assert "second-" in out["k0"] and out["hy"] == "The gateway stored." and out["mis"] == "The collector stored."


def test_short_words_with_two_letter_confusions(make_records):
    for read, word in (("clie", "die"), ("tecl", "ted"), ("vvas", "was"), ("rnay", "may"), ("bom", "born"), ("clic", "die")):
        assert sn.distance(read, word) <= sn.MAX_DISTANCE and sn.deletions(read) & sn.keys(word)
    df = make_records([(f"c{i}", CLEAN * 3) for i in range(30)] + [("s", "The table vvas rebuilt.")])
    assert {(r.id, r.noise) for r in sn.noise_kinds(df).collect()} == {("s", "glyph")}
    assert {r.id: r.text for r in sn.repaired(df).collect()}["s"] == "The table was rebuilt."


def test_context_decides_at_each_place(make_records):
    rows = [(f"b{i}", "They set the bit now. ") for i in range(30)] + [(f"s{i}", "We ate the blt here. ") for i in range(30)]
    df = make_records(rows + [("x", "They set the b1t now. We ate her b1t here.")])
    assert {r.id: r.text for r in sn.repaired(df).collect()}["x"] == "They set the bit now. We ate her blt here."


def test_divided_and_misread(make_records):
    rows = [(f"c{i}", "The farm sent a letter to the collector today. ") for i in range(30)]
    df = make_records(rows + [("a", "The fa-\nrrn sent a let-\ntcr to us."), ("b", "The farm sent a well-\nknown letter.")])
    got = {(r.id, r.noise) for r in sn.noise_kinds(df).collect()}
    assert got == {("a", "hyphen"), ("a", "glyph")}
    out = {r.id: r.text for r in sn.repaired(df).collect()}
    assert out["a"] == "The farm sent a letter to us." and "well-" in out["b"]


def test_all_that_is_found_is_repaired(corpus):
    texts = {r.id: r.text for r in corpus.where("id is not null").collect()}
    out = {r.id: r.text for r in sn.repaired(corpus).collect()}
    found = {r.id for r in sn.noise_kinds(corpus).collect()}
    assert found and all(out[i] != texts[i] and out[i].split() != texts[i].split() for i in found)


def test_long_words():
    long = "a" * 60
    assert len(sn.deletions("x" + long)) == 3 and sn.distance("lettcr", "letter") == pytest.approx(0.3)
    assert sn.distance("吋", "时") == pytest.approx(0.3) and sn.distance("三", "五") > sn.MAX_DISTANCE
