import pytest

from quarrylamp.llm import mojibake

FR = "Le réseau d'accès à l'été — « délai dépassé », 40 °C"
ZH = "实验室要求丢包率高于67，前提是集成台部署完成。"
RU = "Служба поддержки измеряет отозванные сертификаты."


@pytest.mark.parametrize("legacy", ["cp1252", "latin-1", "cp437", "mac_roman", "cp850"])
def test_utf8_read_as_one_byte(legacy):
    chars = mojibake._byte_chars(legacy)
    for text in (FR, "naïve mode, €120 or 3×4", ZH):
        bad = "".join(chars[b] for b in text.encode())
        new, garbled, layers = mojibake.repair(bad)
        assert garbled and new == text and layers


def test_other_pages_and_layers():
    assert mojibake.repair(RU.encode().decode("cp1251", "replace"))[1]
    assert mojibake.repair(ZH.encode("gbk").decode("latin-1"))[0] == ZH
    assert mojibake.repair(RU.encode("cp1251").decode("latin-1"))[0] == RU
    assert mojibake.repair(RU.encode("koi8_r").decode("cp1251"))[0] == RU
    twice = FR
    for _ in range(2):
        chars = mojibake._byte_chars("cp1252")
        twice = "".join(chars[b] for b in twice.encode())
    new, _, layers = mojibake.repair(twice)
    assert new == FR and len(layers) == 2
    assert mojibake.repair(ZH.encode().decode("gbk", "replace"))[1]


@pytest.mark.parametrize(
    "text",
    [FR, ZH, RU, "SÃO TELMO: NÃO CONFORME", "Ðalvik – Ærøhus", "√2 ≈ 1.414, Δt ≤ 5", "ÎLOT Nº 7, ÉTÉ", "├── etc\n│   └── rules.d", "ありがとう、確認済みです。",
     "ＡＢＣ－１２３", "🟢 ok 🔴 down", "café réseau", "𠮷野机房 𡈽层", "ВНИМАНИЕ! Сервер СССР", None, "", "plain"],
)
def test_what_reads_as_intended_stays(text):
    assert mojibake.repair(text) == (text, False, [])


def test_partial_and_lost(spark):
    bad = "".join(mojibake._byte_chars("cp1252")[b] for b in "délai".encode())
    rows = [(1, f"good text\n\n{bad} here"), (2, "na�ve"), (3, FR), (4, None), (5, ""), (1, f"good text\n\n{bad} here"), (6, "x" * 100_000 + bad)]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id bigint, text string, layers string")
    out = {r.doc_id: r for r in mojibake.repair_documents(df).collect()}
    assert set(out) == {1, 2, 6} and out[1].text == "good text\n\ndélai here" and out[1].whole and not out[2].whole
    assert {r.doc_id for r in mojibake.garbled_ids(df).collect()} == {1, 2, 6}
    assert mojibake.garbled_ids(df.limit(0)).count() == 0


@pytest.mark.parametrize("page", ["cp866", "iso8859_5"])
@pytest.mark.parametrize("read", ["cp1252", "cp1251", "koi8_r"])
def test_dos_and_iso_cyrillic_pages(page, read):
    chars = mojibake._byte_chars(read)
    new, garbled, layers = mojibake.repair("".join(chars[b] for b in RU.encode(page)))
    assert garbled and new == RU and layers == [f"{page} as {read}"]


def test_signs_read_as_latin_1():
    assert mojibake.repair("it\x92s the \x93same\x94 \x96 once") == ("it’s the “same” – once", True, ["cp1252 as latin-1"])
    assert mojibake.repair("next\x85line")[1] is False


def test_private_use_alone_proves_nothing():
    assert mojibake.repair("press  to go on")[1] is False and mojibake.repair("录")[1] is True


def test_many_layers_and_long_texts_in_proportion():
    import time

    text = want = "Prüfgerät für Höchstwerte, déjà vérifié. "
    for _ in range(7):
        text = text.encode("utf-8").decode("latin-1")
    new, garbled, layers = mojibake.repair(text)
    assert new == want and garbled and len(layers) == 7
    part = "恥��亥砭頝舐�勗極雿�銵� v6.6.36\n"
    took = []
    for n in (200, 2000):
        t = time.process_time()
        mojibake.repair(part * n)
        took.append(time.process_time() - t)
    assert took[1] < 40 * took[0] + 0.5
