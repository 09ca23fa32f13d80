import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarrylamp.llm import personal

CASES = [
    ("Write to ada.low+x@mail.example.org for access.", {("email", "ada.low+x@mail.example.org")}),
    ("Mail: ada [at] mail [dot] example [dot] org now", {("email", "ada [at] mail [dot] example [dot] org")}),
    ("Escribir a talvi35＠halvorn.example hoy.", {("email", "talvi35＠halvorn.example")}),
    ("手机１５４-０６２９-６２８１，周末勿扰。", {("phone", "１５４-０６２９-６２８１")}),
    ("Call +44 7700 900969 after nine.", {("phone", "+44 7700 900969")}),
    ("Dial oh two oh seven nine four six oh three nine nine now", set()),
    ("Тел. +7 (000) 461-38-67.", {("phone", "+7 (000) 461-38-67")}),
    ("身份证号：99114019710311523X。", {("idnum", "99114019710311523X")}),
    ("Pièce d'identité QQ 65 77 81 C.", {("idnum", "QQ 65 77 81 C")}),
    ("National number 666-61-1317 appears.", {("idnum", "666-61-1317")}),
    ("The visitor lives at Flat 9, 12 Old\nAvenue, Linsdorf ZZ9 4QX and asked.", {("address", "Flat 9, 12 Old Avenue, Linsdorf ZZ9 4QX")}),
    ("Livrer au 79 bis avenue Harrowgate, 00210 Cobrizal.", {("address", "79 bis avenue Harrowgate, 00210 Cobrizal")}),
    ("Anschrift: Kilnweg 142a, 00741 Cobrizal.", {("address", "Kilnweg 142a, 00741 Cobrizal")}),
    ("Адрес: ул. Заречная, д. 74, кв. 75, г. Верхнеполье.", {("address", "ул. Заречная, д. 74, кв. 75, г. Верхнеполье")}),
    ("收货地址：云岭市石渡区青桥大道44弄15号244室。", {("address", "云岭市石渡区青桥大道44弄15号244室")}),
    ("According to Dr. B. Hollowick the result stands.", {("person", "B. Hollowick")}),
    ("Contact: Fennimarsh, Wilka.", {("person", "Fennimarsh, Wilka")}),
    ("Составитель — Дубравинский Т.", {("person", "Дубравинский Т.")}),
    ("訾望霁（项目经理）已签收。", {("person", "訾望霁")}),
    ("Brida Quillsbury\n532 49 02 88", {("person", "Brida Quillsbury"), ("phone", "532 49 02 88")}),
    ("Millrace Road firmware is the branch name for Yarrow-675.", set()),
    ("Package core@4.10.10 was pinned. Notify @oncall when 203.0.113.165:9538 flaps.", set()),
    ("Order 20248085419 is closed. Serial no. 749419008806547166 was scanned. Batch 555-7907-7907 passed.", set()),
]


@pytest.mark.parametrize(("text", "want"), CASES)
def test_items(text, want):
    assert {(k, personal.value_of(text, s, e, k)) for s, e, k in personal.find(text)} == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([c[0] for c in CASES] + ["plain words ", "汉字\n", "𠮷", "\n\n"]), max_size=6))
def test_rest_of_the_text_is_unchanged(parts):
    text = " ".join(parts)
    spans = personal.find(text)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    kept = "".join(text[a:b] for a, b in zip([0, *[e for _, e, _ in spans]], [*[s for s, _, _ in spans], len(text)]))
    new = personal.redact(text)
    for kind in personal.KINDS:
        new = new.replace(f"[{kind.upper()}]", "")
    assert new == kept


def test_spelled_digits_map_back():
    text = "ring zero five five five oh one two three four five today"
    new, places = personal.plain(text)
    assert "05550123" in new and text[places[new.index("0555")] :].startswith("zero")


def test_records_with_dirt(spark, make_records):
    rows = [("a", CASES[0][0]), ("a", CASES[0][0]), ("a", " "), ("b", None), ("c", ""), (None, CASES[0][0]), ("d", "x" * 50_000 + " " + CASES[4][0])]
    df = make_records(rows)
    assert {tuple(r) for r in personal.found_items(df).collect()} == {("a", "email", "ada.low+x@mail.example.org"), ("d", "phone", "+44 7700 900969")}
    out = {r.id: (r.text, r.n_items) for r in personal.redacted(df).collect()}
    assert out["a"] == ("Write to [EMAIL] for access.", 1) and out["b"] == (None, 0) and out["c"] == ("", 0)
    assert personal.found_items(df.limit(0)).count() == 0


def found(text, names=personal.Names()):
    return {(k, personal.value_of(text, s, e, k)) for s, e, k in personal.find(text, names)}


@pytest.mark.parametrize(
    "text",
    ["Call siete uno dos tres cuatro cinco seis siete now", "Ruf null eins fünf eins zwei drei vier fünf sechs sieben acht an", "appelez zéro six un deux trois quatre cinq six sept huit",
     "Звоните восемь девять один два три четыре пять шесть семь восемь девять", "请拨打一三九一二三四五六七八"],
)
def test_spelled_digits_become_digits(text):
    new, places = personal.plain(text)
    assert sum(c.isdigit() for c in new) >= 8 and len(places) == len(new) + 1


def test_spelled_phone_is_found_where_it_stands():
    text = "请拨打一三九一二三四五六七八。"
    assert personal.redact(text) == "请拨打[PHONE]。"
    assert personal.redact("one or two or three, four five") == "one or two or three, four five"


def test_numbers_inside_longer_ones_and_check_digits():
    assert not found("card 6222 0212 3456 7890 123")
    good = "11010519491231002X"
    assert found(f"ID {good}.") == {("idnum", good)} and not found("ID 110105194912310021.")


def test_initial_and_name_at_host():
    assert found("write to j.doe at example.com today") == {("email", "j.doe at example.com")}
    assert not found("look at example.com and config.yaml at host.example.com")


HELD_OUT = [
    ("Mr John Brown wrote this", "John Brown"), ("Please call Maria Lopez tomorrow", "Maria Lopez"), ("The author is Jane Smith", "Jane Smith"), ("Herr Klaus Becker hat angerufen", "Klaus Becker"),
    ("王小明先生昨天来了", "王小明"), ("Мы говорили с г-н Иванов А. П. вчера", "Иванов А. П."), ("Ask Zorvan Quillbeck about it", "Zorvan Quillbeck"), ("Quillbeck met Zorvan T. Marrowin there", "Zorvan T. Marrowin"),
    ("昨天訾望霁来了", "訾望霁"), ("said Mirela Quillbeck-Marrowin, twice", "Mirela Quillbeck-Marrowin"), ("nous avons vu Sophie Dubois hier", "Sophie Dubois"),
]


def test_names_in_wordings_not_seen(spark, make_records):
    seeds = ["Contact: Zorvan Quillbeck.", "Prepared by Mirela Marrowin.", "Signed by Mirela Marrowin.", "Contact: Zorvan Marrowin.", "Reviewed by Mirela Quillbeck.", "联系人：訾望霁。", "编写：訾望霁，", "The Station Report was sent. Second Report."]
    names = personal.learn_names(make_records([(f"s{i}", t) for i, t in enumerate(seeds)]))
    assert {"Zorvan", "Quillbeck", "Mirela", "Marrowin"} == names.words and names.first == {"訾"}
    hit = sum(("person", want) in found(text, names) for text, want in HELD_OUT)
    assert hit / len(HELD_OUT) >= 0.9
    for text in ("The Station Report was sent", "San Jose Street is closed", "John Street and Victoria Station", "Zorvan is a town", "訾为姓"):
        assert not {k for k, _ in found(text, names)} & {"person"}
    assert personal.learn_names(make_records([])) == personal.Names()


def _many_names(n=400):
    import itertools

    given = ["".join(p).capitalize() + "wyn" for p in itertools.product(("ba", "ke", "lo", "mu", "zi", "ro"), repeat=4)]
    last = ["".join(p).capitalize() + "mont" for p in itertools.product(("da", "fe", "go", "nu", "ti", "wo"), repeat=4)]
    rows = []
    for i in range(n):
        name = f"{given[i]} {last[i]}"
        rows += [(f"s{i}", f"Contact: {name}."), (f"t{i}", f"Prepared by {name}."), (f"u{i}", f"we saw {name} there")]
    return rows + [(f"x{i}", "nothing to be seen here") for i in range(8000)], [f"{g} {f}" for g, f in zip(given[:n], last, strict=False)]


def test_names_are_learned_from_every_record(spark, make_records, monkeypatch):
    from quarrylamp.llm import base

    rows, names = _many_names()
    out = {(r.id, r.value) for r in personal.found_items(make_records(rows)).where("id like 'u%'").collect()}
    assert out == {(f"u{i}", name) for i, name in enumerate(names)}
    monkeypatch.setattr(base, "SMALL", 0)  # parts meet the places by a shuffle
    texts = {r.id: r.text for r in personal.redacted(make_records(rows)).where("id like 'u%'").collect()}
    assert set(texts.values()) == {"we saw [PERSON] there"} and len(texts) == len(names)


def test_tables_find_what_single_texts_give(make_records, monkeypatch):
    monkeypatch.setattr(personal, "COUNTED", 3)  # parts handed on between batches
    seeds = ["Contact: Zorvan Quillbeck.", "Prepared by Mirela Marrowin.", "Signed by Mirela Marrowin.", "Contact: Zorvan Marrowin.", "Reviewed by Mirela Quillbeck.", "联系人：訾望霁。", "编写：訾望霁，"]
    texts = 4 * seeds + [t for t, _ in HELD_OUT] + [t for t, _ in CASES] + ["昨天訾望\n霁来了，ｔel", "met Zorvan Quillbeck Marrowin and Mirela\nMarrowin-Quillbeck, ada [at] mail [dot] example [dot] org"]
    rows = [(f"r{i}", t) for i, t in enumerate(texts)] + [("r0", texts[0]), ("r1", "Ask Zorvan Quillbeck about it"), (None, seeds[0]), ("n", None)]
    df = make_records(rows)
    names = personal.learn_names(df)
    assert {"Zorvan", "Mirela"} <= names.words and names.first == {"訾"}
    want = {(i, k, personal.value_of(t, s, e, k)) for i, t in rows if i and t for s, e, k in personal.find(t, names)}
    assert {tuple(r) for r in personal.found_items(df).collect()} == want
    for r in personal.redacted(df).collect():
        kept = [t for i, t in rows if i == r.id]
        assert (r.text, r.n_items) in {(personal.redact(t, names), len(personal.find(t, names))) for t in kept}


def test_words_after_names_are_no_part_of_them(make_records):
    rows = [(f"a{i}", f"编写：訾望霁。联系方式见下。编号{i}。") for i in range(300)] + [(f"b{i}", "编写：訾望联系电话。") for i in range(2)]
    names = personal.learn_names(make_records(rows))
    assert names.first == {"訾"} and names.further == {"望", "霁"}
