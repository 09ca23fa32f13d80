import itertools
import random

import pytest

from quarrylamp.llm import near_duplicates as nd


def brute(rows):
    texts = {i: t for i, t in rows if i and t and len(t.split()) >= 60}
    sets = {i: set(nd.run_set(t).tolist()) for i, t in texts.items()}
    return {(a, b) for a, b in itertools.combinations(sorted(texts), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}


def rebuilt(df):
    """All pairs that the two tables stand for."""
    pairs, members = nd.class_pairs_and_members(df)
    of = {}
    for r in members.collect():
        of.setdefault(r.rep, set()).add(r.id)
    out = {tuple(sorted(p)) for ids in of.values() for p in itertools.combinations(ids, 2)}
    for r in pairs.collect():
        assert (r.n_a, r.n_b) == (len(of[r.rep_a]), len(of[r.rep_b]))
        out |= {tuple(sorted(p)) for p in itertools.product(of[r.rep_a], of[r.rep_b])}
    return out


def test_pairs_against_all_pairs(spark, make_records):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(150)]
        rows.append((f"a{g:02d}", " ".join(base)))
        for v in range(3):
            t = base[:]
            for _ in range(2 + 6 * v):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((f"b{g:02d}{v}", " ".join(t)))
    rows += [("c1", rows[0][1]), ("c2", rows[0][1]), ("c2", rows[0][1]), ("short", "too few words"), ("none", None), ("blank", "  "), (None, rows[0][1])]
    df = make_records(rows)
    want = brute(rows)
    assert {tuple(r) for r in nd.near_duplicate_pairs(df).collect()} == want == rebuilt(df)
    got = {r.id: r for r in nd.near_duplicate_members(df).collect()}
    assert got["c2"].class_id == got["b000"].group_id == "a00" and got["c2"].n_copies == 3 and "short" not in got
    assert {i: r.links for i, r in got.items()} == {i: sum(i in p for p in want) for i in got}
    empty = df.limit(0)
    assert nd.near_duplicate_pairs(empty).count() == 0 and nd.near_duplicate_members(empty).count() == 0


@pytest.mark.parametrize("n", [5, 16, 17, 200])
def test_copies(spark, make_records, monkeypatch, n):
    monkeypatch.setattr(nd, "POSTING", 32)  # large classes in several parts
    text = " ".join(f"t{i}" for i in range(80))
    rows = [(f"x{i:03d}", text) for i in range(n)] + [("y", text + " more words at the end"), ("z", "other " + text), ("z2", "other " + text)]
    df = make_records(rows)
    want = brute(rows)
    got = {tuple(r) for r in nd.near_duplicate_pairs(df).collect()}
    assert rebuilt(df) == want and got <= want
    between = {p for p in want if not (p[0][0] == p[1][0] == "x")}
    assert between <= got and (n > nd.EXPAND or got == want)
    assert len(got - between) == (n - 1 if n > nd.EXPAND else n * (n - 1) // 2)
    links = {r.id: r.links for r in nd.near_duplicate_members(df).collect()}
    assert links == {i: sum(i in p for p in want) for i, _ in rows}


def test_two_large_classes_stay_linked(make_records):
    text = " ".join(f"t{i}" for i in range(80))
    rows = [(f"x{i:02d}", text) for i in range(9)] + [(f"y{i:02d}", text + " and more") for i in range(7)]
    got = {tuple(r) for r in nd.near_duplicate_pairs(make_records(rows), expand=4).collect()}
    assert got == {("x00", f"x{i:02d}") for i in range(1, 9)} | {("y00", f"y{i:02d}") for i in range(1, 7)} | {(f"x{i:02d}", "y00") for i in range(9)} | {("x00", f"y{i:02d}") for i in range(7)}


def test_long_posting_lists_meet_in_parts(make_records, monkeypatch):
    monkeypatch.setattr(nd, "POSTING", 3)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = [(f"r{i:02d}", " ".join(w if rng.random() > 0.02 else f"v{rng.randrange(999)}" for w in base)) for i in range(25)]
    df = make_records(rows)
    assert {tuple(r) for r in nd.near_duplicate_pairs(df).collect()} == brute(rows)


def test_row_with_most_tokens_counts(make_records):
    text = " ".join(f"t{i}" for i in range(80))
    a, b = text + " one", "zero " + text
    rows = [("p", a), ("p", b), ("p", "cut"), ("q", a), ("r", b)]
    assert {tuple(r) for r in nd.near_duplicate_pairs(make_records(rows)).collect()} == {("p", "q"), ("p", "r"), ("q", "r")}


def test_groups_of_a_chain(spark):
    edges = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(40)] + [("z1", "z2")]
    out = {r.id: r.group_id for r in nd.components(spark.createDataFrame(edges, "id_a string, id_b string")).collect()}
    assert set(out.values()) == {"n000", "z1"} and out["n040"] == "n000"
