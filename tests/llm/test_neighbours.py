import numpy as np

from quarrylamp.llm import neighbours


def _table(spark, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((1500, 128)).astype("f4")
    x[:60] = x[100:160] + 0.3 * rng.standard_normal((60, 128))
    rows = [(f"c{i:04d}", [float(v) for v in x[i] * (1 + i % 3)], 1) for i in range(len(x))]
    dirt = [("null", None, 1), ("short", [1.0] * 64, 1), ("zero", [0.0] * 128, 1), ("nan", [float("nan")] * 128, 1), (None, rows[0][1], 1), rows[3]]
    dirt += [("d1", rows[7][1], 1), ("d2", [2 * v for v in rows[7][1]], 1)]
    return x, spark.createDataFrame(rows + dirt, "chunk_id string, vector array<float>, leaf int")


def test_threshold_pairs_and_copies(spark):
    x, df = _table(spark)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T
    want = {(f"c{i:04d}", f"c{j:04d}") for i, j in zip(*np.nonzero(s >= 0.8), strict=True) if i != j}
    out = neighbours.similar_pairs(df, min_similarity=0.8, leaf=128, visits=8).collect()
    got = {(r.id, r.neighbour) for r in out}
    copies = {(a, b) for a, b in got if "d1" in (a, b) or "d2" in (a, b)}
    assert len(got - copies - want) == 0 and len(want - got) <= 0.02 * len(want)
    assert copies == {("d1", "c0007"), ("c0007", "d1"), ("d2", "c0007"), ("c0007", "d2")}
    assert not {"null", "short", "zero", "nan"} & {a for a, _ in got}
    assert neighbours.similar_pairs(df.limit(0), min_similarity=0.8).count() == 0


def test_recall_of_nearest_against_brute_force(spark):
    x, df = _table(spark)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    ask = [f"c{i:04d}" for i in range(0, 1500, 50)]
    q = spark.createDataFrame([(i,) for i in ask], "id string")
    out = neighbours.similar_pairs(df, k=10, queries=q, leaf=128, visits=0.4).collect()
    hit = 0
    for i in range(0, 1500, 50):
        s = u[i] @ u.T
        s[i] = -2
        best = {f"c{j:04d}" for j in np.argsort(-s)[:10]}
        hit += len(best & {r.neighbour for r in out if r.id == f"c{i:04d}"})
    assert hit / (10 * len(ask)) >= 0.9


def test_search_order_is_that_of_a_shared_queue():
    import heapq

    rng = np.random.default_rng(2)
    x = rng.standard_normal((200, 16)).astype("f4")
    normals, offsets = neighbours.fit_forest(x, 4, 3)
    x = rng.standard_normal((20, 16)).astype("f4")
    own, visited = neighbours.search_leaves(x, normals, offsets, 4, 3, 5)
    for r in range(20):
        heap, seen = [(-np.inf, t, 0, 0) for t in range(3)], []
        while len(seen) < 8:
            p, t, level, node = heapq.heappop(heap)
            if level == 4:
                seen.append(t * 16 + node - 15)
                continue
            m = float(x[r] @ normals[t * 15 + node] - offsets[t * 15 + node])
            for child, sign in ((2 * node + 1, -1), (2 * node + 2, 1)):
                heapq.heappush(heap, (max(p, -sign * m), t, level + 1, child))
        assert set(own[r]) | set(visited[r]) == set(seen)


def test_copies_get_all_their_pairs_and_neighbours(spark):
    x, df = _table(spark)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    got = [(r.id, r.neighbour) for r in neighbours.expand_copies(df, 0.8, leaf=2048).collect()]
    ids = {"c0007", "d1", "d2"}
    near = {f"c{j:04d}" for j in np.flatnonzero(u[7] @ u.T >= 0.8)} - ids
    assert near and {p for p in got if p[0] in ids} == {(a, b) for a in ids for b in ids | near if a != b} and len(got) == len(set(got))
    q = spark.createDataFrame([("d2",), ("c0107",)], "id string")
    out = neighbours.similar_pairs(df, k=10, queries=q, leaf=2048).collect()
    assert {r.id for r in out} == {"d2", "c0107"} and len(out) == 20
    s = u @ u.T
    best = [f"c{j:04d}" for j in np.argsort(-s[7]) if j != 7][:8]
    assert {r.neighbour for r in out if r.id == "d2"} == {"c0007", "d1", *best}
    assert ids <= {r.neighbour for r in out if r.id == "c0107"}


def test_large_leaves_in_blocks_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "HELD", 300)  # a leaf of all rows in six blocks
    x, df = _table(spark)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T
    want = {(f"c{i:04d}", f"c{j:04d}") for i, j in zip(*np.nonzero(s >= 0.8), strict=True) if i != j}
    out = {(r.id, r.neighbour) for r in neighbours.similar_pairs(df, min_similarity=0.8, leaf=4096).collect()}
    assert {p for p in out if not {"d1", "d2"} & set(p)} == want
    q = spark.createDataFrame([("c0003",), ("c0107",)], "id string")
    near = neighbours.similar_pairs(df, k=10, queries=q, leaf=4096).collect()
    best = {f"c{j:04d}" for j in np.argsort(-s[3]) if j != 3}
    got = [r.neighbour for r in near if r.id == "c0003"]
    assert len(near) == 20 and got and set(got) == {f"c{j:04d}" for j in [j for j in np.argsort(-s[3]) if j != 3][:10]} and best


def test_blocks_follow_the_share_of_a_leaf():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2000, 8)).astype("f4")
    x[:700] = x[0] + 1e-4 * rng.standard_normal((700, 8))  # a crowd that medians can't divide well
    x /= np.linalg.norm(x, axis=1)[:, None]
    forest = neighbours.fit_forest(x, 3, 2)
    blocks = neighbours._blocks(x, *forest, 3, 2, 2_000_000)
    own, _ = neighbours.search_leaves(x, *forest, 3, 2, 0)
    size = np.bincount(own.reshape(-1), minlength=16) * 1000
    assert (size / blocks <= neighbours.HELD).all() and blocks.min() >= 1
    assert (neighbours._blocks(x[:0], *neighbours.fit_forest(x[:0], 0, 2), 0, 2, 100_000) == 13).all()


def test_visitors_pass_by_in_batches(monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 4)
    x = np.random.default_rng(3).standard_normal((100, 16)).astype("f4")
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = [f"c{i:03d}" for i in range(100)]
    scale = np.abs(x).max(axis=1)
    small = np.round(x / scale[:, None] * 127).astype(np.int8)
    y = small * (scale / 127)[:, None]
    s = y @ y.T
    np.fill_diagonal(s, -2)

    def rows(leaf, members, asks):
        order = sorted(range(100), key=lambda i: i not in members)
        keep = [i for i in order if i in members or i in asks]
        return [(leaf, 0, ids[i], i in asks, float(scale[i]), small[i].tobytes(), i in members) for i in keep]

    every, few = set(range(100)), set(range(10))
    table = rows(1, every, every) + rows(2, few, every) + rows(3, every, few)
    names = ("leaf", "part", "id", "asked", "scale", "v", "member")
    batches = [dict(zip(names, map(list, zip(*table[k : k + 37], strict=True)), strict=True)) for k in range(0, len(table), 37)]
    got = [p for b in neighbours._met(iter(batches), 3, 0.4) for p in zip(b["id"], b["neighbour"], strict=True)]
    full = {(ids[i], ids[j]) for i, j in zip(*np.nonzero(s >= 0.39), strict=True) if i < j}
    assert set(got) == full
    best = [(p, b) for b in neighbours._met(iter(batches[:3]), 3, None) for p in zip(b["id"], b["neighbour"], strict=True)]
    assert {(ids[i], ids[j]) for i in range(100) for j in np.argsort(-s[i])[:3]} <= {p for p, _ in best}


def test_every_row_by_groups_of_leaves(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "GROUP", 700)
    x, df = _table(spark)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T
    np.fill_diagonal(s, -2)
    out = {}
    for r in neighbours.similar_pairs(df, k=10, leaf=64, visits=0.6).collect():
        out.setdefault(r.id, {})[r.neighbour] = r.similarity
    assert len(out) == 1502 and all(len(v) == 10 for v in out.values())
    hit = sum(len({f"c{j:04d}" for j in np.argsort(-s[i])[:10]} & set(out[f"c{i:04d}"])) for i in range(1500) if i != 7)
    assert hit / 14990 >= 0.9
    every = neighbours.similar_pairs(df, k=10, leaf=64, visits=0.99).where("id = 'c0100'").collect()
    want = {j: s[100][j] for j in np.argsort(-s[100])[:8]}
    assert all(abs(r.similarity - s[100][int(r.neighbour[1:])]) < 1e-5 for r in every if r.neighbour[0] == "c") and {f"c{j:04d}" for j in want} <= {r.neighbour for r in every} | {"c0007"}


def test_many_copies(spark, monkeypatch):
    from quarrylamp.llm import base

    monkeypatch.setattr(base, "DEALT", 4)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((40, 128))
    y = x[0] + 0.05 * rng.standard_normal(128)
    z = x[0] + 0.06 * rng.standard_normal(128)
    rows = [(f"a{i:02d}", x[0]) for i in range(15)] + [(f"b{i}", y) for i in range(6)] + [("z", z)] + [(f"o{i:02d}", x[i]) for i in range(1, 40)]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in rows], "chunk_id string, vector array<float>")
    group = [i for i, _ in rows if i[0] in "abz"]
    every = {(p, q) for p in group for q in group if p != q}
    got = [(r.id, r.neighbour) for r in neighbours.expand_copies(df, 0.8).collect()]
    assert set(got) == every and len(got) == len(every)
    few = {(r.id, r.neighbour) for r in neighbours.expand_copies(df, 0.8, expand=5).collect()}
    a, b = [i for i in group if i[0] == "a"], [i for i in group if i[0] == "b"]
    half = {("a00", i) for i in a[1:]} | {("b0", i) for i in b[1:]} | {("a00", i) for i in b} | {(i, "b0") for i in a} | {(i, "z") for i in a + b}
    assert few == half | {(q, p) for p, q in half}
    # fifteen copies and two asked ids: ten neighbours each, all copies
    q = spark.createDataFrame([("a07",), ("o03",)], "id string")
    near = neighbours.similar_pairs(df, k=10, queries=q).collect()
    assert len(near) == 20 and {r.neighbour for r in near if r.id == "a07"} == set(a[:7] + a[8:11])
    each = neighbours.similar_pairs(df, k=10).collect()
    assert len(each) == 10 * len(rows) and {r.neighbour for r in each if r.id == "a00"} == set(a[1:11])


def test_searching_a_deep_forest_takes_little_memory():
    import tracemalloc

    rng = np.random.default_rng(4)
    x = rng.standard_normal((4096, 16)).astype("f4")
    forest = neighbours.fit_forest(x, 10, 4)
    for visits in (0, 6, 1228):  # by paths and by all leaves; rows times nodes are 67 MB
        tracemalloc.start()
        own, visited = neighbours.search_leaves(x, *forest, 10, 4, visits)
        peak = tracemalloc.get_traced_memory()[1] - visited.nbytes
        tracemalloc.stop()
        assert own.shape == (4096, 4) and visited.shape == (4096, visits)
        assert peak < 130e6 if visits > 6 else peak < 40e6


def test_paths_open_the_same_leaves_as_all_priorities():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((3000, 16)).astype("f4")
    forest = neighbours.fit_forest(x, 8, 4)
    normals, offsets = forest
    x = rng.standard_normal((200, 16)).astype("f4")
    own, visited = neighbours._open_few(x, *forest, 8, 4, 6)
    every, _ = neighbours._open_all(x, *forest, 8, 4, 6)
    assert (own == every).all()
    margin = x @ normals.T - offsets
    for r in range(200):
        priority = np.empty(4 * 256)
        for p in range(4 * 256):
            t, node, low = p // 256, p % 256 + 255, np.inf
            while node:
                above = (node - 1) // 2
                low = min(low, margin[r, t * 255 + above] * (1 if node == 2 * above + 2 else -1))
                node = above
            priority[p] = low
        chosen = priority[visited[r]]
        priority[own[r]] = -np.inf
        assert len(set(visited[r])) == 6 and not set(visited[r]) & set(own[r])
        assert np.allclose(np.sort(chosen), np.sort(priority)[-6:], atol=1e-5)
