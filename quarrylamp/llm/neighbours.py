"""Problem 3: the most similar vectors for every vector.

Method: a forest of random-projection trees, searched through one priority queue shared by all trees, then exact
reranking of the leaf candidates.

The trees are fitted on a bounded sample (SAMPLE rows at most): each node projects on the difference of two sampled
vectors and splits at the sample's median, so leaves hold equal shares of the data even where vectors crowd together.
Every row is then indexed in one leaf of each tree and visits further leaves as a query. The shared queue always
opens the node with the largest least margin on its path, over all trees; since a child's priority never exceeds its
parent's, the first P leaves that it yields are those with the P largest path priorities, which is how they are found
here, for a whole batch at once by matrix products.

Rows meet their leaf's other rows in one shuffle, as eight-bit vectors (their dot products are off by some 0.001). A task
holds a bounded block of a leaf's members; those who ask pass by in batches.
Candidates that reach the threshold less SLACK, or are among the best k + SPARE of a query, are reranked by the cosine
of the full vectors.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, spread
from .base import join_counted, join_hot, map_batches, put_members

DIM, K = 128, 10
#: Rows on which trees are fitted at most; trees; rows aimed at in a leaf; levels at most, which bounds the tree table
#: that is sent to tasks to TREES * 2**MAX_DEPTH vectors (8 MB).
SAMPLE, TREES, LEAF, MAX_DEPTH = 16_384, 4, 1024, 12
#: Leaves that a query visits besides its own; eight-bit error allowed for; further candidates kept; rows compared at once.
VISITS, SLACK, SPARE, BLOCK = 6, 0.01, 6, 2048
#: Members of a leaf that a task holds together. A leaf that is to get more is dealt over as many blocks as it needs, and
#: whoever asks in it asks in all of them, so large leaves (beyond 2**MAX_DEPTH * LEAF rows, or where many vectors are
#: nearly equal) lose nothing.
HELD = 8192
#: Size up to which expand_copies writes out all pairs of a class of equal directions.
EXPAND = 64
#: Members of a group of leaves that a task holds where every row visits a share of all leaves.
GROUP = 65_536


def fit_forest(sample: np.ndarray, depth: int, trees: int = TREES, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(normals, offsets) of complete binary trees of `depth` levels: trees * (2**depth - 1) nodes, tree by tree and
    level by level. A node splits at the median of its share of the (unit) sample."""
    rng = np.random.default_rng(seed)
    nodes = 2**depth - 1
    normals = np.zeros((trees, nodes, sample.shape[1]), np.float32)
    offsets = np.zeros((trees, nodes), np.float32)
    for t in range(trees):
        held = {0: np.arange(len(sample))}
        for node in range(nodes):
            rows = held.pop(node, np.empty(0, int))
            normal = rng.standard_normal(normals.shape[2]).astype(np.float32)
            if len(rows) > 2:
                a, b = rng.choice(rows, 2, replace=False)
                if (gap := np.linalg.norm(sample[a] - sample[b])) > 1e-6:
                    normal = sample[a] - sample[b]
                    normal /= gap
            normal /= max(float(np.linalg.norm(normal)), 1e-12)
            side = sample[rows] @ normal if len(rows) else np.zeros(0, np.float32)
            normals[t, node] = normal
            offsets[t, node] = np.median(side) if len(rows) else 0
            if 2 * node + 2 < nodes:
                right = side > offsets[t, node]
                held[2 * node + 1], held[2 * node + 2] = rows[~right], rows[right]
    return normals.reshape(trees * nodes, normals.shape[2]), offsets.reshape(-1)


#: Bytes that search_leaves holds at once for one of its arrays.
SEARCHED = 1 << 24


def search_leaves(
    unit: np.ndarray, normals: np.ndarray, offsets: np.ndarray, depth: int, trees: int, visits: int
) -> tuple[np.ndarray, np.ndarray]:
    """(own, visited): for each row its leaf in every tree, and the `visits` other leaves that the shared queue
    opens first. Leaves are numbered tree * 2**depth + place. Rows go through in blocks, so that memory doesn't grow with
    rows times nodes."""
    if depth == 0:
        return np.tile(np.arange(trees), (len(unit), 1)), np.empty((len(unit), 0), int)
    leaves, dim = 2**depth, normals.shape[1]
    visits = min(visits, trees * leaves - trees)
    # few leaves: only the nodes on their paths
    few = depth * (trees + visits) * 8 < trees * leaves
    step = max(1, SEARCHED // (4 * ((trees + visits) * dim if few else trees * leaves)))
    search = _open_few if few else _open_all
    own, visited = np.empty((len(unit), trees), int), np.empty((len(unit), visits), int)
    for s in range(0, len(unit), step):
        own[s : s + step], visited[s : s + step] = search(unit[s : s + step], normals, offsets, depth, trees, visits)
    return own, visited


def _open_all(unit: np.ndarray, normals: np.ndarray, offsets: np.ndarray, depth: int, trees: int, visits: int) -> tuple[np.ndarray, np.ndarray]:
    """search_leaves by the priorities of all leaves."""
    n, leaves, nodes = len(unit), 2**depth, 2**depth - 1
    margin = (unit @ normals.T - offsets).reshape(n, trees, nodes)
    priority = np.full((n, trees, 1), np.inf, np.float32)
    for level in range(depth):
        m = margin[:, :, 2**level - 1 : 2 ** (level + 1) - 1]
        priority = np.stack([np.minimum(priority, -m), np.minimum(priority, m)], axis=3).reshape(n, trees, -1)
    own = priority.argmax(axis=2) + np.arange(trees) * leaves
    flat = priority.reshape(n, -1)
    np.put_along_axis(flat, own, -np.inf, axis=1)
    visited = np.argpartition(-flat, visits - 1, axis=1)[:, :visits] if visits else np.empty((n, 0), int)
    return own, visited


def _open_few(unit: np.ndarray, normals: np.ndarray, offsets: np.ndarray, depth: int, trees: int, visits: int) -> tuple[np.ndarray, np.ndarray]:
    """search_leaves level by level. Off a row's own paths the nearer child has its parent's priority, so every node has a
    leaf with its own priority below it, and the best `visits` leaves lie below the best `visits` nodes of each level."""
    n, nodes = len(unit), 2**depth - 1
    first = np.arange(trees) * nodes
    own = np.zeros((n, trees), int)  # places within the tree
    tree, node, priority = np.empty((n, 0), int), np.empty((n, 0), int), np.empty((n, 0), np.float32)

    def margins(at: np.ndarray) -> np.ndarray:
        return (normals[at] @ unit[:, :, None])[:, :, 0] - offsets[at]

    for _ in range(depth):
        m = margins(own + first)
        right = m > 0
        if visits:
            o = margins(tree * nodes + node)
            tree = np.concatenate([np.broadcast_to(np.arange(trees), (n, trees)), tree, tree], axis=1)
            node = np.concatenate([2 * own + 2 - right, 2 * node + 1, 2 * node + 2], axis=1)
            priority = np.concatenate([-np.abs(m), np.minimum(priority, -o), np.minimum(priority, o)], axis=1)
            if node.shape[1] > visits:
                best = np.argpartition(-priority, visits - 1, axis=1)[:, :visits]
                tree, node, priority = (np.take_along_axis(x, best, axis=1) for x in (tree, node, priority))
        own = 2 * own + 1 + right
    return own - nodes + np.arange(trees) * 2**depth, tree * 2**depth + node - nodes


def usable(chunks: DataFrame, id_col: str = "chunk_id", vector: str = "vector", dim: int = DIM) -> DataFrame:
    """id, vector of rows whose vector has `dim` finite values, not all zero; one row for each id."""
    good = (F.size(vector) == dim) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        chunks.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull())
        .where(good & F.exists(vector, lambda x: x != 0))
        .select(F.col(id_col).alias("id"), F.col(vector).cast("array<float>").alias("vector"))
    )


def _unit_rows(b) -> np.ndarray:
    flat = b["vector"].flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(len(b["id"]), -1).astype(np.float64)
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def _units(vectors: DataFrame) -> DataFrame:
    """id, unit (float32 bytes of the vector at length one)."""

    def unit(batches):
        for b in batches:
            yield {"id": b["id"], "unit": [r.tobytes() for r in _unit_rows(b)]}

    return map_batches(vectors, unit, "id string, unit binary", raw=("vector",))


def _hashed(vectors: DataFrame) -> DataFrame:
    """id and a 128-bit hash (a, b) of its direction; no vector moves for finding copies."""

    def run(batches):
        import xxhash

        for b in batches:
            h = [xxhash.xxh3_128_intdigest(r.tobytes()) for r in _unit_rows(b)]
            yield {"id": b["id"], "a": [(v >> 64) - (1 << 63) for v in h], "b": [(v & ((1 << 64) - 1)) - (1 << 63) for v in h]}

    return map_batches(vectors, run, "id string, a bigint, b bigint", raw=("vector",))


def similar_pairs(
    chunks: DataFrame,
    min_similarity: float | None = None,
    k: int = K,
    queries: DataFrame | None = None,
    visits: float = VISITS,
    trees: int = TREES,
    leaf: int = LEAF,
    id_col: str = "chunk_id",
    vector: str = "vector",
    dim: int = DIM,
) -> DataFrame:
    """Directed rows (id, neighbour, similarity): for each vector its `k` most similar other vectors by cosine, or,
    with `min_similarity`, all found ones that reach it (k is not used then, so nothing is capped).

    Vectors that are null, of another size, not finite or all zero are left out; repeated rows of an id count once
    (equal ids have equal vectors). Vectors of exactly one direction form a class that its smallest id stands for in
    the search. With `min_similarity` its other members get one row to and from that id, so a class of n copies gives
    2 (n - 1) rows (expand_copies gives all); else every asked member gets its own `k` neighbours, copies included.
    `visits` below 1 is a share of all leaves; where every row is asked for and visits many, it does so by groups of leaves
    (_in_groups) after a first search in a few.
    `queries` (column id) restricts whose neighbours are looked for; every row is indexed. Ties go to the smaller
    id. An empty table gives no rows.
    """
    best, members = _pairs_and_members(chunks, min_similarity, k, queries, visits, trees, leaf, id_col, vector, dim)
    if min_similarity is None:
        return _copies_answered(best, members, queries, k)
    star = members.select("id", F.col("rep").alias("neighbour"), F.lit(1.0).alias("similarity"))
    back = star.select(F.col("neighbour").alias("id"), F.col("id").alias("neighbour"), "similarity")
    return best.unionByName(star).unionByName(back)


def _classes(members: DataFrame) -> DataFrame:
    """rep, id, n of all members of each class with copies, the id that stands for it among them; n is the class's size."""
    every = checkpointed(members.select("rep", "id").unionByName(members.select("rep", F.col("rep").alias("id"))).distinct())
    return checkpointed(join_hot(every, every.groupBy("rep").agg(F.count("*").alias("n")), ["rep"], "n").select("rep", "id", "n"))


def _copies_answered(best: DataFrame, members: DataFrame, queries: DataFrame | None, k: int) -> DataFrame:
    """The `k` best of every asked id: those of the id that stands for it, with each class's members put in. No more
    than the k + 1 smallest ids of a class can be among the k best, one of them being the asked id itself."""
    from pyspark.sql import Window

    if not members.count():
        return best
    every = _classes(members)
    # ranked within tasks first, so a large class hands on k + 1 rows of each
    w = Window.partitionBy("rep").orderBy("id")
    first = every.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k + 1).select("rep", F.col("id").alias("copy"))
    near = join_counted(best, first.withColumnRenamed("rep", "neighbour"), "neighbour", "left")
    near = near.select("id", F.coalesce("copy", "neighbour").alias("neighbour"), "similarity")
    twins = first.select(F.col("rep").alias("id"), F.col("copy").alias("neighbour"), F.lit(1.0).alias("similarity"))
    # one more than k, as an asked id is not its own neighbour
    kept = _top(near.unionByName(twins), k + 1)
    answered = put_members(kept, "id", every).where(F.col("id") != F.col("neighbour"))
    if queries is not None:
        answered = answered.join(queries.select("id").distinct(), "id", "left_semi")
    return _top(answered, k)


def expand_copies(chunks: DataFrame, min_similarity: float, expand: int = EXPAND, **kw) -> DataFrame:
    """similar_pairs with `min_similarity`, members of each class of equal directions put in: directed rows (id, neighbour,
    similarity).

    All come out where of two classes at least one has `expand` members or fewer, and within a class of so many. A larger
    class isn't squared: its members have rows to and from its smallest id, and of two large near classes each member
    has rows to and from the other's smallest id. similar_pairs and the classes give back what is left out."""
    best, members = _pairs_and_members(chunks, min_similarity, **kw)
    if not members.count():
        return best
    every = _classes(members)
    sizes = every.where(F.col("id") == F.col("rep")).select(F.col("rep"), "n")
    size = best.join(sizes.select(F.col("rep").alias("id"), F.col("n").alias("_a")), "id", "left").join(sizes.select(F.col("rep").alias("neighbour"), F.col("n").alias("_b")), "neighbour", "left")
    small = F.least(F.coalesce("_a", F.lit(1)), F.coalesce("_b", F.lit(1))) <= expand
    cols = ["id", "neighbour", "similarity"]
    full, large = size.where(small).select(*cols), size.where(~small).select(*cols)
    across = put_members(put_members(full, "id", every), "neighbour", every)
    across = across.unionByName(put_members(large, "id", every)).unionByName(put_members(large, "neighbour", every))
    few = every.where(F.col("n") <= expand)
    within = few.select("rep", "id").join(few.select("rep", F.col("id").alias("neighbour")), "rep").select("id", "neighbour")
    star = every.where(F.col("n") > expand).select("id", F.col("rep").alias("neighbour"))
    within = within.unionByName(star).unionByName(star.select(F.col("neighbour").alias("id"), F.col("id").alias("neighbour")))
    within = within.where(F.col("id") != F.col("neighbour")).withColumn("similarity", F.lit(1.0))
    return across.unionByName(within).distinct()


def _pairs_and_members(
    chunks: DataFrame,
    min_similarity: float | None = None,
    k: int = K,
    queries: DataFrame | None = None,
    visits: float = VISITS,
    trees: int = TREES,
    leaf: int = LEAF,
    id_col: str = "chunk_id",
    vector: str = "vector",
    dim: int = DIM,
) -> tuple[DataFrame, DataFrame]:
    """(id, neighbour, similarity among the ids that stand for their class; id, rep of all other members)."""
    good = spread(usable(chunks, id_col, vector, dim))
    keyed = _hashed(good)
    classes = checkpointed(
        keyed.groupBy("a", "b").agg(F.min("id").alias("rep"), (F.min("id") != F.max("id")).alias("copied"), F.count("*").alias("n"))
    )
    count = classes.count()
    members = checkpointed(
        join_hot(keyed, classes.where("copied").select("a", "b", "rep", "n"), ["a", "b"], "n").where(F.col("id") != F.col("rep")).select("id", "rep").distinct()
    )
    units = _units(join_counted(good, members.select("id"), "id", "left_anti"))
    depth = int(np.clip(np.ceil(np.log2(max(count, 1) / leaf)), 0, MAX_DEPTH))
    visits = int(np.ceil(visits * trees * 2**depth)) if visits < 1 else int(visits)
    # many leaves for every row: a few first, which tell what the others must reach to count
    further = visits if min_similarity is None and queries is None and visits > 4 * VISITS else 0
    visits = VISITS if further else visits
    # a bounded sample: hashes of ids are as good as random
    share = min(1.0, 1.2 * SAMPLE / max(count, 1))
    picked = (
        units.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("unit").limit(SAMPLE).collect()
        if depth
        else []
    )
    sample = np.stack([np.frombuffer(r.unit, np.float32) for r in picked]) if picked else np.empty((0, dim), np.float32)
    normals, offsets = fit_forest(sample, depth, trees)
    blocks = _blocks(sample, normals, offsets, depth, trees, count)
    shared = chunks.sparkSession.sparkContext.broadcast((normals, offsets, blocks))
    asked = units.withColumn("asked", F.lit(True))
    if queries is not None:
        # a copy is asked for by the id that stands for it
        wanted = queries.select("id").join(members, "id", "left").select(F.coalesce("rep", "id").alias("id")).distinct()
        wanted = wanted.withColumn("asked", F.lit(True))
        asked = units.join(wanted, "id", "left").withColumn("asked", F.coalesce("asked", F.lit(False)))

    def place(batches):
        *forest, parts = shared.value
        for b in batches:
            for s in range(0, len(b["id"]), 1024):
                ids, asks = b["id"][s : s + 1024], np.array(b["asked"][s : s + 1024])
                x = np.stack([np.frombuffer(u, np.float32) for u in b["unit"][s : s + 1024]])
                own, visited = search_leaves(x, *forest, depth, trees, visits)
                scale = np.abs(x).max(axis=1)
                small = np.round(x / scale[:, None] * 127).astype(np.int8)
                packed = [r.tobytes() for r in small]
                o = {k: [] for k in ("leaf", "part", "id", "member", "asked", "scale", "v")}
                for i in range(len(ids)):
                    ask = bool(asks[i])
                    rows = []
                    for p in map(int, own[i]):
                        mine = zlib.crc32(ids[i].encode()) % parts[p]
                        rows += [(p, j, j == mine) for j in (range(parts[p]) if ask else (mine,))]
                    if ask:
                        rows += [(p, j, False) for p in map(int, visited[i]) for j in range(parts[p])]
                    for p, j, member in rows:
                        for key, value in zip(o, (p, j, ids[i], member, ask, float(scale[i]), packed[i]), strict=True):
                            o[key].append(value)
                yield o

    placed = map_batches(asked, place, "leaf int, part int, id string, member boolean, asked boolean, scale float, v binary")
    placed = placed.repartition("leaf", "part").sortWithinPartitions("leaf", "part", F.col("member").desc())

    def compare(batches):
        parts = _met(batches, k, min_similarity)
        yield from parts if min_similarity is not None else _best_of(parts, k + SPARE)

    found = map_batches(placed, compare, "id string, neighbour string, similarity float").where(F.col("id") != F.col("neighbour"))
    if min_similarity is None:  # what is best by eight bits over all leaves goes on
        found = _top(found.groupBy("id", "neighbour").agg(F.max("similarity").alias("similarity")), k + SPARE)
        if further:
            found = checkpointed(found)
            more = _in_groups(asked, found, shared, depth, trees, further, k, count)
            found = _top(found.unionByName(more).groupBy("id", "neighbour").agg(F.max("similarity").alias("similarity")), k + SPARE)
    exact = _rerank(found.select("id", "neighbour").distinct(), units)
    if min_similarity is not None:
        best = exact.where(F.col("similarity") >= min_similarity)
        best = best.unionByName(
            best.select(F.col("neighbour").alias("id"), F.col("id").alias("neighbour"), "similarity")
        ).distinct()
    else:
        best = _top(exact, k)
    return best, members


def _top(pairs: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour")
    return pairs.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def _blocks(sample: np.ndarray, normals: np.ndarray, offsets: np.ndarray, depth: int, trees: int, count: int) -> np.ndarray:
    """Blocks that each leaf's members are dealt over, by the share of the sample that lies in it."""
    out = np.ones(trees * 2**depth, np.int64)
    if len(sample) and count > HELD:
        own, _ = search_leaves(sample, normals, offsets, depth, trees, 0)
        held = np.bincount(own.reshape(-1), minlength=len(out)) * (count / len(sample))
        out = np.maximum(1, np.ceil(held / HELD)).astype(np.int64)
    elif count > HELD:  # no tree: one leaf holds all
        out[:] = -(-count // HELD)
    return out


def _in_groups(asked: DataFrame, first: DataFrame, shared, depth: int, trees: int, visits: int, k: int, count: int) -> DataFrame:
    """(id, neighbour, similarity by eight bits) from the `visits` leaves that each row opens first, of those that reach its
    k-th best of `first` (less SLACK).

    A task holds the members of a group of leaves, about GROUP of them, and a row passes by each group once with the list
    of its leaves there, not each leaf; only what counts is handed on. So the rows moved are those of the table times the
    groups, and the products those of the table times the share of the leaves."""
    groups = max(-(-count * trees // GROUP), asked.sparkSession.sparkContext.defaultParallelism)
    bound = first.groupBy("id").agg(F.min("similarity").alias("low"), F.count("*").alias("n"))
    bound = bound.select("id", F.when(F.col("n") >= k, F.col("low") - SLACK).otherwise(-2.0).cast("float").alias("bound"))
    rows = asked.select("id", "unit").join(bound, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(-2.0).cast("float")))

    def place(batches):
        *forest, _ = shared.value
        for b in batches:
            for s in range(0, len(b["id"]), 1024):
                ids, bounds = b["id"][s : s + 1024], b["bound"][s : s + 1024]
                x = np.stack([np.frombuffer(u, np.float32) for u in b["unit"][s : s + 1024]])
                own, visited = search_leaves(x, *forest, depth, trees, visits)
                opened = np.sort(np.concatenate([own, visited], axis=1), axis=1)
                scale = np.abs(x).max(axis=1)
                small = np.round(x / scale[:, None] * 127).astype(np.int8)
                o = {c: [] for c in ("group", "leaf", "leaves", "id", "bound", "scale", "v")}
                for i, name in enumerate(ids):
                    packed, size = small[i].tobytes(), float(scale[i])
                    table = [(int(p) % groups, int(p), None) for p in own[i]]
                    at = opened[i] % groups
                    table += [(int(g), -1, opened[i][at == g].astype(np.int32).tobytes()) for g in np.unique(at)]
                    for g, leaf, leaves in table:
                        for c, v in zip(o, (g, leaf, leaves, name, bounds[i], size, packed), strict=True):
                            o[c].append(v)
                yield o

    placed = map_batches(rows, place, "group int, leaf int, leaves binary, id string, bound float, scale float, v binary")
    placed = placed.repartition(groups, "group").sortWithinPartitions("group", F.col("leaf").desc())

    def compare(batches):
        at, members, ids, x, slices = None, [], None, None, {}
        for b in batches:
            cuts = np.flatnonzero(np.diff(np.array(b["group"]))) + 1
            for s, e in zip([0, *cuts], [*cuts, len(b["group"])], strict=True):
                if b["group"][s] != at:
                    at, members, ids = b["group"][s], [], None
                leaf = np.array(b["leaf"][s:e])
                m = s + int((leaf >= 0).sum())  # members come first
                members += zip(b["leaf"][s:m], b["id"][s:m], b["scale"][s:m], b["v"][s:m], strict=True)
                if m < e:
                    if ids is None:
                        ids, x, slices = _held(members)
                    for q in range(m, e, BLOCK):
                        z = min(q + BLOCK, e)
                        yield _reaching(b["id"][q:z], b["leaves"][q:z], np.array(b["bound"][q:z], np.float32), _vectors(b["scale"][q:z], b["v"][q:z]), ids, x, slices)

    found = map_batches(placed, compare, "id string, neighbour string, similarity float")
    return found.where(F.col("id") != F.col("neighbour"))


def _held(members: list[tuple]) -> tuple[np.ndarray, np.ndarray, dict[int, slice]]:
    """(ids, vectors, where each leaf lies among them)."""
    if not members:
        return np.empty(0, object), np.empty((0, 0), np.float32), {}
    leaf = np.array([r[0] for r in members])
    ends = [0, *(np.flatnonzero(np.diff(leaf)) + 1).tolist(), len(leaf)]
    where = {int(leaf[a]): slice(a, z) for a, z in zip(ends, ends[1:], strict=False)}
    return np.array([r[1] for r in members], object), _vectors([r[2] for r in members], [r[3] for r in members]), where


def _reaching(asking: list[str], leaves: list[bytes], bound: np.ndarray, y: np.ndarray, ids: np.ndarray, x: np.ndarray, slices: dict[int, slice]) -> dict[str, list]:
    """Members of its leaves that reach each asking row's bound."""
    lists = [np.frombuffer(v, np.int32) for v in leaves]
    flat, row = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(v) for v in lists])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    ends = [0, *(np.flatnonzero(np.diff(flat)) + 1).tolist(), len(flat)]
    q_all, j_all, s_all = [], [], []
    for a, z in zip(ends, ends[1:], strict=False):
        if (where := slices.get(int(flat[a]))) is None:
            continue
        q = row[a:z]
        sims = y[q] @ x[where].T
        i, j = np.nonzero(sims >= bound[q][:, None])
        q_all.append(q[i])
        j_all.append(j + where.start)
        s_all.append(sims[i, j])
    if not q_all:
        return {"id": [], "neighbour": [], "similarity": []}
    q, j, sims = map(np.concatenate, (q_all, j_all, s_all))
    return {"id": np.array(asking, object)[q].tolist(), "neighbour": ids[j].tolist(), "similarity": sims.tolist()}


def _vectors(scale: list[float], packed: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(packed), np.int8).reshape(len(packed), -1).astype(np.float32)
    x *= (np.array(scale, np.float32) / 127)[:, None]
    return x


def _met(batches, k: int, least: float | None):
    """Candidates of one block after the other. Its members come first and are held; those who ask are compared with them
    in batches, members who ask too at once and visitors as they come."""
    at = None
    ids: list[str] = []
    member_rows: list[tuple] = []
    x = None
    waiting: list[tuple] = []

    def members() -> None:
        nonlocal x, ids
        if x is None and member_rows:
            ids = [r[0] for r in member_rows]
            x = _vectors([r[2] for r in member_rows], [r[3] for r in member_rows])

    def ask(rows: list[tuple]):
        if rows and member_rows:
            members()
            yield from _in_block([r[0] for r in rows], _vectors([r[2] for r in rows], [r[3] for r in rows]), ids, x, k, least)

    for b in batches:
        for leaf, part, *row, member in zip(b["leaf"], b["part"], b["id"], b["asked"], b["scale"], b["v"], b["member"], strict=True):
            if (leaf, part) != at:
                yield from ask(waiting)
                at, member_rows, waiting, x = (leaf, part), [], [], None
            if member:
                member_rows.append(tuple(row))
            if row[1]:
                waiting.append(tuple(row))
            if len(waiting) >= BLOCK and not member:
                yield from ask(waiting)
                waiting = []
    yield from ask(waiting)


def _in_block(asking: list[str], y: np.ndarray, ids: list[str], x: np.ndarray, k: int, least: float | None):
    """Every asking row against every member."""
    index, names = np.array(ids, object), np.array(asking, object)
    own = {i: j for j, i in enumerate(ids)}
    me = np.array([own.get(i, -1) for i in asking])
    for s in range(0, len(asking), BLOCK):
        rows = slice(s, s + BLOCK)
        sims = y[rows] @ x.T
        here = np.flatnonzero(me[rows] >= 0)
        sims[here, me[rows][here]] = -2
        if least is not None:
            q, j = np.nonzero(sims >= least - SLACK)
        else:
            take = min(k + SPARE, len(ids))
            j = np.argpartition(-sims, take - 1, axis=1)[:, :take]
            q = np.repeat(np.arange(len(sims)), take)
            j = j.reshape(-1)
            ok = sims[q, j] > -2
            q, j = q[ok], j[ok]
        a, b = names[rows][q], index[j]
        if least is not None and len(a):  # either order will do
            swap = a > b
            a, b = np.where(swap, b, a), np.where(swap, a, b)
        if len(a):
            yield {"id": a.tolist(), "neighbour": b.tolist(), "similarity": sims[q, j].tolist()}


def _best_of(parts, most: int, held: int = 400_000):
    """The `most` best candidates of each id within a task, so that a query that visits many leaves sends few rows on.
    At most about `held` rows wait; then what is best so far goes on."""
    import pandas as pd

    rows: list[pd.DataFrame] = []
    waiting = 0

    def best() -> pd.DataFrame:
        all_rows = pd.concat(rows).sort_values("similarity", ascending=False).drop_duplicates(["id", "neighbour"])
        return all_rows.groupby("id", sort=False).head(most)

    for p in parts:
        rows.append(pd.DataFrame(p))
        waiting += len(p["id"])
        if waiting > held:
            kept = best()
            if len(kept) > held // 2:  # many ids, few rows each: nothing more to gain by waiting
                yield kept.to_dict("list")
                rows, waiting = [], 0
            else:
                rows, waiting = [kept], len(kept)
    if rows:
        yield best().to_dict("list")


def _rerank(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """id, neighbour, similarity by the full vectors."""
    pairs = checkpointed(pairs)
    wanted = checkpointed(pairs.select("id").unionByName(pairs.select(F.col("neighbour").alias("id"))).distinct())
    vectors = join_counted(vectors, wanted, "id", "left_semi").dropDuplicates(["id"])
    joined = pairs.join(vectors.select("id", F.col("unit").alias("u")), "id").join(
        vectors.select(F.col("id").alias("neighbour"), F.col("unit").alias("v")), "neighbour"
    )

    def cosine(batches):
        for b in batches:
            u = np.frombuffer(b"".join(b["u"]), np.float32).reshape(len(b["u"]), -1).astype(np.float64)
            v = np.frombuffer(b"".join(b["v"]), np.float32).reshape(len(b["v"]), -1)
            yield {"id": b["id"], "neighbour": b["neighbour"], "similarity": (u * v).sum(axis=1).tolist()}

    return map_batches(joined, cosine, "id string, neighbour string, similarity double")
