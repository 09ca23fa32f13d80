"""Problem 2: near-duplicate records with small edits.

Method: signature-coordinate inverted join. A text's set of five-token runs gets a signature of COORDINATES minimum
hashes. Each document is posted under its (coordinate, value) pairs; pairs that occur once match nothing and are
skipped. Two signatures that agree in at least MATCHES coordinates must meet under one of the s - MATCHES + 1 rarest
shared pairs of either (s: how many of its pairs occur elsewhere), so only those prefixes are joined, rarest first,
which keeps the posting lists of boilerplate out of the join without losing a pair. Collisions are then counted over
the whole signatures, and survivors are verified by the exact similarity of their run sets.

Equal texts form a class first, of which one member is posted. Classes, their pairs and the members are tables; ids are
put in for classes only where pairs of ids are asked for.

At similarity 0.63 each coordinate agrees with probability 0.63, so of 32 some 20 agree; the chance of fewer than 11
is about 0.0004, at 0.70 below 0.00001.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, spread
from .base import has_text, join_hot, map_batches

RUN, COORDINATES, MATCHES = 5, 32, 11
MIN_TOKENS, SIMILARITY = 60, 0.60
#: Size up to which near_duplicate_pairs writes out all pairs of a class of equal texts.
EXPAND = 64
#: Rows of one posting list, or of one class of equal texts, that a task handles together.
POSTING = 4096

_TOKEN = re.compile(r"[一-鿿]|[^\s一-鿿]+")
_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 1 << 63, COORDINATES, np.uint64)
_MUL = _rng.integers(0, 1 << 63, COORDINATES, np.uint64) | np.uint64(1)
_token_ids: dict[str, int] = {}


def _run_hashes(text: str) -> tuple[np.ndarray, int]:
    """64-bit hashes of all runs of RUN consecutive tokens, with repeats, and the number of tokens."""
    import xxhash

    tokens = _TOKEN.findall(text.lower())
    if len(_token_ids) > 1_000_000:
        _token_ids.clear()
    ids = []
    for t in tokens:
        if (v := _token_ids.get(t)) is None:
            v = _token_ids[t] = xxhash.xxh64_intdigest(t)
        ids.append(v)
    a = np.array(ids, np.uint64)
    if len(a) < RUN:
        return a[:0], len(a)
    with np.errstate(over="ignore"):
        h = np.zeros(len(a) - RUN + 1, np.uint64)
        for i in range(RUN):
            h = h * np.uint64(0x9E3779B97F4A7C15) + a[i : len(a) - RUN + 1 + i]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h, len(a)


def run_set(text: str) -> np.ndarray:
    """Sorted distinct hashes of the runs of `text`."""
    return np.unique(_run_hashes(text)[0])


def _signatures(texts: list[str], min_tokens: int) -> tuple[list[np.ndarray | None], list[int]]:
    hashes, sizes = [], []
    for t in texts:
        h, n = _run_hashes(t)
        hashes.append(h if n >= max(min_tokens, RUN) else h[:0])
        sizes.append(n)
    used = [i for i, h in enumerate(hashes) if len(h)]
    out: list[np.ndarray | None] = [None] * len(texts)
    if used:
        flat = np.concatenate([hashes[i] for i in used])
        starts = np.cumsum([0, *(len(hashes[i]) for i in used[:-1])])
        sig = np.empty((len(used), COORDINATES), np.int32)
        with np.errstate(over="ignore"):
            for c in range(COORDINATES):
                v = (flat ^ _XOR[c]) * _MUL[c]
                sig[:, c] = (np.minimum.reduceat(v, starts) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        for row, i in zip(sig, used, strict=True):
            out[i] = row
    return out, sizes


def _copies(records: DataFrame, min_tokens: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, signatures, members): rep, a, b, n_copies of each distinct text of enough tokens; rep, sig likewise; and
    id, rep, n_copies for each id."""
    rows = records.where(F.col("id").isNotNull() & has_text()).select("id", "text", *_text_hash())

    def sign(batches):
        for b in batches:
            sigs, sizes = _signatures(b["text"], min_tokens)
            keep = [i for i, s in enumerate(sigs) if s is not None]
            yield {
                "id": [b["id"][i] for i in keep],
                "a": [b["a"][i] for i in keep],
                "b": [b["b"][i] for i in keep],
                "n_tokens": [sizes[i] for i in keep],
                "sig": [sigs[i].tolist() for i in keep],
            }

    signed = map_batches(spread(rows), sign, "id string, a bigint, b bigint, n_tokens int, sig array<int>")
    one = signed.groupBy("id").agg(F.max_by(F.struct("a", "b", "sig"), F.struct("n_tokens", "a", "b")).alias("s")).select("id", "s.*")
    one = checkpointed(one)
    classes = checkpointed(one.groupBy("a", "b").agg(F.min("id").alias("rep"), F.count("*").alias("n_copies")))
    signatures = one.groupBy("a", "b").agg(F.min("id").alias("rep"), F.first("sig").alias("sig")).select("rep", "sig")
    members = join_hot(one.select("id", "a", "b"), classes, ["a", "b"], "n_copies")
    return classes, signatures, members.select("id", "rep", "n_copies")


def _text_hash() -> tuple[Column, Column]:
    return F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b")


def _candidates(classes: DataFrame, signatures: DataFrame, matches: int) -> DataFrame:
    """Pairs (rep_a < rep_b) whose signatures agree in at least `matches` coordinates."""
    # eight bytes stand for an id here; two ids of one hash could only add a pair, which the exact step then refuses
    posts = signatures.select(F.xxhash64("rep").alias("r"), "sig").select(F.posexplode("sig").alias("c", "v"), "r").select(F.xxhash64("c", "v").alias("key"), "r")
    counts = posts.groupBy("key").agg(F.count("*").alias("freq")).where(F.col("freq") > 1)
    shared = posts.join(counts, "key").groupBy("r").agg(F.array_sort(F.collect_list(F.struct("freq", "key"))).alias("k"))
    shared = checkpointed(
        shared.where(F.size("k") >= matches).select(
            "r",
            F.expr("transform(k, x -> x.key)").alias("keys"),
            # parts of each key's posting list, null where all have one
            F.expr(f"CASE WHEN exists(k, x -> x.freq > {POSTING}) THEN transform(k, x -> int(ceil(x.freq / {POSTING}))) END").alias("parts"),
        )
    )
    prefix = shared.select("r", "parts", F.posexplode(F.expr(f"slice(keys, 1, size(keys) - {matches - 1})")).alias("at", "key"))
    prefix = prefix.select("r", "key", F.coalesce(F.get("parts", F.col("at")), F.lit(1)).alias("parts"))
    prefix = prefix.withColumn("part", F.pmod(F.xxhash64("r", "key"), "parts").cast("int"))
    # a long posting list meets itself part by part: no task gets more than POSTING**2 of its pairs
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    left = prefix.select("key", F.col("part").alias("i"), F.explode(every).alias("j"), F.col("r").alias("a"))
    right = prefix.select("key", F.explode(every).alias("i"), F.col("part").alias("j"), F.col("r").alias("b"))
    met = left.join(right, ["key", "i", "j"]).where(F.col("a") < F.col("b")).select("a", "b").distinct()
    both = F.array_intersect("keys_a", "keys_b")
    agreed = (
        met.join(shared.select(F.col("r").alias("a"), F.col("keys").alias("keys_a")), "a")
        .join(shared.select(F.col("r").alias("b"), F.col("keys").alias("keys_b")), "b")
        .where(F.size(both) >= matches)
        .select("a", "b")
    )
    names = classes.select(F.xxhash64("rep").alias("r"), "rep")
    named = agreed.join(names.select(F.col("r").alias("a"), F.col("rep").alias("x")), "a").join(
        names.select(F.col("r").alias("b"), F.col("rep").alias("y")), "b"
    )
    return named.select(F.least("x", "y").alias("rep_a"), F.greatest("x", "y").alias("rep_b"))


def class_pairs_and_members(
    records: DataFrame, similarity: float = SIMILARITY, min_tokens: int = MIN_TOKENS, matches: int = MATCHES
) -> tuple[DataFrame, DataFrame]:
    """(pairs, members). pairs: rep_a < rep_b, similarity, n_a, n_b: classes of equal texts, each named by its smallest
    id, whose texts reach `similarity`, and their sizes. members: id, rep, n_copies of every id with at least
    `min_tokens` tokens.

    Tokens are those of the lower-cased text: single ideographs U+4E00..U+9FFF, else runs without white space or such
    ideographs; similarity is the share of distinct five-token runs that both texts have. Together both tables give
    every link: two ids are near duplicates if they have one rep, or their reps are a pair. Both grow in proportion
    to the records and to the near pairs of different texts, however often a text was copied.

    Rows of one id count once, by the row with the most tokens (ties by hash); null ids, null, blank and short texts
    give no row; empty tables give none. Other columns are ignored.
    """
    classes, signatures, members = _copies(records, min_tokens)
    pairs = checkpointed(_candidates(classes, signatures, matches))
    wanted = pairs.select(F.col("rep_a").alias("rep")).unionByName(pairs.select(F.col("rep_b").alias("rep"))).distinct()
    # the very text that was signed: another row of its id may hold another one
    wanted = classes.select("rep", "a", "b", "n_copies").join(wanted, "rep", "left_semi").select(F.col("rep").alias("id"), "a", "b", "n_copies")
    texts = records.where(has_text()).select("id", "text", *_text_hash()).join(wanted, ["id", "a", "b"])

    def runs(batches):
        for b in batches:
            yield {
                "id": b["id"],
                "n": b["n_copies"],
                "runs": [run_set(t).view(np.int64).tolist() for t in b["text"]],
            }

    sets = map_batches(texts, runs, "id string, n bigint, runs array<bigint>")
    sets = sets.groupBy("id").agg(F.first("n").alias("n"), F.first("runs").alias("runs"))  # one shuffle, read by both joins
    common = F.size(F.array_intersect("runs_a", "runs_b"))
    exact = (
        pairs.join(sets.select(F.col("id").alias("rep_a"), F.col("n").alias("n_a"), F.col("runs").alias("runs_a")), "rep_a")
        .join(sets.select(F.col("id").alias("rep_b"), F.col("n").alias("n_b"), F.col("runs").alias("runs_b")), "rep_b")
        .select(
            "rep_a", "rep_b", (common / (F.size("runs_a") + F.size("runs_b") - common)).alias("similarity"), "n_a", "n_b"
        )
        .where(F.col("similarity") >= similarity)
    )
    return exact, members


def near_duplicate_pairs(records: DataFrame, expand: int = EXPAND, **kw) -> DataFrame:
    """id_a < id_b: near duplicates by class_pairs_and_members, with the ids of equal texts put in for their class.

    All pairs of ids come out where of two classes at least one has `expand` members or fewer, and within a class of so
    many. Larger classes aren't squared: one of n members gives n - 1 rows with its smallest id, and two near ones of
    n and m members give n + m - 1 rows, each member with the other class's smallest id. So every id keeps a link to
    every different text that is near its own, and rows stay below 2 * expand times the links of classes; what is left
    out is all in the two tables of class_pairs_and_members.
    """
    pairs, members = class_pairs_and_members(records, **kw)
    pairs, members = checkpointed(pairs), checkpointed(members)
    small = lambda c: F.col(c) <= expand
    across = pairs.withColumn("full", small("n_a") | small("n_b"))
    # members of a large class are dealt over parts, so that no task gets them all
    parts = lambda n: F.ceil(F.col(n) / F.lit(POSTING)).cast("int")
    each = members.select("rep", "id", F.pmod(F.xxhash64("id"), parts("n_copies")).cast("int").alias("part"))

    def put_in(df: DataFrame, side: str) -> DataFrame:
        dealt = df.withColumn("part", F.explode(F.sequence(F.lit(0), parts(f"n_{side}") - 1)))
        return dealt.join(each.select(F.col("rep").alias(f"rep_{side}"), "part", F.col("id").alias(side)), [f"rep_{side}", "part"]).drop("part")

    full = put_in(put_in(across.where("full"), "a"), "b").select("a", "b")
    large = across.where("not full")
    star = put_in(large, "a").select("a", F.col("rep_b").alias("b")).unionByName(put_in(large, "b").select(F.col("rep_a").alias("a"), "b"))
    twins = members.where((F.col("n_copies") > 1) & small("n_copies"))
    within = twins.select("rep", F.col("id").alias("a")).join(twins.select("rep", F.col("id").alias("b")), "rep")
    copies = members.where(~small("n_copies") & (F.col("id") != F.col("rep"))).select(F.col("rep").alias("a"), F.col("id").alias("b"))
    out = full.unionByName(star).unionByName(within.where(F.col("a") < F.col("b")).select("a", "b")).unionByName(copies)
    return out.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).distinct()


def near_duplicate_members(records: DataFrame, rounds: int = 50, **kw) -> DataFrame:
    """id, class_id, n_copies, links, group_id of every id that the comparison covers.

    class_id is the smallest id with an equal text, n_copies the size of that class, links the number of other ids that
    are near duplicates of this one (by the sizes of the classes, so no pair is written out), group_id the smallest id
    that it is connected with by links (its own if it has none).
    """
    pairs, members = class_pairs_and_members(records, **kw)
    pairs = checkpointed(pairs)
    ends = pairs.select(F.col("rep_a").alias("rep"), F.col("n_b").alias("n")).unionByName(pairs.select(F.col("rep_b").alias("rep"), F.col("n_a").alias("n")))
    near = ends.groupBy("rep").agg(F.sum("n").alias("n_near"))
    label = components(pairs.select(F.col("rep_a").alias("id_a"), F.col("rep_b").alias("id_b")), rounds)
    # one row for each class with a near one
    known = checkpointed(near.join(label.select(F.col("id").alias("rep"), "group_id"), "rep"))
    sized = known.join(members.where(F.col("id") == F.col("rep")).select("rep", "n_copies"), "rep")
    lone = members.join(known.select("rep"), "rep", "left_anti").withColumns({"n_near": F.lit(0).cast("bigint"), "group_id": F.col("rep")})
    met = join_hot(members.join(known.select("rep"), "rep", "left_semi").drop("n_copies"), sized, ["rep"], "n_copies")
    every = met.unionByName(lone)
    return every.select("id", F.col("rep").alias("class_id"), "n_copies", (F.col("n_copies") - 1 + F.col("n_near")).alias("links"), "group_id")


def components(pairs: DataFrame, rounds: int = 50) -> DataFrame:
    """Connected groups of the pairs (id_a, id_b): id, group_id (smallest id of the group).

    Labels spread along the links and jump to their label's label, so rounds grow with the logarithm of the longest
    chain; each round's result is checkpointed in the shared folder. Raises if `rounds` don't suffice.
    """
    edges = checkpointed(
        pairs.select(F.col("id_a").alias("u"), F.col("id_b").alias("v"))
        .unionByName(pairs.select(F.col("id_b").alias("u"), F.col("id_a").alias("v")))
        .distinct()
    )
    label = checkpointed(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("g")))
    for _ in range(rounds):
        near = (
            edges.join(label.select(F.col("u").alias("v"), "g"), "v").groupBy("u").agg(F.min("g").alias("n"))
        )
        step = label.join(near, "u", "left").select("u", F.least("g", "n").alias("n"), "g")
        hop = step.join(label.select(F.col("u").alias("n"), F.col("g").alias("h")), "n", "left").select(
            "u", F.least("n", F.coalesce("h", "n")).alias("g"), (F.col("n") != F.col("g")).alias("moved")
        )
        hop = checkpointed(hop)
        label = hop.select("u", "g")
        if hop.where("moved").isEmpty():
            break
    else:
        raise RuntimeError(f"labels still move after {rounds} rounds")
    return label.select(F.col("u").alias("id"), F.col("g").alias("group_id"))
