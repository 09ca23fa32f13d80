"""Problem 9: filling fixed-capacity containers with items.

Method: best-two-fit. A bin is filled greedily with the largest items that fit; then its smallest item is replaced by
two unpacked items that fill the widened gap more tightly, as long as such a pair exists.

Items of one size are alike, so bins are planned on the histogram of sizes, which has at most `capacity` entries
whatever the number of items. A filling that fits n times over is planned once and repeated n times. The plan's
slots then go to the items by their rank within their size; a size is ranked in as many hash buckets as its count asks
for, so one that a third of all items have is no single task's work.
"""

from __future__ import annotations

import bisect

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .base import SMALL, join_hot, map_batches
from .token_budget import token_counts

#: Items of one size that are ranked together in a task.
BUCKET_ROWS = 1_000_000


def _best_pair(sizes: np.ndarray, left: np.ndarray, low: int, high: int) -> tuple[int, int] | None:
    """Two unpacked sizes with the largest sum in (low, high]; sizes ascend, left holds their counts."""
    live = sizes[(left > 0) & (sizes < high)] if len(sizes) else sizes
    if not len(live):
        return None
    partner = np.searchsorted(live, high - live, side="right") - 1
    # where a size's best partner is itself and one item of it is left, the next smaller size is
    alone = left[np.searchsorted(sizes, live)] < 2
    partner -= (partner == np.arange(len(live))) & alone
    sums = np.where(partner >= 0, live + live[np.maximum(partner, 0)], 0)
    i = int(sums.argmax())
    return (int(live[i]), int(live[partner[i]])) if sums[i] > low else None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Fillings as (times, {size: number}); every size is at most `capacity`, and all items are used up."""
    sizes = np.array(sorted(s for s, n in counts.items() if n > 0), np.int64)
    left = np.array([counts[s] for s in sizes.tolist()], np.int64)
    where = {s: i for i, s in enumerate(sizes.tolist())}
    order = sizes.tolist()
    out: list[tuple[int, dict[int, int]]] = []
    while order:
        room, filled = capacity, {}
        hi = len(order)
        while room and hi:
            hi = bisect.bisect_right(order, room, 0, hi)
            if not hi:
                break
            s = order[hi - 1]
            n = min(room // s, int(left[where[s]]))
            filled[s] = n
            room -= n * s
            hi -= 1
        while room:
            smallest = min(filled)
            live = left.copy()
            for s, n in filled.items():
                live[where[s]] -= n
            pair = _best_pair(sizes, live, smallest, smallest + room)
            if pair is None:
                break
            filled[smallest] -= 1
            if not filled[smallest]:
                del filled[smallest]
            for s in pair:
                filled[s] = filled.get(s, 0) + 1
            room -= sum(pair) - smallest
        times = min(int(left[where[s]]) // n for s, n in filled.items())
        out.append((times, filled))
        for s, n in filled.items():
            left[where[s]] -= n * times
            if not left[where[s]]:
                order.pop(bisect.bisect_left(order, s))
    return out


def _slots(fillings: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each size: first rank, first bin and items in a bin of every filling that uses it, by rank."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    first_bin = 0
    for times, filled in fillings:
        for s, n in filled.items():
            rows.setdefault(s, []).append((taken.get(s, 0), first_bin, n))
            taken[s] = taken.get(s, 0) + n * times
        first_bin += times
    return {s: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for s, r in rows.items()}


def _joined(df: DataFrame, side: DataFrame, on: list[str], size: str, rows: int) -> DataFrame:
    """`df` with `side`, whose number of rows is known: broadcast if it is small, else by a shuffle that splits hot keys."""
    return df.join(F.broadcast(side), on) if rows <= SMALL else join_hot(df, side, on, size)


def pack(items: DataFrame, capacities: DataFrame) -> DataFrame:
    """Bins for items (item_id string, n_tokens) under every row of capacities (bin_kind, capacity_tokens).

    Out: bin_kind, bin_id, item_id, part, n_tokens. An item within the capacity is in one bin as part 0; a larger one
    alone fills whole bins and its rest is packed like an item, so only such items are divided. Items of null, zero or
    less tokens are left out, as are capacities of null or less than 1; repeated rows of an item_id count once.
    Equal bin kinds with different capacities are planned apart; their bin_id goes on. Empty tables give no rows.

    The driver gets the histograms (at most the sum of all capacities entries) and sends the slots back to the tasks
    (at most as many entries as the plan has different fillings times their sizes).
    """
    kinds = [
        (r.bin_kind, int(r.capacity_tokens))
        for r in capacities.where(F.col("capacity_tokens") >= 1)
        .groupBy("bin_kind", "capacity_tokens").count().orderBy("bin_kind", "capacity_tokens").collect()
    ]
    items = checkpointed(
        items.where((F.col("n_tokens") > 0) & F.col("item_id").isNotNull())
        .groupBy("item_id").agg(F.max("n_tokens").cast("long").alias("n_tokens"))
    )
    spark = items.sparkSession
    schema = "bin_kind string, bin_id long, item_id string, part int, n_tokens long"
    if not kinds:
        return spark.createDataFrame([], schema)
    caps = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(c).cast("long").alias("cap")) for i, (_, c) in enumerate(kinds)])
    cut = items.select("item_id", F.col("n_tokens").alias("whole"), F.explode(caps).alias("c")).select(
        "item_id",
        F.col("c.k").alias("k"),
        F.floor(F.col("whole") / F.col("c.cap")).alias("full"),
        F.pmod("whole", "c.cap").alias("rest"),
        F.col("c.cap").alias("cap"),
    )
    hist: dict[int, dict[int, int]] = {i: {} for i in range(len(kinds))}
    for r in cut.where(F.col("rest") > 0).groupBy("k", "rest").agg(F.count("*").alias("n")).collect():
        hist[r.k][r.rest] = r.n
    buckets = spark.createDataFrame([(k, s, -(-n // BUCKET_ROWS)) for k, h in hist.items() for s, n in h.items()], "k int, rest long, buckets int")
    bucket = F.pmod(F.xxhash64("item_id"), "buckets").cast("int").alias("bucket")
    # one row for each size of each capacity
    dealt = cut.where(F.col("rest") > 0).join(F.broadcast(buckets), ["k", "rest"]).select("k", "rest", bucket, "item_id", "full")
    sizes = dealt.groupBy("k", "rest", "bucket").agg(F.count("*").alias("n"))
    plans = {i: plan(hist[i], kinds[i][1]) for i in hist}
    shared = spark.sparkContext.broadcast({i: _slots(p) for i, p in plans.items()})
    bins = {i: sum(t for t, _ in p) for i, p in plans.items()}
    base = {}
    for i, (kind, _) in enumerate(kinds):
        base[i] = sum(bins[j] for j in range(i) if kinds[j][0] == kind)
    w = Window.partitionBy("k", "rest", "bucket").orderBy("item_id")
    earlier = Window.partitionBy("k", "rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begin = sizes.select("k", "rest", "bucket", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    n_buckets = sum(-(-n // BUCKET_ROWS) for h in hist.values() for n in h.values())
    ranked = (
        _joined(dealt.withColumn("r", F.row_number().over(w) - 1), begin, ["k", "rest", "bucket"], "n", n_buckets)
        .select("k", "rest", (F.col("begin") + F.col("r")).alias("rank"), "item_id", "full")
    )
    names = [kind for kind, _ in kinds]

    def assign(batches):
        slots = shared.value
        for b in batches:
            o = {k: [] for k in ("bin_kind", "bin_id", "item_id", "part", "n_tokens")}
            for k, rest, rank, item, full in zip(*(b[c] for c in ("k", "rest", "rank", "item_id", "full")), strict=True):
                first, bin0, n = slots[k][rest]
                i = int(np.searchsorted(first, rank, side="right")) - 1
                o["bin_kind"].append(names[k])
                o["bin_id"].append(base[k] + int(bin0[i]) + (rank - int(first[i])) // int(n[i]))
                o["item_id"].append(item)
                o["part"].append(full)
                o["n_tokens"].append(rest)
            yield o

    packed = map_batches(ranked, assign, schema)
    # bins that a divided item fills alone: numbered after the planned ones, by a running count in each bucket
    kind_of = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("k") + 1)
    large = cut.where(F.col("full") > 0)
    counts = {r.k: r.n for r in large.groupBy("k").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return packed
    buckets = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, -(-n // BUCKET_ROWS))]), F.col("k"))
    planned = F.element_at(F.create_map(*[F.lit(x) for k in counts for x in (k, sum(bins[j] for j in bins if kinds[j][0] == kinds[k][0]))]), F.col("k"))
    large = large.withColumn("bucket", F.pmod(F.xxhash64("item_id"), buckets).cast("int"))
    before = Window.partitionBy("kind").orderBy("k", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    at = large.groupBy("k", "bucket").agg(F.sum("full").alias("n"), F.count("*").alias("rows")).withColumn("kind", kind_of)
    at = at.select("k", "bucket", "rows", (planned + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("offset"))
    run = Window.partitionBy("k", "bucket").orderBy("item_id").rowsBetween(Window.unboundedPreceding, -1)
    alone = (
        _joined(large.withColumn("before", F.coalesce(F.sum("full").over(run), F.lit(0))), at, ["k", "bucket"], "rows", sum(-(-n // BUCKET_ROWS) for n in counts.values()))
        .select("k", "item_id", "cap", (F.col("offset") + F.col("before")).alias("at"), F.posexplode(F.sequence(F.lit(1), F.col("full"))).alias("part", "_n"))
        .select(
            kind_of.alias("bin_kind"), (F.col("at") + F.col("part")).cast("long").alias("bin_id"), "item_id",
            F.col("part").cast("int").alias("part"), F.col("cap").alias("n_tokens"),
        )
    )
    return packed.unionByName(alone)


def pack_documents(documents: DataFrame, capacities: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """`pack` of every document by its tokens: bin_kind, bin_id, doc_id, part, n_tokens. Null and '' texts have no
    tokens and get no bin."""
    rows = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("string").alias("item_id"), "text")
    out = pack(token_counts(rows, tokenizer), capacities)
    return out.select("bin_kind", "bin_id", F.col("item_id").cast("long").alias("doc_id"), "part", "n_tokens")


def fill_report(bins: DataFrame, capacities: DataFrame) -> DataFrame:
    """bin_kind, capacity_tokens, n_bins, n_items, n_tokens, fill (share of all space that is used)."""
    each = bins.groupBy("bin_kind", "bin_id").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_items"))
    total = each.groupBy("bin_kind").agg(
        F.count("*").alias("n_bins"), F.sum("n_items").alias("n_items"), F.sum("n_tokens").alias("n_tokens")
    )
    caps = capacities.groupBy("bin_kind").agg(F.max("capacity_tokens").alias("capacity_tokens"))
    return total.join(caps, "bin_kind").select(
        "bin_kind", "capacity_tokens", "n_bins", "n_items", "n_tokens",
        F.round(F.col("n_tokens") / (F.col("n_bins") * F.col("capacity_tokens")), 6).alias("fill"),
    )
