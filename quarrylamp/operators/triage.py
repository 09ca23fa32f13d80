"""Topic triage: weighted capped term counts, bonuses, penalty, hits and snippets, rank, tiers.

The plan is projections with a generated count for each term: no join, no shuffle before the top-k, and the text column
is read once. Terms are counted in blocks of BLOCK, a projection each, and summed by a loop over the counted array, so
generated code stays small however long the list is.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.config import load_yaml
from ..session import spread

#: Defaults (fixed values): weights of the tiers, bonus of a tier that is hit, extensions of bulk data.
WEIGHTS = {"high": 10, "medium": 3, "low": 1}
TIER_BONUS = {"high": 10, "medium": 3}
DATA_EXTS = [".csv", ".xls", ".xlsx"]
#: Terms that one projection counts.
BLOCK = 40


@dataclass(frozen=True)
class Topic:
    """A term list in three tiers. Order counts: snippets and equal hits follow it."""

    name: str
    high: tuple[str, ...] = ()
    medium: tuple[str, ...] = ()
    low: tuple[str, ...] = ()
    description: str = ""
    weights: dict[str, int] = field(default_factory=lambda: dict(WEIGHTS))

    def terms(self) -> list[tuple[str, str]]:
        return [(t, x) for t, xs in (("high", self.high), ("medium", self.medium), ("low", self.low)) for x in xs]

    @classmethod
    def load(cls, path: str | Path) -> Topic:
        """From YAML with high_signal, medium_signal and low_signal; a missing file raises FileNotFoundError."""
        data = load_yaml(path)
        tiers = {k: tuple(map(str, data.get(f"{k}_signal") or ())) for k in WEIGHTS}
        return cls(str(data.get("topic", Path(path).stem)), description=str(data.get("description", "")), **tiers)


def _cap(tier: str, low_cap: int, mid_cap: int) -> int | None:
    return {"low": low_cap, "medium": mid_cap}.get(tier)


def with_hits(records: DataFrame, topic: Topic) -> DataFrame:
    """records with `hits`: array<struct<term, tier, ord, n>> of all terms in order, n occurrences."""
    one = [
        F.struct(
            F.lit(x).alias("term"), F.lit(t).alias("tier"), F.lit(i).alias("ord"), tx.term_count("text", x).cast("int").alias("n")
        )
        for i, (t, x) in enumerate(topic.terms())
    ]
    kind = "array<struct<term:string,tier:string,ord:int,n:int>>"
    out, names = records, []
    for k in range(0, len(one), BLOCK):
        # through a generator of one row, so that the counts are made once and not wherever they are used
        names.append(f"_hits{k}")
        out = out.select("*", F.explode(F.array(F.array(*one[k : k + BLOCK]))).alias(names[-1]))
    return out.withColumn("hits", F.concat(*names) if names else F.array().cast(kind)).drop(*names)


def _of_tier(tier: str):
    return lambda h: h["tier"] == tier


def score(
    records: DataFrame,
    topic: Topic,
    low_cap: int = 5,
    mid_cap: int = 30,
    min_score: int = 1,
    data_penalty: float = 0.25,
    div_bonus: int = 5,
) -> DataFrame:
    """Scored rows that reach min_score: id, path, ext, lang, char_count, score, raw_score, n_unique_terms, high_hits,
    hits (matched terms only).

    raw_score sums weight times capped count; min_score is tested on it. The score adds a bonus for each upper tier
    that is hit and for each distinct term, and bulk data without a high term is scaled down; it is rounded half-even
    to one place. A term in two tiers scores twice and counts once as distinct. Null and empty texts match nothing.
    """
    counted = with_hits(spread(records.where(F.coalesce("text", F.lit("")) != "")), topic)

    def points(h: Column) -> Column:
        out = F.lit(0)
        for tier, weight in topic.weights.items():
            cap = _cap(tier, low_cap, mid_cap)
            out = F.when(h["tier"] == tier, weight * (h["n"] if cap is None else F.least(h["n"], F.lit(cap)))).otherwise(out)
        return out.cast("long")

    raw = F.aggregate("hits", F.lit(0).cast("long"), lambda total, h: total + points(h))
    hit = F.filter("hits", lambda h: h["n"] > 0)
    out = counted.withColumn("raw_score", raw).withColumn("hits", hit).where(F.col("raw_score") >= min_score)
    distinct = F.size(F.array_distinct(F.transform("hits", lambda h: h["term"])))
    high = F.size(F.array_distinct(F.transform(F.filter("hits", lambda h: h["tier"] == "high"), lambda h: h["term"])))
    bonus = F.lit(0)
    for tier, b in TIER_BONUS.items():
        bonus = bonus + F.when(F.exists("hits", _of_tier(tier)), b).otherwise(0)
    out = out.withColumn("n_unique_terms", distinct).withColumn("high_hits", high)
    total = F.col("raw_score") + bonus + div_bonus * F.col("n_unique_terms")
    ext = F.coalesce(tx.suffix("path"), F.lit(""))
    scaled = F.when(ext.isin(DATA_EXTS) & (F.col("high_hits") == 0), total * data_penalty).otherwise(total.cast("double"))
    return out.withColumn("score", F.bround(scaled, 1))


def hits_string(hits: str = "hits") -> Column:
    """'term×n' by falling count, equal counts in the topic's order; a term in two tiers shows once."""
    first = F.filter(hits, lambda h, i: ~F.exists(F.slice(hits, 1, i), lambda g: g["term"] == h["term"]))
    keyed = F.array_sort(F.transform(first, lambda h: F.struct((-h["n"]).alias("k"), h["ord"].alias("o"), h["term"].alias("term"))))
    return F.array_join(F.transform(keyed, lambda h: F.concat(h["term"], F.lit("×"), (-h["k"]).cast("string"))), ", ")


def snippets_string(topic: Topic, chars: int = 160, most: int = 3) -> Column:
    """'[term] snippet' of the first matching high and medium terms in order, joined by ' || '."""
    each = [
        F.when((s := tx.snippet("text", x, chars)).isNotNull(), F.concat(F.lit(f"[{x}] "), s))
        for t, x in topic.terms()
        if t != "low"
    ]
    return F.array_join(F.slice(F.array_compact(F.array(*each)), 1, most), " || ") if each else F.lit("")


def rank(records: DataFrame, topic: Topic, top: int = 300, snippet_chars: int = 160, **options) -> DataFrame:
    """The `top` best rows with hits and snippets as text. Equal scores go by id, then by place. Snippets are made
    after the cut, for `top` rows only. No match gives an empty table."""
    scored = score(records, topic, **options)
    place = [c for c in ("shard_file", "line_no") if c in records.columns]
    best = scored.orderBy(F.desc("score"), "id", *place).limit(top)
    return best.select(
        "id", "path", "lang", F.coalesce("char_count", F.lit(0)).alias("char_count"), "score", "raw_score", "n_unique_terms", "high_hits",
        hits_string().alias("hits"), snippets_string(topic, snippet_chars).alias("snippet"),
    )


def classify(df: DataFrame, internal: str, external: str, path: str = "path") -> DataFrame:
    """df with tier. A high term makes tier1; so does a path of an internal area (Java pattern, any case) with
    ideographs, unless it looks like an attachment from outside (pattern, case counts); all else is tier2."""
    inside = F.col(path).rlike(f"(?i){internal}") & tx.has_cjk(path) & ~F.col(path).rlike(external)
    return df.withColumn(
        "tier", F.when(F.coalesce("high_hits", F.lit(0)) > 0, "tier1").when(F.coalesce(inside, F.lit(False)), "tier1").otherwise("tier2")
    )
