"""What the operators of this package share: table access, Arrow row mapping, tokenizers, labels."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

TOKENIZER_DIR = "/opt/tokenizers"
#: Pre-token pattern of the byte-level vocabularies (fixed value, from their README).
BYTE_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encodings: dict[str, object] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def byte_bpe(path: str | None = None):
    """The byte_bpe_50k encoding; loaded once for each worker process and path."""
    path = path or os.path.join(TOKENIZER_DIR, "byte_bpe_50k.tiktoken")
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding(
            os.path.basename(path), pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _encodings[path]


def map_batches(
    df: DataFrame,
    fn: Callable[[Iterator[dict[str, list]]], Iterable[dict[str, list]]],
    schema: str | T.StructType,
    raw: tuple[str, ...] = (),
) -> DataFrame:
    """Runs `fn` on an iterator over column dicts (name -> list), one for each Arrow batch, and takes column
    dicts back. Rows keep the partition's order; batches that `fn` leaves out are dropped. Columns in `raw` stay
    Arrow arrays."""
    spark_schema = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    arrow = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns() -> Iterator[dict[str, list]]:
            for b in batches:
                if b.num_rows:
                    yield {
                        n: b.column(i) if n in raw else b.column(i).to_pylist() for i, n in enumerate(b.schema.names)
                    }

        for out in fn(columns()):
            yield pa.RecordBatch.from_arrays(
                [
                    v if isinstance(v := out[f.name], pa.Array) else pa.array(v, type=f.type)
                    for f in arrow
                ],
                schema=arrow,
            )

    return df.mapInArrow(run, spark_schema)


def has_text(c: str | Column = "text") -> Column:
    """True for text that is neither null nor only white space."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).rlike(r"(?U)\S")


def path_source(path: str | Column) -> Column:
    """First segment of a path; null for a null path."""
    return F.substring_index(F.col(path) if isinstance(path, str) else path, "/", 1)


#: Codes and names under which labels name the languages of this corpus (fixed values: ISO 639 and usual names).
LANG_NAMES = {
    "zh": ["zh", "zho", "chi", "cmn", "chinese"],
    "en": ["en", "eng", "english"],
    "fr": ["fr", "fra", "fre", "french"],
    "ru": ["ru", "rus", "russian"],
    "es": ["es", "spa", "spanish"],
    "de": ["de", "deu", "ger", "german"],
}


def label_lang(c: str | Column) -> Column:
    """Two-letter language that a label names: its spelling, case and region are dropped; '' when it names none.

    Labels of other languages come out as their lower-case first part ('it', 'ko')."""
    c = F.col(c) if isinstance(c, str) else c
    base = F.regexp_extract(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"^([a-z]+)", 1)
    out = F.when(base.isin("", "und", "unknown", "mul", "mis", "zxx", "none", "null", "n", "na"), F.lit(""))
    for code, names in LANG_NAMES.items():
        out = out.when(base.isin(names), F.lit(code))
    return out.otherwise(base)


def source_domains(sources: DataFrame) -> DataFrame:
    """One row for each source with its filled domain (null where it never has one)."""
    return sources.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("domain").alias("domain"))


def one_row_per_id(records: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of one id count once, by the row that has text (the longest text, then the latest place decides)."""
    cols = [c for c in dict.fromkeys(columns) if c != "id"]
    rank = F.struct(
        F.length(F.coalesce("text", F.lit(""))),
        F.coalesce("shard_file", F.lit("")),
        F.coalesce("line_no", F.lit(-1)),
    )
    return (
        records.where(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.max_by(F.struct(*cols), rank).alias("r"))
        .select("id", *[F.col(f"r.{c}").alias(c) for c in cols])
    )


#: Rows up to which a counted side of a join is broadcast.
SMALL = 200_000


def join_counted(df: DataFrame, side: DataFrame, on: str | list[str], how: str) -> DataFrame:
    """`df` joined with `side`, which is counted first (so it should be stored or cheap): up to SMALL rows it is
    broadcast and `df` stays where it is; a larger one is joined by a shuffle of both."""
    return df.join(F.broadcast(side) if side.count() <= SMALL else side, on, how)


def join_hot(df: DataFrame, side: DataFrame, on: list[str], size: str) -> DataFrame:
    """`df` joined (inner) with `side`, one row for each key, whose column `size` counts the key's rows in `df`.

    Keys that hold more than a thousandth of the counted rows are a thousand at most; they are broadcast, so that none is
    one task's work. All other keys meet by a shuffle.
    """
    total = side.agg(F.sum(size).alias("n")).collect()[0].n or 0
    large = F.col(size) > max(10_000, total // 1000)
    hot = side.where(large)
    if not side.where(large).take(1):
        return df.join(side, on)
    rest = df.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return df.join(F.broadcast(hot), on).unionByName(rest.join(side.where(~large), on))


#: Members of one class that a task puts in together.
DEALT = 4096


def put_members(df: DataFrame, at: str, members: DataFrame) -> DataFrame:
    """`df` with the id that stands for a class in column `at` replaced by each of the class's members (rep, id, n; n the
    size of the class, the standing id among them). Other ids stay. Members of a large class are dealt over parts, so that
    no task gets them all."""
    parts = F.ceil(F.col("n") / F.lit(DEALT)).cast("int")
    sizes = members.where(F.col("id") == F.col("rep")).select(F.col("rep").alias(at), "n")
    sized = df.join(sizes, at, "left")
    dealt = sized.where("n is not null").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n")
    each = members.select(F.col("rep").alias(at), F.pmod(F.xxhash64("id"), parts).cast("int").alias("_part"), F.col("id").alias("_id"))
    put = dealt.join(each, [at, "_part"]).withColumn(at, F.col("_id")).select(*df.columns)
    return put.unionByName(sized.where("n is null").select(*df.columns))
