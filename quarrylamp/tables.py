"""Table access: the stored tables, and schemas of the ones this engine reads from text formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("ext", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("char_count", T.LongType()),
        T.StructField("n_elements", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("ocr", T.BooleanType()),
    ]
)

TRIAGE_SCHEMA = (
    "id string, path string, lang string, char_count bigint, score double, raw_score bigint, "
    "n_unique_terms int, high_hits int, hits string, snippet string"
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
