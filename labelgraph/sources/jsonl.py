"""JSONL source and sink (SRC-05, SNK-01, SNK-02) with declared schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgraph.functions.pyjson import json_of

TURN = T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType())])
SAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("conversations", T.ArrayType(TURN)),
    ]
)
QA_SCHEMA = T.StructType([T.StructField("instruction", T.StringType()), T.StructField("output", T.StringType())])


def write_jsonl(df: DataFrame, path: str, single_file: bool = False, skip_empty: bool = True) -> int:
    """Overwrite ``path`` with one JSON object per line (a directory of part files), each line
    byte-equal to Python's ``json.dumps``; returns the number of rows written, counted by an
    ``observe`` metric during the write itself (no second pass over the data).

    ``single_file`` coalesces to one part (only for small outputs). With ``skip_empty`` an
    empty frame writes nothing and returns 0, like the original's "no output when empty"
    (``isEmpty`` stops at the first row).
    """
    if skip_empty and df.isEmpty():
        return 0
    obs = Observation("jsonl_rows")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    out = out.coalesce(1) if single_file else out
    line = json_of(F.struct(*[F.col(f"`{c}`") for c in df.columns]), df.schema)
    out.select(line.alias("value")).write.mode("overwrite").text(path)
    return int(obs.get["rows"])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, SAMPLE_SCHEMA)


def read_qa(spark: SparkSession, path: str) -> DataFrame:
    return read_jsonl(spark, path, QA_SCHEMA)
