"""Exact train/eval split of a table that grows (SL-04): stored scores and mergeable histograms.

Each batch of rows is scored once and stored in score order with a histogram of the scores' upper
16 bits. Histograms add up, so after an append the cut is found from at most 65,536 summed counts
and the rows of one histogram bucket; the documents of earlier batches are never read again. Between two cuts
only the rows whose scores lie between them change sides, and Parquet's statistics limit a read to those.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.operators.splits import bucket_at, score48

#: Rows of one stored file, in score order.
ROWS_PER_FILE = 2_000_000
_LEVELS = (32, 16, 0)


@dataclass(frozen=True)
class Cut:
    """Rows with a score below ``score`` are eval rows, and of those with this very score the first ``at_cut``
    by batch and key, so that a later batch changes no row's place. ``rows`` is the number of all rows, ``batches`` those the cut is about."""

    score: int
    at_cut: int
    rows: int
    batches: tuple[int, ...]


def append_batch(df: DataFrame, key: str, path: str, batch: int, seed: str = K.DEFAULT_SEED) -> None:
    """Store the scores and the histogram of one batch of rows below ``path``.

    ``batch`` is a number from 0 that names the batch: writing it again replaces it, so a failed or repeated
    append leaves no row twice. Null and repeated keys are rows like any other; an empty batch is allowed.
    """
    scored = df.select(F.col(f"`{key}`").alias("key"), score48(F.col(f"`{key}`"), seed=seed).alias("score"))
    target = f"{path}/scores/batch={int(batch)}"
    files = max(1, -(-df.count() // ROWS_PER_FILE))
    scored.repartitionByRange(files, "score", "key").sortWithinPartitions("score", "key").write.mode("overwrite").parquet(target)
    stored = df.sparkSession.read.schema(scored.schema).parquet(target)
    counts = stored.groupBy(F.shiftright("score", _LEVELS[0]).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/histogram/batch={int(batch)}")


def _stored(spark: SparkSession, path: str, part: str, batches: tuple[int, ...] | None) -> DataFrame:
    df = spark.read.option("basePath", f"{path}/{part}").parquet(f"{path}/{part}")
    return df if batches is None else df.where(F.col("batch").isin(*batches))


def find_cut(spark: SparkSession, path: str, eval_fraction: float = K.EVAL_FRACTION, batches: tuple[int, ...] | None = None) -> Cut:
    """The cut for exactly ``ceil(eval_fraction * n)`` eval rows of the given batches (all by default)."""
    counts = _stored(spark, path, "histogram", batches)
    # at most 65,536 rows whatever the number of batches
    hist = [(r[0], r[1]) for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()]
    known = tuple(sorted(r[0] for r in counts.select("batch").distinct().collect()))
    known = tuple(sorted(batches)) if batches is not None else known
    rows = sum(n for _, n in hist)
    remaining = math.ceil(eval_fraction * rows - 1e-9)
    if remaining <= 0:
        return Cut(0, 0, rows, known)
    prefix, at_value = 0, 0
    for shift in _LEVELS:
        if shift != _LEVELS[0]:
            low = prefix << (shift + 16)
            inside = _stored(spark, path, "scores", known).where(F.col("score").between(low, low + (1 << (shift + 16)) - 1))
            bucket = F.shiftright("score", shift).bitwiseAND(0xFFFF)
            hist = [(r[0], r[1]) for r in inside.groupBy(bucket.alias("b")).count().collect()]
        chosen, before, at_value = bucket_at(hist, remaining)
        remaining -= before
        prefix = (prefix << 16) | int(chosen)
    return Cut(prefix, remaining, rows, known)


def _is_eval(spark: SparkSession, path: str, cut: Cut, rows: DataFrame, col: str) -> DataFrame:
    """Add boolean ``col``; only rows with the very score of the cut are numbered."""
    from labelgraph.operators.sequence import sequence_number

    at_cut = F.col("score") == F.lit(cut.score)
    below = rows.where(~at_cut).withColumn(col, F.col("score") < F.lit(cut.score))
    tied = sequence_number(rows.where(at_cut), ["batch", "key"], col="_rank")
    return below.unionByName(tied.withColumn(col, F.col("_rank") < F.lit(cut.at_cut)).drop("_rank"))


def split_at(spark: SparkSession, path: str, cut: Cut) -> DataFrame:
    """``(key, split)`` of every stored row of the cut's batches, read from the stored scores alone."""
    rows = _stored(spark, path, "scores", cut.batches).select("key", "score", "batch")
    marked = _is_eval(spark, path, cut, rows, "_eval")
    return marked.select("key", F.when(F.col("_eval"), "eval").otherwise("train").alias("split"))


def moved(spark: SparkSession, path: str, old: Cut, new: Cut) -> DataFrame:
    """``(key, score, was, split)``: the rows of ``old``'s batches that change sides at ``new``.

    Only scores from one cut to the other are read. ``new`` has the batches of ``old`` and later ones.
    """
    from labelgraph.operators.sequence import sequence_number

    low, high = sorted((old.score, new.score))
    rows = _stored(spark, path, "scores", old.batches).select("key", "score", "batch").where(F.col("score").between(low, high))

    def side(flag: str) -> Column:
        return F.when(F.col(flag), "eval").otherwise("train")

    ranked = sequence_number(rows, ["batch", "key"], group_cols=["score"], col="_rank")
    for flag, cut in (("_old", old), ("_new", new)):
        below = F.col("score") < F.lit(cut.score)
        ranked = ranked.withColumn(flag, below | ((F.col("score") == F.lit(cut.score)) & (F.col("_rank") < F.lit(cut.at_cut))))
    return ranked.where("_old <> _new").select("key", "score", side("_old").alias("was"), side("_new").alias("split"))
