"""Train/eval splits and subsamples (SL-02..04, SO-04).

``hash`` mode is stateless and append-stable: a row's split depends only on its key and the
seed, so no shuffle and no global state. ``exact`` mode gives exactly ``ceil(frac * n)`` eval
rows (the smallest scores) without a global sort: a 16-bit histogram per level narrows the
cut-off to rows sharing one 48-bit score, and only those are numbered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.functions.text import col_

SCORE_BITS = 48


def score48(*parts: Column | str, seed: str = K.DEFAULT_SEED) -> Column:
    """48-bit score from the first 12 hex digits of md5(seed:part...)."""
    text = F.concat_ws(":", F.lit(seed), *[col_(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def bucket1000(*parts: Column | str, seed: str = K.DEFAULT_SEED) -> Column:
    """Bucket 0..999 from the first 8 hex digits of md5(seed:part...)."""
    text = F.concat_ws(":", F.lit(seed), *[col_(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 1000


def split_hash(df: DataFrame, key: str, seed: str = K.DEFAULT_SEED, eval_per_mille: int = 100) -> DataFrame:
    """Add ``split`` = 'eval' for rows whose key hashes below ``eval_per_mille``/1000, else 'train'.

    Use a group column (e.g. the source) as ``key`` to keep whole groups on one side.
    """
    return df.withColumn("split", F.when(bucket1000(key, seed=seed) < eval_per_mille, "eval").otherwise("train"))


def bucket_at(hist: list[tuple[int, int]], remaining: int) -> tuple[int | None, int, int]:
    """The bucket that holds the ``remaining``-th smallest row (None when there are fewer rows), the
    rows before it and its own."""
    before = 0
    for value, n in sorted(hist):
        if before + n >= remaining:
            return value, before, n
        before += n
    return None, before, 0


def mark_smallest(df: DataFrame, score: Column, k: int, tiebreak: list[str], col: str) -> DataFrame:
    """Add boolean ``col``: true for exactly the ``k`` rows with the smallest (score, tiebreak).

    Three histogram passes over 16-bit slices of the 48-bit score (each histogram has at most
    65,536 rows) find the score at the cut. Rows with that score (equal keys, or hash collisions)
    are numbered on the cluster, so repeated and null keys count row by row; which of several
    rows equal in all ``tiebreak`` columns come first is not fixed.
    """
    if k <= 0:
        return df.withColumn(col, F.lit(False))
    scored = df.withColumn("_score", score)
    cur = scored.select("_score")
    remaining, prefix = k, 0
    for shift in (32, 16, 0):
        b = F.shiftright(F.col("_score"), shift).bitwiseAND(0xFFFF)
        chosen, before, at_value = bucket_at([(r[0], r[1]) for r in cur.groupBy(b.alias("b")).count().collect()], remaining)
        if chosen is None:  # no more rows than k: everything qualifies
            return df.withColumn(col, F.lit(True))
        remaining -= before
        prefix = (prefix << 16) | int(chosen)
        cur = cur.where(b == F.lit(chosen))
    if at_value == remaining:  # all rows at the cut fit: nothing to number
        return scored.withColumn(col, F.col("_score") <= F.lit(prefix)).drop("_score")
    at_cut = F.col("_score") == F.lit(prefix)
    from labelgraph.operators.sequence import sequence_number

    tied = sequence_number(scored.where(at_cut), tiebreak, col="_rank")
    tied = tied.withColumn(col, F.col("_rank") < F.lit(remaining)).drop("_rank")
    return scored.where(~at_cut).withColumn(col, F.col("_score") < F.lit(prefix)).unionByName(tied).drop("_score")


def split_exact(df: DataFrame, key: str, seed: str = K.DEFAULT_SEED, eval_fraction: float = K.EVAL_FRACTION) -> DataFrame:
    """Exactly ``ceil(eval_fraction * n)`` eval rows: the smallest 48-bit key scores, then the
    smallest keys; rows with equal or null keys are split row by row."""
    k = math.ceil(eval_fraction * df.count() - 1e-9)
    marked = mark_smallest(df, score48(key, seed=seed), k, [key], "_eval")
    return marked.withColumn("split", F.when(F.col("_eval"), "eval").otherwise("train")).drop("_eval")


def first_n(df: DataFrame, n: int, order: list[Column | str], strict: bool = False) -> DataFrame:
    """The first ``n`` rows in ``order`` (a top-k, not a global sort). ``strict`` raises when short."""
    out = df.orderBy(*order).limit(n)
    if strict and out.count() < n:
        raise ValueError(f"asked for {n} rows, only {out.count()} available")
    return out


def eval_cap(n_train: int) -> int:
    """Eval subsample size used with a train subsample of ``n_train``: ``max(1, int(0.1 * n))``."""
    return max(1, int(K.EVAL_FRACTION * n_train))


def curriculum(stage1: DataFrame | None, stage2: DataFrame, skip_stage1: bool = False) -> DataFrame:
    """Stage-1 text rows then stage-2 rows, tagged by ``stage`` (both frames: key, text)."""
    s2 = stage2.select(F.lit(2).alias("stage"), "key", "text")
    if skip_stage1 or stage1 is None:
        return s2
    return stage1.select(F.lit(1).alias("stage"), "key", "text").unionByName(s2)
