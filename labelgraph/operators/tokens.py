"""Token arrays and metrics (FN-15..17, AG-06/07).

Token ids come from any ARRAY column; the default tokenizer is Python-style whitespace split
with ids hashed into a fixed vocabulary (a real sub-word tokenizer can be applied with
``labelgraph.udf.batched_map``). Everything here is built-in array/aggregate expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.functions.text import col_

VOCAB_SIZE = 50_000


def hashed_ids(tokens: Column | str, vocab_size: int = VOCAB_SIZE) -> Column:
    """Token id = 1 + (first 8 hex digits of md5(token)) mod (vocab_size - 1); 0 is padding."""
    return F.transform(col_(tokens), lambda t: (F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long") % (vocab_size - 1) + 1).cast("int"))


def truncate_pad(ids: Column | str, max_length: int = K.MAX_LENGTH, pad_id: int = K.PAD_ID) -> tuple[Column, Column]:
    """``(input_ids, attention_mask)`` truncated to ``max_length`` then right-padded to it."""
    t = F.slice(col_(ids), 1, max_length)
    fill = F.greatest(F.lit(0), F.lit(max_length) - F.size(t))
    input_ids = F.concat(t, F.array_repeat(F.lit(pad_id), fill))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(t)), F.array_repeat(F.lit(0), fill))
    return input_ids, mask


def causal_labels(input_ids: Column | str, attention_mask: Column | str, mask_pad: bool = True, ignore_index: int = K.IGNORE_INDEX) -> Column:
    """Labels = copy of ids; with ``mask_pad`` padding positions become ``ignore_index``."""
    ids = col_(input_ids)
    if not mask_pad:
        return ids
    return F.transform(F.arrays_zip(ids.alias("i"), col_(attention_mask).alias("m")), lambda z: F.when(z["m"] == 1, z["i"]).otherwise(F.lit(ignore_index)))


def batch_longest_pad(df: DataFrame, ids: str, seq: str, batch_size: int, pad_id: int = K.PAD_ID, size: str | None = None) -> DataFrame:
    """Pad each row, whole, to the longest row of its batch ``floor(seq / batch_size)``.

    The longest size is a partial aggregate by batch that is joined back, so the arrays are never
    sorted. ``size`` names a column that holds the arrays' sizes, where one is known without them.
    """
    n = F.col(size) if size else F.size(ids)
    d = df.withColumn("batch", F.floor(F.col(seq) / batch_size).cast("long"))
    longest = d.groupBy(F.col("batch").alias("_batch")).agg(F.max(n).alias("batch_len"))
    d = d.join(longest, F.col("batch").eqNullSafe(F.col("_batch"))).drop("_batch")
    return d.withColumn("padded", F.concat(ids, F.array_repeat(F.lit(pad_id), F.col("batch_len") - F.size(ids))))


def masked_accuracy(pairs: DataFrame, pred: str = "pred", label: str = "label", ignore_index: int = K.IGNORE_INDEX) -> DataFrame:
    """``(n_correct, n_total, accuracy)`` over positions whose label is not ``ignore_index``.

    Partial + final hash aggregate; all positions masked gives NULL accuracy.
    """
    keep = F.col(label) != F.lit(ignore_index)
    agg = pairs.agg(
        F.count_if(keep & (F.col(pred) == F.col(label))).alias("n_correct"),
        F.count_if(keep).alias("n_total"),
    )
    return agg.withColumn("accuracy", F.when(F.col("n_total") > 0, F.col("n_correct") / F.col("n_total")))


def shift_pairs(tokens: DataFrame, seq: str = "seq", pos: str = "pos", shift: int = 1) -> DataFrame:
    """Next-token alignment: prediction at ``pos`` against the label at ``pos + shift``.

    An equi-join on (seq, pos), so a very long sequence is spread by position.
    """
    p = tokens.select(seq, F.col(pos).alias("_p"), "pred")
    lab = tokens.select(seq, (F.col(pos) - shift).alias("_p"), "label")
    return p.join(lab, [seq, "_p"]).select(seq, F.col("_p").alias(pos), "pred", "label")


def argmax(v: Column | str) -> Column:
    """Index of the first maximum (0-based), like ``numpy.argmax`` over the last axis."""
    c = col_(v)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")
