"""Membership filter of a fixed size (a blocked Bloom filter), in built-in expressions.

A value's hash names one block of 32,768 bits and PROBES bits in it. Tasks set the bits of their rows
and the blocks are merged by aggregation, so the filter has at most 2^BLOCK_BITS rows of 4 KB
whatever the input, which is what makes its broadcast safe. It never misses a member; with far
more values than bits it lets others pass, which costs work in the exact join that has to follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of 4 KB: 2^12 make 16 MB.
BLOCK_BITS = 12
#: Bits of a block, as the built-in bitmaps have them, and the bits set for a value.
BIT_BITS, PROBES = 15, 3


def _places(value: Column, block_bits: int) -> tuple[Column, list[Column]]:
    """Block of a value and its bits: separate bits of two hashes."""
    h, g = F.xxhash64(value), F.xxhash64(value, F.lit(1))
    mask = F.lit((1 << BIT_BITS) - 1)
    bits = [F.shiftright(g, BIT_BITS * i).bitwiseAND(mask) for i in range(PROBES)]
    return h.bitwiseAND(F.lit((1 << block_bits) - 1)), bits


def member_filter(values: DataFrame, col: str, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``(block, bits)``: the filter over the non-null values of ``col``; repeats change nothing."""
    block, bits = _places(F.col(f"`{col}`"), block_bits)
    rows = values.where(F.col(f"`{col}`").isNotNull()).select(block.alias("block"), F.explode(F.array(*bits)).alias("bit"))
    return rows.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def may_contain(df: DataFrame, col: str, held: DataFrame, flag: str, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Add boolean ``flag``: false only for rows whose ``col`` is null or surely not in the filter."""
    block, bits = _places(F.col(f"`{col}`"), block_bits)
    # at most 2^block_bits rows of 4 KB, so the broadcast has a proven bound
    held = F.broadcast(held.select(F.col("block").alias("_block"), F.col("bits").alias("_bits")))
    out = df.withColumn("_at", block).join(held, F.col("_at") == F.col("_block"), "left")

    def is_set(bit: Column) -> Column:
        byte = F.substring("_bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), bit.bitwiseAND(F.lit(7)).cast("int")) == 1

    found = is_set(bits[0])
    for bit in bits[1:]:
        found = found & is_set(bit)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(found & F.col(f"`{col}`").isNotNull(), F.lit(False)).alias(flag))

