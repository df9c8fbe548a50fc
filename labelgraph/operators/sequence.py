"""Dense sequence numbers without a single-partition window (WN-01, WN-02).

``row_number() over (order by k)`` without a partition clause pulls every row into one task.
Instead: range-partition on the order key, number rows inside each partition, and add the
count of all rows in earlier partitions. The per-partition count table has one row per
(partition, group) and is the only thing a window runs over. A hot group that holds a third of
the rows is spread over many range partitions, so no task sees more than its share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelgraph.session import cut_lineage

_PID, _IDX = "_seq_pid", "_seq_idx"


#: Rows of a range, and bytes of text in it: long texts make for shorter ranges.
ROWS_PER_PARTITION, BYTES_PER_PARTITION = 2_000_000, 128 << 20


def sequence_number(
    df: DataFrame,
    order_cols: list[str],
    group_cols: list[str] | None = None,
    col: str = "seq",
    start: int = 0,
    num_partitions: int | None = None,
    rows_per_partition: int = ROWS_PER_PARTITION,
) -> DataFrame:
    """Add ``col`` = ``start`` + rank of the row in ``order_cols`` order (within ``group_cols``).

    Order keys must be unique within a group for the numbering to be deterministic.
    The input and the range-partitioned rows are stored in the shared folder, so counting,
    sampling, numbering and the join back all see the same rows, also after executor loss. The
    number of ranges follows the row count and the bytes of text, without an upper limit.
    """
    groups = list(group_cols or [])
    keys = groups + list(order_cols)
    src = cut_lineage(df, "numbering-input")
    n = num_partitions
    if not n:
        texts = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, t in src.dtypes if t == "string"]
        size = sum(texts, F.lit(0).cast("long"))
        rows, held = src.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
        n = max(1, -(-rows // rows_per_partition), -(-held // BYTES_PER_PARTITION))
    ranged = src.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    pid, mono = F.spark_partition_id(), F.monotonically_increasing_id()
    # the id holds the partition above 33 bits of row number; more rows would run into it
    fits = F.shiftright(mono, 33) == pid
    idx = F.when(fits, mono - F.shiftleft(pid.cast("long"), 33)).otherwise(F.raise_error(F.lit("a range has over 2^33 rows")).cast("long"))
    ranged = cut_lineage(ranged.select("*", pid.alias(_PID), idx.alias(_IDX)), "numbering")

    stats = ranged.groupBy(_PID, *groups).agg(F.count(F.lit(1)).alias("_cnt"), F.min(_IDX).alias("_first"))
    w = Window.partitionBy(*groups).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(_PID, *groups, "_first", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_offset"))
    if not groups:
        # one row per range partition: bounded by ``n`` by construction, so broadcast it
        stats = F.broadcast(stats)
    else:
        # (partition, group) rows: at most #groups + n; broadcast only after a counted check
        from labelgraph.operators.graph import broadcast_if_small

        stats = broadcast_if_small(cut_lineage(stats, "numbering-offsets"))
    out = ranged.join(stats, [_PID, *groups], "inner")
    seq = F.lit(start) + F.col("_offset") + F.col(_IDX) - F.col("_first")
    return out.withColumn(col, seq.cast("long")).drop(_PID, _IDX, "_first", "_offset")
