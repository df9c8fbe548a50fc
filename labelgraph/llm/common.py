"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelgraph.session import scratch_path

#: ASCII white space, as the word patterns of the operators define it.
ASCII_WS = " \t\n\x0b\f\r"
WORD_RE = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Light rows (ids, hashes, sizes) that one task sorts; a task of this size stays far below 1 GB.
ROWS_PER_TASK = 1_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts the lineage with files that every executor can read, so a lost executor costs no more
    than the tasks it was running; columns, statistics and schema stay.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tidy(scan):
    """The Arrow function, giving freed memory back when its task ends: Python workers live on."""

    def run(batches):
        yield from scan(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not this C library
            pass

    return run


def packed_longs(df: DataFrame, *names: str) -> list[np.ndarray]:
    """The named long columns of a table of bounded size, as arrays in the driver.

    Tasks pack their rows into bytes, so the driver takes one value for each task and column,
    not one Python object for each row, whatever the session's Arrow setting is.
    """

    def pack(batches):
        held: list[list[bytes]] = [[] for _ in names]
        for batch in batches:
            for i, own in enumerate(held):
                own.append(batch.column(i).to_numpy().astype("<i8").tobytes())
        raw = [b"".join(own) for own in held]
        if raw[0]:
            yield pa.RecordBatch.from_arrays([pa.array([r], pa.binary()) for r in raw], names=list(names))

    rows = only(df, *names).mapInArrow(pack, ", ".join(f"`{c}` binary" for c in names))
    parts: list[list[np.ndarray]] = [[] for _ in names]
    for row in rows.toLocalIterator():
        for i, own in enumerate(parts):
            own.append(np.frombuffer(row[i], "<i8"))
    return [np.concatenate(own) if own else np.zeros(0, dtype=np.int64) for own in parts]


#: Bits of :func:`low_bits_filter`: 8 MB whatever the number of keys.
FILTER_BITS = 26


def low_bits_filter(keys: DataFrame, key: str) -> np.ndarray:
    """Bit map, of fixed size, of the low bits of a column of hashes; test it with :func:`in_filter`.

    Other keys may pass, so it only saves work and an exact join has to follow.
    """
    at = F.col(key).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = keys.select(F.shiftright(at, 6).alias("w"), F.expr(f"shiftleft(1L, cast(`{key}` & 63L as int))").alias("b"))
    w, b = packed_longs(words.groupBy("w").agg(F.bit_or("b").alias("b")), "w", "b")  # at most 2^20 rows
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    out[w] = b
    return out


def in_filter(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.int64((1 << FILTER_BITS) - 1)
    return (held[at >> 6] >> (at & 63)) & 1 == 1


def utf8_bytes(text: Column) -> Column:
    """UTF-8 length of a text in bytes, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """Words between ASCII white space, as an array; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def task_count(spark: SparkSession, rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Partitions for ``rows``: the session's shuffle partitions, more when a task would get too many."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


def prefix_sums(
    df: DataFrame,
    order: list[str],
    sums: dict[str, str | None],
    groups: list[str] | None = None,
    name: str = "prefix",
) -> DataFrame:
    """Add, for each ``out: value`` of ``sums``, the sum of ``value`` over all rows before this one.

    Rows are ordered by ``order`` within ``groups``; ``value`` None counts rows, which numbers
    them from 0. Rows that are equal in ``order`` come in an arbitrary order that is fixed by the
    stored table. No window runs over a whole group: rows are dealt out by range, stored with
    their range number, summed within each range, and each range adds the totals of the earlier
    ranges of its group (one row for each range and group). A group of any size, and any number
    of rows with one key, spreads over several ranges since a row number ends the range key.
    Give it light rows: each is shuffled twice and written once.
    """
    spark = df.sparkSession
    groups = groups or []
    taken = set(df.columns)
    pid, tie = _free("pid", taken), _free("tie", taken)
    df = df.withColumn(tie, F.monotonically_increasing_id())
    n = task_count(spark, df.count())
    keys = [*groups, *order, tie]
    ranged = stored(df.repartitionByRange(n, *keys).withColumn(pid, F.spark_partition_id()), name)
    values = {out: F.lit(1) if v is None else F.col(v) for out, v in sums.items()}
    totals = ranged.groupBy(pid, *groups).agg(*[F.sum(v).alias(out) for out, v in values.items()])
    if groups:
        # null-safe group identity: the group's values in one struct
        gid = F.struct(*groups)
        before = Window.partitionBy(gid).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    else:
        before = Window.partitionBy(F.lit(0)).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(
        F.struct(pid, *groups).alias("_at"),
        *[F.coalesce(F.sum(out).over(before), F.lit(0)).alias(f"_off_{out}") for out in sums],
    )
    within = Window.partitionBy(pid, *groups).orderBy(*order, tie).rowsBetween(Window.unboundedPreceding, -1)
    inner = ranged.select(
        "*",
        F.struct(pid, *groups).alias("_at"),
        *[F.coalesce(F.sum(v).over(within), F.lit(0)).alias(f"_in_{out}") for out, v in values.items()],
    )
    # offs: at most one row for each range and group end, so ranges + groups rows
    out = inner.join(offs, F.expr("true") & inner["_at"].eqNullSafe(offs["_at"]))
    return out.select(
        *[c for c in df.columns if c != tie],
        *[(F.col(f"_off_{o}") + F.col(f"_in_{o}")).cast("long").alias(o) for o in sums],
    )


def _free(stem: str, taken: set[str]) -> str:
    while stem in taken:
        stem = "_" + stem
    taken.add(stem)
    return stem


def only(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns alone: extra columns, whatever their names, don't reach the operator."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def carried(docs: DataFrame, *need: str):
    """The columns ``need`` and all others as one struct, so that no name of theirs can meet one
    that an operator uses; and a function that gives a result back its columns, in order.

    ``restore(df, *more, without=())`` unpacks ``df`` and adds further columns; columns named in
    ``without`` are left out.
    """
    name = _free("carried", set(need))
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in need]
    own = docs.select(*[F.col(f"`{c}`") for c in need], F.struct(*(rest or [F.lit(0).alias("none")])).alias(name))

    def restore(df: DataFrame, *more, without: tuple[str, ...] = ()) -> DataFrame:
        cols = [F.col(f"`{c}`") if c in need else F.col(name).getField(c).alias(c) for c in docs.columns if c not in without]
        return df.select(*cols, *more)

    return own, restore
