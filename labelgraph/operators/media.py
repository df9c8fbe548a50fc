"""Media manifests (WN-02/03): every-Nth frame sampling and page numbering.

Decoding video or rendering PDFs is codec work and stays outside; these operators plan which
frames/pages become images and name their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.operators.sequence import sequence_number


def frame_sample(frames: DataFrame, media: str, order: list[str], every: int = K.FRAME_INTERVAL, folder: str = "frames") -> DataFrame:
    """Keep frames 0, N, 2N, ... of each media (numbering = original frame index).

    Frame numbers come from :func:`sequence_number` grouped by media, so a media with a third
    of all frames is numbered across many tasks.
    """
    numbered = sequence_number(frames, order, group_cols=[media], col="frame_no")
    kept = numbered.where(F.col("frame_no") % every == 0)
    return kept.withColumn("path", F.format_string(f"{folder}/%s/{K.FRAME_FILE_FORMAT}", F.col(media).cast("string"), F.col("frame_no")))


def chunked_range(df: DataFrame, key: str, n: Column, start: int, step: int, out: str, chunk: int = 4096) -> DataFrame:
    """``(key, out)`` for ``out`` = start, start + step, ... up to ``start + n - 1`` inclusive.

    Two-level explode: chunk starts first, redistributed across tasks on (key, chunk), then
    each chunk's numbers. A key with a third of all frames is spread over many tasks instead
    of one task emitting its whole range.
    """
    span = step * chunk
    last = F.lit(start) + n - 1
    chunks = df.where(n > 0).select(key, last.alias("_last"), F.explode(F.sequence(F.lit(start), last, F.lit(span))).alias("_c"))
    chunks = chunks.repartition(key, "_c")
    end = F.least(F.col("_c") + F.lit(span - 1), F.col("_last"))
    return chunks.select(key, F.explode(F.sequence(F.col("_c"), end, F.lit(step))).alias(out))


def frame_manifest(counts: DataFrame, media: str, n_frames: str, every: int = K.FRAME_INTERVAL, folder: str = "frames") -> DataFrame:
    """From frame counts per media: the sampled frame numbers and file names."""
    out = chunked_range(counts, media, F.col(n_frames), 0, every, "frame_no")
    return out.withColumn("path", F.format_string(f"{folder}/%s/{K.FRAME_FILE_FORMAT}", F.col(media).cast("string"), F.col("frame_no")))


def page_manifest(docs: DataFrame, doc: str, n_pages: str, folder: str = "pages") -> DataFrame:
    """Pages numbered from 1 with their file names."""
    out = chunked_range(docs, doc, F.col(n_pages), 1, 1, "page_no")
    return out.withColumn("path", F.format_string(f"{folder}/%s/{K.PAGE_FILE_FORMAT}", F.col(doc).cast("string"), F.col("page_no")))
