"""Prompt template source (SRC-06): one whole text file, read once.

A prompt is a single small file, so its text is fetched to the driver once and used as a
literal in the rendering expressions (constant-folded into every task), instead of being
joined to every row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

def read_prompt(spark: SparkSession, path: str) -> str:
    """Whole text of the one prompt file at ``path``."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected exactly one prompt file at {path}, found {len(rows)}")
    return rows[0][0]
