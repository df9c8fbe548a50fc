"""Image listing (SRC-07) for existence tests: the files below a root, listed by tasks, or a manifest
table of paths.

Where tasks cannot list a root (a pattern of roots, a single file, a scheme that Arrow's file systems do not know),
``binaryFile`` does, with the content column pruned; that builds Spark's file index on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgraph.session import list_in_few_tasks
from labelgraph.sources.crawl import crawl, listable
from labelgraph.sources.paths import qualified_root, relative_to_root

#: What ``binaryFile`` leaves out: folders and files with hidden names.
HIDDEN_FOLDER = r"(?s)(^|/)(?!_metadata|_common_metadata)(\.[^/]*|_[^/=]*|[^/]*\._COPYING_)/"
HIDDEN_FILE = r"(?s)(^|/)(\.[^/]*|_[^/=]*|[^/]*\._COPYING_)\z"


def list_images(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """``(path, length)`` of every file below ``root`` (any name, unless ``pattern`` is given);
    ``path`` is relative to ``root``'s parent, prefixed by its last element. As for ``binaryFile``, empty files and
    hidden ones (names that begin with a dot or an underscore) are left out and links to folders are followed."""
    base = qualified_root(root)
    if listable(spark, base):
        found = crawl(spark, root, follow=True).where("length > 0")
        found = found.where(~F.rlike("rel", F.lit(HIDDEN_FOLDER)) & ~F.rlike("rel", F.lit(HIDDEN_FILE)))
        if pattern is not None:
            glob = spark._jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern()
            found = found.where(F.rlike("rel", F.lit(rf"(?s)(^|/)(?=[^/]*\z)(?:{glob})\z")))
        return found.select(F.concat(F.lit(base.rsplit("/", 1)[-1] + "/"), "rel").alias("path"), "length")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    list_in_few_tasks(spark)
    df = reader.load(base)
    return df.select(relative_to_root(F.col("path"), root).alias("path"), "length")


def read_manifest(spark: SparkSession, path: str, column: str = "path") -> DataFrame:
    """Image table ``(path)`` from a Parquet manifest; nothing is listed."""
    return spark.read.parquet(path).select(F.col(column).alias("path"))
