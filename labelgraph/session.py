"""Session helpers: local test sessions and the shared folder used to cut lineage.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names (a DFS / object
store path visible to every executor). We only pick our own folder when the setting is
absent, which is the local-test case.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
LISTING_TASKS_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
OPEN_COST_CONF = "spark.sql.files.openCostInBytes"
#: Bytes that could be read in the time that opening a small file takes: 8,000 files for 128 MB.
SMALL_OPEN_COST = 16 << 10
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "labelgraph",
    checkpoint_dir: str | None = None,
    event_log_dir: str | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC).

    ``spark.checkpoint.dir`` is a launch-time setting; a private temp folder is used when none
    is given (local runs only; on a cluster it names a shared folder).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LABELGRAPH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    builder = builder.config(CHECKPOINT_CONF, checkpoint_dir or tempfile.mkdtemp(prefix="labelgraph-ckpt-"))
    if event_log_dir:
        # stage/task timings without the UI: Spark's JSON event log in a scratch folder
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder, choosing a local one only if unset."""
    sc = spark.sparkContext
    path = sc.getConf().get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set: on a cluster it must name a folder every executor can "
                "read (DFS or object store); labelgraph writes checkpoints and intermediate tables there"
            )
        # Unset on a local master (tests): a private temp folder is acceptable here only.
        path = tempfile.mkdtemp(prefix="labelgraph-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return (sc.getCheckpointDir() or path).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder (for written intermediate tables)."""
    return f"{_run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def list_in_few_tasks(spark: SparkSession) -> None:
    """From here on Spark's file sources list a tree of many folders with some tasks for each core, not
    with up to 10,000, whose start takes longer than the listing. Streams list later and in the session they
    were defined in, so the setting stays."""
    few = 8 * spark.sparkContext.defaultParallelism
    if int(spark.conf.get(LISTING_TASKS_CONF)) > few:
        spark.conf.set(LISTING_TASKS_CONF, str(few))


def small_files_session(spark: SparkSession) -> SparkSession:
    """A copy of the session, for reading very many small files: Spark counts 4 MB for opening a file, so that a task
    would read 32 of them at most and its start would take longer than the reading."""
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    if int(own.conf.get(OPEN_COST_CONF).rstrip("bB")) > SMALL_OPEN_COST:
        own.conf.set(OPEN_COST_CONF, str(SMALL_OPEN_COST))
    list_in_few_tasks(own)
    return own


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed within go when it has ended. Else they stay until the driver happens to
    collect its garbage, and a query of many stored steps holds the files of all of them."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def _run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/labelgraph-{spark.sparkContext.applicationId}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage ends in files that
    every executor can read, and later scans keep column pruning, filters and statistics.

    :func:`cleanup` deletes what a session wrote.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cleanup(spark: SparkSession) -> None:
    """Delete every intermediate table this application wrote below the shared folder."""
    root = _run_dir(spark)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
