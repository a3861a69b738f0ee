"""Session construction and lineage cutting.

``stable(df)`` is the one place where an intermediate result is frozen: a
Parquet table under the shared ``spark.checkpoint.dir``, or, where that is not
set, under the warehouse.  The tables belong to the application, which removes
them with ``drop_stable_tables`` when it is done with all frames built on them.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


# Settings we would start a 100 TB run with (cluster sessions are built by
# the operator; these are the knobs the plans rely on).  Shuffle partitions
# are set high and AQE coalesces them to ~256 MB; skewed join partitions are
# split at run time; a side is broadcast only under the size threshold.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, cpus: int | None = None,
                  shuffle_partitions: int | None = None,
                  app_name: str = "cohortlens", extra: dict | None = None) -> SparkSession:
    """Local/test session builder.  On a cluster, pass your own session."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("COHORTLENS_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    ``spark.checkpoint.dir`` (or the directory registered on the
    SparkContext), else a folder of the warehouse.  A warehouse on a
    machine's own disk is refused on a cluster: each executor would write to
    its own, and later reads would miss rows without an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = warehouse_folder(spark, sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def warehouse_folder(spark: SparkSession, master: str) -> str:
    """A folder under the warehouse, resolved by Hadoop; raises where it is
    machine-local and ``master`` is not ``local``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.sql.warehouse.dir") + "/cohortlens-checkpoints")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    whole = fs.makeQualified(path).toString()
    if whole.startswith("file:") and not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share: {whole} is local to each machine of {master}")
    return whole


@contextmanager
def shuffle_partitions(spark: SparkSession, at_least: int) -> Iterator[None]:
    """Jobs run inside shuffle into ``at_least`` so many partitions, or into
    the session's number where that is larger; adaptive execution still merges
    small ones.  For writes whose input is known, so that what one task sorts
    and aggregates does not grow where the session's number stays."""
    # where the second is set, adaptive execution starts from it
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")}
    raised = {k: v for k, v in old.items() if v is not None and int(v) < at_least}
    try:
        for k in raised:
            spark.conf.set(k, str(at_least))
        yield
    finally:
        for k, v in raised.items():
            spark.conf.set(k, v)


def stable(df: DataFrame, name: str = "stage") -> DataFrame:
    return stable_counted(df, name)[0]


def stable_counted(df: DataFrame, name: str = "stage") -> tuple[DataFrame, int]:
    """Freeze ``df`` as a Parquet table under the shared checkpoint folder.

    Used before a result is read several times (ranking passes read the
    customer table four or five times), so the expensive upstream join and
    aggregation run exactly once and later reads survive executor loss.  A
    written table is computed once (a reliable RDD checkpoint of an
    unpersisted plan computes it twice) and reads back with size statistics
    and column pruning.  Returns the re-read table and its row count.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/cohortlens/{name}-{uuid.uuid4().hex}"
    obs = Observation(f"rows-{uuid.uuid4().hex}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    # The row count is observed during the write: no second pass.  The
    # schema is the written frame's, so the re-read infers nothing.
    return spark.read.schema(df.schema).parquet(path), int(obs.get["rows"])


def drop_stable_tables(spark: SparkSession) -> None:
    """Delete the tables ``stable()`` wrote for this application (call at
    the end of a job, once no DataFrame built on them is used any more)."""
    base = checkpoint_dir(spark).rstrip("/") + "/cohortlens"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)
