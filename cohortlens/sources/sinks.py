"""Materialisation of the metrics view, non-blocking refresh, run report.

Snapshots are entries of a committed table (``commits``): a refresh writes a
folder of its own and then commits its name, so it neither blocks a reader nor
takes the folder away under one, whether it is of a new date or of the same.
``materialize`` writes aside and renames, and trusts only a folder with the
writer's ``_SUCCESS`` mark.  ``stored`` keeps a view under a fingerprint of the
files it was made from.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import checkpoint_dir, shuffle_partitions
from cohortlens.sources.commits import CommittedTable

#: Part of every fingerprint: rise it when a view's definition changes.
VIEW_VERSION = 1

#: Input bytes for each shuffle partition of the job that writes a stored view, at most.
TASK_BYTES = 16 << 20


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_whole(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def publish(spark: SparkSession, aside: str, path: str) -> None:
    """Give the written folder ``aside`` the name ``path``, unless another
    writer's whole table has it by now."""
    source, fs = _path(spark, aside)
    target, _ = _path(spark, path)
    if is_whole(spark, path):
        fs.delete(source, True)  # another writer was faster
        return
    if fs.exists(target):
        fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {aside} to {path}")


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Create-if-absent: write ``df`` unless ``path`` holds a whole table
    already; what an unfinished writer left there is replaced."""
    spark = df.sparkSession
    if not is_whole(spark, path):
        aside = f"{path.rstrip('/')}-writing-{uuid.uuid4().hex}"
        df.write.parquet(aside)
        publish(spark, aside, path)
    return spark.read.schema(df.schema).parquet(path)


def input_files(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """(name, length, modification time) of every file under ``paths``, in order."""
    files = []
    for path in sorted(paths):
        p, fs = _path(spark, path)
        found = fs.listFiles(p, True)
        while found.hasNext():
            s = found.next()
            files.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(files)


def fingerprint(spark: SparkSession, paths: list[str], *params) -> str:
    """A digest of ``input_files`` and of the parameters."""
    return hashlib.sha256(json.dumps([VIEW_VERSION, [str(x) for x in params], input_files(spark, paths)]).encode()).hexdigest()[:32]


def stored(spark: SparkSession, name: str, paths: list[str], build: Callable[[], DataFrame], *params) -> DataFrame:
    """The view ``name`` over the files under ``paths``: read where it is
    stored for just these files and parameters, else built and stored.  A
    changed, added or removed input file makes another fingerprint, so a stale
    view is never read.  The shuffles of the write follow the bytes of the files."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/cohortlens/views/{name}-{fingerprint(spark, paths, name, *params)}"
    if is_whole(spark, folder):
        return spark.read.parquet(folder)
    total = sum(size for _, size, _ in input_files(spark, paths))
    with shuffle_partitions(spark, -(-total // TASK_BYTES)):
        return materialize(build(), folder)


def stored_by(spark: SparkSession, name: str, paths: list[str], build: Callable[[], DataFrame], partition_by: list[str], *params) -> DataFrame:
    """``stored``, in a folder for each value of ``partition_by``: a filter on
    those columns reads the folders it asks for."""
    table = CommittedTable(spark, f"{checkpoint_dir(spark).rstrip('/')}/cohortlens/views/{name}-{fingerprint(spark, paths, name, partition_by, *params)}")
    if "view" not in table.entries():
        table.replace("view", build(), partition_by)
    return table.frame(table.entries()["view"])


def refresh(df: DataFrame, path: str, as_of) -> int:
    """Commit ``df`` as the snapshot of ``as_of`` (others untouched); the
    generation's number."""
    return CommittedTable(df.sparkSession, path).replace(str(as_of), df)


def latest(spark: SparkSession, path: str, as_of=None) -> DataFrame:
    """The snapshot of ``as_of``, or of the newest date."""
    table = CommittedTable(spark, path)
    entries = table.entries()
    key = max(entries, default=None) if as_of is None else str(as_of)
    if key not in entries:
        raise FileNotFoundError(f"no complete snapshot in {path}" + (f" for {as_of}" if as_of else ""))
    return table.frame(entries[key])


def load_report(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Lines, distinct buying customers and their distinct countries (one
    row).  Lines are counted per customer first (partial aggregate), so the
    distinct counts run on customer-grain rows and the line table is never
    expanded or joined."""
    per_customer = transactions.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"))
    joined = per_customer.join(customers.select("customer_id", "country"), "customer_id")
    return joined.agg(
        F.sum("_n").alias("transactions"),
        F.count(F.lit(1)).alias("customers"),
        F.count_distinct("country").alias("countries"),
    )


def observed_count(df: DataFrame, name: str):
    """Attach a row-count observation to a sink path (no second pass): the
    metric is read from ``observation.get`` after the write action."""
    from pyspark.sql import Observation
    obs = Observation(f"{name}-{uuid.uuid4().hex}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
