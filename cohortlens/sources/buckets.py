"""Tables stored in hash buckets of a join key.

Two tables in equally many buckets of their join key meet bucket by bucket: the
join, and every aggregate whose grouping holds that key, moves no row.  A table
is written once under a fingerprint of its input files (``sinks``), one file a
bucket, and declared in the session's catalog over its folder; a session that
finds the folder declares it again.  Buckets suit keys of which no single one
is large, as order numbers are: a bucket is one task and cannot be split.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cohortlens.session import checkpoint_dir, shuffle_partitions
from cohortlens.sources import sinks

#: Input bytes of a bucket.  One task sorts a bucket of either table and aggregates their join;
#: TPC-H-like lines take 12 to 18 bytes of input and some 200 of that task's memory.
BUCKET_BYTES = 16 << 20
FEWEST = 8


def bucket_count(spark: SparkSession, paths: list[str]) -> int:
    """A power of two that follows the bytes under ``paths``, as far as the
    session allows (larger buckets are still joined by sorted streams)."""
    total = sum(size for _, size, _ in sinks.input_files(spark, paths))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    n = FEWEST
    while n * BUCKET_BYTES < total and 2 * n <= most:
        n *= 2
    return n


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _declare(spark: SparkSession, table: str, schema: StructType, folder: str, key: str, n: int) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION {_quoted(folder)} "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS")


def stored_buckets(spark: SparkSession, name: str, paths: list[str], build: Callable[[], DataFrame], key: str, n: int) -> DataFrame:
    """The table ``name`` over the files under ``paths`` in ``n`` buckets of
    ``key``: read where it is stored for just these files, else built and
    stored.  Rows without a key are in one of the buckets.  ``build`` makes a
    frame without running a job: its schema is asked for as well."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/cohortlens/views/{name}-{sinks.fingerprint(spark, paths, name, key, n)}"
    table = f"cohortlens_{name}_{hashlib.sha256(folder.encode()).hexdigest()[:32]}"
    if not sinks.is_whole(spark, folder):
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # its folder was removed
        made = uuid.uuid4().hex
        aside = f"{folder}-writing-{made}"
        with shuffle_partitions(spark, n):  # of joins in ``build``: none holds more than a bucket does
            (build().repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", aside)
             .saveAsTable(f"cohortlens_{name}_{made}"))
        spark.sql(f"DROP TABLE cohortlens_{name}_{made}")  # the declaration: the files stay
        sinks.publish(spark, aside, folder)
    if not spark.catalog.tableExists(table):
        _declare(spark, table, build().schema, folder, key, n)
    return spark.table(table)
