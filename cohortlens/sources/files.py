"""CSV readers and writers with declared schemas (never ``inferSchema``).

Readers select by column name, so a file with extra columns (or the
declared table's columns in another order) still loads the fields a step
needs.  Writers leave the file count to the data (no ``coalesce(1)``: a
single writer task would funnel the whole extract through one executor).
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.sources.commits import CommittedTable
from cohortlens.sources.schemas import schema_for

DATE_FORMAT = "yyyy-MM-dd"


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("dateFormat", DATE_FORMAT)
            .option("mode", "FAILFAST").option("enforceSchema", False).csv(path))


def read_customers(spark: SparkSession, path: str, key_type: T.DataType | None = None) -> DataFrame:
    return _read_csv(spark, path, schema_for("customers_csv", key_type))


def read_transactions(spark: SparkSession, path: str, key_type: T.DataType | None = None) -> DataFrame:
    return _read_csv(spark, path, schema_for("transactions_csv", key_type))


def read_rfm(spark: SparkSession, path: str, key_type: T.DataType | None = None) -> DataFrame:
    return _read_csv(spark, path, schema_for("rfm_scores_csv", key_type))


def read_cohort_matrix(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schema_for("cohort_matrix_csv"))


def require_inputs(spark: SparkSession, directory: str, names) -> None:
    """Fail naming every missing input (checked through the Hadoop FS of the
    path, so it works for any cluster file system)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    missing = []
    for n in names:
        p = jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/{n}")
        if not p.getFileSystem(conf).exists(p):
            missing.append(n)
    if missing:
        raise FileNotFoundError(f"Missing source files: {', '.join(missing)}")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    w = df.write.mode(mode).option("header", True).option("dateFormat", DATE_FORMAT)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.csv(path)


def write_extract(df: DataFrame, path: str, fmt: str = "csv", partition_by=None, mode: str = "overwrite") -> None:
    """Write a BI extract as CSV (header) or Parquet."""
    if fmt == "csv":
        write_csv(df, path, mode, partition_by)
        return
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.format(fmt).save(path)


def _checked(raw: DataFrame, schema: T.StructType, present: list[str]) -> DataFrame:
    """The declared columns, what is wrong with the row, and, where something
    is, its fields as they were read."""
    columns, faults = [], [F.when(F.col(_RAW).isNotNull(), _fault(None, "malformed line", F.col(_RAW)))]
    for f in schema.fields:
        if f.name not in present:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        text = F.col(f.name)
        value = text.try_cast(f.dataType)
        columns.append(value.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            faults.append(F.when(text.isNotNull() & value.isNull(), _fault(f.name, f"no {f.dataType.simpleString()}", text)))
        if not f.nullable:
            faults.append(F.when(text.isNull(), _fault(f.name, "NULL", text)))
    row = F.struct(*[F.col(c) for c in present])
    return (raw.select(*columns, F.array_compact(F.array(*faults)).alias(_FAULTS), row.alias(_ROW))
            .withColumns({_OK: F.size(_FAULTS) == 0, _ROW: F.when(F.size(_FAULTS) > 0, F.col(_ROW))}))


def _fault(column: str | None, reason: str, value):
    return F.struct(F.lit(column).cast("string").alias("column"), F.lit(reason).alias("reason"), value.alias("value"))


_RAW, _FAULTS, _ROW, _OK = "_raw", "_faults", "_row", "_accepted"


def load_table(spark: SparkSession, csv_path: str, table_path: str, schema: T.StructType, quarantine: bool = False) -> DataFrame:
    """Bulk-load a header CSV into a declared table: columns are matched by
    name against the declared schema, missing nullable columns become NULL,
    and rows are appended.

    One read splits the rows: those that fit, and those with a field that is
    not of its type, a NULL in a NOT NULL column, or another number of fields
    than the header.  Both are written aside in one pass and committed
    together, so a failed load leaves nothing.  Without ``quarantine`` a file
    with rows that do not fit is refused whole; with it they can be read with
    ``load_rejects``."""
    present = spark.read.option("header", True).csv(csv_path).columns
    for f in schema.fields:
        if f.name not in present and not f.nullable:
            raise ValueError(f"required column {f.name!r} missing from {csv_path}")
    strings = T.StructType([*[T.StructField(c, T.StringType()) for c in present], T.StructField(_RAW, T.StringType())])
    raw = (spark.read.schema(strings).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
           .option("columnNameOfCorruptRecord", _RAW).csv(csv_path))
    counts = Observation(f"load-{uuid.uuid4().hex}")
    checked = _checked(raw, schema, present).observe(counts, F.count_if(_OK).alias("accepted"), F.count_if(~F.col(_OK)).alias("rejected"))
    table = CommittedTable(spark, table_path)
    entry = table.write(checked, [_OK], source=csv_path)
    n = counts.get
    entry |= {"accepted": n["accepted"], "rejected": n["rejected"], "rejects_schema": entry["schema"], "schema": T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]).json()}
    if n["rejected"] and not quarantine:
        found = _rejects(table, entry).groupBy("column", "reason").count().orderBy("column", "reason").collect()
        table.discard(entry)
        raise ValueError(f"{csv_path} has rows that do not fit (rows by column and reason): {[tuple(r) for r in found]}")
    folder = entry["folder"]
    table.commit(lambda entries: {**entries, folder: entry | {"folder": f"{folder}/{_OK}=true" if n["accepted"] else None, "whole": folder}})
    return read_table(spark, table_path)


def read_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The accepted rows of all loads."""
    table = CommittedTable(spark, table_path)
    entries = table.entries()
    frames = [table.frame(e) for _, e in sorted(entries.items()) if e["folder"]]
    if not frames:
        if not entries:
            raise FileNotFoundError(f"nothing was loaded into {table_path}")
        return spark.createDataFrame([], T.StructType.fromJson(json.loads(next(iter(entries.values()))["schema"])))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _rejects(table: CommittedTable, entry: dict) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(entry["rejects_schema"]))
    bad = table.spark.read.schema(schema).parquet(f"{table.path}/data/{entry.get('whole', entry['folder'])}").where(~F.col(_OK))
    return bad.select(F.lit(entry["source"]).alias("source"), F.col(_ROW).alias("row"), F.explode(_FAULTS).alias("f")).select("source", "row", "f.*")


def load_rejects(spark: SparkSession, table_path: str) -> DataFrame:
    """(source, row, column, reason, value): what kept each rejected row out,
    ``row`` being its fields as text (loads whose files had the same columns)."""
    table = CommittedTable(spark, table_path)
    frames = [_rejects(table, e) for _, e in sorted(table.entries().items()) if e["rejected"]]
    if not frames:
        return spark.createDataFrame([], "source string, row struct<>, column string, reason string, value string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
