"""Committed tables: readers under refreshes, writers that meet, loads with rejects."""

import os
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.sources import files, sinks
from cohortlens.sources.commits import CommittedTable
from cohortlens.sources.schemas import schema_for


def one(spark, v):
    return spark.createDataFrame([(1, v)], "id long, v int")


def test_a_reader_keeps_its_frame_while_one_date_is_refreshed_twice(spark, tmp_path):
    path = str(tmp_path / "snap")
    sinks.refresh(one(spark, 1), path, "2021-01-01")
    old = sinks.latest(spark, path)
    sinks.refresh(one(spark, 2), path, "2021-01-01")
    middle = sinks.latest(spark, path)
    sinks.refresh(one(spark, 3), path, "2021-01-01")
    assert [f.first().v for f in (old, middle, sinks.latest(spark, path))] == [1, 2, 3]
    table = CommittedTable(spark, path)
    assert table.generations() == [0, 1, 2] and table.read(0).first().v == 1
    assert len(table.vacuum()) == 2 and table.generations() == [2]
    assert sinks.latest(spark, path).first().v == 3


def test_no_commit_is_lost(spark, tmp_path):
    """A writer whose number was taken goes on from the newer generation."""
    table = CommittedTable(spark, str(tmp_path / "t"))
    mine = table.write(one(spark, 1))
    seen = []

    def change(entries):
        if not seen:  # another writer commits between reading and renaming
            CommittedTable(spark, str(tmp_path / "t")).append(one(spark, 2))
        seen.append(dict(entries))
        return {**entries, "mine": mine}

    assert table.commit(change) == 1 and len(seen) == 2 and len(seen[1]) == 1
    assert sorted(r.v for r in table.read().collect()) == [1, 2]


def test_uncommitted_folders_are_invisible(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.write(one(spark, 9))
    table.append(one(spark, 1))
    assert [r.v for r in table.read().collect()] == [1]
    assert len(table.vacuum()) == 1 and [r.v for r in table.read().collect()] == [1]


def test_materialize_replaces_what_an_unfinished_writer_left(spark, tmp_path):
    path = str(tmp_path / "mv")
    one(spark, 99).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    assert [r.v for r in sinks.materialize(one(spark, 1), path).collect()] == [1]
    assert [r.v for r in sinks.materialize(one(spark, 2), path).collect()] == [1]


def test_stored_view_follows_its_inputs(spark, tmp_path):
    src, built = str(tmp_path / "src"), []
    one(spark, 1).write.parquet(src)

    def view(*params):
        def build():
            built.append(params)
            return spark.read.parquet(src).withColumn("w", F.col("v") + 1)
        return sorted(r.w for r in sinks.stored(spark, "test-view", [src], build, *params).collect())

    assert view("a") == [2] and view("a") == [2] and len(built) == 1
    assert view("b") == [2] and len(built) == 2  # other parameters
    one(spark, 5).write.mode("append").parquet(src)
    assert view("a") == [2, 6] and len(built) == 3  # another file
    some = next(Path(src).glob("part-*"))
    os.utime(some, (1, 1))
    assert view("a") == [2, 6] and len(built) == 4  # another modification time
    shutil.rmtree(src)


SCHEMA = schema_for("customers", T.LongType())
LINES = "customer_id,country,signup_date\n1,US,2020-01-02\n2,,2020-01-02\nx,DE,soon\n4,FR\n5,GB,\n6,US,2020-13-40\n7,IT,2020-02-03,more\n"


def test_load_splits_rows_in_one_read(spark, tmp_path):
    (tmp_path / "c.csv").write_text(LINES)
    table = str(tmp_path / "t")
    got = files.load_table(spark, str(tmp_path / "c.csv"), table, SCHEMA, quarantine=True)
    assert [f.name for f in got.schema.fields] == [f.name for f in SCHEMA.fields] and [f.dataType for f in got.schema.fields] == [f.dataType for f in SCHEMA.fields]
    assert sorted((r.customer_id, r.country, str(r.signup_date)) for r in got.collect()) == [(1, "US", "2020-01-02"), (5, "GB", "None")]
    bad = sorted((r.row.customer_id, r.column or "", r.reason, r.value or "") for r in files.load_rejects(spark, table).collect())
    assert [b for b in bad if b[1]] == [("2", "country", "NULL", ""), ("6", "signup_date", "no date", "2020-13-40"), ("x", "customer_id", "no bigint", "x"), ("x", "signup_date", "no date", "soon")]
    assert [b[3] for b in bad if b[2] == "malformed line"] == ["4,FR", "7,IT,2020-02-03,more"]
    (tmp_path / "d.csv").write_text("signup_date,country,customer_id\n2021-01-01,US,9\n")
    again = files.load_table(spark, str(tmp_path / "d.csv"), table, SCHEMA)
    assert sorted(r.customer_id for r in again.collect()) == [1, 5, 9]


def test_refused_load_leaves_the_table_as_it_was(spark, tmp_path):
    table = str(tmp_path / "t")
    (tmp_path / "good.csv").write_text("customer_id,country\n1,US\n")
    (tmp_path / "bad.csv").write_text("customer_id,country\n2,US\n3,\n")
    files.load_table(spark, str(tmp_path / "good.csv"), table, SCHEMA)
    folders = sorted(os.listdir(f"{table}/data"))
    with pytest.raises(ValueError, match="country.*NULL"):
        files.load_table(spark, str(tmp_path / "bad.csv"), table, SCHEMA)
    assert sorted(os.listdir(f"{table}/data")) == folders
    assert [r.customer_id for r in files.read_table(spark, table).collect()] == [1]
    with pytest.raises(ValueError, match="customer_id"):
        (tmp_path / "less.csv").write_text("country\nUS\n")
        files.load_table(spark, str(tmp_path / "less.csv"), table, SCHEMA)


def test_load_of_nothing_but_rejects(spark, tmp_path):
    (tmp_path / "c.csv").write_text("customer_id,country\nx,US\n")
    got = files.load_table(spark, str(tmp_path / "c.csv"), str(tmp_path / "t"), SCHEMA, quarantine=True)
    assert got.count() == 0 and got.columns == [f.name for f in SCHEMA.fields]
    assert files.load_rejects(spark, str(tmp_path / "t")).count() == 1
    (tmp_path / "e.csv").write_text("customer_id,country\n")
    assert files.load_table(spark, str(tmp_path / "e.csv"), str(tmp_path / "t2"), SCHEMA).count() == 0
    assert files.load_rejects(spark, str(tmp_path / "t2")).count() == 0
