"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from cohortlens.session import checkpoint_dir, stable_counted

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def _shuffles_end_with_the_write(spark: SparkSession):
    """Shuffle files of what is written inside go as soon as it is written,
    not when the driver happens to collect its garbage."""
    old = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, old)


def freeze_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write ``df`` as a table into the shared checkpoint folder and read it
    back: lineage is cut, and a lost executor costs nothing that was written."""
    with _shuffles_end_with_the_write(df.sparkSession):
        return stable_counted(df, name)


def freeze(df: DataFrame, name: str) -> DataFrame:
    return freeze_counted(df, name)[0]


def drop(df: DataFrame) -> None:
    """Delete a frozen table that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """The URI of a new folder in the shared checkpoint folder, for files that
    tasks write and read themselves (``put_file``, ``get_file``)."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/cohortlens/{name}-{uuid.uuid4().hex}"
    if folder.startswith("file:/") and not folder.startswith("file://"):
        return folder.replace("file:/", "file:///", 1)
    return folder if "://" in folder else f"file://{folder}"


def put_file(folder: str, name: str, content: bytes) -> None:
    """Write a whole file under its name; a task that runs again, or twice,
    leaves the same file."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    tmp = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(tmp) as out:
        out.write(content)
    system.move(tmp, f"{path}/{name}")


def get_file(folder: str, name: str) -> bytes:
    system, path = fs.FileSystem.from_uri(folder)
    with system.open_input_stream(f"{path}/{name}") as source:
        return source.read()


def trim() -> None:
    """Give the worker's unused memory back."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def lean(make, *args):
    """A function for ``mapInArrow``: ``make(batches, *args)``, after which
    the worker gives unused memory back.  Workers outlive their tasks, and
    what the tasks of one stage leave behind is missed in the next."""
    def run(batches):
        try:
            yield from make(batches, *args)
        finally:
            trim()

    return run


# ---------------------------------------------------------------- arrays

def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in place)."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    n = len(sorted_values)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))
    return starts, np.diff(np.append(starts, n))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of arange(s, s + n) for each start and length."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def planes(a: np.ndarray) -> bytes:
    """Bytes of the values, lowest bytes of all first: what is constant in
    the high bytes shrinks to nothing when Spark compresses the shuffle."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def unplanes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(b, np.uint8).reshape(size, len(b) // size).T.copy().view(dtype).ravel()
