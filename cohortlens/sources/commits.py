"""Tables that change by commits: data folders, and a log that names them.

    <path>/data/<uuid>       a written data folder, never changed afterwards
    <path>/log/<number>.json a generation: key -> folder, schema and notes

A writer first writes a whole data folder, then commits: it reads the newest
generation, applies its change, and renames a finished file to the next
number.  The rename fails where that number is taken, and the writer tries
again on the newer generation, so no commit is lost.  A reader takes the
newest generation and reads the folders it names; a refresh under it, of the
same key too, only adds folders, so the reader's frame stays whole until
``vacuum`` removes what the kept generations no longer name.  A writer that
dies leaves a folder that no generation names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ATTEMPTS = 50


class Conflict(OSError):
    """Too many writers committed in between."""


class CommittedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs_package = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._fs_package.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(p)] if self._fs.exists(p) else []

    # ---- generations

    def generations(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("log") if n.endswith(".json") and n[:-5].isdigit())

    def entries(self, generation: int | None = None) -> dict[str, dict]:
        """key -> {"folder", "schema", notes} of a generation, the newest by default."""
        found = self.generations()
        if not found:
            return {}
        source = self._fs.open(self._path(f"log/{found[-1] if generation is None else generation:012d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def commit(self, change: Callable[[dict[str, dict]], dict[str, dict]]) -> int:
        """Make ``change(entries)`` the next generation; its number."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        context = self._fs_package.FileContext.getFileContext(self._fs.makeQualified(self._path("")).toUri(), self._conf)
        no_options = gateway.new_array(getattr(self._fs_package, "Options$Rename"), 0)
        for _ in range(ATTEMPTS):
            known = self.generations()
            entries = change(self.entries(known[-1]) if known else {})
            number = known[-1] + 1 if known else 0
            tmp = self._path(f"log/.{number}-{uuid.uuid4().hex}")
            out = self._fs.create(tmp, False)
            out.write(bytearray((json.dumps(entries) + "\n").encode()))
            out.close()
            try:
                context.rename(self._fs.makeQualified(tmp), self._fs.makeQualified(self._path(f"log/{number:012d}.json")), no_options)
                return number
            except Exception as e:
                self._fs.delete(tmp, False)
                if "FileAlreadyExists" not in str(e):
                    raise
        raise Conflict(f"{ATTEMPTS} commits to {self.path} met others")

    # ---- data

    def write(self, df: DataFrame, partition_by: list[str] = (), **notes) -> dict:
        """Write a data folder that no generation names yet; its entry."""
        folder, rows = uuid.uuid4().hex, Observation(f"rows-{uuid.uuid4().hex}")
        df.observe(rows, F.count(F.lit(1)).alias("n")).write.partitionBy(*partition_by).parquet(f"{self.path}/data/{folder}")
        # partition columns come last when folders are read
        fields = [f for f in df.schema.fields if f.name not in partition_by] + [df.schema[c] for c in partition_by]
        return {"folder": folder, "schema": T.StructType(fields).json(), "rows": rows.get["n"], **notes}

    def frame(self, entry: dict) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(entry["schema"]))).parquet(f"{self.path}/data/{entry['folder']}")

    def read(self, generation: int | None = None) -> DataFrame:
        """All folders of a generation together."""
        frames = [self.frame(e) for _, e in sorted(self.entries(generation).items())]
        if not frames:
            raise FileNotFoundError(f"nothing is committed in {self.path}")
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f, allowMissingColumns=True)
        return out

    def append(self, df: DataFrame, **notes) -> int:
        entry = self.write(df, **notes)
        return self.commit(lambda entries: {**entries, entry["folder"]: entry})

    def replace(self, key: str, df: DataFrame, partition_by: list[str] = (), **notes) -> int:
        """Make ``df`` what stands under ``key``; other keys stay."""
        entry = self.write(df, partition_by, **notes)
        return self.commit(lambda entries: {**entries, key: entry})

    def discard(self, entry: dict) -> None:
        """Remove a folder that was written and shall not be committed."""
        self._fs.delete(self._path(f"data/{entry['folder'].split('/')[0]}"), True)
        if not self.generations() and not self._names("data"):
            self._fs.delete(self._path(""), True)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Forget all but the newest ``keep`` generations and remove the
        folders that those do not name (a running writer's too: call it when
        none writes and no reader holds an older frame)."""
        found = self.generations()
        named = {(e.get("whole") or e["folder"]).split("/")[0] for g in found[-keep:] for e in self.entries(g).values()}
        for g in found[:-keep]:
            self._fs.delete(self._path(f"log/{g:012d}.json"), False)
        gone = [n for n in self._names("data") if n not in named]
        for n in gone:
            self._fs.delete(self._path(f"data/{n}"), True)
        return gone
