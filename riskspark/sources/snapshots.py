"""A table of days with snapshots (O-97): a commit log names the folder of every day.

``data/<commit>/_day=<day>/`` holds the rows of a day as one commit wrote them; ``_log/<version>.json``
is a whole snapshot: for each day the commit that wrote it last, with a bound on its rows, and the
last epoch of each writer. Readers take the newest log entry and read just the folders it names, so
their number is that of the days, however many commits there were.

A commit writes its data first and then puts its log entry in place by a rename that fails if the
version exists: a writer that dies in between leaves the snapshot before, and of two writers one
fails. An epoch that is already in the log is not written again. :func:`vacuum` removes what no
kept snapshot names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.rollups import upsert

#: Rows of a day that go to one file; larger days are spread by the hash of their keys.
FILE_ROWS = 1_000_000
NO_DAY = "none"


class CommitConflict(RuntimeError):
    """Another writer has put this version in place."""


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, file_rows: int = FILE_ROWS) -> None:
        self.spark, self.path, self.file_rows = spark, path.rstrip("/"), file_rows
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- the log -------------------------------------------------------------------------

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def versions(self) -> list[int]:
        log = self._path(f"{self.path}/_log")
        if not self._fs.exists(log):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def snapshot(self, version: int | None = None) -> dict:
        """{version, days: {day: [commit, row bound]}, epochs: {writer: epoch}, schema}; an empty one where nothing is committed."""
        if version is None:
            version = max(self.versions(), default=-1)
        if version < 0:
            return {"version": -1, "days": {}, "epochs": {}, "schema": None}
        text = "\n".join(r["value"] for r in self.spark.read.text(f"{self.path}/_log/{version:020d}.json").collect())  # one small file
        return json.loads(text)

    def _commit(self, snapshot: dict) -> None:
        entry = self._path(f"{self.path}/_log/{snapshot['version']:020d}.json")
        draft = self._path(f"{self.path}/_log/.{uuid.uuid4().hex}.draft")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(snapshot).encode("utf-8")))
        finally:
            out.close()
        if self._fs.exists(entry) or not self._fs.rename(draft, entry):
            self._fs.delete(draft, False)
            raise CommitConflict(f"version {snapshot['version']} of {self.path} exists")

    # --- rows ----------------------------------------------------------------------------

    def _folders(self, snapshot: dict, days: Sequence[str] | None = None) -> list[str]:
        chosen = snapshot["days"] if days is None else {d: snapshot["days"][d] for d in days if d in snapshot["days"]}
        return [f"{self.path}/data/{commit}/_day={day}" for day, (commit, _) in sorted(chosen.items())]

    def read(self, version: int | None = None, days: Sequence[str] | None = None) -> DataFrame:
        """The rows of a snapshot (the newest by default), of all its days or of some."""
        from pyspark.sql.types import StructType

        snapshot = self.snapshot(version)
        if snapshot["schema"] is None:
            raise RuntimeError(f"nothing is committed to {self.path}")
        schema = StructType.fromJson(snapshot["schema"])
        folders = self._folders(snapshot, days)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def files(self) -> int:
        """Data files that a reader of the newest snapshot opens."""
        return sum(sum(1 for f in self._fs.listStatus(self._path(d)) if f.getPath().getName().endswith(".parquet"))
                   for d in self._folders(self.snapshot()))

    def upsert(self, batch: DataFrame, keys: Sequence[str], day: Column, epoch: int, writer: str = "",
               order: Sequence[str] = ()) -> bool:
        """Commit ``batch``: per key and day its last row (by ``order``) replaces the table's; other days are not read.

        False where this ``epoch`` of the writer is committed already. ``day`` is a date of the row."""
        snapshot = self.snapshot()
        if snapshot["epochs"].get(writer, -1) >= epoch:
            return False
        batch = batch.withColumn("_day", F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(NO_DAY))).persist()
        try:
            touched = {r["_day"]: r["n"] for r in batch.groupBy("_day").agg(F.count(F.lit(1)).alias("n")).collect()}  # days of one batch
            days = dict(snapshot["days"])
            schema = snapshot["schema"]
            if touched:
                rows = batch
                known = [d for d in touched if d in days]
                if known:
                    old = self.read(snapshot["version"], known).withColumn("_day", F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(NO_DAY)))
                    rows = upsert(old, batch, [*keys, "_day"], order)
                else:
                    rows = upsert(batch.limit(0), batch, [*keys, "_day"], order)
                rows = rows.select(*batch.columns, *[c for c in rows.columns if c not in batch.columns])
                schema = rows.drop("_day").schema.jsonValue()
                bound = {d: n + (days[d][1] if d in days else 0) for d, n in touched.items()}
                files = F.create_map(*[F.lit(x) for d, n in bound.items() for x in (d, -(-n // self.file_rows))])
                bucket = F.pmod(F.xxhash64(*keys), files[F.col("_day")])
                commit = uuid.uuid4().hex
                width = min(sum(-(-n // self.file_rows) for n in bound.values()), int(self.spark.conf.get("spark.sql.shuffle.partitions")) * 8)
                rows.withColumn("_bucket", bucket).repartition(width, "_day", "_bucket").drop("_bucket") \
                    .write.partitionBy("_day").parquet(f"{self.path}/data/{commit}")
                days |= {d: [commit, n] for d, n in bound.items()}
            self._commit({"version": snapshot["version"] + 1, "days": days, "epochs": snapshot["epochs"] | {writer: epoch}, "schema": schema})
            return True
        finally:
            batch.unpersist()

    def vacuum(self, keep: int = 1) -> int:
        """Drop all but the last ``keep`` snapshots and the day folders that none of them names; returns how many folders went."""
        versions = self.versions()
        named = {f for v in versions[-keep:] for f in self._folders(self.snapshot(v))}
        for v in versions[:-keep]:
            self._fs.delete(self._path(f"{self.path}/_log/{v:020d}.json"), False)
        data, gone = self._path(f"{self.path}/data"), 0
        if not self._fs.exists(data):
            return 0
        for commit in self._fs.listStatus(data):
            name = commit.getPath().getName()
            days = [d.getPath() for d in self._fs.listStatus(commit.getPath()) if d.getPath().getName().startswith("_day=")]
            unused = [d for d in days if f"{self.path}/data/{name}/{d.getName()}" not in named]
            for d in unused:
                self._fs.delete(d, True)
            if len(unused) == len(days):
                self._fs.delete(commit.getPath(), True)
            gone += len(unused)
        return gone
