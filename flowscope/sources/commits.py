"""A table of immutable Parquet folders and a log of commits.

Spark writes every batch to a folder of its own; the batch becomes visible when a
small JSON file with the next number is moved into ``commits/``, which fails if
the number is taken, so writers never overwrite each other's commits and readers
never see half a batch: a reader's frame is made of the folders that the commits
it listed say are live. A commit either puts a batch of a source (a second put
of the same batch, a replay, replaces the first) or replaces the whole table,
which is how it is emptied and how superseded batches are folded into one folder.
Each commit holds the smallest and largest time of its rows; the latest rows are
read from the folders that hold the latest time alone.

A commit is about 200 bytes and the log is read by Spark. Folders that no longer
count stay until ``vacuum``, so that frames read before go on working.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowscope.sources.tables import _fs

COMMIT = "version long, replace boolean, source string, batch_id long, folder string, low string, high string, n long"


class CommitConflict(RuntimeError):
    """Another writer took the number of a commit, again and again."""


class CommittedTable:
    """``path`` as a table of ``schema``; ``time_col`` is the column whose range commits hold."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, time_col: str | None = None):
        self.spark, self.path, self.schema, self.time_col = spark, path.rstrip("/"), schema, time_col

    # ---- reading
    def live(self) -> DataFrame:
        """The commits in force: of each (source, batch) the last one since the table was last replaced."""
        try:
            log = self.spark.read.schema(COMMIT).json(f"{self.path}/commits/*.json")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMIT)
        start = F.coalesce(log.where("replace").agg(F.max("version")).scalar(), F.lit(-1))
        last = log.where(F.col("version") >= start).groupBy("source", "batch_id").agg(
            F.max_by(F.struct("version", "folder", "low", "high", "n"), "version").alias("c"))
        return last.select("source", "batch_id", "c.*").where("folder IS NOT NULL AND n > 0")

    def _rows(self, commits: DataFrame) -> DataFrame:
        folders = [f"{self.path}/rows/{r.folder}" for r in commits.select("folder").distinct().collect()]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def read(self) -> DataFrame:
        """All rows, as of now."""
        return self._rows(self.live())

    def read_latest(self) -> DataFrame:
        """The rows of the largest time: only folders that hold it are read."""
        live = self.live().persist()
        try:
            high = live.agg(F.max("high")).first()[0]
            rows = self._rows(live.where(F.col("high") == high)) if high is not None else self._rows(live.limit(0))
        finally:
            live.unpersist()
        if high is None:
            return rows
        return rows.where(F.col(self.time_col) == F.lit(high).cast(self.schema[self.time_col].dataType))

    # ---- writing
    def put(self, df: DataFrame, source: str, batch_id: int) -> int:
        """Add a batch, or replace the same batch of the source; returns the commit's number."""
        return self._commit(False, source, batch_id, *self._write(df))

    def replace(self, df: DataFrame | None = None, source: str = "table", batch_id: int = 0) -> int:
        """Make ``df`` (nothing, if none is given) the whole table."""
        return self._commit(True, source, batch_id, *(self._write(df) if df is not None else (None, None, None, 0)))

    def _write(self, df: DataFrame):
        folder, seen = uuid.uuid4().hex, Observation()
        time = F.col(self.time_col) if self.time_col else F.lit(None).cast("timestamp_ntz")
        # as text: fixed width, so that text order is time order
        text = [F.date_format(f(time), "yyyy-MM-dd HH:mm:ss.SSSSSS") for f in (F.min, F.max)]
        rows = df.select(*self.schema.names).observe(seen, text[0].alias("low"), text[1].alias("high"), F.count(F.lit(1)).alias("n"))
        rows.write.parquet(f"{self.path}/rows/{folder}")
        got = seen.get
        return folder, got["low"], got["high"], got["n"]

    def _commit(self, replace: bool, source: str, batch_id: int, folder, low, high, n, tries: int = 50) -> int:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        base, fs = _fs(self.spark, f"{self.path}/commits")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(base.toUri(), conf)
        plain = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        fs.mkdirs(base)
        for _ in range(tries):
            taken = [int(s.getPath().getName()[:20]) for s in fs.listStatus(base) if s.getPath().getName().endswith(".json")]
            version = max(taken, default=-1) + 1
            entry = dict(version=version, replace=replace, source=source, batch_id=batch_id, folder=folder, low=low, high=high, n=n)
            aside = jvm.org.apache.hadoop.fs.Path(base, f".{uuid.uuid4().hex}")
            out = fs.create(aside)
            out.write(bytearray(json.dumps(entry).encode()))
            out.close()
            try:
                files.rename(aside, jvm.org.apache.hadoop.fs.Path(base, f"{version:020d}.json"), plain)
                return version
            except Exception as e:  # noqa: BLE001 - py4j wraps every Java exception in one class
                fs.delete(aside, False)
                if "FileAlreadyExistsException" not in str(e):
                    raise
        raise CommitConflict(self.path)

    # ---- upkeep
    def vacuum(self) -> int:
        """Delete folders that no live commit names; readers of older frames must be done, and no
        writer may be between its rows and its commit. Returns the number of folders."""
        base, fs = _fs(self.spark, f"{self.path}/rows")
        used = {r.folder for r in self.live().select("folder").collect()}
        old = [s.getPath() for s in fs.listStatus(base) if s.getPath().getName() not in used] if fs.exists(base) else []
        for p in old:
            fs.delete(p, True)
        return len(old)
