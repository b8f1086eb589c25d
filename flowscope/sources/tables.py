"""Parquet tables of a scale-factor folder."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str, source: str,
            build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return spark.read.parquet(derived_path(spark, sf_dir, name, source, build))


def derived_path(spark: SparkSession, sf_dir: str, name: str, source: str,
                 build: Callable[[DataFrame], DataFrame], fmt: str = "parquet") -> str:
    """Folder of a table Spark derives from ``source`` (e.g. text lines rendered from
    ``events``), written once (as ``fmt``) in the shared checkpoint folder and
    read back on every later call.

    The folder name hashes path, length and modification time (ms) of every
    source file as the Hadoop file system lists them, on any storage, so a
    changed input gets a new table; ``name`` carries the renderer's version. Storing the derived input
    mirrors production, where the lines are the stored input; rendering
    them inside every query would let Catalyst push the parser's filters
    into the rendering and evaluate it several times per row.
    """
    from flowscope.session import shared_dir

    src = f"{sf_dir.rstrip('/')}/{source}.parquet"
    ident = _listing(spark, src)
    path = f"{shared_dir(spark)}/{name}-{hashlib.sha1(ident.encode()).hexdigest()[:16]}"
    if not _exists(spark, path):  # only finished tables are moved here
        # write aside, then move into place: a concurrent writer never sees a
        # half-written table, and if another writer finished first its table is kept
        tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
        build(table(spark, sf_dir, source)).write.mode("overwrite").format(fmt).save(tmp)
        _rename(spark, tmp, path)
    return path


def _fs(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _listing(spark: SparkSession, path: str) -> str:
    """Path, length and modification time of every file under ``path``."""
    p, fs = _fs(spark, path)
    files, found = fs.listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return "\n".join(sorted(found))


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    """Move a finished folder into place. If another writer finished first its
    table is kept; any other failure is an error."""
    p, fs = _fs(spark, src)
    if not fs.rename(p, _fs(spark, dst)[0]) and not _exists(spark, dst):
        raise OSError(f"cannot move {src} to {dst}")


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))
