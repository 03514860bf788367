"""Intermediate tables that outlive an executor, and caching."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="tallygrove-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may run without the setting, where driver and
    executors are one process: it gets one temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master").startswith("local"):
        raise ValueError(
            "set spark.checkpoint.dir to a folder that all executors share"
        )
    return _own_dir()


#: What the open scopes have been handed, the innermost last.
_scopes: list[list[str]] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; no two calls return the same.

    It belongs to the innermost open scope (see ``leaving_nothing``), if there is one.
    """
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete what lies at ``path``, in whatever file system; nothing there is fine."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


@contextmanager
def leaving_nothing(spark: SparkSession) -> Iterator[None]:
    """Delete all intermediate tables that were written within, when the block ends.

    Results are read from such tables, so read or write them before the end: a job's
    or query's caller opens the scope, not the query. Scopes can be nested.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            remove(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and scan it back.

    Cuts the lineage: losing an executor afterwards costs a re-read of the
    written columns, never a recomputation of what produced them.
    """
    return _write_and_scan(df, shared_path(df.sparkSession, name))


def _write_and_scan(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, reuse: str) -> Iterator[DataFrame]:
    """``df`` made ready for several passes, for the length of a ``with`` block.

    * ``"rescan"``: nothing is kept. Right for columnar sources, where each
      pass reads a few pruned columns.
    * ``"stage"``: one columnar copy in the shared folder, deleted at the end.
      Right for text, which is slow to parse again, and for clusters that
      lose executors.
    * ``"cache"``: executor memory, spilling to disk, released at the end.
    """
    if reuse == "rescan":
        yield df
    elif reuse == "stage":
        path = shared_path(df.sparkSession, "staged")
        try:
            yield _write_and_scan(df, path)
        finally:
            remove(df.sparkSession, path)
    elif reuse == "cache":
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield kept
        finally:
            kept.unpersist()
    else:
        raise ValueError(f"reuse must be rescan, stage or cache, not {reuse!r}")
