"""Intermediate tables on storage every executor can reach."""

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Of every table that is written, stored or scratch.
COMPRESSION = "zstd"


def scratch_root(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a temporary folder in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tillstar-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


# Folder of the run in progress, where there is one.
_current: list[str] = []


def _delete(spark: SparkSession, path: str) -> None:
    """Through the cluster's own file system, as the folder need not be local."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    target.getFileSystem(configuration).delete(target, True)


# Of Spark: whether a write deletes its shuffle files at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Writes inside delete their shuffle files when they end. Spark otherwise keeps them until
    the driver happens to collect its garbage, so that those of a whole batch lie on the disks."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def write_parquet(df: DataFrame, path: str) -> None:
    """Write a new folder, and release the shuffles that its rows came through."""
    with shuffles_released(df.sparkSession):
        df.write.option("compression", COMPRESSION).parquet(path)


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """Tables that `materialize` writes inside go to one folder, deleted at the end.

    Whatever reads them must have run by then."""
    path = f"{scratch_root(spark)}/tillstar/run-{uuid4().hex}"
    _current.append(path)
    try:
        yield path
    finally:
        _current.remove(path)
        _delete(spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the scratch folder and read it back.

    Cuts the lineage: later steps that need the same rows twice, or the
    partition a row was in, see one fixed table whatever happens to executors.
    """
    folder = _current[-1] if _current else f"{scratch_root(df.sparkSession)}/tillstar"
    path = f"{folder}/{label}-{uuid4().hex}"
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
