"""Versions of a set of tables: folders that are only added to, and a commit file per version.

A version names the folders of each table. Its file is written under another name first and
then renamed, as the last step: whoever reads sees the version before or the one after, and
a run that stops halfway leaves nothing but folders that no version names.
"""

import json
from dataclasses import asdict, dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tillstar.operators.scratch import write_parquet

_DIGITS = 12


@dataclass(frozen=True)
class Version:
    """number: 0 before the first commit; folders: of each table, below the root; loads: what
    each load has added, by its name and in order."""

    number: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    loads: dict[str, dict[str, int]] = field(default_factory=dict)


def _files(spark: SparkSession, root: str):
    """The file system of `root`, and Hadoop's path class."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _commit(root: str, number: int) -> str:
    return f"{root}/versions/{number:0{_DIGITS}}.json"


def current(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The last version, or the one of a number."""
    files, path = _files(spark, root)
    folder = path(f"{root}/versions")
    if number is None:
        found = files.listStatus(folder) if files.exists(folder) else []
        names = [status.getPath().getName() for status in found]
        number = max((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), default=0)
    if not number:
        return Version()
    (row,) = spark.read.text(_commit(root, number), wholetext=True).collect()
    return Version(**json.loads(row[0]))


def add(spark: SparkSession, root: str, table: str, df: DataFrame) -> str:
    """Write a new folder of a table. No version has it until one is committed with it."""
    folder = f"tables/{table}/{uuid4().hex}"
    write_parquet(df, f"{root}/{folder}")
    return folder


def commit(spark: SparkSession, root: str, version: Version) -> Version:
    """Make a version the last one; an error if there is one of its number already."""
    files, path = _files(spark, root)
    target = path(_commit(root, version.number))
    draft = path(f"{root}/versions/.{uuid4().hex}")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(asdict(version)), "utf-8"))
    out.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise RuntimeError(f"another run has committed version {version.number} below {root}")
    return version


def read(spark: SparkSession, root: str, version: Version, table: str) -> DataFrame:
    return spark.read.parquet(*[f"{root}/{folder}" for folder in version.folders[table]])
