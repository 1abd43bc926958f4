"""Written intermediate tables in the folder that all executors share.

The folder is the one named in ``spark.checkpoint.dir``.  A session on one machine that
names none (``local`` master, as in tests) gets a folder of its own; anywhere else a job
that stages a table stops with a message.  A staged table is a Parquet file set, so losing
an executor loses nothing that later stages read.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_scopes: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """Folder for staged tables."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not re.match(r"local(\[|$)", context.master):
        raise RuntimeError(
            "this job writes an intermediate table: set spark.checkpoint.dir to a "
            "folder that every executor can reach"
        )
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="orderloom-")
    return _local_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path of its own under the shared folder."""
    return f"{_folder(spark, *_scopes)}/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_root(spark), "orderloom", spark.sparkContext.applicationId, *parts])


@contextmanager
def scope(name: str) -> Iterator[None]:
    """Tables that are staged inside share a folder that ``drop_staged`` can remove alone."""
    _scopes.append(name)
    try:
        yield
    finally:
        _scopes.pop()


def stage(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written copy.

    ``codec`` names a compression other than the session's: zstd halves tables of texts.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.mode("errorifexists")
    (writer.option("compression", codec) if codec else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, *scopes: str) -> None:
    """Remove what this application staged, or what it staged in a scope, once it is used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark, *scopes))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
