"""Tables that jobs keep between steps, and joins against tables whose size was checked.

Executors can be lost at any time, so a step that several later steps read, or whose row ids must not
change on a retry, is written to the shared folder named by ``spark.checkpoint.dir`` and read again. An operator
removes what its result does not read (`Work`); a job of several operators removes the rest once the next table
is written (`collecting`, `remove`).
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the folders of stored tables are noted, in each thread.
_collected: ContextVar[list[str] | None] = ContextVar("collected", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where that is unset, a new temporary folder if all tasks run in the
    driver's own process. On a cluster, whose executors would not see that folder, it must be set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-tapewright-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def stored(df: DataFrame, name: str, folder: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the table that reads it."""
    spark = df.sparkSession
    path = f"{folder or new_folder(spark)}/{name}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession) -> str:
    folder = f"{shared_dir(spark).rstrip('/')}/tapewright/{uuid.uuid4().hex}"
    if (made := _collected.get()) is not None:
        made.append(folder)
    return folder


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders, in whatever store they are."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folders_read(df: DataFrame) -> list[str] | None:
    """The root folders of all files that a DataFrame reads; None if it has other sources, whose files can't be told."""
    leaves, found = df._jdf.queryExecution().analyzed().collectLeaves(), []
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        kind = leaf.getClass().getSimpleName()
        if kind == "LocalRelation":
            continue
        if kind != "LogicalRelation" or leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
            return None
        found += leaf.relation().location().rootPaths().mkString("\n").split("\n")
    return found


@contextmanager
def collecting() -> Iterator[list[str]]:
    """The folders of all tables that are stored within the block, by this thread."""
    outer, made = _collected.get(), []
    token = _collected.set(made)
    try:
        yield made
    finally:
        _collected.reset(token)
        if outer is not None:
            outer += made


class Work:
    """The tables of one run of an operator, in a folder of their own."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.names = spark, new_folder(spark), []

    def stored(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        self.names.append(name)
        return stored(df, name, self.folder, **options)

    def drop(self, *names: str) -> None:
        """Remove tables that no later step reads."""
        remove(self.spark, *(f"{self.folder}/{n}" for n in names))
        self.names = [n for n in self.names if n not in names]

    def drop_but(self, *names: str) -> None:
        self.drop(*(n for n in self.names if n not in names))


def broadcast_if_small(table: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only when a count shows that the (stored) table has at most ``most_rows`` rows.

    Beyond that the join stays a shuffle join, which adaptive execution splits where a key is hot.
    """
    return F.broadcast(table) if table.limit(most_rows + 1).count() <= most_rows else table


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
