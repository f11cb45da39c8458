"""Folders for tables that a job writes on the way."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share; where that is unset, below a temporary one
    if all tasks run in the driver's own process, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-tapewright-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tapewright/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once and read again, so that later steps do not compute ``df`` anew."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_back(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that a job has written, which may have no rows yet. The schema is given, as partitioned writes of no rows leave no
    file that tells it; where there is no such folder the table is empty too."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a folder, in whatever store it is."""
    store, place = _place(spark, path)
    return store.exists(place)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders, in whatever store they are."""
    for path in paths:
        store, place = _place(spark, path)
        store.delete(place, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where there is no such folder."""
    store, place = _place(spark, path)
    if not store.exists(place):
        return []
    return sorted(f.getPath().getName() for f in store.listStatus(place) if f.isDirectory())


def claimed(spark: SparkSession, path: str, owner: str) -> str:
    """Who owns a folder: what the file `_owner` in it says, which is written where there is none yet."""
    store, place = _place(spark, f"{path}/_owner")
    if not store.exists(place):
        out = store.create(place, True)
        out.writeBytes(owner)
        out.close()
        return owner
    given = store.open(place)
    found = spark._jvm.org.apache.commons.io.IOUtils.toString(given, "UTF-8")
    given.close()
    return found


def ordered(df: DataFrame, path: str) -> int:
    """Write files whose times follow their names, as streams take files by time; returns their number."""
    spark = df.sparkSession
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f for f in store.listStatus(place) if f.getPath().getName().startswith("part-")), key=lambda f: f.getPath().getName())
    newest = max((f.getModificationTime() for f in files), default=0)
    for k, f in enumerate(files):
        store.setTimes(f.getPath(), newest + 1000 * (k - len(files)), -1)
    return len(files)
