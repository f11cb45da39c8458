"""Inventory snapshots that arrive file by file, published as coverage only once they are whole.

A snapshot is a folder of files, and a manifest that lists them. Each micro-batch turns its lines into bitmaps
by day and keeps these, with the files it has seen, as its version; lines are never read again. When all listed files of a
snapshot are there, its bitmaps are merged and its coverage is published; until then the table of the one before stays. A
listed file must hold a line at least, as an empty one leaves no trace in a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import coverage
from ..sources import io
from ..sources.work import exists
from ..streaming import jobs as streams
from . import jobs

Reader = Callable[[SparkSession], DataFrame]
COVERAGE = "pk string, sk string, data string, last_updated timestamp, version string"


def snapshot_lines(spark: SparkSession, path: str, files: int = 1000) -> DataFrame:
    """Inventory lines as they come: snapshot (the folder below ``path``), file, value."""
    place = F.split(F.col("_metadata.file_path"), "/")
    lines = streams.file_stream(spark, f"{path}/*", "value string", "text", files)
    return lines.select(F.element_at(place, -2).alias("snapshot"), F.element_at(place, -1).alias("file"), "value")


def snapshot_sink(path: str, manifests: Reader, as_of: Column) -> Callable[[DataFrame, int], None]:
    """For a stream of `snapshot_lines`. manifests: (snapshot, file), read anew in each batch."""
    parts, arrived = streams.versions_sink(f"{path}/parts", "snapshot"), streams.versions_sink(f"{path}/arrived")

    def write(batch: DataFrame, number: int) -> None:
        held = coverage.entries(io.inventory_lines(batch, "snapshot"), carry=("snapshot",))
        parts(coverage.days(held, ("snapshot",)), number)
        arrived(batch.select("snapshot", "file").distinct(), number)
        publish(batch.sparkSession, path, manifests, as_of)

    return write


def complete(spark: SparkSession, path: str, manifests: Reader) -> DataFrame:
    """Snapshots of which all listed files have come."""
    listed = manifests(spark).select("snapshot", "file")
    missing = listed.join(spark.read.parquet(f"{path}/arrived").select("snapshot", "file"), ["snapshot", "file"], "left_anti")
    return listed.select("snapshot").distinct().join(missing.select("snapshot").distinct(), "snapshot", "left_anti")


def publish(spark: SparkSession, path: str, manifests: Reader, as_of: Column) -> str | None:
    """Publish the latest snapshot (by its name) that is whole, if it is later than the published one; returns its name.

    The sink calls this after each batch; a schedule calls it too, as a manifest may come after the last file. The mark by
    which readers find the table is written last, so they see a whole one at any time.
    """
    if not exists(spark, f"{path}/arrived"):
        return None
    latest = complete(spark, path, manifests).agg(F.max("snapshot")).first()[0]
    held = published(spark, path)
    if latest is None or held is not None and latest <= held:
        return None
    parts = spark.read.option("basePath", f"{path}/parts").parquet(f"{path}/parts").withColumn("snapshot", F.col("snapshot").cast("string"))
    days = coverage.merged(parts.where(F.col("snapshot") == latest).drop("snapshot", "version")) if exists(spark, f"{path}/parts") else None
    jobs.coverage_of_days(days, as_of).write.mode("overwrite").parquet(f"{path}/documents/{latest}")
    spark.createDataFrame([(latest,)], "snapshot string").write.mode("overwrite").parquet(f"{path}/published/{latest}")
    return latest


def published(spark: SparkSession, path: str) -> str | None:
    """The name of the snapshot whose coverage readers see."""
    if not exists(spark, f"{path}/published"):
        return None
    return spark.read.schema("snapshot string").parquet(f"{path}/published/*").agg(F.max("snapshot")).first()[0]


def current(spark: SparkSession, path: str) -> DataFrame:
    """The published coverage table; an empty one before the first."""
    held = published(spark, path)
    return spark.createDataFrame([], COVERAGE) if held is None else spark.read.schema(COVERAGE).parquet(f"{path}/documents/{held}")
