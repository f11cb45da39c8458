"""Keyed tables for listing: rows of a status lie in order of time, and a page reads the few files that can hold it.

The table is a folder with `rows`, whose files hold consecutive ranges of (status, time, tie) from the latest on, and
`index`, a row for each file and status with its first and last time and number of rows.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables

#: Rows of a file.
PER_FILE = 1_000_000


def write(rows: DataFrame, path: str, status: str = "status", by: str = "minute", tie: str = "listing_id", per_file: int = PER_FILE) -> None:
    spark = rows.sparkSession
    order = (F.col(status), F.col(by).desc(), F.col(tie).desc())
    files = max(1, -(-rows.count() // per_file))
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", per_file).parquet(f"{path}/rows")
    held = spark.read.schema(rows.schema).parquet(f"{path}/rows").groupBy(F.col("_metadata.file_path").alias("file"), status)
    held.agg(F.min(by).alias("first"), F.max(by).alias("last"), F.count("*").alias("n")).write.parquet(f"{path}/index")


def files_of_page(spark: SparkSession, path: str, value: Any, limit: int, before: Any = None, status: str = "status") -> list[str]:
    """Files that hold the ``limit`` latest rows of a status, of those at or before a time: a few, as no more are looked
    at than a page has rows; all that the index admits where more than that overlap the time."""
    index = spark.read.parquet(f"{path}/index").where(F.col(status) == value)
    if before is not None:
        index = index.where(F.col("first") <= before)
    latest = index.orderBy(F.col("last").desc(), F.col("first").desc(), "file")
    overlaps = F.lit(False) if before is None else F.col("last") >= before
    top = latest.select("file", "first", "last", "n", overlaps.alias("cut")).limit(limit + 2).collect()
    so_far, bound = 0, None
    for row in top:
        so_far += 0 if row["cut"] else row["n"]
        if so_far >= limit:
            bound = row["first"]
            break
    if bound is None:  # the index ends here, or many files hold the time itself
        return [r["file"] for r in index.select("file").collect()] if len(top) == limit + 2 else [r["file"] for r in top]
    return [r["file"] for r in top if r["last"] >= bound]


def page(spark: SparkSession, path: str, value: Any, limit: int = 100, after: tuple[Any, Any] | None = None, status: str = "status", by: str = "minute", tie: str = "listing_id") -> DataFrame:
    """The latest rows of a status, or those that follow the last one (time, tie) of a page."""
    before = None if after is None else F.lit(after[0])
    files = files_of_page(spark, path, value, limit, before, status)
    schema = spark.read.parquet(f"{path}/rows").schema
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    follows = [] if after is None else [tables.after(by, tie, F.lit(after[0]), F.lit(after[1]))]
    return tables.listed(rows, F.col(status) == value, *follows, by=by, tie=(tie,), limit=limit, most=limit)
