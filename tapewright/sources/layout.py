"""The tick table as it should lie on disk: partitioned by date and exchange, bucketed and sorted by security and minute.

Scans of a day or minute read its partition only. All ticks of a file are in one bucket, so what is grouped by file (merging,
rules, metrics) needs no shuffle, however large the table; and buckets part the securities of an exchange, of which
one may be far larger than the others, by minute too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = ("date", "exchange_id")
BUCKET = ("security_id", "minute")
#: Buckets of a partition, and so tasks of a job over a day; some hundreds of MB each at the size in view.
BUCKETS = 64
#: Columns with an entry for each level of the book.
DEPTH = ("bid_px", "ask_px", "bid_sz", "ask_sz", "bid_ct", "ask_ct")


def write_ticks(ticks: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> None:
    """Write ticks as a table of the catalog whose files lie at ``path``. Rows are dealt as buckets are, so a task writes one
    file for each partition that it has rows of."""
    dated = ticks.withColumn("date", F.to_date("minute")).repartition(buckets, *BUCKET)
    dated.write.partitionBy(*PARTITION).bucketBy(buckets, *BUCKET).sortBy(*BUCKET).option("path", path).mode("overwrite").format("parquet").saveAsTable(table)


def read_ticks(spark: SparkSession, table: str) -> DataFrame:
    """The table, with joins on all columns of a file's key allowed to use its buckets, which are made of two of them."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark.table(table)


def captures(table: DataFrame, security_id: int, exchange_id: int, schema: str, minute: Column) -> DataFrame:
    """Raw captures of one minute: one partition is read."""
    here = (F.col("date") == F.to_date(minute)) & (F.col("exchange_id") == exchange_id)
    return table.where(here & (F.col("security_id") == security_id) & (F.col("schema") == schema) & (F.col("minute") == minute))


def of_day(table: DataFrame, day: Column) -> DataFrame:
    """Ticks of one day: its partitions are read."""
    return table.where(F.col("date") == day)


def even(ticks: DataFrame) -> DataFrame:
    """Ticks in which all levels of the book have all their columns; a record whose columns differ in depth is an error as
    soon as one of them is read."""
    there = [c for c in DEPTH if c in ticks.columns]
    sizes = F.filter(F.array(*(F.when(F.col(c).isNotNull(), F.size(c)) for c in there)), lambda n: n.isNotNull())
    ragged = F.size(F.array_distinct(sizes)) > 1
    return ticks.withColumns({c: F.when(ragged, F.raise_error(F.lit("columns of the book differ in depth"))).otherwise(F.col(c)) for c in there})
