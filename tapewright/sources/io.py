"""Sources and sinks: tick and manifest tables, inventory listings, notifications, and table writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import keys
from ..operators import tables
from .work import exists, stored


def read_ticks(spark: SparkSession, path: str, raw: bool = False) -> DataFrame:
    """The tick table with its explicit schema; columns that older files lack are null. Filters on date, exchange and minute reach the files."""
    return spark.read.schema(schemas.RAW_TICKS if raw else schemas.TICKS).option("mergeSchema", "false").parquet(path)


def with_level_0(ticks: DataFrame) -> DataFrame:
    """Level 0 of the book as flat columns."""
    return ticks.withColumns({f"{c}_0": F.get(c, F.lit(0)) for c in ("bid_px", "ask_px", "bid_sz", "ask_sz", "bid_ct", "ask_ct")})


def captures(raw: DataFrame, security_id: int, exchange_id: int, schema: str, minute: Column) -> DataFrame:
    """Raw captures of one minute."""
    return raw.where((F.col("security_id") == security_id) & (F.col("exchange_id") == exchange_id) & (F.col("schema") == schema) & (F.col("minute") == minute))


def entries_of_listings(manifest: DataFrame, listings: DataFrame, day: Column | None = None) -> DataFrame:
    """Entries of the listings' own source schema, of one day if given."""
    own = listings.select("security_id", "exchange_id", F.col("source_schema").alias("schema"))
    found = manifest.join(own, ["security_id", "exchange_id", "schema"], "left_semi")
    return found if day is None else found.where(F.to_date("minute") == day)


def with_listing(entries: DataFrame, listings: DataFrame, missing: str = "skip") -> DataFrame:
    """Entries with their listing_id; unknown ones are left out, or with missing='fail' an error."""
    known = listings.select("listing_id", "security_id", "exchange_id").withColumnRenamed("listing_id", "_listing")
    joined = entries.join(known, ["security_id", "exchange_id"], "inner" if missing == "skip" else "left")
    found = F.col("_listing") if missing == "skip" else F.when(F.col("_listing").isNull(), F.raise_error(F.lit("entry of an unknown listing"))).otherwise(F.col("_listing"))
    return joined.withColumn("listing_id", found.cast("int")).drop("_listing")


def with_pair(entries: DataFrame, listings: DataFrame, missing: str = "skip") -> DataFrame:
    """Rows that name a listing with its security, exchange and source schema; unknown listings as in `with_listing`."""
    known = listings.select("listing_id", "security_id", "exchange_id", "source_schema", F.lit(True).alias("_known"))
    joined = entries.join(known, "listing_id", "inner" if missing == "skip" else "left")
    if missing != "skip":
        joined = joined.withColumn("security_id", F.when(F.col("_known").isNull(), F.raise_error(F.lit("unknown listing"))).otherwise(F.col("security_id")))
    return joined.drop("_known")


def sorted_entries(entries: DataFrame, *tie: str) -> DataFrame:
    """Entries by minute, then by further columns: ranges are dealt to tasks and sorted there."""
    return entries.orderBy("minute", *tie)


def inventory_lines(lines: DataFrame, *carry: str) -> DataFrame:
    """(key, size) of inventory lines (column `value`): lines of under five fields are left out; the sixth is the size, else 0."""
    field = lambda i: F.regexp_replace(F.get(F.col("_f"), F.lit(i)), '^"|"$', "")
    parts = lines.select(F.split("value", ",").alias("_f"), *carry).where(F.size("_f") >= 5)
    size = F.when(F.size("_f") >= 6, F.coalesce(F.trim(field(5)).try_cast("long"), F.lit(0))).otherwise(F.lit(0))
    return parts.select(field(1).alias("key"), size.alias("size"), *carry)


def read_inventory(spark: SparkSession, *paths: str) -> DataFrame:
    """All files of one snapshot together, gzipped or not, without header."""
    return inventory_lines(spark.read.text(list(paths)))


_EVENT = "STRUCT<Records: ARRAY<STRUCT<s3: STRUCT<bucket: STRUCT<name: STRING>, object: STRUCT<key: STRING, size: BIGINT>>>>>"


def notified_keys(messages: DataFrame, body: str = "body") -> DataFrame:
    """Distinct object keys of envelopes: JSON with a `Message` that is JSON again; whatever does not parse is skipped."""
    inner = F.from_json(F.get_json_object(body, "$.Message"), _EVENT)
    return messages.select(F.explode(inner["Records"]).alias("r")).select(F.col("r.s3.object.key").alias("key")).where("key is not null").distinct()


def notified_entries(messages: DataFrame, body: str = "body", strict: bool = False) -> DataFrame:
    """Distinct entries that notifications name."""
    return notified_keys(messages, body).select(keys.parse_key(F.col("key"), strict).alias("k")).where("k is not null").select("k.*").distinct()


def inventory_notices(messages: DataFrame, body: str = "body") -> DataFrame:
    """The object key of the first record of one-level notifications."""
    return messages.select(F.get_json_object(body, "$.Records[0].s3.object.key").alias("key")).where("key is not null")


def overwrite_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that ``df`` has rows of; others stay. Writing again gives the same table."""
    df.write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def append(df: DataFrame, path: str, *by: str) -> None:
    (df.write.partitionBy(*by) if by else df.write).mode("append").parquet(path)


def snapshot(df: DataFrame, path: str) -> None:
    """Replace a whole table, for coverage."""
    df.write.mode("overwrite").parquet(path)


def upsert(new: DataFrame, path: str, *key: str, by: tuple[str, ...] = ("date",), keep_reviewed: bool = False) -> DataFrame:
    """Put rows by key into a table partitioned by ``by``, of which only partitions that the rows touch are read and written.

    With ``keep_reviewed`` reviewed rows stay as they are. Rows that lack a part of the key are not put but returned with an
    `error`; the others are not held up by them. There is one writer for a table; putting again changes nothing.
    """
    spark = new.sparkSession
    good = tables.valid_updates(new, key).dropDuplicates(list(key))
    if exists(spark, path):
        # a table that has had no rows yet holds no file to infer a schema from
        old = spark.read.schema(good.schema).parquet(path).join(good.select(*by).distinct(), list(by), "left_semi")
        good = (tables.put_unreviewed if keep_reviewed else tables.put)(old.select(*good.columns), good, *key)
    # written elsewhere first, as the table is read until then
    overwrite_partitions(stored(good, "put"), path, *by)
    return tables.invalid_updates(new, key)


def statistics_range(stats: DataFrame, listing_id: int, start: Column, end: Column, hour: int | None = None) -> DataFrame:
    """Statistics of a listing in a date range, both ends included."""
    found = stats.where((F.col("listing_id") == listing_id) & F.col("date").between(start, end))
    return found if hour is None else found.where(F.col("hour") == hour)
