"""The ledger of conversion jobs: creating, running and closing them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import keys
from . import convert, tables

JOB = ("job_id", "minute")


def conversions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(config.CONVERSIONS), "source_schema string, target_schema string")


def candidates(entries: DataFrame, listings: DataFrame, strict: bool = True) -> DataFrame:
    """Jobs that entries call for: all convertible targets, hourly bars at minute 59 only.

    An entry of an unknown listing is an error, or with strict=False left out.
    """
    spark = entries.sparkSession
    pairs = entries.join(F.broadcast(conversions(spark)), F.col("schema") == F.col("source_schema")).drop("source_schema")
    pairs = pairs.where((F.col("target_schema") != "ohlcv-1h") | (F.minute("minute") == 59))
    known = listings.select("listing_id", "security_id", "exchange_id")
    found = pairs.join(known, ["security_id", "exchange_id"], "left" if strict else "inner")
    listing = F.when(F.col("listing_id").isNull(), F.raise_error(F.lit("entry of an unknown listing"))).otherwise(F.col("listing_id")) if strict else F.col("listing_id")
    return found.select(listing.cast("int").alias("listing_id"), "minute", F.col("target_schema").alias("schema"))


def created(entries: DataFrame, listings: DataFrame, jobs: DataFrame, as_of: Column, strict: bool = True) -> DataFrame:
    """Rows to append: pending jobs whose key the ledger lacks."""
    new = candidates(entries, listings, strict).withColumn("job_id", keys.job_id(F.col("listing_id"), F.col("schema")))
    new = tables.insert_if_absent(jobs, new, *JOB)
    empty = F.lit(None)
    return new.select("job_id", "minute", "listing_id", "schema", F.lit("PENDING").alias("status"), as_of.alias("created_at"), empty.cast("timestamp").alias("processed_at"), empty.cast("string").alias("error_message"), empty.cast("bigint").alias("expires_at"))


def pending(jobs: DataFrame, schema: str, limit: int | None = None) -> DataFrame:
    found = jobs.where((F.col("schema") == schema) & (F.col("status") == "PENDING"))
    return found if limit is None else found.orderBy("minute", "job_id").limit(limit)


def current(versions: DataFrame) -> DataFrame:
    """The ledger as it stands, of rows by several writers: a job that any of them has closed is closed; else its latest row."""
    rank = F.struct((F.col("status") != "PENDING").alias("closed"), F.col("version"))
    rest = [c for c in versions.columns if c not in (*JOB, "writer", "version")]
    best = versions.groupBy(*JOB).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return best.select(*JOB, "_row.*").select(*(c for c in versions.columns if c in (*JOB, *rest)))


def job_minutes(jobs: DataFrame) -> DataFrame:
    """The minutes that each job reads: its own, or those of its hour for hourly bars."""
    start, n = keys.window_start(F.col("minute"), F.col("schema")), keys.window_minutes(F.col("schema"))
    step = F.expr("interval 1 minute")
    return jobs.withColumn("source_minute", F.explode(F.sequence(start, F.timestamp_seconds(F.unix_timestamp(start) + (n - 1) * 60), step)))


#: What tells the output and the input of jobs apart.
OF_JOB = ("job_id", "job_minute")


def job_input(jobs: DataFrame, ticks: DataFrame, schema: str) -> DataFrame:
    """Ticks that the jobs of one schema read, with job_id and job_minute. Hourly jobs join by hour, so their minutes are not
    listed."""
    hourly = schema == "ohlcv-1h"
    bucket = (lambda c: F.date_trunc("hour", c)) if hourly else (lambda c: c)
    wanted = jobs.select("job_id", F.col("minute").alias("job_minute"), "listing_id", bucket(F.col("minute")).alias("_bucket"))
    return ticks.withColumn("_bucket", bucket(F.col("minute"))).join(wanted, ["listing_id", "_bucket"]).drop("_bucket")


def unreadable(ticks: DataFrame) -> Column:
    """Records that no conversion can place: without event time or action, or trades without price or size."""
    there = set(ticks.columns)
    bad = F.lit(False)
    for c in {"ts_event_ns", "action"} & there:
        bad = bad | F.col(c).isNull()
    for c in {"price", "size"} & there:
        bad = bad | (F.coalesce(F.col("action") == "Trade", F.lit(False)) & F.col(c).isNull())
    return bad


def failures(jobs: DataFrame, given: DataFrame, listings: DataFrame | None = None) -> DataFrame:
    """Jobs that can't be done, each with its own error, so that one does not end the others: (job_id, minute, error_message).

    given: `job_input` of the jobs. A job fails if its listing is unknown (where listings are given) or its input holds
    records that can't be read; a job without input does not.
    """
    counts = given.groupBy(*OF_JOB).agg(F.count("*").alias("n"), F.count_if(unreadable(given)).alias("bad")).where("bad > 0")
    found = counts.select("job_id", F.col("job_minute").alias("minute"), F.format_string("%d of %d records can't be read", "bad", "n").alias("error_message"))
    if listings is None:
        return found
    unknown = jobs.join(listings.select("listing_id").distinct(), "listing_id", "left_anti")
    unknown = unknown.select(*JOB, F.format_string("no such listing: %d", "listing_id").alias("error_message"))
    return found.join(unknown, list(JOB), "left_anti").union(unknown)


def converted(given: DataFrame, schema: str, source: str = "mbp-10") -> DataFrame:
    """Output of `job_input` in one plan, apart for each job; a job without input has none."""
    return convert.convert(given, source, schema, OF_JOB)


def closed(jobs: DataFrame, as_of: Column, failed: DataFrame | None = None) -> DataFrame:
    """New versions of processed jobs: FAILED with the error for those in failed (job_id, minute, error_message), else COMPLETE."""
    done = jobs.drop("status", "processed_at", "error_message", "expires_at")
    done = done.withColumn("error_message", F.lit(None).cast("string")) if failed is None else done.join(failed.select(*JOB, "error_message"), list(JOB), "left")
    status = F.when(F.col("error_message").isNotNull(), "FAILED").otherwise("COMPLETE")
    return done.withColumns({"status": status, "processed_at": as_of, "expires_at": keys.expires_at(as_of)}).select(*jobs.columns)
