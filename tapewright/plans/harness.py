"""Ticks, manifest and other tables derived from the given `events` table, in Spark and as SQL for the oracle.

The derivation is a pure projection, so its size follows the events. `cycle` is the length of a file's time span:
minutes hold one event or so in the given data, so queries about the contents of a cycle use hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ACTIONS = {"purchase": "Trade", "click": "Add", "view": "Modify", "signup": "Fill", "error": "Cancel"}
SOURCE = "mbp-10"
STEP = 10_000_000


def ticks(spark: SparkSession, sf_dir: str, cycle: str = "hour") -> DataFrame:
    """Captured ticks with the columns of the tick table that the operators read."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value", "props")
    at = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("long")
    price = (F.round(F.col("value") * 100).cast("long") * STEP).alias("price")
    action = F.coalesce(*[F.when(F.col("event_type") == n, a) for n, a in ACTIONS.items()])
    security, exchange = (F.col("user_id") % 3).cast("int"), (F.col("user_id") % 2).cast("int")
    e = e.select(
        "event_id",
        security.alias("security_id"),
        exchange.alias("exchange_id"),
        (security * 10 + exchange).alias("listing_id"),
        F.lit(SOURCE).alias("schema"),
        F.date_trunc(cycle, at).alias("minute"),
        F.concat(F.lit("c"), (F.col("event_id") % 3).cast("string")).alias("capture_id"),
        F.col("event_id").alias("pos"),
        ((F.col("event_id") * 7919) % 1009).alias("sequence"),
        (F.unix_micros(at) * 1000 + F.when(F.col("event_id") % 50 == 0, F.lit(60_000_000_000)).otherwise(F.lit(0))).alias("ts_event_ns"),
        action.alias("action"),
        price,
        k.alias("size"),
        (k % 17 == 0).alias("maybe_bad_book"),
        (k % 23 == 0).alias("bad_ts_recv"),
    )
    there = F.col("event_id") % 11 != 0
    return e.withColumn("bid_px_0", F.when(there, F.col("price") - (F.col("event_id") % 7) * STEP)).withColumn("ask_px_0", F.when(there, F.col("price") + (F.col("event_id") % 5 - 1) * STEP)).drop("event_id")


def ticks_sql(cycle: str = "hour") -> str:
    """The same as a common table expression named `ticks`, with `minute` in epoch seconds."""
    cases = " ".join(f"WHEN '{n}' THEN '{a}'" for n, a in ACTIONS.items())
    return f"""e0 AS (
  SELECT event_id, CAST(user_id % 3 AS INTEGER) AS security_id, CAST(user_id % 2 AS INTEGER) AS exchange_id,
         CAST(epoch(date_trunc('{cycle}', ts)) AS BIGINT) AS minute, epoch_us(ts) AS us,
         CASE event_type {cases} END AS action,
         CAST(round(value * 100) AS BIGINT) * {STEP} AS price, CAST(json_extract_string(props, '$.k') AS BIGINT) AS size
  FROM events),
ticks AS (
  SELECT security_id, exchange_id, security_id * 10 + exchange_id AS listing_id, '{SOURCE}' AS schema, minute,
         'c' || CAST(event_id % 3 AS VARCHAR) AS capture_id, event_id AS pos, (event_id * 7919) % 1009 AS sequence,
         us * 1000 + CASE WHEN event_id % 50 = 0 THEN 60000000000 ELSE 0 END AS ts_event_ns,
         action, price, size, size % 17 = 0 AS maybe_bad_book, size % 23 = 0 AS bad_ts_recv,
         CASE WHEN event_id % 11 <> 0 THEN price - (event_id % 7) * {STEP} END AS bid_px_0,
         CASE WHEN event_id % 11 <> 0 THEN price + (event_id % 5 - 1) * {STEP} END AS ask_px_0
  FROM e0)"""


def manifest(ticks_: DataFrame) -> DataFrame:
    """One row per file that holds ticks."""
    return ticks_.groupBy("security_id", "exchange_id", "listing_id", "schema", "minute").agg(F.count("*").alias("n_records"), (F.count("*") * 100).alias("size_bytes"))


def listings(ticks_: DataFrame) -> DataFrame:
    """The listing dimension as it occurs in the ticks."""
    return ticks_.select("listing_id", "security_id", "exchange_id", F.col("schema").alias("source_schema")).distinct()
