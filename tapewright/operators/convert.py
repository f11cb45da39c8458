"""Schema conversions: quotes, trades, best bid and offer, bars. Each reads ticks and groups them once; ``by`` names columns
that keep outputs apart, such as those of jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NS = 1_000_000_000
SECONDS = {"ohlcv-1s": 1, "ohlcv-1m": 60, "ohlcv-1h": 3600, "bbo-1s": 1, "bbo-1m": 60}
ENTRY = ("security_id", "exchange_id")


def interval_start(ts_ns: Column, seconds: int) -> Column:
    """Start of a tick's interval in epoch seconds, from nanoseconds without rounding."""
    step = seconds * NS
    return ((ts_ns - F.pmod(ts_ns, F.lit(step))) / F.lit(NS)).cast("long")


def to_mbp1(ticks: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Level 0 of the book: one row for each tick."""
    keep = [c for c in ticks.columns if not c.startswith(("bid_", "ask_")) or c.endswith("_0")]
    return ticks.select(*keep).withColumn("schema", F.lit("mbp-1"))


def to_trades(ticks: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    keep = [*by] + [c for c in ("security_id", "exchange_id", "listing_id", "minute", "pos", "sequence", "ts_event_ns", "price", "size") if c in ticks.columns]
    return ticks.where("action = 'Trade'").select(*keep, F.lit("trades").alias("schema"))


def to_bbo(ticks: DataFrame, seconds: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Last known best bid and offer of each interval that has one."""
    at = F.struct("ts_event_ns", "pos")
    found = ticks.where("bid_px_0 is not null or ask_px_0 is not null").withColumn("bar_start", interval_start(F.col("ts_event_ns"), seconds))
    return found.groupBy(*by, *ENTRY, "bar_start").agg(F.max_by("bid_px_0", at).alias("bid_px_0"), F.max_by("ask_px_0", at).alias("ask_px_0"))


def to_ohlcv(ticks: DataFrame, seconds: int, price_col: str = "price", trades_only: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """Open, high, low, close and volume of each interval with a price; order is by event time, then place in the file."""
    found = ticks.where(f"{price_col} is not null" + (" and action = 'Trade'" if trades_only else "")).withColumn("bar_start", interval_start(F.col("ts_event_ns"), seconds))
    at = F.struct("ts_event_ns", "pos")
    return found.groupBy(*by, *ENTRY, "bar_start").agg(
        F.min_by(price_col, at).alias("open"),
        F.max(price_col).alias("high"),
        F.min(price_col).alias("low"),
        F.max_by(price_col, at).alias("close"),
        F.sum(F.coalesce("size", F.lit(0)).cast("decimal(38,0)")).cast("long").alias("volume"),
        F.count("*").alias("n_records"),
    )


def roll_up(bars: DataFrame, seconds: int) -> DataFrame:
    """Longer bars from shorter ones; equal to bars made from the ticks."""
    start = F.col("bar_start") - F.pmod("bar_start", F.lit(seconds))
    return bars.withColumn("_start", start).groupBy(*ENTRY, "_start").agg(
        F.min_by("open", "bar_start").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "bar_start").alias("close"), F.sum("volume").alias("volume"), F.sum("n_records").alias("n_records")
    ).withColumnRenamed("_start", "bar_start")


def only_complete_hours(bars: DataFrame, manifest: DataFrame) -> DataFrame:
    """Hourly bars of hours whose minute 59 exists, stored under that minute (`job_minute`)."""
    last = manifest.where("minute(minute) = 59").select(*ENTRY, (F.unix_timestamp(F.date_trunc("hour", "minute"))).alias("bar_start"), F.unix_timestamp("minute").alias("job_minute")).distinct()
    return bars.join(last, [*ENTRY, "bar_start"])


#: Conversions by (source, target).
REGISTRY: dict[tuple[str, str], Callable[..., DataFrame]] = {}
for _source in ("mbp-10", "mbp-1", "mbo"):
    REGISTRY[_source, "trades"] = to_trades
    for _target in ("ohlcv-1s", "ohlcv-1m", "ohlcv-1h"):
        REGISTRY[_source, _target] = lambda t, by=(), s=SECONDS[_target]: to_ohlcv(t, s, by=by)
for _source in ("mbp-10", "mbp-1"):
    for _target in ("bbo-1s", "bbo-1m"):
        REGISTRY[_source, _target] = lambda t, by=(), s=SECONDS[_target]: to_bbo(t, s, by)
REGISTRY["mbp-10", "mbp-1"] = to_mbp1
REGISTRY["mbp-10", "mbp-10"] = lambda t, by=(): t


def convert(ticks: DataFrame, source: str, target: str, by: tuple[str, ...] = ()) -> DataFrame:
    if (source, target) not in REGISTRY:
        raise ValueError(f"no conversion from {source} to {target}")
    return REGISTRY[source, target](ticks, by)
