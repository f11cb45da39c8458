"""Metrics of a file (one listing and minute), and their hourly sufficient statistics."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BOOK_SCHEMAS, PRICE_SCALE, SIZE_SCALE, TRADE_SCHEMAS

CYCLE = ("listing_id", "minute", "schema")


def _total(value: Column) -> Column:
    """Sum of longs without overflow."""
    return F.sum(value.cast("decimal(38,0)")).cast("double")


def aggregates() -> dict[str, Column]:
    """Each metric as an aggregate over the ticks of a file; null where it does not apply."""
    bid, ask = F.col("bid_px_0"), F.col("ask_px_0")
    both = bid.isNotNull() & ask.isNotNull()
    spread = F.when(both & (ask >= bid), ask - bid)
    mid = F.when(both, bid.cast("decimal(38,0)") + ask)
    trade = F.col("action") == "Trade"
    book = F.first("schema").isin(*BOOK_SCHEMAS)
    traded = F.first("schema").isin(*TRADE_SCHEMAS)
    price = F.col("price").cast("double") / float(PRICE_SCALE)
    return {
        "tickCount": F.count("*").cast("double"),
        "spread": F.when(book, F.try_divide(_total(spread), F.count(spread)) / float(PRICE_SCALE)),
        "midPrice": F.when(book, F.try_divide(F.sum(mid).cast("double"), 2 * F.count(mid)) / float(PRICE_SCALE)),
        "tradeVolume": F.when(traded, F.coalesce(_total(F.when(trade, F.col("size"))), F.lit(0.0)) / float(SIZE_SCALE)),
        "tradeFrequency": F.when(traded, F.count_if(trade).cast("double")),
        "volatility": F.when(traded & (F.count("price") >= 2), F.stddev_pop(price)),
    }


#: Metrics of one's own by name, as aggregates over the ticks of a file.
Own = Mapping[str, Callable[[], Column]]


def wide(ticks: DataFrame, cycle: tuple[str, ...] = CYCLE, more: Own | None = None) -> DataFrame:
    """One row per file with all metrics, and ``more`` of them: a single partial and final aggregate serves them all."""
    own = {n: made().cast("double") for n, made in (more or {}).items()}
    return ticks.groupBy(*cycle).agg(*(c.alias(n) for n, c in (aggregates() | own).items()))


def with_empty_files(metrics: DataFrame, manifest: DataFrame) -> DataFrame:
    """Adds files that exist without a record: tickCount is 0, sums of trades are 0, the rest is null."""
    files = manifest.select("listing_id", "minute", "schema").distinct()
    joined = files.join(metrics.drop("schema"), ["listing_id", "minute"], "left")
    traded = F.col("schema").isin(*TRADE_SCHEMAS)
    return joined.withColumn("tickCount", F.coalesce("tickCount", F.lit(0.0))).withColumns({m: F.when(traded, F.coalesce(m, F.lit(0.0))) for m in ("tradeVolume", "tradeFrequency")})


def long(metrics: DataFrame, more: Own | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per metric that has a value: listing_id, minute, carried columns, metric, value."""
    names = [*aggregates(), *(more or {})]
    stacked = metrics.select("listing_id", "minute", *carry, F.explode(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*names))).alias("metric", "value"))
    return stacked.where("value is not null and not isnan(value)")


def minute_metrics(ticks: DataFrame, manifest: DataFrame | None = None, more: Own | None = None) -> DataFrame:
    found = wide(ticks, more=more)
    return long(found if manifest is None else with_empty_files(found, manifest), more)


#: Columns that name a file beside its listing and minute.
FILE = ("security_id", "exchange_id", "schema", "n_records")


def file_metrics(ticks: DataFrame, more: Own | None = None) -> DataFrame:
    """`minute_metrics` with the columns of `FILE`, from the same aggregate."""
    found = wide(ticks, (*CYCLE, "security_id", "exchange_id"), more)
    return long(found.withColumn("n_records", F.col("tickCount").cast("long")), more, FILE)


def hourly_stats(values: DataFrame) -> DataFrame:
    """Mergeable statistics of metric values: count, sum and sum of squares by listing, date, hour and metric."""
    return values.groupBy("listing_id", F.to_date("minute").alias("date"), F.hour("minute").alias("hour"), "metric").agg(
        F.count("*").cast("double").alias("count"), F.sum("value").alias("sum"), F.sum(F.col("value") * F.col("value")).alias("sum_sq")
    )


#: A variance below this share of the squared mean is what rounding leaves of equal samples, and counts as 0.
NOISE = 1e-12


def combined(count: Column, total: Column, squares: Column) -> tuple[Column, Column]:
    """Mean and deviation from sums: 0 without samples, deviation 0 with fewer than two or for equal samples."""
    mean = F.when(count > 0, F.try_divide(total, count)).otherwise(F.lit(0.0))
    variance = F.try_divide(squares, count) - mean * mean
    return mean, F.when((count >= 2) & (variance > NOISE * mean * mean), F.sqrt(F.greatest(F.lit(0.0), variance))).otherwise(F.lit(0.0))


def combine(stats: DataFrame, *keys: str) -> DataFrame:
    """Statistics merged by keys: mean, stddev, n."""
    zero = F.lit(0.0)
    sums = stats.groupBy(*keys).agg(*(F.sum(F.coalesce(c, zero)).alias(f"_{c}") for c in ("count", "sum", "sum_sq")))
    mean, sd = combined(F.col("_count"), F.col("_sum"), F.col("_sum_sq"))
    return sums.select(*keys, mean.alias("mean"), sd.alias("stddev"), F.col("_count").cast("long").alias("n"))


def listing_statistics(stats: DataFrame, as_of: Column, lookback_days: int = 14, hour: int | None = None) -> DataFrame:
    """Per listing and metric: mean, deviation, samples, rows and days that are included."""
    found = stats.where((F.col("date") <= as_of) & (F.col("date") >= F.date_sub(as_of, lookback_days)))
    if hour is not None:
        found = found.where(F.col("hour") == hour)
    days = found.groupBy("listing_id", "metric").agg(F.count("*").alias("rows_included"), F.count_distinct("date").alias("days_included"))
    return combine(found, "listing_id", "metric").join(days, ["listing_id", "metric"])


def listing_history(stats: DataFrame, as_of: Column, lookback_days: int = 30, hour: int | None = None) -> DataFrame:
    """The same per date."""
    found = stats.where((F.col("date") <= as_of) & (F.col("date") >= F.date_sub(as_of, lookback_days)))
    if hour is not None:
        found = found.where(F.col("hour") == hour)
    return combine(found, "listing_id", "date", "metric")
