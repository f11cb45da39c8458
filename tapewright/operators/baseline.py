"""Baselines of metric values as of each minute, and the statistical rule.

A baseline takes the samples of the same listing and metric within the last days, of the same kind of day, in
hours near the value's own, strictly before it. Written as a join that is a range join over all samples; here it
is sums by hour, a range window over days, and a running sum within the hour, all on equal keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import METRICS, MetricParams
from ..functions import fields, keys
from .metrics import combined
from .rules import issue_rows

_SUMS = ("c", "s", "q")


def hourly_sums(values: DataFrame) -> DataFrame:
    """What a kept baseline is made of: listing_id, metric, date, hour, c, s, q. Sums of different values add up by key."""
    return values.groupBy("listing_id", "metric", F.to_date("minute").alias("date"), F.hour("minute").alias("hour")).agg(F.count("*").alias("c"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))


def asof_sums(values: DataFrame, lookback: int, hour_window: int, day_type: bool = True, whole_day: bool = False, history: DataFrame | None = None) -> DataFrame:
    """Values with the sums of their baseline: c, s, q (count, sum, squares), days, latest (day number).

    values: listing_id, metric, minute, value and any other columns. ``whole_day`` takes all samples of the value's
    own day, later ones too, as a table of daily sums gives them. history: `hourly_sums` of values that came before all of
    these; they need not be read again.
    """
    date = F.to_date("minute")
    day = F.datediff(date, F.lit("1970-01-01").cast("date"))
    kind = keys.is_weekend(date) if day_type else F.lit(False)
    v = values.withColumns({"_d": day, "_k": kind, "_h": F.hour("minute")})
    group = ["listing_id", "metric", "_k"]
    hourly = v.groupBy(*group, "_d", "_h").agg(F.count("*").alias("c"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    if history is not None:
        kept = history.select("listing_id", "metric", (keys.is_weekend(F.col("date")) if day_type else F.lit(False)).alias("_k"), F.datediff("date", F.lit("1970-01-01").cast("date")).alias("_d"), F.col("hour").alias("_h"), *_SUMS)
        kept = kept.groupBy(*group, "_d", "_h").agg(*(F.sum(x).alias(x) for x in _SUMS))
        hourly = hourly.unionByName(kept).groupBy(*group, "_d", "_h").agg(*(F.sum(x).alias(x) for x in _SUMS))
    offsets = list(range(-hour_window, hour_window + 1)) if 2 * hour_window + 1 < 24 else list(range(24))
    near = hourly.withColumn("_t", F.explode(F.transform(F.array(*map(F.lit, offsets)), lambda o: F.pmod(F.col("_h") + o, F.lit(24)))))
    earlier = F.lit(True) if whole_day else F.col("_h") < F.col("_t")
    daily = near.groupBy(*group, "_t", "_d").agg(*(F.sum(x).alias(x) for x in _SUMS), *(F.coalesce(F.sum(F.when(earlier, F.col(x))), F.lit(0)).alias(f"e{x}") for x in _SUMS))
    before = Window.partitionBy(*group, "_t").orderBy("_d").rangeBetween(-lookback, -1)
    daily = daily.select(
        *group, "_t", "_d", *(F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"p{x}") for x in _SUMS), *(f"e{x}" for x in _SUMS), F.count("*").over(before).alias("_days"), F.max("_d").over(before).alias("_latest")
    )
    met = v.join(daily.withColumnRenamed("_t", "_h"), [*group, "_h", "_d"])
    run = Window.partitionBy(*group, "_d", "_h").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    now = {"c": F.count("*").over(run), "s": F.coalesce(F.sum("value").over(run), F.lit(0.0)), "q": F.coalesce(F.sum(F.col("value") * F.col("value")).over(run), F.lit(0.0))}
    if whole_day:
        now = {x: F.lit(0) for x in _SUMS}
    met = met.withColumns({f"n{x}": now[x] for x in _SUMS})
    if history is not None and not whole_day:
        met = met.join(kept.withColumnsRenamed({x: f"k{x}" for x in _SUMS}), [*group, "_d", "_h"], "left")
        met = met.withColumns({f"n{x}": F.col(f"n{x}") + F.coalesce(f"k{x}", F.lit(0)) for x in _SUMS})
    today = (F.col("ec") + F.col("nc")) > 0
    return met.select(
        *values.columns,
        *((F.col(f"p{x}") + F.col(f"e{x}") + F.col(f"n{x}")).cast("double").alias(x) for x in _SUMS),
        (F.col("_days") + today.cast("int")).alias("days"),
        F.when(today, F.col("_d")).otherwise(F.col("_latest")).alias("latest"),
        F.col("_d").alias("day"),
    )


def asof_baselines(values: DataFrame, params: Sequence[MetricParams] = METRICS, whole_day: bool = False, history: DataFrame | None = None) -> DataFrame:
    """`asof_sums` of all metrics, each with its own window; metrics that share a window share the pass."""
    groups: dict[tuple[int, int], list[str]] = {}
    for p in params:
        groups.setdefault((p.lookback, p.hour_window), []).append(p.name)
    of = lambda rows, names: None if rows is None else rows.where(F.col("metric").isin(*names))
    parts = [asof_sums(of(values, names), lookback, window, whole_day=whole_day, history=of(history, names)) for (lookback, window), names in groups.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def param_table(spark: SparkSession, params: Sequence[MetricParams]) -> DataFrame:
    rows = [(p.name, p.direction, p.z, p.fallback, p.detect, p.rule, p.minimum_days, p.freshness_days) for p in params]
    return spark.createDataFrame(rows, "metric string, direction string, z double, fallback double, detect boolean, rule string, minimum_days int, freshness_days int")


def is_anomalous(value: Column, mean: Column, sd: Column, direction: Column, z: Column, fallback: Column) -> Column:
    """Beyond z deviations on the metric's side; without deviation against a share of the mean; never for a mean of 0 or less."""
    off = F.when(direction == "LOW", mean - value).when(direction == "HIGH", value - mean).otherwise(F.abs(value - mean))
    flat = F.when(direction == "LOW", value < mean * fallback).when(direction == "HIGH", value >= mean * fallback).otherwise(F.lit(False))
    return F.when(mean <= 0, False).when(sd > 0, F.try_divide(off, sd) > z).otherwise(flat)


def scored(values: DataFrame, params: Sequence[MetricParams] = METRICS, whole_day: bool = False) -> DataFrame:
    """Values with mean, stddev, n, days, ready (enough and fresh days) and anomalous (detected by the rule)."""
    found = asof_baselines(values, params, whole_day).join(F.broadcast(param_table(values.sparkSession, params)), "metric")
    mean, sd = combined(F.col("c"), F.col("s"), F.col("q"))
    found = found.withColumns({"mean": mean, "stddev": sd, "n": F.col("c").cast("long")})
    ready = (F.col("days") >= F.col("minimum_days")) & F.coalesce(F.col("latest") >= F.col("day") - F.col("freshness_days"), F.lit(False))
    hit = is_anomalous(F.col("value"), F.col("mean"), F.col("stddev"), F.col("direction"), F.col("z"), F.col("fallback"))
    return found.withColumn("ready", ready).withColumn("anomalous", F.col("detect") & ready & hit)


def statistical_issues(values: DataFrame, files: DataFrame | None, as_of: Column, params: Sequence[MetricParams] = METRICS, whole_day: bool = False) -> DataFrame:
    """Issues of the statistical rule. files: listing_id, minute, security_id, exchange_id, schema, n_records; None where the
    values hold these columns themselves."""
    hits = scored(values, params, whole_day).where("anomalous")
    if files is not None:
        hits = hits.join(files.select("listing_id", "minute", "security_id", "exchange_id", "schema", "n_records"), ["listing_id", "minute"])
    text = fields.anomaly_text(F.col("metric"), F.col("direction"), F.col("value"), F.col("mean"), F.col("stddev"))
    return issue_rows(hits, F.col("rule"), text, F.col("n_records"), as_of)
