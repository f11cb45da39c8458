"""Merging redundant captures of a minute: the most complete capture wins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ("security_id", "exchange_id", "schema", "minute")


def capture_counts(raw: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Records of each capture of a minute."""
    return raw.groupBy(*key, "capture_id").agg(F.count("*").alias("n_records"))


def winners(counts: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """The capture with most records; of equal ones the smallest id. One aggregate, no sort."""
    best = F.min(F.struct((-F.col("n_records")).alias("less"), "capture_id"))
    return counts.groupBy(*key).agg(best.alias("_best")).select(*key, F.col("_best.capture_id").alias("capture_id"), (-F.col("_best.less")).alias("n_records"))


def most_records(raw: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Records of the winning capture of each minute, in that capture's own order (`pos`).

    Only counts are shuffled; the records meet the winners in a join, which is broadcast where Spark finds it small.
    """
    best = winners(capture_counts(raw, key), key).drop("n_records")
    return raw.join(best, [*key, "capture_id"], "left_semi").drop("capture_id")


def with_captured(raw: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """As `most_records`, but the first record of a minute carries in `captured` how many all captures hold, others 0.

    So totals of in and out can be taken from the merged records alone, wherever they are written.
    """
    first = raw.groupBy(*key, "capture_id").agg(F.count("*").alias("n"), F.min("pos").alias("first"))
    best = F.min(F.struct((-F.col("n")).alias("less"), "capture_id", "first")).alias("_best")
    totals = first.groupBy(*key).agg(F.sum("n").alias("_n_in"), best).select(*key, "_best.capture_id", F.col("_best.first").alias("_first"), "_n_in")
    joined = raw.join(totals, [*key, "capture_id"])
    return joined.withColumn("captured", F.when(F.col("pos") == F.col("_first"), F.col("_n_in")).otherwise(F.lit(0))).drop("capture_id", "_first", "_n_in")


STRATEGIES: dict[str, Callable[..., DataFrame]] = {"most_records": most_records}
#: Which strategy merges a schema.
BY_SCHEMA = {"mbp-10": "most_records"}


def merge(raw: DataFrame, strategy: str = "most_records", key: tuple[str, ...] = KEY) -> DataFrame:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown merge strategy: {strategy}")
    return STRATEGIES[strategy](raw, key)


def strategy_for(schema: str) -> str:
    if schema not in BY_SCHEMA:
        raise ValueError(f"no merge strategy for schema: {schema}")
    return BY_SCHEMA[schema]


def deficits(counts: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """By how many records each capture falls short of its minute's best, where it does."""
    best = F.max("n_records").over(Window.partitionBy(*key))
    return counts.withColumn("deficit", best - F.col("n_records")).where("deficit > 0")


def merge_totals(counts: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Records in and out of the merge of each minute."""
    return counts.groupBy(*key).agg(F.sum("n_records").alias("n_in"), F.max("n_records").alias("n_out"), F.count("*").alias("n_captures"))


def affected_minutes(entries: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Distinct minutes that notified raw entries belong to; each is merged again from all its captures."""
    return entries.where("entry_type = 'RAW'").select(*key).distinct()


def merged_manifest(manifest: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """Manifest of merged minutes: also those whose captures are all empty, with 0 records."""
    return manifest.where("entry_type = 'RAW'").groupBy(*key).agg(F.max("n_records").alias("n_records")).withColumn("entry_type", F.lit("AGGREGATED"))
