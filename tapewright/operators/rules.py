"""Quality rules over files: static ones, and the assembly of issue rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SEQUENCE_RATIO, TRADE_SCHEMAS
from ..functions import fields, keys

FILE = ("listing_id", "security_id", "exchange_id", "schema", "minute")


@dataclass(frozen=True)
class Rule:
    """A rule over files: when it is hit and what it says (given the seconds of a file), as expressions over the measures of
    a file, and further measures as aggregates over its ticks."""

    name: str
    hit: Callable[[], Column]
    details: Callable[[int], Column]
    measures: Mapping[str, Callable[[], Column]] = field(default_factory=dict)


def measures(ticks: DataFrame, seconds: int = 60, more: Mapping[str, Callable[[], Column]] | None = None) -> DataFrame:
    """What the static rules need of each file, from one shuffle by file.

    total, misaligned (event time outside [minute, minute + seconds), in ns), decreases of the sequence number in
    file order, the counts of both flags (null for schemas without them), and ``more``.
    """
    start = F.unix_timestamp("minute") * F.lit(1_000_000_000)
    outside = (F.col("ts_event_ns") < start) | (F.col("ts_event_ns") >= start + F.lit(seconds * 1_000_000_000))
    before = F.lag("sequence").over(Window.partitionBy(*FILE).orderBy("pos"))
    flag = lambda c: F.when(F.first("schema").isin(*TRADE_SCHEMAS), F.count_if(F.col(c)))
    rows = ticks.withColumn("_down", F.col("sequence") < before)
    return rows.groupBy(*FILE).agg(F.count("*").alias("total"), F.count_if(outside).alias("misaligned"), F.count_if(F.col("_down")).alias("decreases"), flag("maybe_bad_book").alias("bad_book"), flag("bad_ts_recv").alias("bad_recv"), *(made().alias(name) for name, made in (more or {}).items()))


def misaligned(found: DataFrame) -> DataFrame:
    return found.where("misaligned > 0")


def not_monotonic(found: DataFrame, ratio: float = SEQUENCE_RATIO) -> DataFrame:
    """Files whose share of decreasing transitions is above the ratio; fewer than two records have none."""
    return found.where((F.col("total") >= 2) & (F.try_divide("decreases", F.col("total") - 1) > ratio))


def flagged(found: DataFrame) -> DataFrame:
    return found.where("bad_book > 0 or bad_recv > 0")


def issue_rows(found: DataFrame, rule: Column, details: Column, total: Column, as_of: Column) -> DataFrame:
    """Unreviewed issues, keyed by listing and `epoch#RULE`."""
    return found.select(
        "listing_id",
        keys.issue_id(F.col("minute"), rule).alias("issue_id"),
        rule.alias("rule_type"),
        F.lit("UNREVIEWED").alias("status"),
        "minute",
        keys.build_key(F.col("security_id"), F.col("exchange_id"), F.col("minute"), F.col("schema")).alias("s3_key"),
        details.alias("details"),
        total.cast("long").alias("record_count"),
        F.lit(None).cast("string").alias("note"),
        as_of.alias("created_at"),
    )


def _flags() -> Column:
    return (F.col("bad_book") > 0) | (F.col("bad_recv") > 0)


def _not_monotonic() -> Column:
    return (F.col("total") >= 2) & (F.try_divide("decreases", F.col("total") - 1) > SEQUENCE_RATIO)


def _alignment(seconds: int) -> Column:
    return fields.alignment_text(F.col("misaligned"), F.col("total"), F.col("minute"), F.col("minute") + F.expr(f"interval {seconds} seconds"))


STATIC: tuple[Rule, ...] = (
    Rule("TIMESTAMP_ALIGNMENT", lambda: F.col("misaligned") > 0, _alignment),
    Rule("SEQUENCE_MONOTONICITY", _not_monotonic, lambda seconds: fields.sequence_text(F.col("decreases"), F.col("total"))),
    Rule("BAD_DATA_FLAGS", _flags, lambda seconds: fields.flags_text(F.col("bad_book"), F.col("bad_recv"), F.col("total"))),
)


def static_issues(ticks: DataFrame, as_of: Column, seconds: int = 60, rules: Sequence[Rule] = STATIC) -> DataFrame:
    """Issues of rules over files; one row each, made from a single aggregate however many rules there are."""
    more = {name: made for rule in rules for name, made in rule.measures.items()}
    hits = F.array(*(F.when(rule.hit(), F.struct(F.lit(rule.name).alias("rule"), rule.details(seconds).alias("details"))) for rule in rules))
    rows = measures(ticks, seconds, more).withColumn("_hit", F.explode(F.filter(hits, lambda x: x.isNotNull())))
    return issue_rows(rows, F.col("_hit.rule"), F.col("_hit.details"), F.col("total"), as_of)
