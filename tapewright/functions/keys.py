"""Names and keys of stored entries, jobs, statistics, issues and coverage rows, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two forms of an object key, security/exchange/Y/M/D/h/m/schema[/capture].zst without padding.
AGGREGATED_KEY = r"^(\d+)/(\d+)/(\d+)/(\d+)/(\d+)/(\d+)/(\d+)/([^/]+)\.zst$"
RAW_KEY = r"^(\d+)/(\d+)/(\d+)/(\d+)/(\d+)/(\d+)/(\d+)/([^/]+)/([^/]+)\.zst$"


def parse_key(key: Column, strict: bool = False) -> Column:
    """Struct (security_id, exchange_id, minute, schema, entry_type, capture_id) of an object key.

    A key of neither form, or with an impossible date, gives null; with ``strict`` it is an error.
    """
    parts = F.split(F.regexp_replace(key, r"\.zst$", ""), "/")
    part = lambda i: F.get(parts, F.lit(i))
    number = lambda i: part(i).try_cast("int")
    minute = F.try_make_timestamp(number(2), number(3), number(4), number(5), number(6), F.lit(0))
    form = F.when(key.rlike(AGGREGATED_KEY), F.lit("AGGREGATED")).when(key.rlike(RAW_KEY), F.lit("RAW"))
    found = F.struct(
        number(0).alias("security_id"),
        number(1).alias("exchange_id"),
        minute.alias("minute"),
        part(7).alias("schema"),
        form.alias("entry_type"),
        part(8).alias("capture_id"),
    )
    good = form.isNotNull() & minute.isNotNull() & number(0).isNotNull() & number(1).isNotNull()
    bad = F.raise_error(F.concat(F.lit("not an object key: "), key)) if strict else F.lit(None)
    return F.when(good, found).otherwise(bad)


def build_key(security_id: Column, exchange_id: Column, minute: Column, schema: Column, capture_id: Column | None = None) -> Column:
    """The inverse of `parse_key`: with a capture the key of a raw entry, else that of an aggregated one."""
    parts = [security_id, exchange_id, F.year(minute), F.month(minute), F.dayofmonth(minute), F.hour(minute), F.minute(minute)]
    name = F.concat_ws("/", *(p.cast("string") for p in parts), schema, *([capture_id] if capture_id is not None else []))
    return F.concat(name, F.lit(".zst"))


def date_text(minute: Column) -> Column:
    return F.date_format(minute, "yyyy-MM-dd")


def minute_text(minute: Column) -> Column:
    return F.date_format(minute, "yyyy-MM-dd HH:mm")


def job_id(listing_id: Column, schema: Column) -> Column:
    return F.concat_ws("-", listing_id.cast("string"), schema)


def parse_job_id(value: Column) -> Column:
    """Struct (listing_id, schema): cut at the first dash, as schemas hold dashes."""
    parts = F.split(value, "-", 2)
    return F.struct(F.get(parts, F.lit(0)).try_cast("int").alias("listing_id"), F.get(parts, F.lit(1)).alias("schema"))


def coverage_pk(security_id: Column | None = None, exchange_id: Column | None = None) -> Column:
    if security_id is None:
        return F.lit("GLOBAL")
    name = F.concat(F.lit("SEC#"), security_id.cast("string"))
    return name if exchange_id is None else F.concat(name, F.lit("#EX#"), exchange_id.cast("string"))


def coverage_sk(date: Column | None = None) -> Column:
    return F.lit("SUMMARY") if date is None else F.concat(F.lit("DATE#"), date.cast("string"))


def statistic_sk(hour: Column, date: Column, metric: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit("#"), date.cast("string"), F.lit("#"), metric)


def parse_statistic_sk(value: Column) -> Column:
    """Struct (hour, date, metric)."""
    parts = F.split(value, "#", 3)
    return F.struct(F.get(parts, F.lit(0)).try_cast("int").alias("hour"), F.get(parts, F.lit(1)).try_cast("date").alias("date"), F.get(parts, F.lit(2)).alias("metric"))


def issue_id(minute: Column, rule: Column) -> Column:
    return F.concat_ws("#", F.unix_timestamp(minute).cast("string"), rule)


def is_weekend(date: Column) -> Column:
    return F.weekday(date) >= 5


def day_name(date: Column) -> Column:
    return F.upper(F.date_format(date, "EEEE"))


def epoch_seconds(minute: Column) -> Column:
    return F.unix_timestamp(minute)


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def wrapped_hour(hour: Column, offset: Column | int) -> Column:
    return F.pmod(hour + offset, F.lit(24)).cast("int")


def window_start(minute: Column, schema: Column) -> Column:
    """First minute that a job reads: that of the hour for hourly bars, else the job's own."""
    return F.when(schema == "ohlcv-1h", F.date_trunc("hour", minute)).otherwise(minute)


def window_minutes(schema: Column) -> Column:
    return F.when(schema == "ohlcv-1h", F.lit(60)).otherwise(F.lit(1))


def expires_at(processed_at: Column) -> Column:
    """A week later, in epoch seconds."""
    return F.unix_timestamp(processed_at) + F.lit(7 * 24 * 3600)
