"""Fields of ticks by schema, scaling, and the wording of findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import BOOK_SCHEMAS, PRICE_SCALE, SIZE_SCALE, TRADE_SCHEMAS


def of_schema(value: Column, schema: Column, schemas: Sequence[str]) -> Column:
    """The value where the schema has such a field, else null."""
    return F.when(schema.isin(*schemas), value)


def trade_fields(schema: Column, price: Column, size: Column, action: Column) -> Column:
    return F.struct(*(of_schema(c, schema, TRADE_SCHEMAS).alias(n) for n, c in (("price", price), ("size", size), ("action", action))))


def book_fields(schema: Column, bid: Column, ask: Column) -> Column:
    return F.struct(of_schema(bid, schema, BOOK_SCHEMAS).alias("bid_px_0"), of_schema(ask, schema, BOOK_SCHEMAS).alias("ask_px_0"))


def flag_fields(schema: Column, bad_book: Column, bad_recv: Column) -> Column:
    return F.struct(of_schema(bad_book, schema, TRADE_SCHEMAS).alias("maybe_bad_book"), of_schema(bad_recv, schema, TRADE_SCHEMAS).alias("bad_ts_recv"))


def without_sentinel(value: Column, sentinel: int) -> Column:
    """Null prices come as a sentinel value; done once when ticks are read."""
    return F.nullif(value, F.lit(sentinel))


def price(value: Column) -> Column:
    return value.cast("double") / F.lit(float(PRICE_SCALE))


def size(value: Column) -> Column:
    return value.cast("double") / F.lit(float(SIZE_SCALE))


# The wording of findings.
ALIGNMENT = "%d of %d records have timestamps outside the expected minute window [%s, %s)"
SEQUENCE = "%d decrease(s) out of %d transitions (%.1f%%) in %d records"
FLAGS = "%d record(s) with maybeBadBook flag and %d record(s) with badTimestampRecv flag out of %d total"
DEVIATION = "%s %.4g is %.1fσ %s conditional mean of %.4g (σ=%.4g)"
FLAT = "%s %.4g is anomalously %s conditional mean of %.4g (zero variance baseline)"


def alignment_text(bad: Column, total: Column, start: Column, end: Column) -> Column:
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm")
    return F.format_string(ALIGNMENT, bad, total, iso(start), iso(end))


def sequence_text(bad: Column, total: Column) -> Column:
    return F.format_string(SEQUENCE, bad, total - 1, F.try_divide(bad, total - 1) * 100.0, total)


def flags_text(bad_book: Column, bad_recv: Column, total: Column) -> Column:
    return F.format_string(FLAGS, bad_book, bad_recv, total)


def anomaly_text(metric: Column, direction: Column, value: Column, mean: Column, sd: Column) -> Column:
    """What deviates, by how many deviations, and on which side."""
    side = F.when(direction == "LOW", "below").when(direction == "HIGH", "above").otherwise(F.when(value >= mean, "above").otherwise("below"))
    spread = F.format_string(DEVIATION, metric, value, F.abs(value - mean) / sd, side, mean, sd)
    flat = F.format_string(FLAT, metric, value, side, mean)
    return F.when(sd > 0, spread).otherwise(flat)
