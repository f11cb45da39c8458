"""Explicit schemas of the stored tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

LISTINGS = "listing_id INT, security_id INT, exchange_id INT, source_schema STRING"
_LONGS = "ARRAY<BIGINT>"
TICKS = (
    "security_id INT, exchange_id INT, schema STRING, minute TIMESTAMP, pos BIGINT, sequence BIGINT, ts_event_ns BIGINT, ts_sent_ns BIGINT, ts_recv_ns BIGINT, "
    f"action STRING, price BIGINT, size BIGINT, bid_px {_LONGS}, ask_px {_LONGS}, bid_sz {_LONGS}, ask_sz {_LONGS}, bid_ct {_LONGS}, ask_ct {_LONGS}, maybe_bad_book BOOLEAN, bad_ts_recv BOOLEAN"
)
RAW_TICKS = TICKS.replace("minute TIMESTAMP,", "minute TIMESTAMP, capture_id STRING,")
MANIFEST = "security_id INT, exchange_id INT, schema STRING, minute TIMESTAMP, entry_type STRING, capture_id STRING, n_records BIGINT, size_bytes BIGINT"
JOBS = "job_id STRING, minute TIMESTAMP, listing_id INT, schema STRING, status STRING, created_at TIMESTAMP, processed_at TIMESTAMP, error_message STRING, expires_at BIGINT"
GAPS = "listing_id INT, minute TIMESTAMP, status STRING, reason STRING, expected BOOLEAN, note STRING, created_at TIMESTAMP"
ISSUES = "listing_id INT, issue_id STRING, rule_type STRING, status STRING, minute TIMESTAMP, s3_key STRING, details STRING, record_count BIGINT, note STRING, created_at TIMESTAMP"
MINUTE_METRICS = "listing_id INT, minute TIMESTAMP, metric STRING, value DOUBLE"
HOURLY_STATS = "listing_id INT, date DATE, hour INT, metric STRING, count DOUBLE, sum DOUBLE, sum_sq DOUBLE"
INVENTORY = "bucket STRING, key STRING, version STRING, latest STRING, deleted STRING, size STRING"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
