import math

import pytest
from pyspark.sql import functions as F

from tapewright.operators import metrics, rules

START = 1_705_314_600  # 2024-01-15 10:30 UTC
SCHEMA = "listing_id int, security_id int, exchange_id int, schema string, pos long, sequence long, ts_event_ns long, action string, price long, size long, bid_px_0 long, ask_px_0 long, maybe_bad_book boolean, bad_ts_recv boolean"


def ticks(spark, files, schema="mbp-10"):
    """files: lists of dicts; each list is a file of its own listing."""
    rows = []
    for n, file in enumerate(files):
        for i, r in enumerate(file):
            rows.append((n, n, 1, r.get("schema", schema), i, r.get("sequence", i), r.get("ts", START * 10**9), r.get("action", "Add"), r.get("price"), r.get("size"), r.get("bid"), r.get("ask"), r.get("book", False), r.get("recv", False)))
    return spark.createDataFrame(rows, SCHEMA).withColumn("minute", F.timestamp_seconds(F.lit(START)))


def test_sequence_rule(spark):
    cases = ["5,4", "1,1,5,3,10", "1,2,3,4,5,6,7,8,9,8,11", "1,0,3,4,5,6,7,6,9,10", "7,7,7", "1", ""]
    files = [[{"sequence": int(s)} for s in c.split(",") if s] for c in cases]
    hit = {r.listing_id for r in rules.not_monotonic(rules.measures(ticks(spark, files))).collect()}
    assert hit == {0, 1, 3}


def test_alignment_rule_in_nanoseconds(spark):
    lo = START * 10**9
    files = [[{"ts": lo - 1}], [{"ts": lo + 60 * 10**9}], [{"ts": lo + 60 * 10**9 - 1}], [{"ts": lo}], [{"ts": lo - 1}, {"ts": lo}, {"ts": lo + 61 * 10**9}]]
    found = {r.listing_id: (r.misaligned, r.total) for r in rules.misaligned(rules.measures(ticks(spark, files))).collect()}
    assert found == {0: (1, 1), 1: (1, 1), 4: (2, 3)}


def test_flags_rule_and_issue_rows(spark):
    files = [[{"book": True}, {"recv": True}, {}], [{}], [{"book": True, "schema": "trades"}]]
    df = ticks(spark, files)
    assert {(r.listing_id, r.bad_book, r.bad_recv) for r in rules.flagged(rules.measures(df)).collect()} == {(0, 1, 1)}
    (issue,) = rules.static_issues(df, F.timestamp_seconds(F.lit(9))).collect()
    assert issue.issue_id == f"{START}#BAD_DATA_FLAGS" and issue.s3_key == "0/1/2024/1/15/10/30/mbp-10.zst"
    assert issue.details == "1 record(s) with maybeBadBook flag and 1 record(s) with badTimestampRecv flag out of 3 total"


def test_wording_of_sequence_and_alignment(spark):
    lo = START * 10**9
    found = {r.rule_type: r.details for r in rules.static_issues(ticks(spark, [[{"sequence": 5, "ts": lo}, {"sequence": 4, "ts": lo - 1}]]), F.current_timestamp()).collect()}
    assert found["SEQUENCE_MONOTONICITY"] == "1 decrease(s) out of 1 transitions (100.0%) in 2 records"
    assert found["TIMESTAMP_ALIGNMENT"] == "1 of 2 records have timestamps outside the expected minute window [2024-01-15T10:30, 2024-01-15T10:31)"


def values(spark, files, **kw):
    out = {}
    for r in metrics.minute_metrics(ticks(spark, files, **kw)).collect():
        out.setdefault(r.listing_id, {})[r.metric] = r.value
    return out


def test_metrics(spark):
    got = values(spark, [
        [{"price": 100}, {"price": 200}],
        [{"price": 100}, {"price": 200}, {"price": 300}],
        [{"price": 100}],
        [{"bid": 100, "ask": 102}, {"bid": 100, "ask": 106}, {"bid": 5}, {"bid": 200, "ask": 198}],
        [{"action": "Trade", "size": 150}, {"action": "Trade", "size": 75}, {"action": "Cancel", "size": 9}],
    ])
    assert got[0]["volatility"] == pytest.approx(50 / 1e9, abs=1e-12) and got[1]["volatility"] == pytest.approx(81.6496580928 / 1e9, abs=1e-12)
    assert "volatility" not in got[2] and got[2]["tickCount"] == 1 and "spread" not in got[2] and got[2]["tradeVolume"] == 0
    assert got[3]["spread"] == pytest.approx(4 / 1e9) and got[3]["midPrice"] == pytest.approx((202 + 206 + 398) / 6 / 1e9)
    assert (got[4]["tradeVolume"], got[4]["tradeFrequency"]) == (225, 2)
    assert set(values(spark, [[{"bid": 1, "ask": 2, "price": 3}]], schema="mbo")[0]) == {"tickCount", "tradeVolume", "tradeFrequency"}


def test_prices_do_not_overflow(spark):
    big = 9 * 10**18
    got = values(spark, [[{"bid": big, "ask": big, "action": "Trade", "size": big}] * 3])
    assert got[0]["midPrice"] == pytest.approx(big / 1e9) and got[0]["tradeVolume"] == pytest.approx(3.0 * big)


def test_empty_files_count_no_ticks(spark):
    df = ticks(spark, [[{"price": 1}]])
    manifest = df.select("listing_id", "minute", "schema").union(df.select(F.lit(7), "minute", "schema"))
    got = {(r.listing_id, r.metric): r.value for r in metrics.minute_metrics(df, manifest).collect()}
    assert got[7, "tickCount"] == 0 and got[7, "tradeVolume"] == 0 and (7, "volatility") not in got


def test_combined_statistics(spark):
    rows = [("a", 2.0, 300.0, 50000.0), ("a", 2.0, 400.0, 85000.0), ("b", 3.0, 60.0, 1400.0), ("c", None, None, None), ("d", 1.0, 5.0, 25.0), ("e", 3.0, 0.3, 0.03)]
    got = {r.k: r for r in metrics.combine(spark.createDataFrame(rows, "k string, count double, sum double, sum_sq double"), "k").collect()}
    assert (got["a"].n, got["a"].mean) == (4, 175) and got["a"].stddev == pytest.approx(math.sqrt(3125))
    assert got["b"].mean == 20 and got["b"].stddev == pytest.approx(math.sqrt(200 / 3))
    assert (got["c"].n, got["c"].mean, got["c"].stddev) == (0, 0, 0) and got["d"].stddev == 0 and got["e"].stddev == 0
