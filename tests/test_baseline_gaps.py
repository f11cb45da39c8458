import random
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tapewright.config import METRICS
from tapewright.operators import baseline, gaps

TICKS = METRICS[0]


def values(spark, rows):
    """rows: (listing, metric, datetime text, value)"""
    df = spark.createDataFrame(rows, "listing_id int, metric string, at string, value double")
    return df.withColumn("minute", F.to_timestamp("at")).drop("at")


def history(days, n=10, value=1000.0, time="10:0{}:00"):
    return [(42, "tickCount", f"{d} " + time.format(i), value) for d in days for i in range(n)]


def anomalous(spark, rows, when="2024-01-15 10:30:00", value=5.0, params=(TICKS,)):
    found = baseline.scored(values(spark, [*rows, (42, "tickCount", when, value)]), params)
    return [r.anomalous for r in found.where(F.col("minute") == F.lit(when).cast("timestamp")).collect()] == [True]


def test_anomaly_needs_days_that_are_enough_fresh_and_of_the_same_kind(spark):
    week = ["2024-01-10", "2024-01-11", "2024-01-12"]
    assert anomalous(spark, history(week))
    assert not anomalous(spark, history(week[:1]))
    assert not anomalous(spark, history(["2023-12-18", "2023-12-19", "2023-12-20"]))
    assert not anomalous(spark, history(["2024-01-06", "2024-01-07", "2024-01-11", "2024-01-12"]))
    weekend = history(["2024-01-06", "2024-01-07", "2024-01-13"])
    assert anomalous(spark, weekend, "2024-01-14 10:30:00")
    assert not anomalous(spark, history(week), value=990.0)
    late = history(week, time="23:0{}:00")
    assert anomalous(spark, late, "2024-01-15 00:30:00") and not anomalous(spark, late, "2024-01-15 02:30:00")


@pytest.mark.parametrize("direction,value,mean,sd,want", [
    ("LOW", 60, 100, 10, True), ("LOW", 71, 100, 10, False), ("LOW", 140, 100, 10, False), ("HIGH", 140, 100, 10, True), ("HIGH", 60, 100, 10, False), ("BOTH", 60, 100, 10, True), ("BOTH", 140, 100, 10, True), ("BOTH", 129, 100, 10, False),
    ("LOW", 9, 100, 0, True), ("LOW", 10, 100, 0, False), ("HIGH", 10, 100, 0, True), ("HIGH", 9, 100, 0, False), ("BOTH", 1, 100, 0, False), ("LOW", 0, 0, 5, False), ("HIGH", 9, -1, 0, False),
])
def test_scores(spark, direction, value, mean, sd, want):
    lit = lambda x: F.lit(float(x))
    assert spark.range(1).select(baseline.is_anomalous(lit(value), lit(mean), lit(sd), F.lit(direction), lit(3), lit(0.1))).first()[0] is want


@pytest.mark.parametrize("whole_day", [False, True])
def test_sums_equal_the_range_join(spark, whole_day):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    rows = {(rng.randrange(2), "tickCount", (start + timedelta(minutes=rng.randrange(60 * 24 * 40))).isoformat(" "), float(rng.randrange(50))) for _ in range(500)}
    rows = list({(r[0], r[2]): r for r in rows}.values())
    got = {(r.listing_id, r.minute.isoformat(" ")): (r.c, r.s, r.q, r.days) for r in baseline.asof_sums(values(spark, rows), 9, 1, whole_day=whole_day).withColumn("minute", F.col("minute").cast("timestamp_ntz")).collect()}
    for listing, _, at, _ in rows:
        t = datetime.fromisoformat(at)
        own = []
        for l2, _, at2, v in rows:
            u = datetime.fromisoformat(at2)
            before = u.date() <= t.date() if whole_day else u < t
            if l2 == listing and before and (t.date() - u.date()).days <= 9 and (u.weekday() >= 5) == (t.weekday() >= 5) and (u.hour - t.hour + 25) % 24 <= 2:
                own.append((u.date(), v))
        assert got[listing, at] == (len(own), sum(v for _, v in own), sum(v * v for _, v in own), len({d for d, _ in own})), (listing, at)


def test_issue_rows_of_the_statistical_rule(spark):
    rows = [*history(["2024-01-10", "2024-01-11", "2024-01-12"]), (42, "tickCount", "2024-01-15 10:30:00", 5.0)]
    v = values(spark, rows)
    files = v.select("listing_id", "minute", F.lit(4).alias("security_id"), F.lit(2).alias("exchange_id"), F.lit("mbp-10").alias("schema"), F.lit(5).alias("n_records"))
    (issue,) = baseline.statistical_issues(v, files, F.timestamp_seconds(F.lit(1))).collect()
    assert (issue.issue_id, issue.rule_type, issue.record_count) == ("1705314600#TICK_COUNT_ANOMALY", "TICK_COUNT_ANOMALY", 5)
    assert issue.details == "tickCount 5.000 is anomalously below conditional mean of 1000 (zero variance baseline)"
    assert baseline.statistical_issues(v, files, F.timestamp_seconds(F.lit(1)), [replace(TICKS, detect=False)]).collect() == []


@pytest.mark.parametrize("n,mean,sd,want", [(0, 0, 0, 1), (2, 5, 0, 1), (9, 500, 0, 1), (9, 10, 0, 1), (9, 0.5, 0, 6), (9, 0.1, 0, 30), (9, 0.001, 0, 1440), (9, 0, 0, 1440), (9, 1, 24**0.5, 13), (9, 1e-300, 0, 1440)])
def test_tolerance(spark, n, mean, sd, want):
    assert spark.range(1).select(gaps.tolerance(F.lit(float(n)), F.lit(float(mean)), F.lit(float(sd)))).first()[0] == want


def minutes(spark, *at, listing=1):
    base = datetime(2024, 1, 15, 10, 30, tzinfo=timezone.utc)
    return spark.createDataFrame([(listing, int((base + timedelta(minutes=m)).timestamp())) for m in at], "listing_id int, s long").select("listing_id", F.timestamp_seconds("s").alias("minute"))


def test_gaps(spark):
    count = lambda df, tol=None: gaps.detect(df, F.current_timestamp(), tol).count()
    assert count(minutes(spark, -2, 0)) == 1 and count(minutes(spark, -5, 0)) == 4 and count(minutes(spark, -1, 0)) == 0 and count(minutes(spark, 0)) == 0
    assert count(minutes(spark, -2879, 0)) == 2878 and count(minutes(spark, -2880, 0)) == 2879 and count(minutes(spark, -2881, 0)) == 0
    six = minutes(spark, 0).withColumn("tolerance", F.lit(6))
    assert count(minutes(spark, -5, 0), six) == 0 and count(minutes(spark, -7, 0), six) == 6 and count(minutes(spark, -10, 0), six) == 9
    row = gaps.detect(minutes(spark, -2, 0), F.timestamp_seconds(F.lit(5))).first()
    assert (row.status, row.reason, row.expected, row.note) == ("UNREVIEWED", "UNKNOWN", False, "Gap detected by gap detector lambda")


def test_ledger_minutes_count_as_observed_and_late_minutes_resolve(spark):
    seen = gaps.observed(minutes(spark, -1), minutes(spark, -2, 0))
    assert gaps.detect(seen, F.current_timestamp()).count() == 0
    found = gaps.detect(minutes(spark, -3, 0), F.current_timestamp())
    assert sorted(r.resolved for r in gaps.resolved(found, minutes(spark, -1)).collect()) == [False, True]
    assert date(2024, 1, 15)
