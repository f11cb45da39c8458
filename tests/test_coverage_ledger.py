import json
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tapewright.functions import keys
from tapewright.operators import coverage, ledger, tables
from tapewright.plans import jobs
from tapewright.sources import clustered, versioned
from tapewright.streaming import jobs as streams


@pytest.fixture
def at(spark):
    return F.timestamp_seconds(F.lit(1_705_314_600))


def entries(spark):
    rows = [(1, 1, "mbp-10", "2024-01-01 10:00:00", 10), (1, 1, "trades", "2024-01-01 10:00:00", 5), (1, 2, "mbp-10", "2024-01-01 10:00:00", 7), (1, 1, "mbp-10", "2024-01-02 10:01:00", 1), (2, 1, "mbp-10", "2024-01-01 10:00:00", 3)]
    df = spark.createDataFrame(rows, "security_id int, exchange_id int, schema string, at string, size long").withColumn("minute", F.to_timestamp("at"))
    return df.select(keys.build_key(F.col("security_id"), F.col("exchange_id"), F.col("minute"), F.col("schema")).alias("key"), "size")


def test_coverage_documents(spark, at):
    inventory = entries(spark).union(spark.createDataFrame([("bad", 1), ("1/1/2024/1/1/1/1/mbo/raw.zst", 1)], "key string, size long"))
    rows = {(r.pk, r.sk): json.loads(r.data) for r in jobs.coverage_tables(inventory, at).collect()}
    top = rows["GLOBAL", "SUMMARY"]
    assert (top["totalFiles"], top["totalMinutes"], top["totalSizeBytes"], top["securityExchangeCount"]) == (5, 2, 26, 3)
    assert top["securities"]["1-1"]["schemaTypes"] == ["mbp-10", "trades"] and top["schemaTypes"]["mbp-10"] == {"fileCount": 4, "minuteCount": 2, "sizeBytes": 21}
    one = rows["SEC#1", "SUMMARY"]
    assert (one["totalDays"], one["totalMinutes"], one["totalExchanges"], one["earliestDate"], one["latestDate"]) == (2, 2, 2, "2024-01-01", "2024-01-02")
    assert one["exchanges"]["2"]["totalMinutes"] == 1
    date = rows["SEC#1", "DATE#2024-01-01"]
    assert date["hasCoverage"] is True and date["totalMinutes"] == 1 and date["schemaTypes"]["mbp-10"] == {"hasCoverage": True, "minutes": 1, "sizeBytes": 17}
    assert date["exchanges"]["1"]["schemaTypes"]["trades"]["minutes"] == 1
    assert rows["SEC#1#EX#1", "DATE#2024-01-02"]["totalMinutes"] == 1 and len(rows) == 1 + 2 + 3 + 3 + 4
    assert coverage.bad_keys(inventory).count() == 1
    with pytest.raises(PySparkException):
        coverage.entries(inventory, strict=True).collect()
    table = jobs.coverage_tables(inventory, at)
    assert len(coverage.read_documents(table, keys.coverage_pk(F.lit(1))).first().coverage) == 2
    assert coverage.read_documents(table, keys.coverage_pk(F.lit(8))).collect() == [] and jobs.coverage_tables(inventory.limit(0), at).collect() == []


def test_levels_agree_with_single_levels(spark, at):
    e = coverage.entries(entries(spark))
    got = {(r.level, r.security_id, r.exchange_id, r.schema, str(r.date) if r.date else None): (r.files, r.minutes, r.size_bytes) for r in coverage.levels(e).collect()}
    assert got["global", None, None, None, None] == (5, 2, 26) and got["pair", 1, 1, None, None] == (3, 2, 16) and got["security_date", 1, None, None, "2024-01-01"] == (3, 1, 22)
    assert len([k for k in got if k[0] == "schema"]) == 2


LISTINGS = "listing_id int, security_id int, exchange_id int, source_schema string"


def raw_entries(spark, *minutes, security=1):
    return spark.createDataFrame([(security, 1, "mbp-10", f"2024-01-15 {m}:00") for m in minutes], "security_id int, exchange_id int, schema string, at string").withColumn("minute", F.to_timestamp("at")).drop("at")


def test_jobs_are_created_once_and_hourly_ones_at_minute_59(spark, at):
    listings = spark.createDataFrame([(7, 1, 1, "mbp-10")], LISTINGS)
    none = spark.createDataFrame([], "job_id string, minute timestamp")
    found = ledger.created(raw_entries(spark, "10:58", "10:59", "10:59"), listings, none, at)
    assert {(r.job_id, r.minute.minute) for r in found.where("schema = 'ohlcv-1h'").collect()} == {("7-ohlcv-1h", 59)}
    assert found.count() == 15 and found.where("status <> 'PENDING'").count() == 0
    assert ledger.created(raw_entries(spark, "10:58", "10:59"), listings, found.select("job_id", "minute"), at).count() == 0
    with pytest.raises(PySparkException):
        ledger.created(raw_entries(spark, "10:58", security=5), listings, none, at).collect()
    assert ledger.created(raw_entries(spark, "10:58", security=5), listings, none, at, strict=False).count() == 0


def test_jobs_run_and_close(spark, at):
    listings = spark.createDataFrame([(7, 1, 1, "mbp-10")], LISTINGS)
    due = ledger.created(raw_entries(spark, "10:59", "11:59"), listings, spark.createDataFrame([], "job_id string, minute timestamp"), at)
    base = 1_705_312_800  # 10:00
    ticks = spark.createDataFrame([(7, 1, 1, (base + m * 60) * 10**9, m, 100 + m, 1, "Trade", base + m * 60) for m in (0, 15, 59)], "listing_id int, security_id int, exchange_id int, ts_event_ns long, pos long, price long, size long, action string, s long").withColumn("minute", F.timestamp_seconds("s"))
    bars, closed = jobs.run_jobs(due, ticks, "ohlcv-1h", at)
    assert [(r.open, r.high, r.low, r.close, r.volume) for r in bars.collect()] == [(100, 159, 100, 159, 3)]
    assert {(r.status, r.expires_at) for r in closed.collect()} == {("COMPLETE", 1_705_314_600 + 604800)} and closed.count() == 2
    failed = due.where("schema = 'trades'").limit(1).select("job_id", "minute", F.lit("boom").alias("error_message"))
    assert sorted(r.status for r in ledger.closed(ledger.pending(due, "trades"), at, failed).collect()) == ["COMPLETE", "FAILED"]
    assert ledger.pending(due, "trades", 1).count() == 1
    assert ledger.job_minutes(due.where("schema = 'ohlcv-1h'")).count() == 120


def test_keyed_tables(spark, at):
    table = spark.createDataFrame([(1, 10, "UNREVIEWED", "a", None), (1, 11, "REVIEWED", "b", "x")], "listing_id int, minute int, status string, reason string, note string")
    updates = spark.createDataFrame([(1, 10, "OTHER", None), (2, 5, None, "n"), (None, 5, "OTHER", None)], "listing_id int, minute int, reason string, note string")
    got = {(r.listing_id, r.minute): (r.status, r.reason, r.note) for r in tables.review(table, updates, ("listing_id", "minute"), ("reason", "note")).collect()}
    assert got == {(1, 10): ("REVIEWED", "OTHER", None), (1, 11): ("REVIEWED", "b", "x"), (2, 5): ("REVIEWED", None, "n")}
    assert tuple(tables.review_counts(updates, ("listing_id", "minute")).first()) == (2, 1)
    assert tables.invalid_updates(updates, ("listing_id", "minute")).first().error == "listing_id and minute are required"
    again = table.withColumn("reason", F.lit("new"))
    assert {r.reason for r in tables.put(table, again, "listing_id", "minute").collect()} == {"new"}
    assert {(r.minute, r.reason) for r in tables.put_unreviewed(table, again, "listing_id", "minute").collect()} == {(10, "new"), (11, "b")}
    versions = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 1)], "k int, v string, version int")
    assert {(r.k, r.v) for r in tables.latest(versions, "k").collect()} == {(1, "b"), (2, "d")}
    page = tables.listed(table, by="minute", limit=1)
    assert [r.minute for r in page.collect()] == [11]
    assert [r.minute for r in tables.listed(table, tables.after("minute", "listing_id", F.lit(11), F.lit(1))).collect()] == [10]
    assert "TakeOrderedAndProject" in page._jdf.queryExecution().executedPlan().toString()


def test_modes_and_backfill(spark, at):
    with pytest.raises(ValueError):
        jobs.quality_check(spark.range(1), at, mode="other")


def test_one_failing_job_does_not_end_the_others(spark, at):
    base = 1_705_312_800
    due = spark.createDataFrame([(f"{n}-trades", base, n, "trades", "PENDING") for n in (7, 8, 9, 10)], "job_id string, s long, listing_id int, schema string, status string")
    due = due.select("job_id", F.timestamp_seconds("s").alias("minute"), "listing_id", "schema", "status", at.alias("created_at"), F.lit(None).cast("timestamp").alias("processed_at"), F.lit(None).cast("string").alias("error_message"), F.lit(None).cast("bigint").alias("expires_at"))
    rows = [(7, base * 10**9, "Trade", 5, 1), (8, None, "Trade", 5, 1), (8, base * 10**9, "Add", None, None), (9, base * 10**9, "Trade", 5, 1)]
    ticks = spark.createDataFrame(rows, "listing_id int, ts_event_ns long, action string, price long, size long").withColumns({"minute": F.timestamp_seconds(F.lit(base)), "security_id": F.lit(1), "exchange_id": F.lit(1), "pos": F.lit(0)})
    listings = spark.createDataFrame([(7, 1, 1, "mbp-10"), (8, 1, 1, "mbp-10"), (10, 1, 1, "mbp-10")], LISTINGS)
    out, closed = jobs.run_jobs(due, ticks, "trades", at, listings=listings)
    assert [r.job_id for r in out.collect()] == ["7-trades"]
    assert {r.job_id: (r.status, r.error_message) for r in closed.collect()} == {"7-trades": ("COMPLETE", None), "8-trades": ("FAILED", "1 of 2 records can't be read"), "9-trades": ("FAILED", "no such listing: 9"), "10-trades": ("COMPLETE", None)}


def test_tables_are_put_by_key_and_partition(spark, tmp_path):
    path = str(tmp_path / "gaps")
    rows = lambda *r: spark.createDataFrame(r, "listing_id int, at string, status string, note string").withColumn("minute", F.to_timestamp("at")).drop("at")
    assert jobs.store_gaps(rows((1, "2024-01-01 10:00:00", "UNREVIEWED", "a"), (1, "2024-01-02 10:00:00", "REVIEWED", "b")), path).collect() == []
    bad = jobs.store_gaps(rows((1, "2024-01-01 10:00:00", "UNREVIEWED", "c"), (1, "2024-01-02 10:00:00", "UNREVIEWED", "c"), (None, "2024-01-03 10:00:00", "UNREVIEWED", "c")), path)
    assert [r.error for r in bad.collect()] == ["listing_id and minute are required"]
    assert sorted((str(r.date), r.status, r.note) for r in spark.read.parquet(path).collect()) == [("2024-01-01", "UNREVIEWED", "c"), ("2024-01-02", "REVIEWED", "b")]


def test_an_empty_coverage_table_says_so(spark, at):
    row = coverage.summary_answer(jobs.coverage_tables(entries(spark).limit(0), at)).first()
    assert (row.total_files, row.total_minutes, row.pairs, row.last_inventory_date, row.error) == (0, 0, 0, None, coverage.NO_COVERAGE)


def test_pages_read_few_files(spark, tmp_path):
    """All pages of a status, one after another, with many rows at the same minute; each reads few of many files."""
    rows = [(listing, F_BASE + 60 * (k // 7), ("UNREVIEWED", "REVIEWED")[k % 3 == 0]) for k in range(700) for listing in (k % 5, 5 + k % 4)]
    rows = sorted({(a, b): c for a, b, c in rows}.items())
    table = spark.createDataFrame([(a, b, c) for (a, b), c in rows], "listing_id int, s long, status string").select("listing_id", F.timestamp_seconds("s").alias("minute"), "status")
    path = str(tmp_path / "t")
    clustered.write(table, path, per_file=20)
    total = spark.read.parquet(f"{path}/index").select("file").distinct().count()
    want = [(x[0][1], x[0][0]) for x in sorted((r for r in rows if r[1] == "UNREVIEWED"), key=lambda r: (-r[0][1], -r[0][0]))]
    got, after = [], None
    while True:
        files = clustered.files_of_page(spark, path, "UNREVIEWED", 150, None if after is None else F.lit(after[0]))
        found = [(int(r.minute.timestamp()), r.listing_id) for r in clustered.page(spark, path, "UNREVIEWED", 150, after).collect()]
        got += found
        if len(found) < 150:
            break
        assert len(files) < total / 2
        after = (datetime.fromtimestamp(found[-1][0]), found[-1][1])
    assert got == want and clustered.page(spark, path, "OTHER").collect() == []


F_BASE = 1_705_312_800


def test_versions_are_folded(spark, tmp_path):
    """Fifty batches leave a bounded number of folders; what is read is the latest row of each key before and after, also
    where a fold broke off before it removed what it replaces."""
    path, schema = str(tmp_path / "t"), "k int, v string, expires_at long"
    rows = lambda n: spark.createDataFrame([(n % 7, f"v{n}", None), (100 + n, "once", 5 if n % 2 else None)], schema).coalesce(1)
    sink = versioned.folding(streams.versions_sink(versioned.tail(path)), path, schema, ("k",), 10, F.col("expires_at").isNull())
    for n in range(50):
        sink(rows(n), n)
        assert versioned.folders(spark, path) <= 12
    got = {r.k: r.v for r in versioned.current(spark, path, schema, "k").where("k < 100").collect()}
    assert got == {k: f"v{max(n for n in range(50) if n % 7 == k)}" for k in range(7)}
    once = {r.k - 100 for r in versioned.current(spark, path, schema, "k").where("k >= 100").collect()}
    assert once == {n for n in range(50) if n % 2 == 0 or n >= 49}
    before = sorted(tuple(r) for r in versioned.current(spark, path, schema, "k").collect())
    spark.read.schema(f"{schema}, version int").parquet(f"{path}/base/48").write.parquet(f"{path}/base/47")
    assert sorted(tuple(r) for r in versioned.current(spark, path, schema, "k").collect()) == before


def test_gaps_are_put_into_a_table_without_rows(spark, tmp_path):
    """The first rows may come after puts of none, which leave no file; another put of none takes nothing away."""
    path = str(tmp_path / "gaps")
    found = spark.createDataFrame([(1, 1_705_314_600, "UNREVIEWED"), (2, 1_705_414_600, "REVIEWED")], "listing_id int, s long, status string")
    found = found.select("listing_id", F.timestamp_seconds("s").alias("minute"), "status", F.lit("UNKNOWN").alias("reason"), F.lit(False).alias("expected"), F.lit("n").alias("note"), F.timestamp_seconds("s").alias("created_at"))
    ids = lambda: sorted(r.listing_id for r in jobs.gap_table(spark, path).collect())
    assert ids() == []
    for rows, want in ((found.limit(0), []), (found.limit(0), []), (found, [1, 2]), (found.limit(0), [1, 2])):
        assert jobs.store_gaps(rows, path).collect() == [] and ids() == want
