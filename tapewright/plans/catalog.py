"""The registered queries over the given tables: each applies operators to ticks derived from the whole `events` table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import METRICS, MetricParams
from ..functions import fields, keys
from ..operators import baseline, convert, coverage, gaps, ledger, merge, metrics, rules, tables
from ..sources import clustered, io, layout, versioned
from ..sources.work import ordered, remove, stored, work_dir
from ..streaming import jobs as streams
from . import harness, jobs, snapshots

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Job time of all queries: operators never read the clock.
AS_OF = 1_706_800_000
#: A day and listing within the given data.
DAY, LISTING, CENTER = "2024-01-20", 10, 1_705_752_000
#: The given ticks vary too little for the default thresholds, so these queries look on both sides at 2.1 deviations.
TUNED: tuple[MetricParams, ...] = tuple(replace(p, direction="BOTH", z=2.1, detect=True) for p in METRICS)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def as_of() -> Column:
    return F.timestamp_seconds(F.lit(AS_OF))


def epoch(name: str = "minute") -> Column:
    return F.unix_timestamp(name).alias(name)


def rounded(name: str, digits: int = 8) -> Column:
    return F.round(name, digits).alias(name)


def in_epochs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.unix_timestamp(n) for n in names})


def in_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


# ---------------------------------------------------------------- merging


@query
def a01_capture_counts(spark, sf):
    return in_epochs(merge.capture_counts(harness.ticks(spark, sf)), "minute")


@query
def a02_capture_deficits(spark, sf):
    return in_epochs(merge.deficits(merge.capture_counts(harness.ticks(spark, sf))), "minute")


def _messages(spark, sf) -> DataFrame:
    """Notification envelopes of all raw captures, some of them malformed."""
    files = merge.capture_counts(harness.ticks(spark, sf, "minute"))
    key = keys.build_key(F.col("security_id"), F.col("exchange_id"), F.col("minute"), F.col("schema"), F.col("capture_id"))
    record = F.struct(F.struct(F.struct(F.lit("raw").alias("name")).alias("bucket"), F.struct(key.alias("key"), (F.col("n_records") * 100).alias("size")).alias("object")).alias("s3"))
    body = F.to_json(F.struct(F.lit("Notification").alias("Type"), F.to_json(F.struct(F.array(record).alias("Records"))).alias("Message")))
    good = files.select(body.alias("body"))
    bad = files.where("capture_id = 'c0'").select(F.explode(F.array(F.lit("{oops"), F.lit('{"Type":"x"}'), F.lit('{"Message":"{\\"Records\\":[{}]}"}'))).alias("body"))
    return good.union(good).union(bad)


@query
def s08_notified_keys(spark, sf):
    return io.notified_keys(_messages(spark, sf))


@query
def a03_affected_minutes(spark, sf):
    return in_epochs(merge.affected_minutes(io.notified_entries(_messages(spark, sf))), "minute")


@query
def a04_merge_totals(spark, sf):
    return in_epochs(merge.merge_totals(merge.capture_counts(harness.ticks(spark, sf))), "minute")


@query
def w03_winning_capture(spark, sf):
    return in_epochs(merge.winners(merge.capture_counts(harness.ticks(spark, sf))), "minute")


@query
def q01_merged_ticks(spark, sf):
    raw = harness.ticks(spark, sf)
    entries = raw.select(*merge.KEY, F.lit("RAW").alias("entry_type"))
    return in_epochs(jobs.merge_captures(entries, raw)[0].select("listing_id", "minute", "pos", "sequence", "price", "size"), "minute")


# ---------------------------------------------------------------- static rules


@query
def w01_sequence_transitions(spark, sf):
    found = rules.measures(harness.ticks(spark, sf))
    return in_epochs(found.select("listing_id", "minute", "total", "decreases"), "minute")


@query
def r01_timestamp_alignment(spark, sf):
    return in_epochs(rules.misaligned(rules.measures(harness.ticks(spark, sf, "minute"))).select("listing_id", "minute", "total", "misaligned"), "minute")


@query
def r02_sequence_monotonicity(spark, sf):
    return in_epochs(rules.not_monotonic(rules.measures(harness.ticks(spark, sf))).select("listing_id", "minute", "total", "decreases"), "minute")


@query
def r03_bad_data_flags(spark, sf):
    return in_epochs(rules.flagged(rules.measures(harness.ticks(spark, sf))).select("listing_id", "minute", "total", "bad_book", "bad_recv"), "minute")


@query
def r09_static_issues(spark, sf):
    found = rules.static_issues(harness.ticks(spark, sf), as_of(), 3600)
    return in_epochs(found.select("listing_id", "issue_id", "rule_type", "status", "minute", "s3_key", "record_count"), "minute")


# ---------------------------------------------------------------- metrics and statistics


def _values(spark, sf, cycle="hour") -> DataFrame:
    return metrics.minute_metrics(harness.ticks(spark, sf, cycle))


@query
def a08_minute_metrics(spark, sf):
    return _values(spark, sf).select("listing_id", epoch(), "metric", rounded("value"))


@query
def a14_hourly_statistics(spark, sf):
    return in_text(metrics.hourly_stats(_values(spark, sf, "minute")), "date").select("listing_id", "date", "hour", "metric", "count", rounded("sum"), rounded("sum_sq"))


@query
def a15_combined_statistics(spark, sf):
    return metrics.combine(metrics.hourly_stats(_values(spark, sf)), "listing_id", "metric").select("listing_id", "metric", rounded("mean"), rounded("stddev", 6), "n")


@query
def a29_listing_statistics(spark, sf):
    stats = metrics.hourly_stats(_values(spark, sf))
    return metrics.listing_statistics(stats, F.to_date(F.lit(DAY)), 14).select("listing_id", "metric", rounded("mean"), rounded("stddev", 6), "n", "rows_included", "days_included")


@query
def a30_listing_history(spark, sf):
    stats = metrics.hourly_stats(_values(spark, sf))
    return in_text(metrics.listing_history(stats, F.to_date(F.lit(DAY)), 30, hour=12), "date").select("listing_id", "date", "metric", rounded("mean"), rounded("stddev", 6), "n")


@query
def q19_one_listing_statistics(spark, sf):
    stats = metrics.hourly_stats(_values(spark, sf).where(F.col("listing_id") == LISTING))
    return metrics.listing_statistics(stats, F.to_date(F.lit(DAY)), 14, hour=12).select("metric", rounded("mean"), rounded("stddev", 6), "n", "rows_included", "days_included")


@query
def u03_merged_statistics(spark, sf):
    """Statistics of two halves of the files, merged, are those of the whole."""
    v = _values(spark, sf)
    half = F.pmod(F.unix_timestamp("minute") / 3600, F.lit(2)) == 0
    both = tables.merge_statistics(metrics.hourly_stats(v.where(half)), metrics.hourly_stats(v.where(~half)))
    return in_text(both, "date").select("listing_id", "date", "hour", "metric", "count", rounded("sum"), rounded("sum_sq"))


@query
def u07_reset_statistics(spark, sf):
    day = F.to_date(F.lit(DAY))
    return in_text(jobs.reset_statistics(metrics.hourly_stats(_values(spark, sf)), LISTING, day, day), "date").select("listing_id", "date", "hour", "metric", "count", rounded("sum"), rounded("sum_sq"))


# ---------------------------------------------------------------- baselines and scores


@query
def w04_asof_baseline(spark, sf):
    return _baseline_rows(baseline.asof_baselines(_values(spark, sf)))


def _baseline_rows(found: DataFrame) -> DataFrame:
    return found.select("listing_id", "metric", epoch(), "c", rounded("s"), F.round(F.sqrt(F.coalesce(F.try_divide("q", "c"), F.lit(0.0))), 6).alias("rms"), F.col("days").cast("long").alias("days"), F.coalesce(F.col("latest").cast("long"), F.lit(-1)).alias("latest"))


@query
def j04_table_baseline(spark, sf):
    return _baseline_rows(baseline.asof_baselines(_values(spark, sf), whole_day=True))


@query
def a16_warm_up(spark, sf):
    found = baseline.scored(_values(spark, sf))
    return found.groupBy("listing_id", "metric").agg(F.count_if("ready").alias("ready"), F.count_if(~F.col("ready")).alias("not_ready"), F.max("days").cast("long").alias("most_days"))


@query
def r06_anomalies(spark, sf):
    found = baseline.scored(_values(spark, sf), TUNED).where("anomalous")
    return found.select("listing_id", "metric", epoch(), rounded("value"), rounded("mean"), rounded("stddev", 6), "n")


@query
def r04_default_anomalies(spark, sf):
    return baseline.scored(_values(spark, sf)).where("anomalous").select("listing_id", "metric", epoch(), rounded("value"))


@query
def q05_quality_check(spark, sf):
    found = jobs.quality_check(harness.ticks(spark, sf), as_of(), params=TUNED, seconds=3600).issues
    return found.select("listing_id", "issue_id", "rule_type", epoch(), "record_count")


@query
def q07_backfill(spark, sf):
    ticks = harness.ticks(spark, sf)
    start, end = F.to_date(F.lit("2024-01-15")), F.to_date(F.lit(DAY))
    found, _ = jobs.backfill(ticks, LISTING, start, end, as_of(), "all", TUNED, 3600)
    return found.issues.select("issue_id", "rule_type", epoch(), "record_count")


@query
def a19_backfill_counters(spark, sf):
    start, end = F.to_date(F.lit("2024-01-15")), F.to_date(F.lit(DAY))
    return jobs.backfill(harness.ticks(spark, sf), LISTING, start, end, as_of(), "all", TUNED, 3600)[1]


# ---------------------------------------------------------------- gaps


def _observed(spark, sf) -> DataFrame:
    return gaps.observed(None, harness.ticks(spark, sf, "minute").select("listing_id", "minute"))


@query
def j02_observed_minutes(spark, sf):
    ticks = harness.ticks(spark, sf, "minute")
    ledger_ = ticks.where("action = 'Trade'").select("listing_id", "minute")
    return in_epochs(gaps.observed(ledger_, ticks.where("action <> 'Fill'")), "minute")


@query
def w02_previous_minute(spark, sf):
    found = gaps.neighbours(_observed(spark, sf), 120)
    return found.select("listing_id", epoch(), epoch("previous"), "missing")


@query
def a17_gap_tolerance(spark, sf):
    return in_epochs(gaps.tolerances(_values(spark, sf, "minute")), "minute")


@query
def q04_gap_rows(spark, sf):
    found = gaps.reported(_observed(spark, sf), gaps.tolerances(_values(spark, sf, "minute")))
    return gaps.gap_rows(found, as_of()).select("listing_id", epoch(), "status", "reason", "expected")


@query
def r10_reported_gaps(spark, sf):
    found = gaps.reported(_observed(spark, sf), gaps.tolerances(_values(spark, sf, "minute")))
    return found.select("listing_id", epoch("previous"), epoch(), "missing", F.col("tolerance").cast("long").alias("tolerance"))


@query
def t05_missing_minutes(spark, sf):
    """Expected minus observed minutes between the first and last of each listing, without a tolerance or search span."""
    found = gaps.neighbours(_observed(spark, sf), 10**6).where("missing > 0")
    return gaps.gap_rows(found, as_of()).groupBy("listing_id").agg(F.count("*").alias("missing"))


# ---------------------------------------------------------------- coverage


def _inventory(spark, sf) -> DataFrame:
    """Inventory lines of three schemas of files, with lines that are too short."""
    ticks = harness.ticks(spark, sf, "minute")
    key = lambda schema: keys.build_key(F.col("security_id"), F.col("exchange_id"), F.col("minute"), F.lit(schema))
    line = lambda schema, size: F.concat(F.lit('"final","'), key(schema), F.lit('","v1","true","false","'), size.cast("string"), F.lit('"'))
    files = ticks.groupBy("security_id", "exchange_id", "minute").agg(F.count("*").alias("n"), F.count_if(F.col("action") == "Trade").alias("trades"))
    lines = F.array(line("mbp-10", F.col("n") * 100), F.when(F.col("trades") > 0, line("trades", F.col("trades") * 40)), F.concat(F.lit('"final","'), key("ohlcv-1m"), F.lit('","v1","true","false"')), F.lit("short,line"))
    return files.select(F.explode(lines).alias("value")).where("value is not null")


def _entries(spark, sf) -> DataFrame:
    return coverage.entries(io.inventory_lines(_inventory(spark, sf)))


@query
def s07_inventory(spark, sf):
    return io.inventory_lines(_inventory(spark, sf)).groupBy("key").agg(F.sum("size").alias("size"))


@query
def a20_coverage_global(spark, sf):
    return in_text(coverage.global_summary(_entries(spark, sf)), "earliest_date", "latest_date")


@query
def a21_coverage_by_schema(spark, sf):
    return coverage.by_schema(_entries(spark, sf))


@query
def a22_coverage_by_pair(spark, sf):
    found = in_text(coverage.by_pair(_entries(spark, sf)), "earliest_date", "latest_date")
    return found.withColumn("schema_types", F.array_join("schema_types", ","))


@query
def a23_coverage_by_security(spark, sf):
    found = in_text(coverage.summary(_entries(spark, sf), "security_id"), "earliest_date", "latest_date")
    return found.withColumn("schema_types", F.array_join("schema_types", ","))


@query
def a24_coverage_exchanges_of_security(spark, sf):
    found = in_text(coverage.summary(_entries(spark, sf), "security_id", "exchange_id"), "earliest_date", "latest_date").drop("total_exchanges")
    return found.withColumn("schema_types", F.array_join("schema_types", ","))


@query
def a25_coverage_security_dates(spark, sf):
    return in_text(coverage.per_date(_entries(spark, sf), "security_id", "schema"), "date")


@query
def a26_coverage_security_date_exchanges(spark, sf):
    return in_text(coverage.per_date(_entries(spark, sf), "security_id", "exchange_id", "schema"), "date")


@query
def a28_coverage_pair_dates(spark, sf):
    return in_text(coverage.per_date(_entries(spark, sf), "security_id", "exchange_id"), "date")


@query
def t03_coverage_levels(spark, sf):
    return in_text(coverage.levels(_entries(spark, sf)), "date", "earliest", "latest")


@query
def q09_coverage_records(spark, sf):
    """All coverage rows with the fields of their documents."""
    return _documents(jobs.coverage_tables(io.inventory_lines(_inventory(spark, sf)), as_of()))


def _documents(found: DataFrame) -> DataFrame:
    field = lambda n: F.get_json_object("data", f"$.{n}")
    number = lambda n: field(n).cast("long")
    per_schema = F.when(~F.col("sk").startswith("DATE"), F.lit(None)).otherwise(number("schemaTypes.trades.minutes"))
    return found.select(
        "pk", "sk", number("totalMinutes").alias("total_minutes"), number("totalDays").alias("total_days"), number("totalSizeBytes").alias("total_size_bytes"), field("earliestDate").alias("earliest_date"), field("latestDate").alias("latest_date"), field("hasCoverage").alias("has_coverage"),
        per_schema.alias("trade_minutes"), F.when(F.col("sk").startswith("DATE"), number("schemaTypes.trades.sizeBytes")).alias("trade_bytes"), number("exchanges.0.totalMinutes").alias("minutes_at_0"), number("totalExchanges").alias("total_exchanges"), "version", epoch("last_updated"),
    )


@query
def s10_stored_coverage(spark, sf):
    """The coverage table as a job leaves it, run twice."""
    path = work_dir(spark, "coverage")
    for _ in range(2):
        jobs.store_coverage(io.inventory_lines(_inventory(spark, sf)), as_of(), path)
    return _documents(spark.read.parquet(path))


@query
def t03_merged_inventories(spark, sf):
    """Levels of two inventories that list different files of the same minutes, from their merged bitmaps."""
    lines = io.inventory_lines(_inventory(spark, sf))
    half = F.pmod(F.xxhash64("key"), F.lit(2)) == 0
    days = coverage.merged(*(coverage.days(coverage.entries(lines.where(part))) for part in (half, ~half)))
    return in_text(coverage.levels(stored(days, "days")), "date", "earliest", "latest")


def _land(spark, lines: DataFrame, folder: str, files: int) -> DataFrame:
    """Write a snapshot's lines as text files and return its manifest: (snapshot, file)."""
    lines.repartitionByRange(files, "value").write.text(folder)
    place = F.split(F.col("_metadata.file_path"), "/")
    listed = spark.read.text(folder).select(F.element_at(place, -2).alias("snapshot"), F.element_at(place, -1).alias("file"))
    return stored(listed.distinct(), "manifest")


@query
def x11_streamed_coverage(spark, sf):
    """An inventory snapshot that arrives in one micro-batch."""
    landing, path = work_dir(spark, "inventory"), work_dir(spark, "coverage")
    listed = _land(spark, _inventory(spark, sf), f"{landing}/2024-01-20", 4)
    streams.run_available(snapshots.snapshot_lines(spark, landing), snapshots.snapshot_sink(path, lambda s: listed, as_of()))
    return _documents(snapshots.current(spark, path))


@query
def x11_split_snapshot(spark, sf):
    """The same with a file a batch; its manifest comes last of all, after the stream has run."""
    landing, path, job = work_dir(spark, "inventory"), work_dir(spark, "coverage"), streams.Scheduled(work_dir(spark, "job"))
    listed = _land(spark, _inventory(spark, sf), f"{landing}/2024-01-20", 5)
    none = listed.limit(0)
    job.run(snapshots.snapshot_lines(spark, landing, 1), snapshots.snapshot_sink(path, lambda s: none, as_of()))
    snapshots.publish(spark, path, lambda s: listed, as_of())
    return _documents(snapshots.current(spark, path))


@query
def x11_incomplete_snapshot(spark, sf):
    """A snapshot up to a day is published; of the next one a file is missing, so the table stays."""
    landing, path, job = work_dir(spark, "inventory"), work_dir(spark, "coverage"), streams.Scheduled(work_dir(spark, "job"))
    lines = _inventory(spark, sf)
    before = F.coalesce(keys.parse_key(F.get(F.split("value", '"'), F.lit(3)))["minute"] < F.lit(DAY).cast("timestamp"), F.lit(True))
    first = _land(spark, lines.where(before), f"{landing}/2024-01-20", 2)
    job.run(snapshots.snapshot_lines(spark, landing, 1), snapshots.snapshot_sink(path, lambda s: first, as_of()))
    second = _land(spark, lines, f"{landing}/2024-01-21", 3)
    absent = second.limit(1).withColumn("file", F.lit("part-that-never-came"))
    both = first.union(second).union(absent)
    job.run(snapshots.snapshot_lines(spark, landing, 1), snapshots.snapshot_sink(path, lambda s: both, as_of()))
    return _documents(snapshots.current(spark, path))


@query
def q10_empty_summary(spark, sf):
    """What the summary says where the given inventory has no line that can be read."""
    lines = _inventory(spark, sf).where("value = 'short,line'")
    return _answer(jobs.coverage_tables(io.inventory_lines(lines), as_of()))


@query
def q10_summary_answer(spark, sf):
    return _answer(jobs.coverage_tables(io.inventory_lines(_inventory(spark, sf)), as_of()))


def _answer(table: DataFrame) -> DataFrame:
    return coverage.summary_answer(table).select("total_files", "total_minutes", "total_size_bytes", "pairs", epoch("last_inventory_date"), "error")


@query
def q10_coverage_summary(spark, sf):
    found = jobs.coverage_tables(io.inventory_lines(_inventory(spark, sf)), as_of()).where("pk = 'GLOBAL'")
    field = lambda n: F.get_json_object("data", f"$.{n}")
    return found.select(field("totalFiles").cast("long").alias("total_files"), field("securityExchangeCount").cast("long").alias("pairs"), field("schemaTypes.trades.fileCount").cast("long").alias("trade_files"), epoch("last_updated"))


@query
def q11_coverage_of_security(spark, sf):
    found = coverage.read_documents(jobs.coverage_tables(io.inventory_lines(_inventory(spark, sf)), as_of()), keys.coverage_pk(F.lit(1)))
    return found.select("pk", F.get_json_object("summary", "$.totalExchanges").cast("long").alias("total_exchanges"), F.explode("coverage").alias("date", "document")).select("pk", "total_exchanges", "date", F.get_json_object("document", "$.totalMinutes").cast("long").alias("total_minutes"), F.get_json_object("document", "$.schemaTypes.trades.minutes").cast("long").alias("trade_minutes"))


@query
def q12_coverage_of_pair(spark, sf):
    found = coverage.read_documents(jobs.coverage_tables(io.inventory_lines(_inventory(spark, sf)), as_of()), keys.coverage_pk(F.lit(1), F.lit(0)))
    return found.select("pk", F.get_json_object("summary", "$.totalDays").cast("long").alias("total_days"), F.explode("coverage").alias("date", "document")).select("pk", "total_days", "date", F.get_json_object("document", "$.totalMinutes").cast("long").alias("total_minutes"))


# ---------------------------------------------------------------- conversions


@query
def c01_mbp1(spark, sf):
    return in_epochs(convert.to_mbp1(harness.ticks(spark, sf)).select("listing_id", "schema", "minute", "sequence", "bid_px_0", "ask_px_0"), "minute")


@query
def c02_ohlcv_1h(spark, sf):
    return convert.convert(harness.ticks(spark, sf), "mbp-10", "ohlcv-1h")


@query
def c03_ohlcv_1m(spark, sf):
    return convert.convert(harness.ticks(spark, sf), "mbp-10", "ohlcv-1m")


@query
def c04_ohlcv_1s(spark, sf):
    return convert.convert(harness.ticks(spark, sf), "mbp-10", "ohlcv-1s")


@query
def c05_trades(spark, sf):
    return convert.to_trades(harness.ticks(spark, sf)).select("listing_id", "pos", "ts_event_ns", "price", "size")


@query
def c06_bbo_1m(spark, sf):
    return convert.convert(harness.ticks(spark, sf), "mbp-10", "bbo-1m")


@query
def c07_rolled_up_hours(spark, sf):
    return convert.roll_up(convert.roll_up(convert.to_ohlcv(harness.ticks(spark, sf), 1), 60), 3600)


@query
def c08_bars_of_bids(spark, sf):
    return convert.to_ohlcv(harness.ticks(spark, sf), 3600, price_col="bid_px_0", trades_only=False)


@query
def c09_complete_hours(spark, sf):
    ticks = harness.ticks(spark, sf, "minute")
    return convert.only_complete_hours(convert.to_ohlcv(ticks, 3600), ticks.select("security_id", "exchange_id", "minute"))


# ---------------------------------------------------------------- keys and fields


@query
def p01_keys(spark, sf):
    """Keys are built, parsed again, and written in their other forms."""
    files = merge.capture_counts(harness.ticks(spark, sf, "minute"))
    raw = keys.build_key(F.col("security_id"), F.col("exchange_id"), F.col("minute"), F.col("schema"), F.col("capture_id"))
    k = keys.parse_key(F.col("key"))
    rows = files.select(raw.alias("key")).select("key", k.alias("k"))
    listing = F.col("k.security_id") * 10 + F.col("k.exchange_id")
    job = keys.job_id(listing, F.col("k.schema"))
    date = F.to_date("k.minute")
    stat = keys.statistic_sk(F.hour("k.minute"), date, F.lit("tickCount"))
    return rows.select(
        "key", F.col("k.security_id").alias("security_id"), F.col("k.exchange_id").alias("exchange_id"), F.unix_timestamp("k.minute").alias("minute"), F.col("k.schema").alias("schema"), F.col("k.entry_type").alias("entry_type"), F.col("k.capture_id").alias("capture_id"),
        job.alias("job_id"), keys.parse_job_id(job)["schema"].alias("job_schema"), keys.coverage_pk(F.col("k.security_id"), F.col("k.exchange_id")).alias("pk"), keys.coverage_sk(date).alias("sk"),
        stat.alias("stat"), keys.parse_statistic_sk(stat)["metric"].alias("stat_metric"), keys.issue_id(F.col("k.minute"), F.lit("BAD_DATA_FLAGS")).alias("issue_id"), keys.is_weekend(date).alias("weekend"), keys.minute_text(F.col("k.minute")).alias("text"), keys.wrapped_hour(F.hour("k.minute"), -1).alias("hour_before"),
    )


# ---------------------------------------------------------------- ledger and reviews


def _entries_of(spark, sf, cycle="minute") -> DataFrame:
    return harness.ticks(spark, sf, cycle).select("security_id", "exchange_id", "schema", "minute").distinct()


def _jobs(spark, sf) -> DataFrame:
    """Jobs of all files; those of even minutes are complete."""
    ticks = harness.ticks(spark, sf, "minute")
    empty = spark.createDataFrame([], "job_id string, minute timestamp")
    found = ledger.created(_entries_of(spark, sf), harness.listings(ticks), empty, as_of())
    return found.withColumn("status", F.when(F.pmod(F.unix_timestamp("minute") / 60, F.lit(2)) == 0, "COMPLETE").otherwise("PENDING"))


@query
def j06_convertible_targets(spark, sf):
    ticks = harness.ticks(spark, sf, "minute")
    return in_epochs(ledger.candidates(_entries_of(spark, sf), harness.listings(ticks)), "minute")


@query
def q02_created_jobs(spark, sf):
    """Only jobs that the ledger lacks: it holds those of trades already."""
    ticks = harness.ticks(spark, sf, "minute")
    known = _jobs(spark, sf).where("schema in ('trades', 'bbo-1s')")
    found = ledger.created(_entries_of(spark, sf), harness.listings(ticks), known, as_of())
    return found.select("job_id", epoch(), "listing_id", "schema", "status", epoch("created_at"))


@query
def q03_run_jobs(spark, sf):
    ticks = harness.ticks(spark, sf, "minute")
    return in_epochs(jobs.run_jobs(_jobs(spark, sf), ticks, "ohlcv-1h", as_of())[0], "job_minute")


@query
def q03_run_jobs_in_parts(spark, sf):
    """A limited run, and another of what it left: the output of each job is that of one run."""
    ticks, ledger_ = harness.ticks(spark, sf, "minute"), stored(_jobs(spark, sf), "jobs")
    first, closed = jobs.run_jobs(ledger_, ticks, "ohlcv-1h", as_of(), limit=50)
    second, _ = jobs.run_jobs(stored(tables.put(ledger_, closed, *ledger.JOB), "jobs"), ticks, "ohlcv-1h", as_of())
    return in_epochs(first.union(second), "job_minute")


def _some_fail(spark, sf) -> tuple[DataFrame, DataFrame]:
    """A run in which some records have no event time and one listing is unknown."""
    ticks = harness.ticks(spark, sf, "minute")
    broken = ticks.withColumn("ts_event_ns", F.when(F.col("pos") % 997 != 0, F.col("ts_event_ns")))
    return jobs.run_jobs(_jobs(spark, sf), broken, "ohlcv-1h", as_of(), listings=harness.listings(ticks).where("listing_id <> 1"))


@query
def q03_isolated_output(spark, sf):
    return in_epochs(_some_fail(spark, sf)[0], "job_minute")


@query
def u04_failed_jobs(spark, sf):
    return _some_fail(spark, sf)[1].select("job_id", epoch(), "status", "error_message")


@query
def l06_limited_run(spark, sf):
    """Jobs that a run of at most 40 closes: the earliest."""
    ticks = harness.ticks(spark, sf, "minute")
    return jobs.run_jobs(_jobs(spark, sf), ticks, "trades", as_of(), limit=40)[1].select("job_id", epoch(), "status")


def _tick_tables(spark, sf) -> tuple[snapshots.Reader, snapshots.Reader]:
    """Ticks and listings as jobs read them, in the session of the batch."""
    return (lambda s: harness.ticks(s, sf, "minute")), (lambda s: harness.listings(harness.ticks(s, sf, "minute")))


@query
def x05_converted_entries(spark, sf):
    """Merged entries that arrive in files, streamed through job creation and conversion."""
    landing, ledger_, out = (work_dir(spark, n) for n in ("entries", "jobs", "bars"))
    entries = _entries_of(spark, sf)
    ordered(entries.repartitionByRange(3, "minute"), landing)
    streams.run_available(streams.file_stream(spark, landing, entries.schema, files=1), jobs.conversion_sink(ledger_, out, *_tick_tables(spark, sf), "ohlcv-1m", as_of()))
    return in_epochs(spark.read.parquet(out).drop("version"), "job_minute")


@query
def x05_restarted_runs(spark, sf):
    """Three scheduled runs over a landing folder that is cleared before each: what came is converted once, and stays."""
    landing, ledger_, out, job = work_dir(spark, "entries"), work_dir(spark, "jobs"), work_dir(spark, "bars"), streams.Scheduled(work_dir(spark, "job"))
    entries = stored(_in_thirds(_entries_of(spark, sf)), "entries")
    for part in range(3):
        path = f"{landing}/{part}"
        entries.where(F.col("part") == part).drop("part").write.parquet(path)
        stream = streams.file_stream(spark, f"{landing}/*", entries.drop("part").schema, files=1)
        job.run(stream, jobs.conversion_sink(ledger_, out, *_tick_tables(spark, sf), "ohlcv-1m", as_of()))
        job.run(stream, jobs.conversion_sink(ledger_, out, *_tick_tables(spark, sf), "ohlcv-1m", as_of()))  # nothing has come since
        remove(spark, path)
    return in_epochs(spark.read.parquet(out).drop("version"), "job_minute")


def _in_thirds(rows: DataFrame) -> DataFrame:
    """Rows with a part from 0 to 2 by day."""
    return rows.withColumn("part", F.dayofmonth("minute") % 3)


@query
def x05_shared_ledger(spark, sf):
    """Two streams of entries with a schema each, on one ledger, and a schedule for a third schema whose jobs they created."""
    landing, ledger_ = work_dir(spark, "entries"), work_dir(spark, "jobs")
    entries = _entries_of(spark, sf)
    ordered(entries.repartitionByRange(2, "minute"), landing)
    ticks, listings = _tick_tables(spark, sf)
    for schema in ("ohlcv-1m", "trades"):
        job = streams.Scheduled(work_dir(spark, schema))
        job.run(streams.file_stream(spark, landing, entries.schema, files=1), jobs.conversion_sink(ledger_, work_dir(spark, "out"), ticks, listings, schema, as_of()))
    for limit in (25, None):
        jobs.process_pending(spark, ledger_, work_dir(spark, "out"), ticks, listings, "ohlcv-1h", as_of(), limit)
    return ledger.current(jobs.ledger_rows(spark, ledger_)).select("job_id", epoch(), "schema", "status", F.coalesce("expires_at", F.lit(0)).alias("expires_at"))


@query
def u04_closed_jobs(spark, sf):
    ticks = harness.ticks(spark, sf, "minute")
    found = jobs.run_jobs(_jobs(spark, sf), ticks, "trades", as_of())[1]
    return found.select("job_id", epoch(), "status", epoch("processed_at"), "expires_at")


@query
def q21_list_jobs(spark, sf):
    found = tables.listed(_jobs(spark, sf), F.col("schema") == "trades", F.col("status") == "PENDING", tie=("job_id",))
    return found.select("job_id", epoch(), "status")


@query
def q22_search_jobs(spark, sf):
    found = tables.listed(_jobs(spark, sf), F.col("listing_id") == LISTING, F.col("schema") == "ohlcv-1m", tie=("job_id",), limit=50)
    return found.select("job_id", epoch(), "status")


def _gaps(spark, sf) -> DataFrame:
    """Gaps without tolerance within 2 hours; a third of them are reviewed."""
    found = gaps.gap_rows(gaps.reported(_observed(spark, sf), search_minutes=120), as_of())
    return found.withColumn("status", F.when(F.pmod(F.unix_timestamp("minute") / 60, F.lit(3)) == 0, "REVIEWED").otherwise(F.col("status")))


@query
def q13_list_gaps(spark, sf):
    found = tables.listed(_gaps(spark, sf), F.col("status") == "UNREVIEWED", tie=("listing_id",))
    return found.select("listing_id", epoch(), "status")


@query
def l05_next_page_of_gaps(spark, sf):
    page = tables.after("minute", "listing_id", F.timestamp_seconds(F.lit(CENTER)), F.lit(LISTING))
    return tables.listed(_gaps(spark, sf), F.col("status") == "UNREVIEWED", page, tie=("listing_id",)).select("listing_id", epoch(), "status")


@query
def q14_gaps_of_listing(spark, sf):
    return tables.listed(_gaps(spark, sf), F.col("listing_id") == LISTING, limit=1000, most=1000).select("listing_id", epoch(), "status")


@query
def q15_review_gaps(spark, sf):
    """Gaps of whole hours get a reason, some a note, and unknown keys are added."""
    table = _gaps(spark, sf)
    at = F.unix_timestamp("minute")
    updates = table.where(F.pmod(at / 60, F.lit(60)) == 0).select("listing_id", "minute", F.lit("EXCHANGE_CLOSED").alias("reason"), F.lit(True).alias("expected"), F.when(F.pmod(at / 3600, F.lit(2)) == 0, "checked").alias("note"))
    unknown = updates.where(F.col("listing_id") == LISTING).withColumn("listing_id", F.lit(99))
    missing = updates.where(F.col("listing_id") == LISTING).withColumn("listing_id", F.lit(None).cast("int"))
    done = tables.review(table, updates.union(unknown).union(missing), ("listing_id", "minute"), ("reason", "expected", "note"))
    return done.select("listing_id", epoch(), "status", "reason", "expected", "note")


@query
def a31_review_counts(spark, sf):
    table = _gaps(spark, sf)
    updates = table.select(F.when(F.col("listing_id") != LISTING, F.col("listing_id")).alias("listing_id"), "minute")
    return tables.review_counts(updates, ("listing_id", "minute"))


@query
def u02_put_keeps_reviews(spark, sf):
    table = _gaps(spark, sf)
    again = table.withColumns({"status": F.lit("UNREVIEWED"), "note": F.lit("found again")})
    return tables.put_unreviewed(table, again, "listing_id", "minute").select("listing_id", epoch(), "status", "note")


def _issues(spark, sf) -> DataFrame:
    found = rules.static_issues(harness.ticks(spark, sf), as_of(), 3600)
    return found.withColumn("status", F.when(F.pmod(F.unix_timestamp("minute") / 3600, F.lit(4)) == 0, "REVIEWED").otherwise(F.col("status")))


@query
def q16_list_issues(spark, sf):
    found = tables.listed(_issues(spark, sf), F.col("rule_type") == "BAD_DATA_FLAGS", F.col("status") == "UNREVIEWED", tie=("listing_id",))
    return found.select("listing_id", "issue_id", epoch(), "status")


@query
def q17_issues_of_listing(spark, sf):
    found = tables.listed(_issues(spark, sf), F.col("listing_id") == LISTING, by="issue_id", limit=1000, most=1000)
    return found.select("listing_id", "issue_id", "rule_type")


@query
def q18_review_issues(spark, sf):
    table = _issues(spark, sf)
    updates = table.where("rule_type = 'SEQUENCE_MONOTONICITY'").select("listing_id", "issue_id", F.lit("known").alias("note"))
    return tables.review(table, updates, ("listing_id", "issue_id"), ("note",)).select("listing_id", "issue_id", "status", "note")


@query
def w06_latest_versions(spark, sf):
    """Job versions: each job pending, then closed; the latest of each."""
    first = _jobs(spark, sf).where("schema = 'trades'").withColumn("version", F.lit(1))
    second = ledger.closed(first.drop("version").where("status = 'PENDING'"), as_of()).withColumn("version", F.lit(2))
    return tables.latest(first.unionByName(second), "job_id", "minute").select("job_id", epoch(), "status", "version")


@query
def u08_live_jobs(spark, sf):
    closed = ledger.closed(_jobs(spark, sf).where("schema = 'trades'"), F.col("minute"))
    return tables.live(closed, F.timestamp_seconds(F.lit(CENTER))).select("job_id", epoch(), "expires_at")


# ---------------------------------------------------------------- investigation


def _investigation(spark, sf) -> jobs.Investigation:
    ticks = harness.ticks(spark, sf, "minute")
    values = stored(metrics.minute_metrics(ticks), "values")
    return jobs.investigate(values, harness.manifest(ticks), rules.static_issues(ticks, as_of()), LISTING, F.timestamp_seconds(F.lit(CENTER)), 60)


@query
def q08_investigated_minutes(spark, sf):
    return _investigation(spark, sf).minutes.select("epoch", "has_data", F.coalesce("record_count", F.lit(-1)).alias("record_count"), F.round(F.col("metrics")["midPrice"], 8).alias("mid_price"), F.col("metrics")["tickCount"].alias("tick_count"))


@query
def f13_issues_near_a_minute(spark, sf):
    return _investigation(spark, sf).issues.select("issue_id", "rule_type", "record_count")


@query
def a18_baseline_of_the_hour(spark, sf):
    return _investigation(spark, sf).baseline.select("metric", rounded("mean"), rounded("stddev", 6), "n")


# ---------------------------------------------------------------- scans


@query
def s03_entries_of_day(spark, sf):
    ticks = harness.ticks(spark, sf, "minute")
    return in_epochs(io.entries_of_listings(harness.manifest(ticks), harness.listings(ticks), F.to_date(F.lit(DAY))).select("listing_id", "minute", "n_records"), "minute")


@query
def j01_entries_with_listing(spark, sf):
    """Only listings of exchange 0 are known; entries of others are left out."""
    ticks = harness.ticks(spark, sf, "minute")
    known = harness.listings(ticks).where("exchange_id = 0")
    return in_epochs(io.with_listing(_entries_of(spark, sf), known).select("listing_id", "security_id", "exchange_id", "minute"), "minute")


# ---------------------------------------------------------------- streams


def _tick_stream(spark, sf, cycle="minute") -> DataFrame:
    """The ticks in files of bounded size, written once from the given events in their order, as a stream of five batches."""
    ticks = harness.ticks(spark, sf, cycle).withColumn("event_time", F.timestamp_micros((F.col("ts_event_ns") / 1000).cast("long")))
    return _landed(spark, ticks, "pos")


def _landed(spark, rows: DataFrame, by: str) -> DataFrame:
    path = work_dir(spark, "landing")
    files = ordered(rows.repartitionByRange(5 * max(1, rows.count() // 5_000_000), by), path)
    return streams.file_stream(spark, path, rows.schema, files=-(-files // 5))


@query
def x06_window_counts(spark, sf):
    path = work_dir(spark, "windows")
    # late rows are within two minutes of their order here
    counts = streams.window_counts(_tick_stream(spark, sf), "event_time", "1 hour", keys=("listing_id",)).select("listing_id", F.unix_timestamp("window.start").alias("start"), "n")
    streams.run_available(counts, streams.versions_sink(path), "update")
    return tables.latest(spark.read.parquet(path), "listing_id", "start").select("listing_id", "start", "n")


@query
def x07_running_statistics(spark, sf):
    path = work_dir(spark, "running")
    values = _tick_stream(spark, sf).select("listing_id", "minute", F.lit("price").alias("metric"), (F.col("price") / 1e9).alias("value"))
    streams.run_available(streams.running_hourly(values), streams.versions_sink(path), "update")
    found = tables.latest(spark.read.parquet(path), "listing_id", "date", "hour", "metric")
    return in_text(found, "date").select("listing_id", "date", "hour", "count", rounded("sum"), rounded("sum_sq"))


@query
def x08_gaps_on_arrival(spark, sf):
    path = work_dir(spark, "gaps")
    streams.run_available(streams.gaps_on_arrival(_tick_stream(spark, sf)), streams.versions_sink(path), "update")
    return streams.arrived_gaps(spark, path)


def _late(spark, sf) -> DataFrame:
    """Minutes in five batches, a seventh of them one batch late."""
    ticks = harness.ticks(spark, sf, "minute").select("listing_id", "minute", "pos")
    span = ticks.agg(F.max("pos") - F.min("pos")).first()[0]
    return ticks.withColumn("pos", F.col("pos") + F.when(F.col("pos") % 7 == 0, F.lit(span // 5)).otherwise(F.lit(0)))


@query
def x08_late_minutes(spark, sf):
    """Late minutes take back the gaps they fall in and leave those at their sides; the watermark waits a batch for them."""
    path = work_dir(spark, "gaps")
    streams.run_available(streams.gaps_on_arrival(_landed(spark, _late(spark, sf), "pos"), 120, "10 days"), streams.versions_sink(path), "update")
    found = streams.arrived_gaps(spark, path)
    return found.select("listing_id", F.explode(F.sequence(F.col("previous") + 60, F.col("minute") - 60, F.lit(60))).alias("minute"))


@query
def x03_gaps_after_late_data(spark, sf):
    """Minutes arrive in five batches, a seventh of them one batch late: gaps are looked for 15 minutes behind, and taken back."""
    seen, found = work_dir(spark, "seen"), work_dir(spark, "found")
    streams.run_available(_landed(spark, _late(spark, sf), "pos"), streams.gap_sink(seen, found, search_minutes=120))
    return in_epochs(streams.current_gaps(spark, found), "minute")


@query
def x09_streamed_notifications(spark, sf):
    """Repeated and malformed notifications as a stream: each key once."""
    messages = _messages(spark, sf).withColumn("received", as_of())
    path = work_dir(spark, "keys")
    streams.run_available(streams.distinct_notifications(_landed(spark, messages, "body"), "received"), streams.fan_out(streams.versions_sink(path)))
    return spark.read.parquet(path).select("key")


# ---------------------------------------------------------------- tables that jobs leave, own rules and metrics, further scans


@query
def s11_stored_issues(spark, sf):
    """Issues are put, some of them are reviewed, and all are put again: reviews stay."""
    path = work_dir(spark, "issues")
    found = rules.static_issues(harness.ticks(spark, sf), as_of(), 3600)
    jobs.store_issues(found, path)
    seen = found.where(F.pmod(F.unix_timestamp("minute") / 3600, F.lit(4)) == 0).withColumns({"status": F.lit("REVIEWED"), "note": F.lit("seen")})
    jobs.store_issues(seen, path)
    jobs.store_issues(found, path)
    return spark.read.parquet(path).select("listing_id", "issue_id", "status", "note")


@query
def s12_stored_gaps(spark, sf):
    """Gap rows put twice, among them rows that lack a part of the key."""
    path = work_dir(spark, "gaps")
    found = gaps.gap_rows(gaps.reported(_observed(spark, sf), search_minutes=120), as_of())
    broken = found.where(F.col("listing_id") == LISTING).withColumn("listing_id", F.lit(None).cast("int"))
    jobs.store_gaps(found, path)
    jobs.store_gaps(found.union(broken), path)
    return jobs.gap_table(spark, path).select("listing_id", epoch(), "status")


@query
def s12_rejected_gaps(spark, sf):
    found = gaps.gap_rows(gaps.reported(_observed(spark, sf), search_minutes=120), as_of())
    broken = found.where(F.col("listing_id") == LISTING).withColumn("listing_id", F.lit(None).cast("int"))
    return jobs.store_gaps(found.union(broken), work_dir(spark, "gaps")).select(epoch(), "error")


@query
def e01_own_rule(spark, sf):
    crossed = rules.Rule("CROSSED_BOOK", lambda: F.col("crossed") > 0, lambda seconds: F.format_string("%d of %d records are crossed", "crossed", "total"), {"crossed": lambda: F.count_if(F.col("ask_px_0") < F.col("bid_px_0"))})
    found = rules.static_issues(harness.ticks(spark, sf), as_of(), 3600, [crossed, rules.STATIC[2]])
    return found.select("listing_id", "issue_id", "rule_type", "details", "record_count")


@query
def e02_own_metric(spark, sf):
    largest = {"largestTrade": lambda: F.max(F.when(F.col("action") == "Trade", F.col("size")))}
    return metrics.minute_metrics(harness.ticks(spark, sf), more=largest).where("metric in ('largestTrade', 'tickCount')").select("listing_id", epoch(), "metric", "value")


@query
def r09_issue_details(spark, sf):
    """What static issues say; the share of transitions is left to its rounding."""
    found = rules.static_issues(harness.ticks(spark, sf), as_of(), 3600)
    return found.select("listing_id", "issue_id", F.regexp_replace("details", r" \(\d+\.\d%\)", "").alias("details"), "note", epoch("created_at"))


@query
def p13_fields_of_schemas(spark, sf):
    schema = F.get(F.array(F.lit("mbo"), F.lit("mbp-10"), F.lit("trades")), (F.col("pos") % 3).cast("int"))
    trade = fields.trade_fields(schema, F.col("price"), F.col("size"), F.col("action"))
    book, flags = fields.book_fields(schema, F.col("bid_px_0"), F.col("ask_px_0")), fields.flag_fields(schema, F.col("maybe_bad_book"), F.col("bad_ts_recv"))
    size = fields.without_sentinel(F.col("size"), 7)
    return harness.ticks(spark, sf).select("pos", schema.alias("schema"), trade["price"].alias("price"), trade["action"].alias("action"), book["bid_px_0"].alias("bid"), flags["bad_ts_recv"].alias("bad"), size.alias("size"), F.round(fields.price(F.col("price")), 6).alias("units"), fields.size(F.col("size")).alias("lots"))


@query
def s01_captures_of_minute(spark, sf):
    return io.captures(harness.ticks(spark, sf), 1, 0, harness.SOURCE, F.timestamp_seconds(F.lit(CENTER))).select("capture_id", "pos", "sequence")


@query
def s13_listing_by_id(spark, sf):
    ticks = harness.ticks(spark, sf, "minute")
    return io.with_pair(ticks.select("listing_id", "pos"), harness.listings(ticks).where("exchange_id = 0")).select("pos", "security_id", "exchange_id", "source_schema")


@query
def l01_sorted_entries(spark, sf):
    return in_epochs(io.sorted_entries(harness.manifest(harness.ticks(spark, sf, "minute")), "listing_id").select("listing_id", "minute", "n_records"), "minute")


@query
def l05_next_page_of_jobs(spark, sf):
    page = tables.after("minute", "job_id", F.timestamp_seconds(F.lit(CENTER)), F.lit("10-trades"))
    return tables.listed(_jobs(spark, sf), F.col("schema") == "trades", F.col("status") == "PENDING", page, tie=("job_id",)).select("job_id", epoch(), "status")


@query
def l05_next_page_of_issues(spark, sf):
    page = tables.after("minute", "issue_id", F.timestamp_seconds(F.lit(CENTER)), F.lit(f"{CENTER}#BAD_DATA_FLAGS"))
    return tables.listed(_issues(spark, sf), F.col("listing_id") == LISTING, page, tie=("issue_id",)).select("issue_id", epoch(), "rule_type")


@query
def c06_bbo_1s(spark, sf):
    return convert.convert(harness.ticks(spark, sf), "mbp-10", "bbo-1s")


@query
def c10_bars_of_mbp1(spark, sf):
    return convert.convert(convert.to_mbp1(harness.ticks(spark, sf)), "mbp-1", "ohlcv-1m")


@query
def r08_statistics_mode(spark, sf):
    """Values only: no issue is made."""
    found = jobs.quality_check(harness.ticks(spark, sf), as_of(), "statistics", TUNED, 3600)
    return found.values.select("listing_id", epoch(), "metric", rounded("value")).join(found.issues.select(F.col("listing_id").alias("_l")), F.col("listing_id") == F.col("_l"), "left_anti")


@query
def r08_issues_mode(spark, sf):
    """Issues against baselines of whole days."""
    found = jobs.quality_check(harness.ticks(spark, sf), as_of(), "issues", TUNED, 3600).issues
    return found.select("listing_id", "issue_id", "rule_type", epoch(), "record_count")


@query
def q06_backfill_of_a_day(spark, sf):
    day = F.to_date(F.lit(DAY))
    found, _ = jobs.backfill(harness.ticks(spark, sf), LISTING, day, day, as_of(), "all", TUNED, 3600)
    return found.issues.select("issue_id", "rule_type", epoch(), "record_count")


# ---------------------------------------------------------------- what had no query of its own


@query
def q04_detected_gaps(spark, sf):
    """The gap job as a whole: observed minutes of manifest and ledger, tolerances as of each minute, rows."""
    ticks = harness.ticks(spark, sf, "minute")
    found = jobs.detect_gaps(harness.manifest(ticks), _jobs(spark, sf).where("schema = 'trades'"), _values(spark, sf, "minute"), as_of())
    return found.select("listing_id", epoch(), "status", "reason", "expected", epoch("created_at"))


@query
def p19_anomaly_text(spark, sf):
    """What statistical issues say, taken apart again: metric and side, and whether the numbers are those of the score to the
    digits that the text has. (Halves are rounded up there, by the shortest decimal form, which SQL has no function for.)"""
    values = stored(metrics.file_metrics(harness.ticks(spark, sf)), "values")
    found = baseline.statistical_issues(values, None, as_of(), TUNED)
    part = lambda i: F.regexp_extract("details", r"^(\S+) (\S+) is (\S+)σ (\S+) conditional mean of (\S+) \(σ=(\S+)\)$", i)
    said = found.select("listing_id", "issue_id", "minute", part(1).alias("metric"), part(4).alias("side"), *(part(i).cast("double").alias(n) for i, n in ((2, "s_value"), (3, "s_off"), (5, "s_mean"), (6, "s_dev"))))
    score = baseline.scored(values, TUNED).where("anomalous").select("listing_id", "minute", "metric", "value", "mean", "stddev")
    four = lambda text, x: F.abs(F.col(text) - x) <= F.lit(0.501) * F.pow(F.lit(10.0), F.floor(F.log10(F.greatest(x, F.lit(1e-12)))) - 3)
    off = F.abs(F.abs(F.col("value") - F.col("mean")) / F.col("stddev") - F.col("s_off")) <= 0.0501
    agrees = four("s_value", F.col("value")) & four("s_mean", F.col("mean")) & four("s_dev", F.col("stddev")) & off
    return said.join(score, ["listing_id", "minute", "metric"]).select("listing_id", "issue_id", "metric", "side", rounded("value"), rounded("mean"), rounded("stddev", 6), agrees.alias("agrees"))


@query
def s09_inventory_notices(spark, sf):
    """Notifications of one level name the object of their first record; others are passed over."""
    files = merge.capture_counts(harness.ticks(spark, sf, "minute"))
    key = keys.build_key(F.col("security_id"), F.col("exchange_id"), F.col("minute"), F.col("schema"), F.col("capture_id"))
    record = lambda k: F.struct(F.struct(F.struct(k.alias("key")).alias("object")).alias("s3"))
    body = F.to_json(F.struct(F.array(record(key), record(F.lit("second"))).alias("Records")))
    bad = files.where("capture_id = 'c0'").select(F.explode(F.array(F.lit("{oops"), F.lit('{"Records":[]}'))).alias("body"))
    return io.inventory_notices(files.select(body.alias("body")).union(bad))


@query
def x06_minute_windows(spark, sf):
    path = work_dir(spark, "windows")
    counts = streams.window_counts(_tick_stream(spark, sf), "event_time", "1 minute", keys=("listing_id",)).select("listing_id", F.unix_timestamp("window.start").alias("start"), "n")
    streams.run_available(counts, streams.versions_sink(path), "update")
    return tables.latest(spark.read.parquet(path), "listing_id", "start").select("listing_id", "start", "n")


def _tick_table(spark, sf, cycle: str = "hour") -> DataFrame:
    """The ticks written as they should lie on disk."""
    name = f"ticks_{uuid.uuid4().hex}"
    layout.write_ticks(harness.ticks(spark, sf, cycle), name, work_dir(spark, "ticks"), 8)
    return layout.read_ticks(spark, name)


@query
def s01_pruned_captures(spark, sf):
    """Captures of a minute from one partition."""
    return layout.captures(_tick_table(spark, sf), 1, 0, harness.SOURCE, F.timestamp_seconds(F.lit(CENTER))).select("capture_id", "pos", "sequence")


@query
def s03_pruned_day(spark, sf):
    """Entries of a day from its partitions."""
    ticks = layout.of_day(_tick_table(spark, sf, "minute"), F.to_date(F.lit(DAY)))
    return harness.manifest(ticks).select("listing_id", epoch(), "n_records")


@query
def q01_bucketed_merge(spark, sf):
    """Merging a bucketed table: neither counts nor ticks are shuffled."""
    return in_epochs(merge.merge(_tick_table(spark, sf)).select("listing_id", "minute", "pos", "sequence", "price", "size"), "minute")


@query
def r09_bucketed_issues(spark, sf):
    """Static rules over a bucketed table, whose window and sums need no shuffle either."""
    found = rules.static_issues(_tick_table(spark, sf), as_of(), 3600)
    return in_epochs(found.select("listing_id", "issue_id", "rule_type", "status", "minute", "s3_key", "record_count"), "minute")


def _clustered_gaps(spark, sf) -> str:
    path = work_dir(spark, "gaps")
    rows = stored(_gaps(spark, sf), "rows")
    clustered.write(rows, path, per_file=max(1000, rows.count() // 40))
    return path


@query
def l02_clustered_gaps(spark, sf):
    """The first page of a status, from the files that hold it."""
    return clustered.page(spark, _clustered_gaps(spark, sf), "UNREVIEWED").select("listing_id", epoch(), "status")


@query
def l05_clustered_page(spark, sf):
    """The page that follows a row, from the files that hold it."""
    after = (F.timestamp_seconds(F.lit(CENTER)), LISTING)
    return clustered.page(spark, _clustered_gaps(spark, sf), "UNREVIEWED", after=after).select("listing_id", epoch(), "status")


@query
def w04_kept_baseline(spark, sf):
    """Values in five batches: a batch reads kept sums by hour, and none of the values before it."""
    sums, out = work_dir(spark, "sums"), work_dir(spark, "baselines")
    streams.run_available(_landed(spark, stored(_values(spark, sf), "values"), "minute"), streams.baseline_sink(sums, out))
    return _baseline_rows(spark.read.parquet(out))


@query
def x04_late_captures(spark, sf):
    """Captures in three batches, many of them late, through merging to scores and gaps: what a run from scratch gives."""
    raw_path, merged, values, issues, seen, found = (work_dir(spark, n) for n in ("raw", "merged", "values", "issues", "seen", "gaps"))
    raw = harness.ticks(spark, sf).withColumn("date", F.to_date("minute"))
    day = F.dayofmonth("minute")
    batch = F.when(F.col("capture_id") == "c2", F.when(day.between(5, 20), 1).otherwise(2)).otherwise(F.when(day <= 15, 0).otherwise(1))
    raw = stored(raw.withColumn("batch", batch), "batches")
    score = lambda v: baseline.scored(v, TUNED).where("anomalous").select("listing_id", "minute", "metric", "value", "mean", "stddev")
    sink = streams.capture_sink(raw_path, merged, metrics.minute_metrics, streams.score_sink(values, issues, score), streams.gap_sink(seen, found, search_minutes=300))
    for number in range(3):
        came = raw.where(F.col("batch") == number).drop("batch")
        io.append(came, raw_path, "date", "exchange_id")
        sink(came.select(*merge.KEY, F.lit("RAW").alias("entry_type")).distinct(), number)
    rows = streams.current_issues(spark, issues).select(F.lit("issue").alias("kind"), "listing_id", epoch(), "metric", rounded("value"), rounded("mean"), rounded("stddev", 6))
    none = F.lit(None).cast("double")
    return rows.union(streams.current_gaps(spark, found).select(F.lit("gap"), "listing_id", epoch(), F.lit(""), none, none, none))


@query
def w06_compacted_versions(spark, sf):
    """Jobs in fourteen batches of versions, folded every fourth: readers find the live ones in a bounded number of folders."""
    path, key, parts = work_dir(spark, "jobs"), ledger.JOB, 7
    rows = stored(_jobs(spark, sf).where("schema = 'trades'").withColumns({"status": F.lit("PENDING"), "part": F.pmod(F.xxhash64("minute"), F.lit(parts))}), "jobs")
    now = F.timestamp_seconds(F.lit(CENTER))
    alive = F.col("expires_at").isNull() | (F.col("expires_at") > F.unix_timestamp(now))
    sink = versioned.folding(streams.versions_sink(versioned.tail(path)), path, schemas.JOBS, key, 4, alive)
    most = 0
    for number in range(2 * parts):
        due = rows.where(F.col("part") == number % parts).drop("part")
        sink(due if number < parts else ledger.closed(due, F.col("minute")), number)
        most = max(most, versioned.folders(spark, path))
    found = tables.live(versioned.current(spark, path, schemas.JOBS, *key), now)
    return found.select("job_id", epoch(), "status", "expires_at", F.lit(most <= 6).alias("bounded"))


def _broken_backfill(spark, sf, mode: str, reset: bool) -> jobs.Backfill:
    """A backfill of a range in which some records have no event time, over statistics of all files."""
    ticks = harness.ticks(spark, sf)
    broken = ticks.withColumn("ts_event_ns", F.when(F.col("pos") % 97 != 0, F.col("ts_event_ns")))
    stats = metrics.hourly_stats(metrics.minute_metrics(ticks))
    return jobs.backfill_entries(broken, stats, LISTING, F.to_date(F.lit("2024-01-15")), F.to_date(F.lit(DAY)), as_of(), mode, reset, TUNED, 3600)


@query
def q06_backfill_with_errors(spark, sf):
    return _broken_backfill(spark, sf, "all", False).quality.issues.select("issue_id", "rule_type", epoch(), "record_count")


@query
def q06_backfill_errors(spark, sf):
    return _broken_backfill(spark, sf, "issues", False).errors.select("listing_id", epoch(), "error")


@query
def a19_counters_with_errors(spark, sf):
    return _broken_backfill(spark, sf, "all", True).counters


@query
def q06_reset_statistics(spark, sf):
    """Statistics mode with reset: hours of the range come from what could be read, others are as before."""
    found = _broken_backfill(spark, sf, "statistics", True).statistics
    return in_text(found, "date").select("listing_id", "date", "hour", "metric", "count", rounded("sum"), rounded("sum_sq"))


@query
def q06_kept_statistics(spark, sf):
    """Without reset hours that could not be read keep the row they had."""
    found = _broken_backfill(spark, sf, "statistics", False).statistics
    return in_text(found, "date").select("listing_id", "date", "hour", "metric", "count", rounded("sum"), rounded("sum_sq"))


def _counters(spark, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "counter string, value long")


@query
def a04_written_totals(spark, sf):
    """Records in and out of a merge, counted while the merged ticks are written, and the sum of what was written."""
    raw, path = harness.ticks(spark, sf), work_dir(spark, "merged")
    counts = jobs.store_merged(raw.select(*merge.KEY, F.lit("RAW").alias("entry_type")), raw, path)
    return _counters(spark, counts).union(spark.read.parquet(path).agg(F.lit("sequence_sum"), F.sum("sequence")))


@query
def a19_written_counters(spark, sf):
    """Counters of a backfill with entries that can't be read, counted while its tables are written."""
    return _counters(spark, jobs.store_backfill(_broken_backfill(spark, sf, "all", True), work_dir(spark, "backfill")))


@query
def a31_written_reviews(spark, sf):
    """Reviews of which some lack their listing and some are of unknown gaps, counted while the table is written."""
    table, path = stored(_gaps(spark, sf), "gaps"), work_dir(spark, "reviewed")
    own = table.select("listing_id", "minute", F.lit("HALT").alias("reason"))
    lacking = own.where(F.col("listing_id") == LISTING).withColumn("listing_id", F.lit(None).cast("int"))
    unknown = own.where(F.col("listing_id") == LISTING).withColumn("listing_id", F.lit(99))
    updates = own.where(F.col("listing_id") != LISTING).union(lacking).union(unknown)
    counts = jobs.store_reviews(table, updates, ("listing_id", "minute"), ("reason",), path, work_dir(spark, "rejected"))
    return _counters(spark, counts).union(spark.read.parquet(path).agg(F.lit("reviewed"), F.count_if(F.col("reason") == "HALT")))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Quality issues of all files: static rules, and metric values against baselines as of each minute."""
    return q05_quality_check(spark, sf)
