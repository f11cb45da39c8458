"""End-to-end jobs over tables, composed of the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import METRICS, MetricParams
from ..operators import baseline, coverage, gaps, ledger, merge, metrics, rules, tables
from ..sources import io
from ..sources.counted import written
from ..sources.work import exists, read_back, stored
from ..streaming import jobs as streams

MODES = ("statistics", "issues", "all")


def merge_captures(entries: DataFrame, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merged ticks of the notified minutes, and the report of captures that fell short."""
    wanted = merge.affected_minutes(entries)
    held = raw.join(wanted, list(merge.KEY), "left_semi")
    return merge.merge(held), merge.deficits(merge.capture_counts(held))


def create_jobs(entries: DataFrame, listings: DataFrame, jobs: DataFrame, as_of: Column) -> DataFrame:
    return ledger.created(entries, listings, jobs, as_of)


def run_jobs(jobs: DataFrame, ticks: DataFrame, schema: str, as_of: Column, limit: int | None = None, listings: DataFrame | None = None, source: str = "mbp-10") -> tuple[DataFrame, DataFrame]:
    """Output of the pending jobs of a schema, apart for each job, and the new versions of these jobs.

    A job whose input can't be read, or whose listing is not among ``listings``, is FAILED and has no output; the others are
    not held up by it. ``limit`` takes the earliest jobs only (the reference's runs stop at 10,000; the default is all).
    """
    due = ledger.pending(jobs, schema, limit)
    given = ledger.job_input(due, ticks, schema)
    failed = ledger.failures(due, given, listings)
    good = given.join(failed.select("job_id", F.col("minute").alias("job_minute")), list(ledger.OF_JOB), "left_anti")
    return ledger.converted(good, schema, source), ledger.closed(due, as_of, failed)


def detect_gaps(manifest: DataFrame, jobs: DataFrame | None, values: DataFrame, as_of: Column) -> DataFrame:
    """Gap rows of all minutes, with tolerances as of each minute."""
    return gaps.detect(gaps.observed(jobs, manifest), as_of, gaps.tolerances(values))


@dataclass
class Quality:
    issues: DataFrame
    values: DataFrame


def quality_check(ticks: DataFrame, as_of: Column, mode: str = "all", params: Sequence[MetricParams] = METRICS, seconds: int = 60, manifest: DataFrame | None = None) -> Quality:
    """Issues and metric values of files. Modes: all; statistics (values only); issues (scored against the whole day's table)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}: {mode}")
    found = rules.static_issues(ticks, as_of, seconds)
    # metrics come with the file's own columns, unless files without a record are to be scored too
    values, files = (metrics.file_metrics(ticks), None) if manifest is None else (metrics.minute_metrics(ticks, manifest), manifest)
    plain = values.drop(*metrics.FILE) if manifest is None else values
    if mode == "statistics":
        return Quality(found.limit(0), plain)
    return Quality(found.unionByName(baseline.statistical_issues(values, files, as_of, params, whole_day=mode == "issues")), plain)


def backfill(ticks: DataFrame, listing_id: int, start: Column, end: Column, as_of: Column, mode: str = "all", params: Sequence[MetricParams] = METRICS, seconds: int = 60) -> tuple[Quality, DataFrame]:
    """Quality of a listing over a date range as one job: days need no order, as baselines are as of each minute.

    Returns the issues and values of the range, and the counters entries_processed and issues_found as rows. Values before the range serve as baseline.
    """
    own = ticks.where(F.col("listing_id") == listing_id)
    inside = F.to_date("minute").between(start, end)
    found = quality_check(own, as_of, mode, params, seconds)
    kept = Quality(found.issues.where(inside), found.values.where(inside))
    counters = own.where(inside).agg(F.lit("entries_processed").alias("counter"), F.count_distinct("minute").alias("value"))
    counters = counters.union(kept.issues.agg(F.lit("issues_found"), F.count("*")))
    return kept, counters


def reset_statistics(stats: DataFrame, listing_id: int, start: Column, end: Column) -> DataFrame:
    """Statistics without those of a listing and dates, before these are computed again."""
    return tables.delete(stats, (F.col("listing_id") == listing_id) & F.col("date").between(start, end))


@dataclass
class Backfill:
    """What a backfill leaves: quality and statistics of what could be read, errors of what could not, and the counters of both."""

    quality: Quality
    statistics: DataFrame
    errors: DataFrame
    counters: DataFrame


def backfill_entries(ticks: DataFrame, statistics: DataFrame, listing_id: int, start: Column, end: Column, as_of: Column, mode: str = "all", reset: bool = False, params: Sequence[MetricParams] = METRICS, seconds: int = 60) -> Backfill:
    """`backfill` in which an entry that holds records that can't be read is set aside with its error, and the others are done.

    The table of hourly statistics is returned as it is afterwards: hours that were computed replace their rows, unless the
    mode is issues, which leaves the table alone; with ``reset`` all rows of the range go first, so hours of which no entry could
    be read are gone. Entries before the range serve as baseline and are not checked for errors.
    """
    own = ticks.where(F.col("listing_id") == listing_id)
    inside = F.to_date("minute").between(start, end)
    counts = own.where(inside).groupBy("listing_id", "minute").agg(F.count("*").alias("n"), F.count_if(ledger.unreadable(own)).alias("bad")).where("bad > 0")
    errors = stored(counts.select("listing_id", "minute", F.format_string("%d of %d records can't be read", "bad", "n").alias("error")), "errors")
    good = own.join(errors, ["listing_id", "minute"], "left_anti")
    found, counters = backfill(good, listing_id, start, end, as_of, mode, params, seconds)
    table = reset_statistics(statistics, listing_id, start, end) if reset and mode != "issues" else statistics
    if mode != "issues":
        table = tables.put(table, metrics.hourly_stats(found.values), "listing_id", "date", "hour", "metric")
    counters = counters.union(errors.agg(F.lit("entries_failed"), F.count("*")))
    return Backfill(found, table, errors, counters)


@dataclass
class Investigation:
    minutes: DataFrame
    issues: DataFrame
    baseline: DataFrame


def investigate(values: DataFrame, manifest: DataFrame, issues: DataFrame, listing_id: int, center: Column, window_minutes: int = 30, lookback_days: int = 14) -> Investigation:
    """Minutes around one minute with their metrics, the issues among them, and the baseline of its hour."""
    spark = values.sparkSession
    at = F.unix_timestamp(center)
    grid = spark.range(1).select(F.explode(F.sequence(at - window_minutes * 60, at + window_minutes * 60, F.lit(60))).alias("epoch"))
    own = lambda df: df.where(F.col("listing_id") == listing_id)
    near = F.unix_timestamp("minute").between(at - window_minutes * 60, at + window_minutes * 60)
    files = own(manifest).where(near).select(F.unix_timestamp("minute").alias("epoch"), "n_records")
    found = own(values).where(near).groupBy(F.unix_timestamp("minute").alias("epoch")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("metrics"))
    minutes = grid.join(files, "epoch", "left").join(found, "epoch", "left").select("epoch", F.col("n_records").isNotNull().alias("has_data"), F.col("n_records").alias("record_count"), F.coalesce("metrics", F.create_map().cast("map<string,double>")).alias("metrics"))
    day = F.to_date(center)
    stats = io.statistics_range(metrics.hourly_stats(own(values)), listing_id, F.date_sub(day, lookback_days), day).where(F.col("hour") == F.hour(center))
    return Investigation(minutes, own(issues).where(near), metrics.combine(stats, "metric").where("n > 0"))


def coverage_of_days(days: DataFrame, as_of: Column) -> DataFrame:
    """Coverage rows of a table of `coverage.days`. The levels are written once, as all documents are made of them."""
    return coverage.records(stored(coverage.levels(days), "levels"), as_of)


def coverage_tables(inventory: DataFrame, as_of: Column) -> DataFrame:
    """Coverage rows of a snapshot."""
    return coverage_of_days(coverage.days(coverage.entries(inventory)), as_of)


# Jobs that end in tables.


def store_coverage(inventory: DataFrame, as_of: Column, path: str) -> None:
    """The coverage table of a snapshot, in place of the one before."""
    io.snapshot(coverage_tables(inventory, as_of), path)


def store_issues(issues: DataFrame, path: str) -> DataFrame:
    """Put issues into their table; reviewed ones stay. Returns rows without a key, with the error."""
    return io.upsert(issues.withColumn("date", F.to_date("minute")), path, "listing_id", "issue_id", keep_reviewed=True)


def store_gaps(found: DataFrame, path: str) -> DataFrame:
    """Put gap rows into their table; reviewed ones stay. Returns rows without a key, with the error."""
    return io.upsert(found.withColumn("date", F.to_date("minute")), path, "listing_id", "minute", keep_reviewed=True)


def gap_table(spark: SparkSession, path: str) -> DataFrame:
    """The table of `store_gaps`, also where no gap was ever put."""
    return read_back(spark, path, f"{schemas.GAPS}, date DATE")


def store_merged(entries: DataFrame, raw: DataFrame, path: str) -> dict[str, int]:
    """Write the merged ticks of the notified minutes. Returns records_in, records_out and minutes, counted in the write."""
    held = raw.join(merge.affected_minutes(entries), list(merge.KEY), "left_semi")
    minutes = F.count_if(F.col("captured") > 0)
    return written(merge.with_captured(held), path, drop=("captured",), records_in=F.sum("captured"), records_out=F.count("*"), minutes=minutes)


def store_backfill(done: Backfill, folder: str) -> dict[str, int]:
    """Write issues, values, statistics and errors of a backfill below a folder. Returns its counters, each counted in a write:
    a file has one tickCount, so values tell the entries, and those that could not be read are not among them."""
    counts = written(done.quality.values, f"{folder}/values", entries_processed=F.count_if(F.col("metric") == "tickCount"))
    counts |= written(done.quality.issues, f"{folder}/issues", issues_found=F.count("*"))
    counts |= written(done.errors, f"{folder}/errors", entries_failed=F.count("*"))
    io.snapshot(done.statistics, f"{folder}/statistics")
    return counts


def store_reviews(table: DataFrame, updates: DataFrame, key: tuple[str, ...], fields: tuple[str, ...], path: str, errors_path: str) -> dict[str, int]:
    """Write the table after reviews, and the updates that lack a part of the key with their error. Returns how many rows were
    updated or added, and how many updates were errors, counted in the two writes."""
    marked = tables.review(table, updates, key, fields, mark="_reached")
    counts = written(marked, path, drop=("_reached",), updated=F.count_if("_reached"))
    return counts | written(tables.invalid_updates(updates, key), errors_path, errors=F.count("*"))


#: What a job reads when it runs, not when it is set up: files that come meanwhile are seen.
Reader = Callable[[SparkSession], DataFrame]


def ledger_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ledger: those of jobs, with writer and version. A ledger is a folder of versions for each writer."""
    schema = schemas.struct(f"{schemas.JOBS}, writer STRING, version INT")
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def ledger_sink(path: str, listings: Reader, as_of: Column, writer: str = "created") -> Callable[[DataFrame, int], None]:
    """For a stream of merged entries: appends the jobs they call for and the ledger lacks. A repeated batch replaces its own."""
    keep = streams.versions_sink(f"{path}/writer={writer}")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = ledger_rows(spark, path).where(~((F.col("writer") == writer) & (F.col("version") >= number)))
        keep(ledger.created(batch, listings(spark), known.select(*ledger.JOB).distinct(), as_of, strict=False), number)

    return write


def process_pending(spark: SparkSession, path: str, out_path: str, ticks: Reader, listings: Reader, schema: str, as_of: Column, limit: int | None = None) -> int:
    """Run the jobs of a schema that are pending in the ledger now, whoever created them and when; returns the run's number.

    The number follows from the runs that the ledger holds, and jobs are closed after their output is written: a run that
    broke off is repeated under the same number, and replaces what it had written. One run of a schema at a time.
    """
    rows = ledger_rows(spark, path)
    run = 1 + (rows.where(F.col("writer") == schema).agg(F.max("version")).first()[0] or 0)
    due = stored(ledger.pending(ledger.current(rows), schema, limit), "due")
    out, closed = run_jobs(due, ticks(spark), schema, as_of, listings=listings(spark))
    versions(out, out_path, run)
    versions(closed, f"{path}/writer={schema}", run)
    return run


def versions(rows: DataFrame, path: str, number: int) -> None:
    """Replace one version of a table whose numbers are not those of a stream's batches."""
    rows.write.mode("overwrite").parquet(f"{path}/version={number}")


def conversion_sink(path: str, out_path: str, ticks: Reader, listings: Reader, schema: str, as_of: Column) -> Callable[[DataFrame, int], None]:
    """For a stream of merged entries: their jobs are created in the ledger, and all that are pending for the schema are run,
    also those that other streams or earlier runs have created. Several schemas may share a ledger, each with a sink."""
    create = ledger_sink(path, listings, as_of, f"created-for-{schema}")

    def write(batch: DataFrame, number: int) -> None:
        create(batch, number)
        process_pending(batch.sparkSession, path, out_path, ticks, listings, schema, as_of)

    return write
