"""Structured Streaming jobs. Each has a batch twin among the operators, and its sinks can be written again.

Streams of files come in micro-batches (`maxFilesPerTrigger`); scheduled runs use `availableNow`. Work on a late
capture reads the affected minutes from the table, not from the batch, and replaces their output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import GAP_SEARCH_MINUTES, METRICS, MetricParams
from ..operators import baseline, gaps, merge, tables
from ..sources import io
from ..sources.work import claimed, exists, read_back, stored, work_dir
from .gap_state import GapState

#: How long late captures are waited for before gaps are looked for.
LATENESS = "15 minutes"


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None) -> None:
    """Run a stream over all input that is there, in micro-batches, and wait.

    With a checkpoint the run goes on where the one before ended, and batch numbers go on counting. Without one it is the
    only run of its sink; `Scheduled` is for those that come back.
    """
    checkpoint = checkpoint or work_dir(stream.sparkSession, "stream")
    query = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


@dataclass(frozen=True)
class Scheduled:
    """A job that runs again and again over what has come since its last run.

    Its checkpoint lies in its own lasting folder. So each file is read by one run only, also where it is removed
    after that, and the numbers of batches, by which versions are named, never come twice. A run that broke off is gone on with.
    """

    folder: str

    def run(self, stream: DataFrame, sink: Callable[[DataFrame, int], None], mode: str = "append") -> None:
        run_available(stream, sink, mode, f"{self.folder}/checkpoint")


def start(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, every: str = "3 minutes", mode: str = "append") -> StreamingQuery:
    """Run a stream for good, in batches of the given time."""
    return stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def file_stream(spark: SparkSession, path: str, schema: Any, fmt: str = "parquet", files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files).load(path)


def _of_this_job(batch: DataFrame, path: str) -> None:
    """A table of versions belongs to one job, as the numbers of another's batches would replace its versions. Jobs are told
    apart by the id that their checkpoint keeps; a batch outside a stream has none."""
    own = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if own is not None and claimed(batch.sparkSession, path, own) != own:
        raise RuntimeError(f"{path} holds the versions of another job; run this one with that job's checkpoint or give it a table of its own")


def versions_sink(path: str, *by: str) -> Callable[[DataFrame, int], None]:
    """Each batch replaces its own partition, so that a repeated batch leaves one copy; the batch is the version. ``by``
    parts it further. The table belongs to the job that first writes to it."""

    def write(batch: DataFrame, number: int) -> None:
        _of_this_job(batch, path)
        batch.withColumn("version", F.lit(number)).write.partitionBy("version", *by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)

    return write


def window_counts(ticks: DataFrame, event_time: str, length: str, lateness: str = LATENESS, keys: tuple[str, ...] = ()) -> DataFrame:
    """Records by tumbling window. In append mode windows that are still open when input ends are not given; use update."""
    return ticks.withWatermark(event_time, lateness).groupBy(*keys, F.window(event_time, length).alias("window")).agg(F.count("*").alias("n"))


def running_hourly(values: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Sufficient statistics of metric values as streaming state, by listing, date, hour and metric, as in `metrics.hourly_stats`.
    State of hours that lie further back than the lateness is dropped, so it does not grow for ever."""
    hour = F.window("minute", "1 hour").alias("_hour")
    sums = values.withWatermark("minute", lateness).groupBy("listing_id", hour, "metric").agg(F.count("*").cast("double").alias("count"), F.sum("value").alias("sum"), F.sum(F.col("value") * F.col("value")).alias("sum_sq"))
    return sums.select("listing_id", F.to_date("_hour.start").alias("date"), F.hour("_hour.start").alias("hour"), "metric", "count", "sum", "sum_sq")


def distinct_notifications(messages: DataFrame, received: str, lateness: str = LATENESS) -> DataFrame:
    """Notified keys, each once within the watermark."""
    inner = F.from_json(F.get_json_object("body", "$.Message"), io._EVENT)
    rows = messages.withWatermark(received, lateness).select(received, F.explode(inner["Records"]).alias("r"))
    return rows.select(received, F.col("r.s3.object.key").alias("key")).where("key is not null").dropDuplicatesWithinWatermark(["key"])


def gaps_on_arrival(minutes: DataFrame, search_minutes: int = GAP_SEARCH_MINUTES, lateness: str | None = None) -> DataFrame:
    """Gaps as minutes (listing_id, minute) arrive: listing_id, previous, minute, missing (epoch seconds), present.

    The batch twin is gaps.neighbours. A late minute takes the gap back that it falls in (present is false) and gives those
    that are left on its sides; the latest version of (listing_id, previous, minute) counts. Minutes that come
    later than ``lateness`` (the search span, if not given) are passed over. See `gap_state` for what is kept.
    """
    spark = minutes.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    dated = minutes.select("listing_id", "minute").withWatermark("minute", lateness or f"{search_minutes} minutes")
    return dated.groupBy("listing_id").transformWithStateInPandas(GapState(search_minutes), GapState.OUTPUT, "Update", "EventTime")


def arrived_gaps(spark: SparkSession, path: str) -> DataFrame:
    """Gaps that stand by the latest version, of a table that `gaps_on_arrival` fills: listing_id, previous, minute, missing."""
    versions = read_back(spark, path, f"{GapState.OUTPUT}, version int")
    return tables.latest(versions, "listing_id", "previous", "minute").where("present").select("listing_id", "previous", "minute", "missing")


def merge_sink(raw_path: str, merged_path: str, strategy: str = "most_records") -> Callable[[DataFrame, int], None]:
    """Batches of notified raw entries: their minutes are merged again from all captures in the raw table and replaced.

    The raw table is partitioned by date and exchange, the merged one by hour too; hours that hold an affected minute are
    merged and written as a whole, others are not read further than their partition.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        hours = merge.affected_minutes(batch).select(F.to_date("minute").alias("date"), "exchange_id", F.hour("minute").alias("hour")).distinct()
        raw = spark.read.parquet(raw_path).withColumn("hour", F.hour("minute")).join(hours, ["date", "exchange_id", "hour"], "left_semi")
        io.overwrite_partitions(merge.merge(raw, strategy), merged_path, "date", "exchange_id", "hour")

    return write


def baseline_sink(sums_path: str, out_path: str, params: Sequence[MetricParams] = METRICS) -> Callable[[DataFrame, int], None]:
    """Batches of metric values in order of time: each value with its baseline as of its minute.

    What a batch needs of the past are sums by listing, metric, date and hour, which each batch adds to; no value is
    read again. Of the sums only the listings of the batch and dates that a baseline can reach are read.
    """
    add, give = versions_sink(sums_path, "date"), versions_sink(out_path)

    def write(batch: DataFrame, number: int) -> None:
        history = _earlier_sums(batch, sums_path, number, max(p.lookback for p in params))
        give(baseline.asof_baselines(batch, params, history=history), number)
        add(baseline.hourly_sums(batch), number)

    return write


_HOURLY_SUMS = "listing_id int, metric string, hour int, c bigint, s double, q double, version int, date date"


def _earlier_sums(batch: DataFrame, path: str, number: int, lookback_days: int) -> DataFrame | None:
    spark = batch.sparkSession
    if not exists(spark, path):
        return None
    first = batch.agg(F.to_date(F.min("minute"))).first()[0]
    sums = spark.read.schema(_HOURLY_SUMS).parquet(path).where((F.col("version") < number) & (F.col("date") >= F.date_sub(F.lit(first), lookback_days)))
    return sums.join(batch.select("listing_id").distinct(), "listing_id", "left_semi")


def score_sink(values_path: str, issues_path: str, score: Callable[[DataFrame], DataFrame], lookback_days: int = max(p.lookback for p in METRICS)) -> Callable[[DataFrame, int], None]:
    """Batches of metric values, new ones and ones that replace earlier ones, in any order: appended as versions, then scored
    as of each minute together with what they change: all later minutes of their listing that a baseline reaches.

    The minutes that a batch has scored are noted beside its issues. `current_issues` gives those of the latest scoring of each minute,
    which equal those of a batch run over the latest values. Of the table only listings of the batch and dates within
    the reach of a baseline, before and after, are read. A repeated batch replaces its own versions.
    """
    store, issues, marks = versions_sink(values_path, "date"), versions_sink(f"{issues_path}/issues"), versions_sink(f"{issues_path}/scored")

    def write(batch: DataFrame, number: int) -> None:
        store(batch.withColumn("date", F.to_date("minute")), number)
        spark = batch.sparkSession
        since = batch.groupBy("listing_id").agg(F.min("minute").alias("since"), F.max("minute").alias("until"))
        first, last = batch.agg(F.to_date(F.min("minute")), F.to_date(F.max("minute"))).first()
        reach = F.col("date").between(F.date_sub(F.lit(first), lookback_days), F.date_add(F.lit(last), lookback_days))
        table = spark.read.parquet(values_path).where(reach & (F.col("version") <= number)).drop("date")
        table = table.join(since.select("listing_id"), "listing_id", "left_semi")
        # the values of a minute come together: a minute that is given again has those of its last version only
        values = table.withColumn("_newest", F.max("version").over(Window.partitionBy("listing_id", "minute"))).where("version = _newest").drop("_newest", "version")
        # a baseline reaches back whole days
        changed = (F.col("minute") >= F.col("since")) & (F.datediff("minute", "until") <= lookback_days)
        fresh = values.select("listing_id", "minute").distinct().join(since, "listing_id").where(changed).select("listing_id", "minute")
        issues(score(values).join(fresh, ["listing_id", "minute"], "left_semi"), number)
        marks(fresh, number)

    return write


def current_issues(spark: SparkSession, issues_path: str) -> DataFrame:
    """Issues of the latest scoring of each minute."""
    scored = spark.read.parquet(f"{issues_path}/scored").groupBy("listing_id", "minute").agg(F.max("version").alias("version"))
    return spark.read.parquet(f"{issues_path}/issues").join(scored, ["listing_id", "minute", "version"], "left_semi").drop("version")


def capture_sink(raw_path: str, merged_path: str, values: Callable[[DataFrame], DataFrame], *sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Batches of notified raw entries to the end: their minutes are merged again, and what the merged minutes now hold goes on
    to the sinks of metrics and scores (`score_sink`), of gaps (`gap_sink`) or others, as rows that ``values`` makes of merged ticks.

    So a capture that comes late changes the merged minute, its metrics, the scores of later minutes, and gaps. Hours that
    hold an affected minute are read from the merged table after they have been replaced.
    """
    merge_ = merge_sink(raw_path, merged_path)

    def write(batch: DataFrame, number: int) -> None:
        merge_(batch, number)
        spark = batch.sparkSession
        affected = merge.affected_minutes(batch)
        hours = affected.select(F.to_date("minute").alias("date"), "exchange_id", F.hour("minute").alias("hour")).distinct()
        merged = spark.read.parquet(merged_path).join(hours, ["date", "exchange_id", "hour"], "left_semi")
        rows = stored(values(merged.join(affected, list(merge.KEY), "left_semi").drop("date", "hour")), "values")
        fan_out(*sinks)(rows, number)

    return write


def fan_out(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One stream for several sinks, as merged minutes go to quality, gaps and jobs."""

    def write(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            for sink in sinks:
                sink(held, number)
        finally:
            held.unpersist()

    return write


def gap_sink(observed_path: str, gaps_path: str, tolerances: DataFrame | None = None, delay_minutes: int = 15, search_minutes: int = GAP_SEARCH_MINUTES) -> Callable[[DataFrame, int], None]:
    """Batches of observed minutes (listing_id, minute): each minute is checked once the stream is ``delay_minutes`` past it, so
    that late captures come first; gaps that a still later minute fills are taken back.

    Both tables are versions by batch, and a repeated batch replaces its own. A batch looks again at its listings from the
    earliest minute that is new or due, and reads the search span before that. `current_gaps` reads the result, which equals
    that of `gaps.reported` over all minutes that are due.
    """
    keep, give = versions_sink(observed_path), versions_sink(gaps_path)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        keep(batch.select("listing_id", "minute").distinct(), number)
        seen = spark.read.parquet(observed_path).where(F.col("version") <= number)
        clock = lambda rows: rows.agg(F.unix_timestamp(F.max("minute"))).first()[0]
        until = lambda at: F.timestamp_seconds(F.lit(at - delay_minutes * 60))
        last, before = clock(seen), clock(seen.where(F.col("version") < number))
        if last is None:
            return
        search = F.expr(f"interval {search_minutes} minutes")
        due = seen.where(F.col("minute") <= until(last))
        fresh = due if before is None else due.where((F.col("version") == number) | (F.col("minute") > until(before)))
        since = fresh.groupBy("listing_id").agg(F.min("minute").alias("since"))
        own = due.join(since, "listing_id").where(F.col("minute") >= F.col("since") - search).select("listing_id", "minute", "since").distinct()
        prior = own.where("minute < since").groupBy("listing_id").agg(F.max("minute").alias("prior"))
        found = gaps.reported(own.select("listing_id", "minute"), tolerances, search_minutes).join(since, "listing_id").where("minute >= since")
        step = F.expr("interval 1 minute")
        rows = found.select("listing_id", F.explode(F.sequence(F.col("previous") + step, F.col("minute") - step, step)).alias("minute"), F.lit(True).alias("present"))
        old = tables.latest(_gap_versions(spark, gaps_path).where(F.col("version") < number), "listing_id", "minute").where("present")
        old = old.join(since, "listing_id").join(prior, "listing_id", "left").where(F.col("minute") > F.coalesce("prior", "since"))
        give(rows.union(old.select("listing_id", "minute", F.lit(False)).join(rows, ["listing_id", "minute"], "left_anti")), number)

    return write


def _gap_versions(spark: SparkSession, gaps_path: str) -> DataFrame:
    schema = "listing_id int, minute timestamp, present boolean, version int"
    return spark.read.schema(schema).parquet(gaps_path) if exists(spark, gaps_path) else spark.createDataFrame([], schema)


def current_gaps(spark: SparkSession, gaps_path: str) -> DataFrame:
    """Minutes that are missing by the latest version: listing_id, minute."""
    return tables.latest(_gap_versions(spark, gaps_path), "listing_id", "minute").where("present").select("listing_id", "minute")
