import json
import time

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tapewright.operators import coverage, gaps, ledger, merge, tables
from tapewright.plans import harness, jobs, snapshots
from tapewright.sources import io
from tapewright.streaming import gap_state
from tapewright.streaming import jobs as streams


def raw(spark, sf):
    ticks = harness.ticks(spark, sf).withColumn("date", F.to_date("minute"))
    return ticks.drop("listing_id")


def test_late_captures_replace_their_minutes(spark, sf, tmp_path):
    path, merged = str(tmp_path / "raw"), str(tmp_path / "merged")
    all_ = raw(spark, sf)
    io.append(all_.where("capture_id <> 'c2'"), path, "date", "exchange_id")
    sink = streams.merge_sink(path, merged)
    entries = lambda df: df.select(*merge.KEY, F.lit("RAW").alias("entry_type")).distinct()
    sink(entries(all_), 0)
    first = spark.read.parquet(merged).count()
    io.append(all_.where("capture_id = 'c2'"), path, "date", "exchange_id")
    late = entries(all_.where("capture_id = 'c2'"))
    sink(late, 1)
    sink(late, 1)
    got = sorted((r.minute, r.pos) for r in spark.read.parquet(merged).select("minute", "pos").collect())
    assert got == sorted((r.minute, r.pos) for r in merge.merge(all_).select("minute", "pos").collect()) and len(got) > first


def message(*keys):
    return json.dumps({"Message": json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": k, "size": 1}}} for k in keys]})})


def test_repeated_notifications_and_fan_out(spark, tmp_path):
    rows = [("2024-01-01 10:00:00", message("a", "b")), ("2024-01-01 10:01:00", message("b")), ("2024-01-01 10:02:00", "{bad"), ("2024-01-01 10:03:00", message("c", "a"))]
    df = spark.createDataFrame(rows, "at string, body string").select(F.to_timestamp("at").alias("received"), "body")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = streams.distinct_notifications(streams.file_stream(spark, str(tmp_path / "in"), df.schema), "received")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    streams.run_available(stream, streams.fan_out(streams.versions_sink(one), streams.versions_sink(two)))
    for path in (one, two):
        assert sorted(r.key for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]


def test_gap_state_takes_late_minutes_in(spark, tmp_path):
    """Late minutes split the gap they fall in; what the search span makes a gap is decided anew at their sides."""
    base = 1_705_314_600
    path = str(tmp_path / "in")
    batches = ([0, 3], [1, 10, 3100], [10, 2000, 5001], [2990, 5002])
    for batch in batches:
        frame = spark.createDataFrame([(1, base + 60 * m) for m in batch], "listing_id int, s long").select("listing_id", F.timestamp_seconds("s").alias("minute"))
        ordered_write(frame, path)
    out = str(tmp_path / "out")
    stream = streams.file_stream(spark, path, "listing_id int, minute timestamp", files=1)
    streams.run_available(streams.gaps_on_arrival(stream, 2880, "4000 minutes"), streams.versions_sink(out), "update")
    found = tables.latest(spark.read.parquet(out), "listing_id", "previous", "minute").where("present").collect()
    got = {((r.previous - base) // 60, (r.minute - base) // 60, r.missing) for r in found}
    minutes = sorted({m for b in batches for m in b})
    assert got == {(a, b, b - a - 1) for a, b in zip(minutes, minutes[1:]) if 1 < b - a <= 2880}
    in_order = spark.createDataFrame([(1, base + 60 * m) for m in minutes], "listing_id int, s long").select("listing_id", F.timestamp_seconds("s").alias("minute"))
    assert {r.missing for r in gaps.neighbours(in_order).where("missing > 0").collect()} == {x[2] for x in got}


def ordered_write(frame, path):
    """One more file of a stream; files are taken by time."""
    frame.coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)


class Handle:
    """The part of a state handle that the gap check uses, in memory."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class Clock:
    def __init__(self, minute):
        self.minute = minute

    def getCurrentWatermarkInMs(self):
        return self.minute * 60_000


def test_gap_state_is_bounded_and_ends():
    handle, state = Handle(), gap_state.GapState(100)
    state.init(handle)
    stamp = lambda ms: pd.DataFrame({"minute": pd.to_datetime([m * 60 for m in ms], unit="s")})
    rows = []
    for at in range(0, 5000, 50):
        for out in state.handleInputRows((7,), iter([stamp(range(at, at + 50, 2)), stamp([at])]), Clock(at - 60)):
            rows += list(out.itertuples(index=False))
        assert len(handle.value[0]) <= 4 * (100 + 60 + 50) and len(handle.timers) == 1
    assert {(r.minute - r.previous, r.present) for r in rows} == {(120, True)}
    timer = handle.timers.pop()
    for _ in range(100):  # the watermark passes: first what is old goes, then all
        list(state.handleExpiredTimer((7,), Clock(timer // 60_000), None))
        if handle.value is None:
            break
        timer = handle.timers.pop()
    assert handle.value is None and not handle.timers


def test_a_table_of_versions_belongs_to_one_job(spark, tmp_path):
    """A run without the job's checkpoint would begin at version 0 again and replace what earlier runs wrote: it is an error."""
    path, table = str(tmp_path / "in"), str(tmp_path / "out")
    job = streams.Scheduled(str(tmp_path / "job"))
    rows = lambda a: spark.createDataFrame([(i,) for i in range(a, a + 3)], "x long")
    for a in (0, 3, 6):
        rows(a).coalesce(1).write.mode("overwrite").parquet(path)  # what came before is gone
        job.run(streams.file_stream(spark, path, "x long"), streams.versions_sink(table))
    assert sorted(r.x for r in spark.read.parquet(table).collect()) == list(range(9))
    with pytest.raises(StreamingQueryException, match="another job"):
        streams.run_available(streams.file_stream(spark, path, "x long"), streams.versions_sink(table))
    assert sorted(r.x for r in spark.read.parquet(table).collect()) == list(range(9))


def test_pending_jobs_of_a_broken_run_are_done_once(spark, tmp_path, sf, monkeypatch):
    """A run that fails after its output is written leaves its jobs pending; the next one replaces that output."""
    ledger_, out = str(tmp_path / "ledger"), str(tmp_path / "out")
    ticks = lambda s: harness.ticks(s, sf, "minute")
    listings = lambda s: harness.listings(ticks(s))
    at = F.timestamp_seconds(F.lit(1_706_800_000))
    entries = ticks(spark).select("security_id", "exchange_id", "schema", "minute").distinct()
    jobs.ledger_sink(ledger_, listings, at)(entries, 0)
    jobs.ledger_sink(ledger_, listings, at)(entries, 0)
    jobs.ledger_sink(ledger_, listings, at)(entries, 1)
    total = jobs.ledger_rows(spark, ledger_).count()
    assert total == ledger.current(jobs.ledger_rows(spark, ledger_)).count() == 8 * entries.count() - entries.where("minute(minute) <> 59").count()
    write = jobs.versions

    def broken(rows, path, number):
        if "writer=" in path:
            raise RuntimeError("lost")
        write(rows, path, number)

    monkeypatch.setattr(jobs, "versions", broken)
    with pytest.raises(RuntimeError):
        jobs.process_pending(spark, ledger_, out, ticks, listings, "trades", at)
    monkeypatch.setattr(jobs, "versions", write)
    assert jobs.process_pending(spark, ledger_, out, ticks, listings, "trades", at) == 1
    assert spark.read.parquet(out).count() == ticks(spark).where("action = 'Trade'").count()
    assert ledger.current(jobs.ledger_rows(spark, ledger_)).where("schema = 'trades' and status <> 'COMPLETE'").count() == 0


def test_snapshots_are_published_whole(spark, tmp_path):
    landing, path = tmp_path / "landing", str(tmp_path / "coverage")
    line = lambda day, minute: f'"b","1/1/2024/1/{day}/10/{minute}/mbp-10.zst","v","t","f","7"\n'
    listed = []

    def put(snapshot, name, *lines):
        (landing / snapshot).mkdir(parents=True, exist_ok=True)
        (landing / snapshot / name).write_text("".join(lines))

    manifests = lambda s: s.createDataFrame(listed, "snapshot string, file string")
    job = streams.Scheduled(str(tmp_path / "job"))
    at = F.timestamp_seconds(F.lit(1_705_314_600))
    run = lambda: job.run(snapshots.snapshot_lines(spark, str(landing), 1), snapshots.snapshot_sink(path, manifests, at))
    total = lambda: coverage.summary_answer(snapshots.current(spark, path)).first()
    assert snapshots.publish(spark, path, manifests, at) is None and snapshots.current(spark, path).count() == 0
    put("s1", "a", line(1, 1), line(1, 2), "short\n")
    listed += [("s1", "a"), ("s1", "b")]
    run()
    assert snapshots.published(spark, path) is None
    put("s1", "b", line(1, 2), line(2, 1))
    run()
    assert snapshots.published(spark, path) == "s1" and (total().total_files, total().total_minutes) == (4, 3)
    put("s2", "a", line(1, 1))
    put("s2", "c", line(3, 1))
    run()  # no manifest yet
    assert total().total_files == 4
    listed += [("s2", "a"), ("s2", "c")]
    assert snapshots.publish(spark, path, manifests, at) == "s2" and snapshots.publish(spark, path, manifests, at) is None
    assert (total().total_files, total().total_minutes, total().total_size_bytes) == (2, 2, 14)


def test_gaps_wait_and_are_taken_back(spark, tmp_path):
    """Batches with late minutes against the definition over all minutes that are due; a repeated batch changes nothing."""
    base = 1_705_314_600
    seen, found = str(tmp_path / "seen"), str(tmp_path / "found")
    sink = streams.gap_sink(seen, found, delay_minutes=5, search_minutes=100)
    batches = [[0, 1, 4], [12, 8], [2, 30], [31, 20, 5], [25, 500], [501, 520]]
    so_far = set()
    for number, minutes in enumerate(batches):
        batch = spark.createDataFrame([(7, base + 60 * m) for m in minutes], "listing_id int, s long").select("listing_id", F.timestamp_seconds("s").alias("minute"))
        sink(batch, number)
        if number == 3:
            sink(batch, number)
        so_far |= set(minutes)
        due = sorted(m for m in so_far if m <= max(so_far) - 5)
        want = {g for a, b in zip(due, due[1:]) if b - a <= 100 for g in range(a + 1, b)}
        got = [(r.minute.timestamp() - base) // 60 for r in streams.current_gaps(spark, found).select(F.col("minute").cast("timestamp")).collect()]
        assert sorted(got) == sorted(want), number
