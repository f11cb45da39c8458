import random

import pytest
from pyspark.sql import functions as F

from tapewright.operators import convert, merge
from tapewright.plans import jobs
from tapewright.sources.counted import written

TICK = "security_id int, exchange_id int, schema string, minute timestamp, capture_id string, pos long, sequence long"



def captures_at_random(rng):
    """Some captures of one minute by id, each with its sequence numbers in file order; some are empty."""
    names = rng.sample(["east", "west", "spare", "lab", "z9"], rng.randint(1, 5))
    return {name: [rng.randrange(50) for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8]))] for name in names}


def most_complete(captures):
    """The definition by hand: the longest capture, of equally long ones that with the least id; as it stands."""
    best = None
    for name in sorted(captures):
        if best is None or len(captures[name]) > len(captures[best]):
            best = name
    return captures[best]


def ticks(spark, minutes):
    rows = [(n, 1, "mbp-10", None, name, i, seq) for n, captures in enumerate(minutes) for name, seqs in captures.items() for i, seq in enumerate(seqs)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, TICK).withColumn("minute", F.to_timestamp(F.lit("2024-01-15 10:30:00")))


OWN_CASES = [
    {"b": [9, 9, 9], "a": [4, 5, 6]},  # a tie goes to the least id
    {"a": [], "b": []},  # nothing to keep
    {"late": [7, 3, 3, 1], "full": [8, 8, 8, 8, 2], "x": [5]},  # order and repeats stay as captured
]


def test_most_complete_capture_wins_and_keeps_its_order(spark):
    rng = random.Random(29)
    minutes = OWN_CASES + [captures_at_random(rng) for _ in range(120)]
    got = {}
    for r in merge.merge(ticks(spark, minutes)).orderBy("security_id", "pos").collect():
        got.setdefault(r.security_id, []).append(r.sequence)
    assert [got.get(n, []) for n in range(len(minutes))] == [most_complete(c) for c in minutes]


def test_deficits_totals_and_unknown_strategies(spark):
    counts = merge.capture_counts(ticks(spark, [{"c1": [1, 2, 3], "c2": [1], "c3": [1, 2]}]))
    assert {(r.capture_id, r.deficit) for r in merge.deficits(counts).collect()} == {("c2", 2), ("c3", 1)}
    assert [(r.n_in, r.n_out, r.n_captures) for r in merge.merge_totals(counts).collect()] == [(6, 3, 3)]
    with pytest.raises(ValueError):
        merge.merge(counts, "other")
    with pytest.raises(ValueError):
        merge.strategy_for("mbo")


def test_minutes_whose_captures_are_empty_stay_in_the_manifest(spark):
    m = spark.createDataFrame([(1, 1, "mbp-10", "RAW", "a", 0), (1, 1, "mbp-10", "RAW", "b", 0)], "security_id int, exchange_id int, schema string, entry_type string, capture_id string, n_records long").withColumn("minute", F.lit("2024-01-15 10:30:00").cast("timestamp"))
    assert [(r.n_records, r.entry_type) for r in merge.merged_manifest(m).collect()] == [(0, "AGGREGATED")]


def prices(spark, rows):
    return spark.createDataFrame([(1, 2, t * 10**9 + n, n, p, p, p + 2, 5, a) for n, (t, p, a) in enumerate(rows)], "security_id int, exchange_id int, ts_event_ns long, pos long, price long, bid_px_0 long, ask_px_0 long, size long, action string")


def test_hourly_bar(spark):
    rows = [(0, 50000, "Trade"), (900, 49000, "Trade"), (1800, 51000, "Trade"), (2700, 52000, "Trade"), (3540, 50500, "Trade"), (3541, 99999, "Add")]
    (bar,) = convert.to_ohlcv(prices(spark, rows), 3600).collect()
    assert (bar.bar_start, bar.open, bar.high, bar.low, bar.close, bar.volume, bar.n_records) == (0, 50000, 52000, 49000, 50500, 25, 5)


def test_bars_split_on_nanoseconds_and_roll_up(spark):
    rows = [(t, 100 + (t * 7) % 13, "Trade") for t in range(0, 7300, 11)]
    df = prices(spark, rows)
    direct = {tuple(r) for r in convert.to_ohlcv(df, 3600).collect()}
    rolled = convert.roll_up(convert.roll_up(convert.to_ohlcv(df, 1), 60), 3600).select(*convert.to_ohlcv(df, 3600).columns)
    assert {tuple(r) for r in rolled.collect()} == direct
    edge = df.limit(1).withColumn("ts_event_ns", F.lit(3_600_000_000_000 - 1))
    assert convert.to_ohlcv(edge, 3600).first().bar_start == 0


def test_quotes_trades_and_unknown_conversions(spark):
    df = prices(spark, [(0, 10, "Trade"), (59, 12, "Add"), (61, 9, "Cancel")])
    assert {(r.bar_start, r.bid_px_0, r.ask_px_0) for r in convert.convert(df, "mbp-10", "bbo-1m").collect()} == {(0, 12, 14), (60, 9, 11)}
    assert convert.to_trades(df).count() == 1
    assert "bid_px_0" in convert.to_mbp1(df).columns
    with pytest.raises(ValueError):
        convert.convert(df, "trades", "mbp-10")


def test_totals_are_counted_in_the_write(spark, tmp_path):
    minutes = OWN_CASES + [captures_at_random(random.Random(n)) for n in range(40)]
    raw = ticks(spark, minutes)
    entries = raw.select(*merge.KEY, F.lit("RAW").alias("entry_type"))
    counts = jobs.store_merged(entries, raw, str(tmp_path / "merged"))
    full = [c for c in minutes if any(c.values())]
    assert counts == {"records_in": sum(len(s) for c in full for s in c.values()), "records_out": sum(len(most_complete(c)) for c in full), "minutes": len(full)}
    got = spark.read.parquet(str(tmp_path / "merged"))
    assert sorted(map(tuple, got.select(sorted(got.columns)).collect())) == sorted(map(tuple, merge.merge(raw).select(sorted(got.columns)).collect()))


def test_counters_of_an_empty_write_are_zero(spark, tmp_path):
    none = spark.range(5).where("id > 9")
    assert written(none, str(tmp_path / "none"), rows=F.count("*"), total=F.sum("id")) == {"rows": 0, "total": 0}
    some = spark.range(5).withColumn("even", F.col("id") % 2 == 0)
    assert written(some, str(tmp_path / "some"), drop=("even",), even=F.count_if("even"), total=F.sum("id")) == {"even": 3, "total": 10}
    assert spark.read.parquet(str(tmp_path / "some")).columns == ["id"]
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0
