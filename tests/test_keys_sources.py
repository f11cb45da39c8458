import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tapewright.functions import fields, keys
from tapewright.sources import io, layout

KEYS = ["41/7/2023/11/2/9/5/mbp-10.zst", "41/7/2023/11/2/9/5/mbp-10/node-b.zst", "1/2/2024/12/31/0/0/ohlcv-1h.zst", "some/other/file.txt", "1/2/2024/13/1/0/0/mbo.zst", "1/2/2024/1/1/0/0/mbo.zst/", "", None, "99999999999/2/2024/1/1/0/0/mbo.zst"]


def test_keys_are_parsed_and_built_again(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "key string").select("key", keys.parse_key(F.col("key")).alias("k"))
    got = {r.key: r.k for r in df.collect()}
    assert got[KEYS[0]].entry_type == "AGGREGATED" and got[KEYS[0]].capture_id is None and got[KEYS[1]].capture_id == "node-b"
    assert [k for k in KEYS if got[k] is not None] == KEYS[:3]
    again = df.where("k is not null").select("key", keys.build_key(F.col("k.security_id"), F.col("k.exchange_id"), F.col("k.minute"), F.col("k.schema")).alias("plain"), keys.build_key(F.col("k.security_id"), F.col("k.exchange_id"), F.col("k.minute"), F.col("k.schema"), F.col("k.capture_id")).alias("raw"))
    assert all(r.key == (r.raw if r.raw and "node-b" in r.raw else r.plain) for r in again.collect())
    with pytest.raises(PySparkException):
        spark.createDataFrame([("some/other/file.txt",)], "key string").select(keys.parse_key(F.col("key"), strict=True)).collect()


def test_other_keys(spark):
    at = F.timestamp_seconds(F.lit(1_705_314_600))
    row = spark.range(1).select(
        keys.parse_job_id(F.lit("12-ohlcv-1h")).alias("job"), keys.job_id(F.lit(12), F.lit("mbp-10")).alias("id"), keys.coverage_pk().alias("g"), keys.coverage_pk(F.lit(1)).alias("s"), keys.coverage_pk(F.lit(1), F.lit(2)).alias("p"), keys.coverage_sk(F.to_date(at)).alias("sk"),
        keys.statistic_sk(F.lit(3), F.to_date(at), F.lit("spread")).alias("stat"), keys.parse_statistic_sk(F.lit("03#2024-01-15#spread")).alias("back"), keys.is_weekend(F.to_date(at)).alias("w"), keys.day_name(F.to_date(at)).alias("day"), keys.wrapped_hour(F.lit(0), -1).alias("h"),
        F.unix_timestamp(keys.window_start(at, F.lit("ohlcv-1h"))).alias("start"), keys.expires_at(at).alias("e"), keys.date_text(at).alias("d"), keys.minute_text(at).alias("m"),
    ).first()
    assert tuple(row.job) == (12, "ohlcv-1h") and row.id == "12-mbp-10" and (row.g, row.s, row.p, row.sk) == ("GLOBAL", "SEC#1", "SEC#1#EX#2", "DATE#2024-01-15")
    assert row.stat == "03#2024-01-15#spread" and row.back.metric == "spread" and row.back.hour == 3 and str(row.back.date) == "2024-01-15"
    assert (row.w, row.day, row.h, row.start, row.e) == (False, "MONDAY", 23, 1_705_312_800, 1_705_314_600 + 604800) and (row.d, row.m) == ("2024-01-15", "2024-01-15 10:30")


def test_fields_by_schema(spark):
    one = spark.range(1)
    for schema, trade, book in (("mbo", True, False), ("mbp-1", True, True), ("mbp-10", True, True), ("trades", False, False)):
        r = one.select(fields.trade_fields(F.lit(schema), F.lit(1), F.lit(2), F.lit("Trade")).alias("t"), fields.book_fields(F.lit(schema), F.lit(1), F.lit(2)).alias("b"), fields.flag_fields(F.lit(schema), F.lit(True), F.lit(False)).alias("f")).first()
        assert ((r.t.price is not None), (r.b.bid_px_0 is not None), (r.f.maybe_bad_book is not None)) == (trade, book, trade)
    r = one.select(fields.without_sentinel(F.lit(7), 7).alias("n"), fields.price(F.lit(5 * 10**8)).alias("p"), fields.anomaly_text(F.lit("spread"), F.lit("HIGH"), F.lit(9.0), F.lit(5.0), F.lit(1.0)).alias("x")).first()
    assert (r.n, r.p) == (None, 0.5) and r.x == "spread 9.000 is 4.0σ above conditional mean of 5.000 (σ=1.000)"


def envelope(*names):
    return json.dumps({"Type": "Notification", "Message": json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": n, "size": 1}}} for n in names]})})


def test_notifications(spark):
    bodies = [envelope(KEYS[0], KEYS[1]), envelope(KEYS[0]), "{bad", "{}", '{"Message": "{}"}', '{"Message": "{\\"Records\\":[{}]}"}', envelope("some/other/file.txt"), None]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    assert {r.key for r in io.notified_keys(df).collect()} == {KEYS[0], KEYS[1], "some/other/file.txt"}
    assert io.notified_entries(df).count() == 2
    notice = spark.createDataFrame([('{"Records":[{"s3":{"object":{"key":"inv/a.csv.gz"}}},{"s3":{"object":{"key":"no"}}}]}',), ("{}",), ("x",)], "body string")
    assert [r.key for r in io.inventory_notices(notice).collect()] == ["inv/a.csv.gz"]


def test_inventory_files(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write('"b","1/2/2024/1/1/0/0/mbo.zst","v","true","false","123"\n"b","k2","v","true","false"\nshort,line\n"b","k3","v","true","false",""\n')
    (tmp_path / "b.csv").write_text('b,k4,v,true,false,9,more\n')
    assert {(r.key, r["size"]) for r in io.read_inventory(spark, str(tmp_path)).collect()} == {("1/2/2024/1/1/0/0/mbo.zst", 123), ("k2", 0), ("k3", 0), ("k4", 9)}


def test_partition_overwrite_is_repeatable_and_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("2024-01-01", 1, 5), ("2024-01-02", 1, 6)], "date string, exchange_id int, v int")
    io.overwrite_partitions(rows, path, "date", "exchange_id")
    io.overwrite_partitions(rows.where("v = 6").withColumn("v", F.lit(7)), path, "date", "exchange_id")
    io.overwrite_partitions(rows.where("v = 6").withColumn("v", F.lit(7)), path, "date", "exchange_id")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [5, 7]
    plan = spark.read.parquet(path).where("date = '2024-01-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_tick_tables_are_read_with_their_schema(spark, tmp_path):
    spark.createDataFrame([(1, 2, "mbp-10", 3, [5], [6])], "security_id int, exchange_id int, schema string, sequence long, bid_px array<long>, ask_px array<long>").write.parquet(str(tmp_path / "old"))
    row = io.with_level_0(io.read_ticks(spark, str(tmp_path / "old"))).first()
    assert (row.sequence, row.bid_px_0, row.ask_px_0, row.price, row.bid_sz_0) == (3, 5, 6, None, None)


def test_missing_listings_are_skipped_or_fail(spark):
    entries = spark.createDataFrame([(1, 2), (9, 9)], "security_id int, exchange_id int")
    listings = spark.createDataFrame([(7, 1, 2, "mbp-10")], "listing_id int, security_id int, exchange_id int, source_schema string")
    assert [r.listing_id for r in io.with_listing(entries, listings).collect()] == [7]
    with pytest.raises(PySparkException):
        io.with_listing(entries, listings, missing="fail").collect()


def test_ragged_books_are_an_error(spark):
    rows = [([1, 2], [3, 4], None, 1), ([], [], [], 2), (None, None, None, 3)]
    schema = "bid_px array<bigint>, ask_px array<bigint>, bid_sz array<bigint>, pos int"
    good = spark.createDataFrame(rows, schema)
    assert sorted(r.pos for r in layout.even(good).collect()) == [1, 2, 3]
    with pytest.raises(PySparkException, match="differ in depth"):
        layout.even(good.union(spark.createDataFrame([([1, 2], [3], None, 4)], schema))).select("ask_px").collect()
