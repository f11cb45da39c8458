"""Every registered query outside the llm subpackage against its SQL, on the smallest given tables; and what plans must look like."""

import os
import shutil
import subprocess
import sys

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tapewright.operators import baseline, coverage, merge, metrics, rules
from tapewright.plans import catalog, harness, oracle
from tapewright.sources import layout
from tapewright.sources.work import stored
from tapewright.streaming import jobs as streams

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    cell = lambda v: None if pd.isna(v) else round(float(v), 6) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)
    return sorted(map(repr, (tuple(cell(v) for v in r) for r in df.itertuples(index=False))))


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.SQL)
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_against_sql(spark, sf, duck, name):
    got, want = catalog.QUERIES[name](spark, sf).toPandas(), duck.execute(oracle.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.fixture(scope="module")
def complete(tmp_path_factory):
    """Events of six listings without a missing minute, four in each, so that late ones leave no gap for a while either."""
    path = tmp_path_factory.mktemp("complete")
    sql = """SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_minutes(i // 24) AS ts, i % 6 AS user_id, 'view' AS event_type, 1.5 AS value, '{"k": 1}' AS props FROM range(240) r(i)"""
    duckdb.execute(f"COPY ({sql}) TO '{path}/events.parquet' (FORMAT parquet)")
    return str(path)


@pytest.mark.parametrize("name", ["s12_stored_gaps", "x08_gaps_on_arrival", "x08_late_minutes"])
def test_no_gap_is_no_error(spark, sf, complete, name):
    """A table that no row was ever put into is read as an empty one."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{complete}/events.parquet'")
    got = catalog.QUERIES[name](spark, complete)
    assert got.collect() == con.execute(oracle.SQL[name]).fetchall() == []
    assert got.dtypes == catalog.QUERIES[name](spark, sf).dtypes


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_anomaly_queries_find_something(spark):
    assert catalog.r06_anomalies(spark, "/root/testdata/sf0.01").count() > 0


def test_scans_read_few_columns_and_baselines_make_no_range_join(spark, sf):
    plan = catalog.a01_capture_counts(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "value" not in plan.split("ReadSchema")[1].split("\n")[0]
    plan = baseline.scored(catalog._values(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_bucketed_table_is_pruned_and_not_shuffled(spark, sf):
    """Partition filters reach the scan; merging, rules and metrics by file have no exchange, also where no side is broadcast."""
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = catalog._tick_table(spark, sf)
        plan = text(layout.captures(table, 1, 0, harness.SOURCE, F.timestamp_seconds(F.lit(catalog.CENTER))))
        pruned = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "date" in pruned and "exchange_id" in pruned
        for df in (merge.merge(table), merge.deficits(merge.capture_counts(table)), rules.static_issues(table, F.current_timestamp()), metrics.file_metrics(table)):
            assert "Exchange" not in text(df) and "Scan parquet" in text(df)
        assert "Exchange" in text(merge.merge(harness.ticks(spark, sf)))
        days = table.select("date", "exchange_id").distinct().count()
        files = layout.of_day(table, F.to_date(F.lit("2024-01-20"))).select(F.input_file_name()).distinct().count()
        assert 0 < files <= 8 * 2 < len(table.inputFiles()) and days > 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_coverage_shuffles_entries_once(spark, sf):
    """After bitmaps are made nothing is grouped by minute."""
    plan = coverage.levels(stored(catalog._entries(spark, sf), "entries"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange hashpartitioning") == 3
    assert "minute" not in " ".join(x.split(")")[0] for x in plan.split("hashpartitioning(")[1:])


def test_streams_equal_batches_and_replays_change_nothing(spark, sf, tmp_path):
    ticks = harness.ticks(spark, sf, "minute").select("listing_id", "minute", F.lit("price").alias("metric"), (F.col("price") / 1e9).alias("value"))
    sink = streams.versions_sink(str(tmp_path / "v"))
    sink(ticks, 0)
    sink(ticks, 0)
    assert spark.read.parquet(str(tmp_path / "v")).count() == ticks.count()


def test_scores_of_batches_equal_those_of_the_whole(spark, tmp_path):
    values = catalog._values(spark, "/root/testdata/sf0.01").where("listing_id = 10 and metric = 'tickCount'").cache()
    score = lambda v: baseline.scored(v, catalog.TUNED).where("anomalous").select("listing_id", "minute", "metric", "value")
    sink = streams.score_sink(str(tmp_path / "values"), str(tmp_path / "issues"), score)
    for number, cut in enumerate([("2024-01-01", "2024-01-12"), ("2024-01-12", "2024-01-24"), ("2024-01-24", "2024-02-10")]):
        sink(values.where(F.col("minute").cast("date") >= cut[0]).where(F.col("minute").cast("date") < cut[1]), number)
    got = {(r.minute, r.value) for r in streams.current_issues(spark, str(tmp_path / "issues")).collect()}
    assert got == {(r.minute, r.value) for r in score(values).collect()} and got


def test_the_package_stands_without_the_subpackage(tmp_path):
    """A copy without the two folders and the pipeline: it imports, has all other queries, and runs one."""
    root = __spark_entry__.ROOT
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(root, "tapewright"), copy / "tapewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), copy)
    script = """
import __spark_entry__ as e
from pyspark.sql import SparkSession
names = set(e.queries())
assert names == set(e.oracle_sql()) and not [n for n in names if n.startswith('op') or n == 'pipeline']
spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '1').getOrCreate()
print('rows', e.queries()['a01_capture_counts'](spark, '/root/testdata/sf0.001').count(), len(names))
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split()[-2]) > 0 and int(done.stdout.split()[-1]) == len(catalog.QUERIES)
