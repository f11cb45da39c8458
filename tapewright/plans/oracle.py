"""The registered queries as SQL over the same tables (DuckDB), written from the definitions, not from the plans:
range joins instead of windows, and one query a level instead of grouping sets."""

from __future__ import annotations

from .catalog import AS_OF, CENTER, DAY, LISTING, METRICS, TUNED
from .harness import SOURCE, ticks_sql

SQL: dict[str, str] = {}


def _with(body: str, *more: str, cycle: str = "hour") -> str:
    return "WITH " + ",\n".join([ticks_sql(cycle), *more]) + "\n" + body


FILE = "security_id, exchange_id, schema, minute"
COUNTS = f"counts AS (SELECT {FILE}, capture_id, count(*) AS n_records FROM ticks GROUP BY ALL)"
BEST = f"best AS (SELECT *, row_number() OVER (PARTITION BY {FILE} ORDER BY n_records DESC, capture_id) AS rk, max(n_records) OVER (PARTITION BY {FILE}) AS most FROM counts)"


def at(seconds: str) -> str:
    return f"make_timestamp(CAST(({seconds}) AS BIGINT) * 1000000)"


def day(seconds: str) -> str:
    return f"CAST({at(seconds)} AS DATE)"


def object_key(capture: str = "") -> str:
    t = at("minute")
    parts = ["security_id", "exchange_id", *(f"{p}({t})" for p in ("year", "month", "day", "hour", "minute")), "schema"] + ([capture] if capture else [])
    return "concat_ws('/', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ") || '.zst'"


SQL["a01_capture_counts"] = _with("SELECT * FROM counts", COUNTS)
SQL["a02_capture_deficits"] = _with(f"SELECT {FILE}, capture_id, n_records, most - n_records AS deficit FROM best WHERE most > n_records", COUNTS, BEST)
SQL["s08_notified_keys"] = _with(f"SELECT {object_key('capture_id')} AS key FROM counts", COUNTS, cycle="minute")
SQL["a03_affected_minutes"] = _with(f"SELECT DISTINCT {FILE} FROM ticks", cycle="minute")
SQL["a04_merge_totals"] = _with(f"SELECT {FILE}, CAST(sum(n_records) AS BIGINT) AS n_in, max(n_records) AS n_out, count(*) AS n_captures FROM counts GROUP BY ALL", COUNTS)
SQL["w03_winning_capture"] = _with(f"SELECT {FILE}, capture_id, n_records FROM best WHERE rk = 1", COUNTS, BEST)
SQL["q01_merged_ticks"] = _with(f"SELECT t.listing_id, t.minute, t.pos, t.sequence, t.price, t.size FROM ticks t JOIN best b USING ({FILE}, capture_id) WHERE b.rk = 1", COUNTS, BEST)

LAGGED = "lagged AS (SELECT *, lag(sequence) OVER (PARTITION BY listing_id, minute ORDER BY pos) AS before FROM ticks)"


def measures(seconds: int) -> str:
    return f"""m AS (SELECT listing_id, {FILE}, count(*) AS total,
      count(*) FILTER (ts_event_ns < minute * 1000000000 OR ts_event_ns >= (minute + {seconds}) * 1000000000) AS misaligned,
      count(*) FILTER (sequence < before) AS decreases, count(*) FILTER (maybe_bad_book) AS bad_book, count(*) FILTER (bad_ts_recv) AS bad_recv
    FROM lagged GROUP BY ALL)"""


SQL["w01_sequence_transitions"] = _with("SELECT listing_id, minute, total, decreases FROM m", LAGGED, measures(60))
SQL["r01_timestamp_alignment"] = _with("SELECT listing_id, minute, total, misaligned FROM m WHERE misaligned > 0", LAGGED, measures(60), cycle="minute")
SQL["r02_sequence_monotonicity"] = _with("SELECT listing_id, minute, total, decreases FROM m WHERE total >= 2 AND decreases / (total - 1)::DOUBLE > 0.20::DOUBLE", LAGGED, measures(60))
SQL["r03_bad_data_flags"] = _with("SELECT listing_id, minute, total, bad_book, bad_recv FROM m WHERE bad_book > 0 OR bad_recv > 0", LAGGED, measures(60))


def static_issues(seconds: int) -> list[str]:
    hit = lambda rule, when: f"SELECT *, '{rule}' AS rule_type FROM m WHERE {when}"
    rows = " UNION ALL ".join((hit("TIMESTAMP_ALIGNMENT", "misaligned > 0"), hit("SEQUENCE_MONOTONICITY", "total >= 2 AND decreases / (total - 1)::DOUBLE > 0.20::DOUBLE"), hit("BAD_DATA_FLAGS", "bad_book > 0 OR bad_recv > 0")))
    return [LAGGED, measures(seconds), f"hits AS ({rows})", f"issues AS (SELECT listing_id, CAST(minute AS VARCHAR) || '#' || rule_type AS issue_id, rule_type, minute, {object_key()} AS s3_key, total AS record_count FROM hits)"]


SQL["r09_static_issues"] = _with("SELECT listing_id, issue_id, rule_type, 'UNREVIEWED' AS status, minute, s3_key, record_count FROM issues", *static_issues(3600))

WIDE = """w AS (SELECT listing_id, minute, count(*)::DOUBLE AS tickCount,
    sum(CASE WHEN ask_px_0 >= bid_px_0 THEN (ask_px_0 - bid_px_0)::HUGEINT END)::DOUBLE / nullif(count(CASE WHEN ask_px_0 >= bid_px_0 THEN 1 END), 0) / 1e9 AS spread,
    sum(bid_px_0::HUGEINT + ask_px_0::HUGEINT)::DOUBLE / nullif(2 * count(bid_px_0 + ask_px_0), 0) / 1e9 AS midPrice,
    coalesce(sum(size) FILTER (action = 'Trade'), 0)::DOUBLE AS tradeVolume, count(*) FILTER (action = 'Trade')::DOUBLE AS tradeFrequency,
    CASE WHEN count(price) >= 2 THEN stddev_pop(price::DOUBLE / 1e9) END AS volatility
  FROM ticks GROUP BY ALL)"""
VALUES = "v0 AS (" + " UNION ALL ".join(f"SELECT listing_id, minute, '{p.name}' AS metric, {p.name} AS value FROM w WHERE {p.name} IS NOT NULL" for p in METRICS) + ")"
DATED = f"v AS (SELECT *, {day('minute')} AS date, CAST(floor(minute / 86400) AS BIGINT) AS d, CAST(hour({at('minute')}) AS INTEGER) AS hour, isodow({at('minute')}) >= 6 AS wk FROM v0)"
V = (WIDE, VALUES, DATED)
STATS = "stats AS (SELECT listing_id, date, hour, metric, count(*)::DOUBLE AS count, sum(value) AS sum, sum(value * value) AS sum_sq FROM v GROUP BY ALL)"
MEAN = "coalesce(sum(sum) / nullif(sum(count), 0), 0)"
NOISE = "1e-12::DOUBLE"
SD = f"CASE WHEN sum(count) >= 2 AND sum(sum_sq) / sum(count) - ({MEAN}) * ({MEAN}) > {NOISE} * ({MEAN}) * ({MEAN}) THEN sqrt(sum(sum_sq) / sum(count) - ({MEAN}) * ({MEAN})) ELSE 0 END"
COMBINED = f"round({MEAN}, 8) AS mean, round({SD}, 6) AS stddev, CAST(sum(count) AS BIGINT) AS n"
STAT_ROWS = "listing_id, CAST(date AS VARCHAR) AS date, hour, metric, count, round(sum, 8) AS sum, round(sum_sq, 8) AS sum_sq FROM stats"
WITHIN = f"date <= DATE '{DAY}' AND date >= DATE '{DAY}' - INTERVAL "

SQL["a08_minute_metrics"] = _with("SELECT listing_id, minute, metric, round(value, 8) AS value FROM v", *V)
SQL["a14_hourly_statistics"] = _with(f"SELECT {STAT_ROWS}", *V, STATS, cycle="minute")
SQL["a15_combined_statistics"] = _with(f"SELECT listing_id, metric, {COMBINED} FROM stats GROUP BY ALL", *V, STATS)
SQL["a29_listing_statistics"] = _with(f"SELECT listing_id, metric, {COMBINED}, count(*) AS rows_included, count(DISTINCT date) AS days_included FROM stats WHERE {WITHIN} 14 DAY GROUP BY listing_id, metric", *V, STATS)
SQL["a30_listing_history"] = _with(f"SELECT listing_id, CAST(date AS VARCHAR) AS date, metric, {COMBINED} FROM stats WHERE {WITHIN} 30 DAY AND hour = 12 GROUP BY ALL", *V, STATS)
SQL["q19_one_listing_statistics"] = _with(f"SELECT metric, {COMBINED}, count(*) AS rows_included, count(DISTINCT date) AS days_included FROM stats WHERE {WITHIN} 14 DAY AND hour = 12 AND listing_id = {LISTING} GROUP BY metric", *V, STATS)
SQL["u03_merged_statistics"] = _with(f"SELECT {STAT_ROWS}", *V, STATS)
SQL["u07_reset_statistics"] = _with(f"SELECT {STAT_ROWS} WHERE NOT (listing_id = {LISTING} AND date = DATE '{DAY}')", *V, STATS)


def baselines(params, whole_day: bool = False) -> str:
    """Every value with every sample of its baseline: the definition as a range join."""
    look = "CASE v.metric " + " ".join(f"WHEN '{p.name}' THEN {p.lookback}" for p in params) + " END"
    near = "CASE v.metric " + " ".join(f"WHEN '{p.name}' THEN {p.hour_window}" for p in params) + " END"
    before = "b.d <= v.d" if whole_day else "b.minute < v.minute"
    return f"""bl AS (SELECT v.listing_id, v.metric, v.minute, v.value, v.d, count(b.value)::DOUBLE AS c, coalesce(sum(b.value), 0) AS s, coalesce(sum(b.value * b.value), 0) AS q,
      count(DISTINCT b.d) AS days, max(b.d) AS latest
    FROM v LEFT JOIN v b ON b.listing_id = v.listing_id AND b.metric = v.metric AND b.wk = v.wk AND {before} AND b.d >= v.d - {look} AND (b.hour - v.hour + 24 + {near}) % 24 <= 2 * {near}
    GROUP BY ALL)"""


def scores(params) -> str:
    pick = lambda f: "CASE metric " + " ".join(f"WHEN '{p.name}' THEN {f(p)}" for p in params) + " END"
    return f"""sc0 AS (SELECT *, CASE WHEN c > 0 THEN s / c ELSE 0 END AS mean, {pick(lambda p: f"'{p.direction}'")} AS direction, {pick(lambda p: f"{p.z}::DOUBLE")} AS z, {pick(lambda p: f"{p.fallback}::DOUBLE")} AS f,
      {pick(lambda p: str(p.detect).lower())} AS detect, {pick(lambda p: f"'{p.rule}'")} AS rule FROM bl),
    sc1 AS (SELECT *, CASE WHEN c >= 2 AND q / c - mean * mean > {NOISE} * mean * mean THEN sqrt(q / c - mean * mean) ELSE 0 END AS sd, days >= 3 AND coalesce(latest >= d - 9, false) AS ready FROM sc0),
    sc AS (SELECT *, detect AND ready AND CASE WHEN mean <= 0 THEN false
        WHEN sd > 0 THEN CASE direction WHEN 'LOW' THEN mean - value WHEN 'HIGH' THEN value - mean ELSE abs(value - mean) END / sd > z
        ELSE CASE direction WHEN 'LOW' THEN value < mean * f WHEN 'HIGH' THEN value >= mean * f ELSE false END END AS anomalous FROM sc1)"""


BASE_ROWS = "SELECT listing_id, metric, minute, c, round(s, 8) AS s, round(sqrt(coalesce(q / nullif(c, 0), 0)), 6) AS rms, days, coalesce(latest, -1) AS latest FROM bl"
SQL["w04_asof_baseline"] = _with(BASE_ROWS, *V, baselines(METRICS))
SQL["j04_table_baseline"] = _with(BASE_ROWS, *V, baselines(METRICS, True))
SQL["a16_warm_up"] = _with("SELECT listing_id, metric, count(*) FILTER (ready) AS ready, count(*) FILTER (NOT ready) AS not_ready, max(days) AS most_days FROM sc GROUP BY ALL", *V, baselines(METRICS), scores(METRICS))
SQL["r06_anomalies"] = _with("SELECT listing_id, metric, minute, round(value, 8) AS value, round(mean, 8) AS mean, round(sd, 6) AS stddev, CAST(c AS BIGINT) AS n FROM sc WHERE anomalous", *V, baselines(TUNED), scores(TUNED))
SQL["r04_default_anomalies"] = _with("SELECT listing_id, metric, minute, round(value, 8) AS value FROM sc WHERE anomalous", *V, baselines(METRICS), scores(METRICS))
ALL_ISSUES = "all_issues AS (SELECT listing_id, issue_id, rule_type, minute, record_count FROM issues UNION ALL SELECT sc.listing_id, CAST(sc.minute AS VARCHAR) || '#' || rule, rule, sc.minute, w.tickCount::BIGINT FROM sc JOIN w USING (listing_id, minute) WHERE anomalous)"
CHECK = (*V, baselines(TUNED), scores(TUNED), *static_issues(3600), ALL_ISSUES)
RANGE = f"listing_id = {LISTING} AND {day('minute')} BETWEEN DATE '2024-01-15' AND DATE '{DAY}'"
SQL["q05_quality_check"] = _with("SELECT * FROM all_issues", *CHECK)
SQL["q07_backfill"] = _with(f"SELECT issue_id, rule_type, minute, record_count FROM all_issues WHERE {RANGE}", *CHECK)
SQL["a19_backfill_counters"] = _with(f"SELECT 'entries_processed' AS counter, count(DISTINCT minute) AS value FROM ticks WHERE {RANGE} UNION ALL SELECT 'issues_found', count(*) FROM all_issues WHERE {RANGE}", *CHECK)

OBSERVED = "ob AS (SELECT DISTINCT listing_id, minute FROM ticks)"
LAST = "lg AS (SELECT *, lag(minute) OVER (PARTITION BY listing_id ORDER BY minute) AS prev FROM ob)"
TOLERANCE = f"""tv AS (SELECT listing_id, minute, count(*)::DOUBLE AS value, CAST(floor(minute / 86400) AS BIGINT) AS d, hour({at('minute')}) AS hour FROM ticks GROUP BY ALL),
tb AS (SELECT v.listing_id, v.minute, count(b.value)::DOUBLE AS c, coalesce(sum(b.value), 0) AS s, coalesce(sum(b.value * b.value), 0) AS q
  FROM tv v LEFT JOIN tv b ON b.listing_id = v.listing_id AND b.hour = v.hour AND b.minute < v.minute AND b.d >= v.d - 14 GROUP BY ALL),
tm AS (SELECT *, CASE WHEN c > 0 THEN s / c ELSE 0 END AS mean, CASE WHEN c >= 2 AND q / c - (s / c) * (s / c) > {NOISE} * (s / c) * (s / c) THEN sqrt(q / c - (s / c) * (s / c)) ELSE 0 END AS sd FROM tb),
tol AS (SELECT listing_id, minute, CAST(CASE WHEN c < 3 THEN 1 WHEN mean <= 0 THEN 1440
    ELSE greatest(1, least(1440, ceil(least(1440.0::DOUBLE, 1.0::DOUBLE / mean * CASE WHEN sd > 0 THEN greatest(3.0::DOUBLE, 3.0::DOUBLE + 2.0::DOUBLE * (sd / mean)) ELSE 3.0::DOUBLE END)))) END AS INTEGER) AS tolerance FROM tm)"""


def near(minutes: int) -> str:
    return f"nb AS (SELECT listing_id, minute, CASE WHEN minute - prev <= {minutes * 60} THEN prev END AS previous, CASE WHEN minute - prev <= {minutes * 60} THEN CAST((minute - prev) / 60 AS BIGINT) - 1 END AS missing FROM lg)"


GAP_ROWS = "gap_rows AS (SELECT listing_id, unnest(range(previous + 60, minute, 60)) AS minute FROM rep)"
SQL["j02_observed_minutes"] = _with("SELECT DISTINCT listing_id, minute FROM ticks WHERE action = 'Trade' OR action <> 'Fill'", cycle="minute")
SQL["w02_previous_minute"] = _with("SELECT * FROM nb", OBSERVED, LAST, near(120), cycle="minute")
SQL["a17_gap_tolerance"] = _with("SELECT * FROM tol", TOLERANCE, cycle="minute")
REPORTED = (OBSERVED, LAST, near(2880), TOLERANCE, "rep AS (SELECT nb.*, tolerance FROM nb JOIN tol USING (listing_id, minute) WHERE missing > 0 AND missing >= tolerance)", GAP_ROWS)
SQL["q04_gap_rows"] = _with("SELECT listing_id, minute, 'UNREVIEWED' AS status, 'UNKNOWN' AS reason, false AS expected FROM gap_rows", *REPORTED, cycle="minute")
SQL["r10_reported_gaps"] = _with("SELECT listing_id, previous, minute, missing, CAST(tolerance AS BIGINT) AS tolerance FROM rep", *REPORTED, cycle="minute")
SQL["t05_missing_minutes"] = _with("SELECT g.listing_id, count(*) AS missing FROM (SELECT listing_id, unnest(range(min(minute), max(minute), 60)) AS minute FROM ob GROUP BY listing_id) g ANTI JOIN ob USING (listing_id, minute) GROUP BY ALL", OBSERVED, cycle="minute")

FILES = f"""inv AS (
  SELECT security_id, exchange_id, '{SOURCE}' AS schema, minute, count(*) * 100 AS size FROM ticks GROUP BY ALL
  UNION ALL SELECT security_id, exchange_id, 'trades', minute, count(*) * 40 FROM ticks WHERE action = 'Trade' GROUP BY ALL
  UNION ALL SELECT security_id, exchange_id, 'ohlcv-1m', minute, 0 FROM ticks GROUP BY ALL),
en AS (SELECT *, {day('minute')} AS date FROM inv)"""
DATES = "CAST(min(date) AS VARCHAR) AS earliest_date, CAST(max(date) AS VARCHAR) AS latest_date"
SCHEMAS = "array_to_string(list_sort(list(DISTINCT schema)), ',') AS schema_types"


def cover(body: str) -> str:
    return _with(body, FILES, cycle="minute")


SQL["s07_inventory"] = cover(f"SELECT {object_key()} AS key, CAST(sum(size) AS BIGINT) AS size FROM inv GROUP BY 1")
SQL["a20_coverage_global"] = cover(f"SELECT count(*) AS total_files, count(DISTINCT minute) AS total_minutes, CAST(sum(size) AS BIGINT) AS total_size_bytes, count(DISTINCT (security_id, exchange_id)) AS security_exchange_count, {DATES} FROM en")
SQL["a21_coverage_by_schema"] = cover("SELECT schema, count(*) AS file_count, count(DISTINCT minute) AS minute_count, CAST(sum(size) AS BIGINT) AS size_bytes FROM en GROUP BY schema")
SQL["a22_coverage_by_pair"] = cover(f"SELECT security_id, exchange_id, count(*) AS file_count, count(DISTINCT minute) AS minute_count, CAST(sum(size) AS BIGINT) AS size_bytes, {DATES}, {SCHEMAS} FROM en GROUP BY security_id, exchange_id")
SUMMARY = f"count(DISTINCT date) AS total_days, count(DISTINCT minute) AS total_minutes, CAST(sum(size) AS BIGINT) AS total_size_bytes, {DATES}, {SCHEMAS}"
SQL["a23_coverage_by_security"] = cover(f"SELECT security_id, count(DISTINCT exchange_id) AS total_exchanges, {SUMMARY} FROM en GROUP BY security_id")
SQL["a24_coverage_exchanges_of_security"] = cover(f"SELECT security_id, exchange_id, {SUMMARY} FROM en GROUP BY security_id, exchange_id")
PER_DATE = "CAST(date AS VARCHAR) AS date, count(DISTINCT minute) AS minutes, CAST(sum(size) AS BIGINT) AS size_bytes FROM en GROUP BY"
SQL["a25_coverage_security_dates"] = cover(f"SELECT security_id, schema, {PER_DATE} security_id, schema, date")
SQL["a26_coverage_security_date_exchanges"] = cover(f"SELECT security_id, exchange_id, schema, {PER_DATE} security_id, exchange_id, schema, date")
SQL["a28_coverage_pair_dates"] = cover(f"SELECT security_id, exchange_id, {PER_DATE} security_id, exchange_id, date")
_DIMS = {"security_id": "INTEGER", "exchange_id": "INTEGER", "schema": "VARCHAR", "date": "VARCHAR"}
_LEVELS = {"global": (), "schema": ("schema",), "pair": ("security_id", "exchange_id"), "security": ("security_id",), "security_date": ("security_id", "date"), "security_date_schema": ("security_id", "date", "schema"), "pair_date": ("security_id", "exchange_id", "date"), "pair_date_schema": ("security_id", "exchange_id", "date", "schema")}
SQL["t03_coverage_levels"] = cover(" UNION ALL ".join(
    f"SELECT {', '.join(f'CAST({c if c in k else "NULL"} AS {t}) AS {c}' for c, t in _DIMS.items())}, '{n}' AS level, count(*) AS files, count(DISTINCT minute) AS minutes, CAST(sum(size) AS BIGINT) AS size_bytes, count(DISTINCT en.date) AS days, CAST(min(en.date) AS VARCHAR) AS earliest, CAST(max(en.date) AS VARCHAR) AS latest FROM en" + (f" GROUP BY {', '.join('en.' + c for c in k)}" if k else "")
    for n, k in _LEVELS.items()
))
_PAIR = "'SEC#' || CAST(security_id AS VARCHAR) || '#EX#' || CAST(exchange_id AS VARCHAR)"
_SEC = "'SEC#' || CAST(security_id AS VARCHAR)"
SQL["q09_coverage_records"] = cover(" UNION ALL ".join(
    f"""SELECT {pk} AS pk, {sk} AS sk, count(DISTINCT minute) AS total_minutes, {'NULL' if not g or 'date' in g else 'count(DISTINCT en.date)'} AS total_days, {'NULL' if 'date' in g else 'CAST(sum(size) AS BIGINT)'} AS total_size_bytes,
      {'NULL' if 'date' in g else 'CAST(min(en.date) AS VARCHAR)'} AS earliest_date, {'NULL' if 'date' in g else 'CAST(max(en.date) AS VARCHAR)'} AS latest_date, {"'true'" if 'date' in g else 'NULL'} AS has_coverage,
      {"nullif(count(DISTINCT minute) FILTER (schema = 'trades'), 0)" if 'date' in g else 'NULL'} AS trade_minutes, {"CAST(sum(size) FILTER (schema = 'trades') AS BIGINT)" if 'date' in g else 'NULL'} AS trade_bytes,
      {"nullif(count(DISTINCT minute) FILTER (exchange_id = 0), 0)" if g.startswith('security_id') and 'exchange' not in g else 'NULL'} AS minutes_at_0, {'count(DISTINCT exchange_id)' if g == 'security_id' else 'NULL'} AS total_exchanges,
      '1.0' AS version, CAST({AS_OF} AS BIGINT) AS last_updated FROM en""" + (f" GROUP BY {g}" if g else "")
    for pk, sk, g in (("'GLOBAL'", "'SUMMARY'", ""), (_SEC, "'SUMMARY'", "security_id"), (_PAIR, "'SUMMARY'", "security_id, exchange_id"), (_SEC, "'DATE#' || CAST(date AS VARCHAR)", "security_id, date"), (_PAIR, "'DATE#' || CAST(date AS VARCHAR)", "security_id, exchange_id, date"))
))
SQL["s10_stored_coverage"] = SQL["x11_streamed_coverage"] = SQL["q09_coverage_records"]
_ANSWER = "SELECT count(*) AS total_files, count(DISTINCT minute) AS total_minutes, CAST(coalesce(sum(size), 0) AS BIGINT) AS total_size_bytes, count(DISTINCT (security_id, exchange_id)) AS pairs, CASE WHEN count(*) > 0 THEN CAST(%d AS BIGINT) END AS last_inventory_date, CASE WHEN count(*) = 0 THEN 'No coverage data available' END AS error FROM en" % AS_OF
SQL["q10_summary_answer"] = cover(_ANSWER)
SQL["q10_empty_summary"] = cover(_ANSWER + " WHERE false")
SQL["q10_coverage_summary"] = cover(f"SELECT count(*) AS total_files, count(DISTINCT (security_id, exchange_id)) AS pairs, count(*) FILTER (schema = 'trades') AS trade_files, CAST({AS_OF} AS BIGINT) AS last_updated FROM en")
SQL["q11_coverage_of_security"] = cover("SELECT 'SEC#1' AS pk, (SELECT count(DISTINCT exchange_id) FROM en WHERE security_id = 1) AS total_exchanges, CAST(date AS VARCHAR) AS date, count(DISTINCT minute) AS total_minutes, nullif(count(DISTINCT CASE WHEN schema = 'trades' THEN minute END), 0) AS trade_minutes FROM en WHERE security_id = 1 GROUP BY date")
SQL["q12_coverage_of_pair"] = cover("SELECT 'SEC#1#EX#0' AS pk, (SELECT count(DISTINCT date) FROM en WHERE security_id = 1 AND exchange_id = 0) AS total_days, CAST(date AS VARCHAR) AS date, count(DISTINCT minute) AS total_minutes FROM en WHERE security_id = 1 AND exchange_id = 0 GROUP BY date")


def bars(seconds: int, price: str = "price", where: str = "action = 'Trade'", source: str = "ticks", by: str = "") -> str:
    return f"""bars AS (SELECT {by}security_id, exchange_id, CAST(ts_event_ns // {seconds * 10**9} AS BIGINT) * {seconds} AS bar_start,
      arg_min({price}, (ts_event_ns, pos)) AS open, max({price}) AS high, min({price}) AS low, arg_max({price}, (ts_event_ns, pos)) AS close, CAST(sum(size) AS BIGINT) AS volume, count(*) AS n_records
    FROM {source} WHERE {where} AND {price} IS NOT NULL GROUP BY ALL)"""


SQL["c01_mbp1"] = _with("SELECT listing_id, 'mbp-1' AS schema, minute, sequence, bid_px_0, ask_px_0 FROM ticks")
for _name, _seconds in (("c02_ohlcv_1h", 3600), ("c03_ohlcv_1m", 60), ("c04_ohlcv_1s", 1), ("c07_rolled_up_hours", 3600)):
    SQL[_name] = _with("SELECT * FROM bars", bars(_seconds))
SQL["c05_trades"] = _with("SELECT listing_id, pos, ts_event_ns, price, size FROM ticks WHERE action = 'Trade'")
SQL["c06_bbo_1m"] = _with("SELECT security_id, exchange_id, CAST(ts_event_ns // 60000000000 AS BIGINT) * 60 AS bar_start, arg_max(bid_px_0, (ts_event_ns, pos)) AS bid_px_0, arg_max(ask_px_0, (ts_event_ns, pos)) AS ask_px_0 FROM ticks WHERE bid_px_0 IS NOT NULL OR ask_px_0 IS NOT NULL GROUP BY 1, 2, 3")
SQL["c08_bars_of_bids"] = _with("SELECT * FROM bars", bars(3600, "bid_px_0", "true"))
SQL["c09_complete_hours"] = _with("SELECT bars.*, l.minute AS job_minute FROM bars JOIN (SELECT DISTINCT security_id, exchange_id, minute FROM ticks WHERE (minute // 60) % 60 = 59) l ON l.security_id = bars.security_id AND l.exchange_id = bars.exchange_id AND l.minute - 3540 = bar_start", bars(3600), cycle="minute")

SQL["p01_keys"] = _with(f"""SELECT {object_key('capture_id')} AS key, security_id, exchange_id, minute, schema, 'RAW' AS entry_type, capture_id,
  CAST(security_id * 10 + exchange_id AS VARCHAR) || '-' || schema AS job_id, schema AS job_schema, {_PAIR} AS pk, 'DATE#' || CAST({day('minute')} AS VARCHAR) AS sk,
  printf('%02d', hour({at('minute')})) || '#' || CAST({day('minute')} AS VARCHAR) || '#tickCount' AS stat, 'tickCount' AS stat_metric, CAST(minute AS VARCHAR) || '#BAD_DATA_FLAGS' AS issue_id,
  isodow({at('minute')}) >= 6 AS weekend, strftime({at('minute')}, '%Y-%m-%d %H:%M') AS text, CAST((hour({at('minute')}) + 23) % 24 AS INTEGER) AS hour_before
FROM counts""", COUNTS, cycle="minute")

TARGETS = ["mbp-10", "mbp-1", "trades", "bbo-1s", "bbo-1m", "ohlcv-1s", "ohlcv-1m", "ohlcv-1h"]
JOBS = f"""tg AS (SELECT unnest({TARGETS}) AS target),
jb AS (SELECT o.listing_id, o.minute, target AS schema, CAST(o.listing_id AS VARCHAR) || '-' || target AS job_id, CASE WHEN (o.minute // 60) % 2 = 0 THEN 'COMPLETE' ELSE 'PENDING' END AS status
  FROM (SELECT DISTINCT listing_id, minute FROM ticks) o, tg WHERE target <> 'ohlcv-1h' OR (o.minute // 60) % 60 = 59)"""


def ledger(body: str, *more: str) -> str:
    return _with(body, JOBS, *more, cycle="minute")


SQL["j06_convertible_targets"] = ledger("SELECT listing_id, minute, schema FROM jb")
SQL["q02_created_jobs"] = ledger(f"SELECT job_id, minute, listing_id, schema, 'PENDING' AS status, CAST({AS_OF} AS BIGINT) AS created_at FROM jb WHERE schema NOT IN ('trades', 'bbo-1s')")
def of_jobs(schema: str, bucket: str, which: str) -> str:
    return f"kept AS (SELECT t.*, j.job_id, j.jm AS job_minute FROM ticks t JOIN (SELECT job_id, listing_id AS l, minute AS jm, {bucket} AS h FROM jb WHERE schema = '{schema}' AND {which}) j ON t.listing_id = j.l AND t.{bucket} = j.h)"


HOURLY = of_jobs("ohlcv-1h", "minute // 3600", "status = 'PENDING'")
SQL["q03_run_jobs"] = SQL["q03_run_jobs_in_parts"] = ledger("SELECT bars.* FROM bars", HOURLY, bars(3600, source="kept", by="job_id, job_minute, "))
SQL["x05_converted_entries"] = ledger("SELECT bars.* FROM bars", of_jobs("ohlcv-1m", "minute // 60", "true"), bars(60, source="kept", by="job_id, job_minute, "))
FAILED = "fl AS (SELECT job_id, job_minute, count(*) AS n, count(*) FILTER (pos % 997 = 0 OR action IS NULL OR (action = 'Trade' AND (price IS NULL OR size IS NULL))) AS bad, any_value(listing_id) AS listing FROM kept GROUP BY ALL)"
SQL["q03_isolated_output"] = ledger("SELECT bars.* FROM bars", HOURLY, FAILED, "good AS (SELECT kept.* FROM kept SEMI JOIN (SELECT * FROM fl WHERE bad = 0 AND listing <> 1) f USING (job_id, job_minute))", bars(3600, source="good", by="job_id, job_minute, "))
SQL["u04_failed_jobs"] = ledger("SELECT jb.job_id, jb.minute, CASE WHEN listing_id = 1 OR bad > 0 THEN 'FAILED' ELSE 'COMPLETE' END AS status, CASE WHEN listing_id = 1 THEN 'no such listing: 1' WHEN bad > 0 THEN CAST(bad AS VARCHAR) || ' of ' || CAST(n AS VARCHAR) || ' records can''t be read' END AS error_message FROM jb LEFT JOIN fl ON fl.job_id = jb.job_id AND fl.job_minute = jb.minute WHERE schema = 'ohlcv-1h' AND status = 'PENDING'", HOURLY, FAILED)
SQL["l06_limited_run"] = ledger("SELECT job_id, minute, 'COMPLETE' AS status FROM jb WHERE schema = 'trades' AND status = 'PENDING' ORDER BY minute, job_id LIMIT 40")
SQL["l05_next_page_of_jobs"] = ledger(f"SELECT job_id, minute, status FROM jb WHERE schema = 'trades' AND status = 'PENDING' AND (minute < {CENTER} OR (minute = {CENTER} AND job_id < '10-trades')) ORDER BY minute DESC, job_id DESC LIMIT 100")
SQL["u04_closed_jobs"] = ledger(f"SELECT job_id, minute, 'COMPLETE' AS status, CAST({AS_OF} AS BIGINT) AS processed_at, CAST({AS_OF + 604800} AS BIGINT) AS expires_at FROM jb WHERE schema = 'trades' AND status = 'PENDING'")
SQL["q21_list_jobs"] = ledger("SELECT job_id, minute, status FROM jb WHERE schema = 'trades' AND status = 'PENDING' ORDER BY minute DESC, job_id DESC LIMIT 100")
SQL["q22_search_jobs"] = ledger(f"SELECT job_id, minute, status FROM jb WHERE listing_id = {LISTING} AND schema = 'ohlcv-1m' ORDER BY minute DESC, job_id DESC LIMIT 50")
SQL["w06_latest_versions"] = ledger("SELECT job_id, minute, 'COMPLETE' AS status, CAST(CASE WHEN status = 'PENDING' THEN 2 ELSE 1 END AS INTEGER) AS version FROM jb WHERE schema = 'trades'")
SQL["u08_live_jobs"] = ledger(f"SELECT job_id, minute, minute + 604800 AS expires_at FROM jb WHERE schema = 'trades' AND minute + 604800 > {CENTER}")

GAPS = (OBSERVED, LAST, near(120), "rep AS (SELECT * FROM nb WHERE missing > 0)", GAP_ROWS, "gp AS (SELECT listing_id, minute, CASE WHEN (minute // 60) % 3 = 0 THEN 'REVIEWED' ELSE 'UNREVIEWED' END AS status, 'UNKNOWN' AS reason, false AS expected, 'Gap detected by gap detector lambda' AS note FROM gap_rows)")


def of_gaps(body: str, *more: str) -> str:
    return _with(body, *GAPS, *more, cycle="minute")


SQL["q13_list_gaps"] = of_gaps("SELECT listing_id, minute, status FROM gp WHERE status = 'UNREVIEWED' ORDER BY minute DESC, listing_id DESC LIMIT 100")
SQL["l05_next_page_of_gaps"] = of_gaps(f"SELECT listing_id, minute, status FROM gp WHERE status = 'UNREVIEWED' AND (minute < {CENTER} OR (minute = {CENTER} AND listing_id < {LISTING})) ORDER BY minute DESC, listing_id DESC LIMIT 100")
SQL["q14_gaps_of_listing"] = of_gaps(f"SELECT listing_id, minute, status FROM gp WHERE listing_id = {LISTING} ORDER BY minute DESC LIMIT 1000")
SQL["q15_review_gaps"] = of_gaps(
    f"""SELECT listing_id, minute, CASE WHEN hit THEN 'REVIEWED' ELSE status END AS status, CASE WHEN hit THEN 'EXCHANGE_CLOSED' ELSE reason END AS reason, CASE WHEN hit THEN true ELSE expected END AS expected,
      CASE WHEN hit AND (minute // 3600) % 2 = 0 THEN 'checked' ELSE note END AS note FROM (SELECT *, (minute // 60) % 60 = 0 AS hit FROM gp)
    UNION ALL SELECT 99, minute, 'REVIEWED', 'EXCHANGE_CLOSED', true, CASE WHEN (minute // 3600) % 2 = 0 THEN 'checked' END FROM gp WHERE listing_id = {LISTING} AND (minute // 60) % 60 = 0"""
)
SQL["a31_review_counts"] = of_gaps(f"SELECT count(*) FILTER (listing_id <> {LISTING}) AS updated, count(*) FILTER (listing_id = {LISTING}) AS errors FROM gp")
SQL["u02_put_keeps_reviews"] = of_gaps("SELECT listing_id, minute, status, CASE WHEN status = 'REVIEWED' THEN note ELSE 'found again' END AS note FROM gp")

REVIEWED = (*static_issues(3600), "iss AS (SELECT *, CASE WHEN (minute // 3600) % 4 = 0 THEN 'REVIEWED' ELSE 'UNREVIEWED' END AS status FROM issues)")
SQL["q16_list_issues"] = _with("SELECT listing_id, issue_id, minute, status FROM iss WHERE rule_type = 'BAD_DATA_FLAGS' AND status = 'UNREVIEWED' ORDER BY minute DESC, listing_id DESC LIMIT 100", *REVIEWED)
SQL["q17_issues_of_listing"] = _with(f"SELECT listing_id, issue_id, rule_type FROM iss WHERE listing_id = {LISTING} ORDER BY issue_id DESC LIMIT 1000", *REVIEWED)
SQL["q18_review_issues"] = _with("SELECT listing_id, issue_id, CASE WHEN rule_type = 'SEQUENCE_MONOTONICITY' THEN 'REVIEWED' ELSE status END AS status, CASE WHEN rule_type = 'SEQUENCE_MONOTONICITY' THEN 'known' END AS note FROM iss", *REVIEWED)

NEAR = f"listing_id = {LISTING} AND minute BETWEEN {CENTER - 3600} AND {CENTER + 3600}"
SQL["q08_investigated_minutes"] = _with(f"SELECT g.epoch, w.minute IS NOT NULL AS has_data, coalesce(CAST(w.tickCount AS BIGINT), -1) AS record_count, round(w.midPrice, 8) AS mid_price, w.tickCount AS tick_count FROM (SELECT unnest(range({CENTER - 3600}, {CENTER + 3601}, 60)) AS epoch) g LEFT JOIN w ON w.minute = g.epoch AND w.listing_id = {LISTING}", WIDE, cycle="minute")
SQL["f13_issues_near_a_minute"] = _with(f"SELECT issue_id, rule_type, record_count FROM issues WHERE {NEAR}", *static_issues(60), cycle="minute")
SQL["a18_baseline_of_the_hour"] = _with(f"SELECT metric, {COMBINED} FROM stats WHERE listing_id = {LISTING} AND hour = hour({at(str(CENTER))}) AND date BETWEEN {day(str(CENTER))} - INTERVAL 14 DAY AND {day(str(CENTER))} GROUP BY metric HAVING sum(count) > 0", *V, STATS, cycle="minute")
SQL["s03_entries_of_day"] = _with(f"SELECT listing_id, minute, count(*) AS n_records FROM ticks WHERE {day('minute')} = DATE '{DAY}' GROUP BY ALL", cycle="minute")
SQL["j01_entries_with_listing"] = _with("SELECT DISTINCT listing_id, security_id, exchange_id, minute FROM ticks WHERE exchange_id = 0", cycle="minute")

SQL["x06_window_counts"] = _with("SELECT listing_id, CAST(ts_event_ns // 3600000000000 AS BIGINT) * 3600 AS start, count(*) AS n FROM ticks GROUP BY 1, 2")
SQL["x07_running_statistics"] = _with(f"SELECT listing_id, CAST({day('minute')} AS VARCHAR) AS date, CAST(hour({at('minute')}) AS INTEGER) AS hour, count(*)::DOUBLE AS count, round(sum(price / 1e9), 8) AS sum, round(sum((price / 1e9) * (price / 1e9)), 8) AS sum_sq FROM ticks GROUP BY 1, 2, 3", cycle="minute")
SQL["x08_gaps_on_arrival"] = _with("SELECT listing_id, previous, minute, missing FROM nb WHERE missing > 0", OBSERVED, LAST, near(2880), cycle="minute")

ON_TIME = "ob AS (SELECT DISTINCT listing_id, minute FROM ticks WHERE minute <= (SELECT max(minute) FROM ticks) - 900)"
SQL["x03_gaps_after_late_data"] = _with("SELECT listing_id, minute FROM gap_rows", ON_TIME, LAST, near(120), "rep AS (SELECT * FROM nb WHERE missing > 0)", GAP_ROWS, cycle="minute")
SQL["x09_streamed_notifications"] = SQL["s08_notified_keys"]

SQL["s11_stored_issues"] = _with("SELECT listing_id, issue_id, status, CASE WHEN status = 'REVIEWED' THEN 'seen' END AS note FROM iss", *REVIEWED)
SQL["s12_stored_gaps"] = of_gaps("SELECT listing_id, minute, 'UNREVIEWED' AS status FROM gap_rows")
SQL["s12_rejected_gaps"] = of_gaps(f"SELECT minute, 'listing_id and minute are required' AS error FROM gap_rows WHERE listing_id = {LISTING}")
CROSSED = "cr AS (SELECT listing_id, minute, count(*) FILTER (ask_px_0 < bid_px_0) AS crossed FROM ticks GROUP BY ALL)"
FLAG_TEXT = "printf('%d record(s) with maybeBadBook flag and %d record(s) with badTimestampRecv flag out of %d total', bad_book, bad_recv, total)"
SQL["e01_own_rule"] = _with(
    f"""SELECT listing_id, CAST(minute AS VARCHAR) || '#CROSSED_BOOK' AS issue_id, 'CROSSED_BOOK' AS rule_type, printf('%d of %d records are crossed', crossed, total) AS details, total AS record_count FROM m JOIN cr USING (listing_id, minute) WHERE crossed > 0
    UNION ALL SELECT listing_id, CAST(minute AS VARCHAR) || '#BAD_DATA_FLAGS', 'BAD_DATA_FLAGS', {FLAG_TEXT}, total FROM m WHERE bad_book > 0 OR bad_recv > 0""",
    LAGGED, measures(3600), CROSSED,
)
SQL["e02_own_metric"] = _with("SELECT listing_id, minute, 'tickCount' AS metric, count(*)::DOUBLE AS value FROM ticks GROUP BY ALL UNION ALL SELECT listing_id, minute, 'largestTrade', max(size)::DOUBLE FROM ticks WHERE action = 'Trade' AND size IS NOT NULL GROUP BY ALL")
_ISO = "strftime(" + at("minute + {0}") + ", '%Y-%m-%dT%H:%M')"
SQL["r09_issue_details"] = _with(
    f"""SELECT listing_id, CAST(minute AS VARCHAR) || '#' || rule_type AS issue_id, CASE rule_type WHEN 'TIMESTAMP_ALIGNMENT' THEN printf('%d of %d records have timestamps outside the expected minute window [%s, %s)', misaligned, total, {_ISO.format(0)}, {_ISO.format(3600)})
      WHEN 'SEQUENCE_MONOTONICITY' THEN printf('%d decrease(s) out of %d transitions in %d records', decreases, total - 1, total) ELSE {FLAG_TEXT} END AS details, CAST(NULL AS VARCHAR) AS note, CAST({AS_OF} AS BIGINT) AS created_at FROM hits""",
    *static_issues(3600),
)
_SCHEMA = "['mbo', 'mbp-10', 'trades'][pos % 3 + 1]"
SQL["p13_fields_of_schemas"] = _with(f"SELECT pos, {_SCHEMA} AS schema, CASE WHEN pos % 3 < 2 THEN price END AS price, CASE WHEN pos % 3 < 2 THEN action END AS action, CASE WHEN pos % 3 = 1 THEN bid_px_0 END AS bid, CASE WHEN pos % 3 < 2 THEN bad_ts_recv END AS bad, nullif(size, 7) AS size, round(price / 1e9, 6) AS units, size::DOUBLE AS lots FROM ticks")
SQL["s01_captures_of_minute"] = _with(f"SELECT capture_id, pos, sequence FROM ticks WHERE security_id = 1 AND exchange_id = 0 AND minute = {CENTER}")
SQL["s13_listing_by_id"] = _with(f"SELECT pos, security_id, exchange_id, '{SOURCE}' AS source_schema FROM ticks WHERE exchange_id = 0", cycle="minute")
SQL["l01_sorted_entries"] = _with("SELECT listing_id, minute, count(*) AS n_records FROM ticks GROUP BY ALL ORDER BY minute, listing_id", cycle="minute")
SQL["l05_next_page_of_issues"] = _with(f"SELECT issue_id, minute, rule_type FROM iss WHERE listing_id = {LISTING} AND (minute < {CENTER} OR (minute = {CENTER} AND issue_id < '{CENTER}#BAD_DATA_FLAGS')) ORDER BY minute DESC, issue_id DESC LIMIT 100", *REVIEWED)
SQL["c06_bbo_1s"] = SQL["c06_bbo_1m"].replace("60000000000 AS BIGINT) * 60", "1000000000 AS BIGINT)")
SQL["c10_bars_of_mbp1"] = SQL["c03_ohlcv_1m"]
SQL["r08_statistics_mode"] = SQL["a08_minute_metrics"]
SQL["r08_issues_mode"] = _with("SELECT * FROM all_issues", *V, baselines(TUNED, True), scores(TUNED), *static_issues(3600), ALL_ISSUES)
SQL["q06_backfill_of_a_day"] = _with(f"SELECT issue_id, rule_type, minute, record_count FROM all_issues WHERE listing_id = {LISTING} AND {day('minute')} = DATE '{DAY}'", *CHECK)

SQL["t03_merged_inventories"] = SQL["t03_coverage_levels"]
SQL["x11_split_snapshot"] = SQL["q09_coverage_records"]
SQL["x11_incomplete_snapshot"] = SQL["q09_coverage_records"].replace("FROM inv)", f"FROM inv WHERE minute < epoch(TIMESTAMP '{DAY}'))")
SQL["x05_restarted_runs"] = SQL["x05_converted_entries"]
SQL["x05_shared_ledger"] = ledger(f"SELECT job_id, minute, schema, CASE WHEN schema IN ('ohlcv-1m', 'trades', 'ohlcv-1h') THEN 'COMPLETE' ELSE 'PENDING' END AS status, CAST(CASE WHEN schema IN ('ohlcv-1m', 'trades', 'ohlcv-1h') THEN {AS_OF + 604800} ELSE 0 END AS BIGINT) AS expires_at FROM jb")
SQL["x08_late_minutes"] = of_gaps("SELECT listing_id, minute FROM gap_rows")
SQL["q04_detected_gaps"] = SQL["q04_gap_rows"].replace("false AS expected", f"false AS expected, CAST({AS_OF} AS BIGINT) AS created_at")
SQL["p19_anomaly_text"] = _with("""SELECT listing_id, CAST(minute AS VARCHAR) || '#' || rule AS issue_id, metric, CASE WHEN value >= mean THEN 'above' ELSE 'below' END AS side,
  round(value, 8) AS value, round(mean, 8) AS mean, round(sd, 6) AS stddev, true AS agrees FROM sc WHERE anomalous""", *V, baselines(TUNED), scores(TUNED))
SQL["s09_inventory_notices"] = SQL["s08_notified_keys"]
SQL["x06_minute_windows"] = SQL["x06_window_counts"].replace("3600000000000 AS BIGINT) * 3600", "60000000000 AS BIGINT) * 60")
SQL["w04_kept_baseline"] = SQL["w04_asof_baseline"]


def of(table: str, *parts: str) -> tuple[str, ...]:
    """The same parts over another table of ticks."""
    return tuple(p.replace("FROM ticks", f"FROM {table}") for p in parts)


MERGED = f"merged AS (SELECT t.* FROM ticks t JOIN best b USING ({FILE}, capture_id) WHERE b.rk = 1)"
SQL["x04_late_captures"] = _with("""SELECT 'issue' AS kind, listing_id, minute, metric, round(value, 8) AS value, round(mean, 8) AS mean, round(sd, 6) AS stddev FROM sc WHERE anomalous
  UNION ALL SELECT 'gap', listing_id, minute, '', NULL, NULL, NULL FROM gap_rows""", COUNTS, BEST, MERGED, *of("merged", *V), baselines(TUNED), scores(TUNED), ON_TIME, LAST, near(300), "rep AS (SELECT * FROM nb WHERE missing > 0)", GAP_ROWS)
SQL["w06_compacted_versions"] = ledger(f"SELECT job_id, minute, 'COMPLETE' AS status, minute + 604800 AS expires_at, true AS bounded FROM jb WHERE schema = 'trades' AND minute + 604800 > {CENTER}")
BROKEN = f"bk AS (SELECT listing_id, minute, count(*) AS n, count(*) FILTER (pos % 97 = 0) AS bad FROM ticks WHERE {RANGE} GROUP BY ALL HAVING bad > 0)"
GOOD = "good AS (SELECT t.* FROM ticks t ANTI JOIN bk ON bk.listing_id = t.listing_id AND bk.minute = t.minute)"
GOOD_CHECK = (BROKEN, GOOD, *of("good", *CHECK))
SQL["q06_backfill_with_errors"] = _with(f"SELECT issue_id, rule_type, minute, record_count FROM all_issues WHERE {RANGE}", *GOOD_CHECK)
SQL["q06_backfill_errors"] = _with("SELECT listing_id, minute, CAST(bad AS VARCHAR) || ' of ' || CAST(n AS VARCHAR) || ' records can''t be read' AS error FROM bk", BROKEN)
SQL["a19_counters_with_errors"] = _with(f"SELECT 'entries_processed' AS counter, count(DISTINCT minute) AS value FROM good WHERE {RANGE} UNION ALL SELECT 'issues_found', count(*) FROM all_issues WHERE {RANGE} UNION ALL SELECT 'entries_failed', count(*) FROM bk", *GOOD_CHECK)
SQL["q06_reset_statistics"] = _with(f"SELECT {STAT_ROWS}", BROKEN, GOOD, *of("good", *V), STATS)
SQL["q06_kept_statistics"] = SQL["u03_merged_statistics"]
SQL["s01_pruned_captures"] = SQL["s01_captures_of_minute"]
SQL["s03_pruned_day"] = SQL["s03_entries_of_day"]
SQL["q01_bucketed_merge"] = SQL["q01_merged_ticks"]
SQL["r09_bucketed_issues"] = SQL["r09_static_issues"]
SQL["l02_clustered_gaps"] = SQL["q13_list_gaps"]
SQL["l05_clustered_page"] = SQL["l05_next_page_of_gaps"]
SQL["a04_written_totals"] = _with(f"""SELECT 'records_in' AS counter, CAST(sum(n_records) AS BIGINT) AS value FROM counts UNION ALL SELECT 'records_out', CAST(sum(n_records) AS BIGINT) FROM best WHERE rk = 1
  UNION ALL SELECT 'minutes', count(*) FROM best WHERE rk = 1 UNION ALL SELECT 'sequence_sum', CAST(sum(sequence) AS BIGINT) FROM merged""", COUNTS, BEST, MERGED)
SQL["a19_written_counters"] = SQL["a19_counters_with_errors"]
SQL["a31_written_reviews"] = of_gaps(f"SELECT 'updated' AS counter, count(*) AS value FROM gp UNION ALL SELECT 'errors', count(*) FROM gp WHERE listing_id = {LISTING} UNION ALL SELECT 'reviewed', count(*) FROM gp")
