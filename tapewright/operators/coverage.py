"""Storage inventory rolled up into coverage tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys

#: Levels by name and the columns that are their keys.
LEVELS: dict[str, tuple[str, ...]] = {
    "global": (),
    "schema": ("schema",),
    "pair": ("security_id", "exchange_id"),
    "security": ("security_id",),
    "security_date": ("security_id", "date"),
    "security_date_schema": ("security_id", "date", "schema"),
    "pair_date": ("security_id", "exchange_id", "date"),
    "pair_date_schema": ("security_id", "exchange_id", "date", "schema"),
}
_DIMS = ("security_id", "exchange_id", "schema", "date")


def entries(inventory: DataFrame, strict: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Aggregated entries of inventory rows (key, size): security_id, exchange_id, schema, minute, date, size, and carried columns."""
    parsed = inventory.select(keys.parse_key(F.col("key"), strict).alias("k"), "size", *carry)
    return parsed.where("k.entry_type = 'AGGREGATED'").select("k.security_id", "k.exchange_id", "k.schema", "k.minute", F.to_date("k.minute").alias("date"), "size", *carry)


def bad_keys(inventory: DataFrame) -> DataFrame:
    """Inventory rows that are left out as their key is of no known form."""
    return inventory.where(keys.parse_key(F.col("key")).isNull())


#: A day's minutes as 24 words of 60 bits, one for each hour. 192 bytes whatever the day holds, merged by `bit or`.
WORDS = tuple(f"h{h}" for h in range(24))
_SUMS = ("files", "size_bytes")


def days(entries_: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Entries as bitmaps: security_id, exchange_id, schema, date (and carried keys), files, size_bytes, and the words of its minutes.

    The only shuffle of entries. Everything else about coverage comes from this table, which has one row for a day of a
    pair and schema, in place of up to 1,440 entries and their copies.
    """
    bit = F.expr("shiftleft(1L, minute(minute))")
    words = (F.coalesce(F.bit_or(F.when(F.hour("minute") == h, bit)), F.lit(0).cast("long")).alias(w) for h, w in enumerate(WORDS))
    return entries_.groupBy(*carry, *_DIMS).agg(F.count("*").alias("files"), F.sum("size").alias("size_bytes"), *words)


def _merged() -> list[Column]:
    return [*(F.sum(c).alias(c) for c in _SUMS), *(F.bit_or(w).alias(w) for w in WORDS)]


def minutes() -> Column:
    """The number of minutes of a bitmap."""
    return sum((F.bit_count(w) for w in WORDS[1:]), F.bit_count(WORDS[0])).cast("long")


def merged(*tables: DataFrame) -> DataFrame:
    """One table of `days` from those of inventories that list different files. A minute that several of them hold counts once."""
    return reduce(DataFrame.unionByName, tables).groupBy(*_DIMS).agg(*_merged())


def _as_days(table: DataFrame) -> DataFrame:
    """`days` of entries; a table of days as it is."""
    return table if WORDS[0] in table.columns else days(table)


#: What is grouped: keys within a date, the level with dates and the level that adds its dates up.
_GROUPED: tuple[tuple[tuple[str, ...], str | None, str | None], ...] = (
    (("security_id", "exchange_id", "schema"), "pair_date_schema", None),
    (("security_id", "exchange_id"), "pair_date", "pair"),
    (("security_id", "schema"), "security_date_schema", None),
    (("security_id",), "security_date", "security"),
    (("schema",), None, "schema"),
    ((), None, "global"),
)


def levels(table: DataFrame) -> DataFrame:
    """All levels of entries or `days`: level, its keys, files, minutes (distinct), size_bytes, days, earliest, latest.

    Bitmaps are merged by date in one pass of grouping sets; as dates part minutes, levels without a date add up
    the minutes of their dates.
    """
    sets = [[*key, "date"] for key, _, _ in _GROUPED]
    found = _as_days(table).groupingSets(sets, *_DIMS).agg(F.grouping_id().alias("_set"), *_merged())
    # a bit of the set is 1 where the column is not grouped by
    number = lambda key: sum(0 if c in (*key, "date") else 1 << (len(_DIMS) - 1 - k) for k, c in enumerate(_DIMS))
    row = lambda name, date: F.struct(F.lit(name).alias("level"), date.alias("own"))
    targets = F.lit(None)
    for key, dated, whole in _GROUPED:
        rows = [row(dated, F.col("date"))] * bool(dated) + [row(whole, F.lit(None).cast("date"))] * bool(whole)
        targets = F.when(F.col("_set") == number(key), F.array(*rows)).otherwise(targets)
    each = found.select("security_id", "exchange_id", "schema", "date", "files", "size_bytes", minutes().alias("minutes"), F.explode(targets).alias("_to"))
    sums = (F.sum(c).alias(c) for c in ("files", "minutes", "size_bytes"))
    out = each.groupBy("security_id", "exchange_id", "schema", F.col("_to.own").alias("own"), F.col("_to.level").alias("level")).agg(*sums, F.count("*").alias("days"), F.min("date").alias("earliest"), F.max("date").alias("latest"))
    return out.select("security_id", "exchange_id", "schema", F.col("own").alias("date"), "level", "files", "minutes", "size_bytes", "days", "earliest", "latest")


def _by_date(table: DataFrame, *key: str) -> DataFrame:
    """Bitmaps merged by keys and date, as numbers, with the exchanges and schemas of each."""
    held = F.collect_set("schema").alias("schemas"), F.collect_set("exchange_id").alias("exchanges")
    return _as_days(table).groupBy(*(k for k in key if k != "date"), "date").agg(*_merged(), *held).withColumn("minutes", minutes())


def _distinct(column: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(column))))


def global_summary(table: DataFrame) -> DataFrame:
    table = _as_days(table)
    dates = _by_date(table).select("files", "minutes", "size_bytes", "date", F.lit(0).alias("pair"))
    # pairs are rows of their own, so one pass adds both up
    pairs = table.select("security_id", "exchange_id").distinct().select(*(F.lit(0).cast("long").alias(c) for c in ("files", "minutes", "size_bytes")), F.lit(None).cast("date").alias("date"), F.lit(1).alias("pair"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return dates.union(pairs).agg(total("files").alias("total_files"), total("minutes").alias("total_minutes"), total("size_bytes").alias("total_size_bytes"), total("pair").alias("security_exchange_count"), F.min("date").alias("earliest_date"), F.max("date").alias("latest_date"))


def by_schema(table: DataFrame) -> DataFrame:
    return _by_date(table, "schema").groupBy("schema").agg(F.sum("files").alias("file_count"), F.sum("minutes").alias("minute_count"), F.sum("size_bytes").alias("size_bytes"))


def by_pair(table: DataFrame) -> DataFrame:
    return _by_date(table, "security_id", "exchange_id").groupBy("security_id", "exchange_id").agg(F.sum("files").alias("file_count"), F.sum("minutes").alias("minute_count"), F.sum("size_bytes").alias("size_bytes"), F.min("date").alias("earliest_date"), F.max("date").alias("latest_date"), _distinct("schemas").alias("schema_types"))


def summary(table: DataFrame, *key: str) -> DataFrame:
    """Days, minutes, size, exchanges, dates and schemas by security, or by security and exchange."""
    return _by_date(table, *key).groupBy(*key).agg(F.count("*").alias("total_days"), F.sum("minutes").alias("total_minutes"), F.sum("size_bytes").alias("total_size_bytes"), F.size(_distinct("exchanges")).cast("long").alias("total_exchanges"), F.min("date").alias("earliest_date"), F.max("date").alias("latest_date"), _distinct("schemas").alias("schema_types"))


def per_date(table: DataFrame, *key: str) -> DataFrame:
    """Minutes and size by keys and date (keys may hold schema)."""
    return _by_date(table, *key).select(*key, "date", "minutes", "size_bytes")


def _schemas() -> Column:
    return F.array_sort(F.collect_set("schema"))


def _map(*pair: Column | str, ordered: bool = True) -> Column:
    """A map of a group's rows, in the order of its keys unless values have no order (maps)."""
    pairs = F.collect_list(F.struct(*pair))
    return F.map_from_entries(F.array_sort(pairs) if ordered else pairs)


def records(levels_: DataFrame, as_of: Column) -> DataFrame:
    """Coverage rows (pk, sk, data as JSON, last_updated, version) of a stored table of `levels`: summaries and dates.

    Each document holds maps over schemas, exchanges or pairs of one key and date, which are few by nature; that of all
    pairs has an entry for each listing.
    """
    of = lambda name: levels_.where(F.col("level") == name)
    pair, security = ["security_id", "exchange_id"], ["security_id"]
    camel = {"totalDays": "days", "totalMinutes": "minutes", "totalSizeBytes": "size_bytes", "earliestDate": "earliest", "latestDate": "latest", "schemaTypes": "schema_types"}
    totals = [F.col(c).alias(n) for n, c in camel.items()]
    types = lambda name, key: of(name).groupBy(*key).agg(_schemas().alias("schema_types"))
    pairs = of("pair").drop("schema").join(types("pair_date_schema", pair), pair)

    item = F.struct("securityId", "exchangeId", "fileCount", "minuteCount", "sizeBytes", "earliestDate", "latestDate", "schemaTypes")
    named = pairs.withColumnsRenamed({"files": "fileCount", "minutes": "minuteCount", "size_bytes": "sizeBytes", "earliest": "earliestDate", "latest": "latestDate", "schema_types": "schemaTypes"}).withColumns({"securityId": F.col("security_id"), "exchangeId": F.col("exchange_id")})
    securities = named.agg(_map(F.concat_ws("-", "security_id", "exchange_id").alias("name"), item).alias("securities"), F.count("*").alias("securityExchangeCount"))
    schemas = of("schema").agg(_map("schema", F.struct(F.col("files").alias("fileCount"), F.col("minutes").alias("minuteCount"), F.col("size_bytes").alias("sizeBytes"))).alias("schemaTypes"))
    one = F.lit(1).alias("_one")
    top = of("global").select("*", one).join(securities.select("*", one), "_one").join(schemas.select("*", one), "_one")
    data = F.to_json(F.struct(F.col("files").alias("totalFiles"), F.col("minutes").alias("totalMinutes"), F.col("size_bytes").alias("totalSizeBytes"), "securityExchangeCount", F.col("earliest").alias("earliestDate"), F.col("latest").alias("latestDate"), "securities", "schemaTypes"))
    out = top.select(keys.coverage_pk().alias("pk"), keys.coverage_sk().alias("sk"), data.alias("data"))

    exchanges = pairs.groupBy("security_id").agg(_map(F.col("exchange_id").cast("string").alias("name"), F.struct(*totals)).alias("exchanges"), F.count("*").alias("totalExchanges"))
    whole = of("security").drop("exchange_id", "schema").join(types("security_date_schema", security), security).join(exchanges, security)
    out = out.union(whole.select(keys.coverage_pk(F.col("security_id")), keys.coverage_sk(), F.to_json(F.struct(*totals, "totalExchanges", "exchanges"))))
    out = out.union(pairs.select(keys.coverage_pk(F.col("security_id"), F.col("exchange_id")), keys.coverage_sk(), F.to_json(F.struct(*totals))))

    held = F.struct(F.lit(True).alias("hasCoverage"), F.col("minutes"), F.col("size_bytes").alias("sizeBytes"))
    dated = lambda name, key: of(name).select(*key, "date", "minutes").join(of(f"{name}_schema").groupBy(*key, "date").agg(_map("schema", held).alias("schemaTypes")), [*key, "date"])
    pair_dates = dated("pair_date", pair)
    by_exchange = pair_dates.groupBy("security_id", "date").agg(_map(F.col("exchange_id").cast("string").alias("name"), F.struct("schemaTypes", F.col("minutes").alias("totalMinutes")), ordered=False).alias("exchanges"))
    document = [F.lit(True).alias("hasCoverage"), F.col("minutes").alias("totalMinutes"), F.col("schemaTypes")]
    security_dates = dated("security_date", security).join(by_exchange, ["security_id", "date"])
    out = out.union(security_dates.select(keys.coverage_pk(F.col("security_id")), keys.coverage_sk(F.col("date")), F.to_json(F.struct(*document, "exchanges"))))
    out = out.union(pair_dates.select(keys.coverage_pk(F.col("security_id"), F.col("exchange_id")), keys.coverage_sk(F.col("date")), F.to_json(F.struct(*document))))
    return out.select("*", as_of.alias("last_updated"), F.lit("1.0").alias("version"))


# Fixed value: what an empty summary says.
NO_COVERAGE = "No coverage data available"


def summary_answer(table: DataFrame) -> DataFrame:
    """One row for the summary of a coverage table: its totals and time, or zeros and an error where it has none."""
    own = table.where("pk = 'GLOBAL' and sk = 'SUMMARY'")
    number = lambda name: F.coalesce(F.first(F.get_json_object("data", f"$.{name}").cast("long")), F.lit(0))
    return own.agg(number("totalFiles").alias("total_files"), number("totalMinutes").alias("total_minutes"), number("totalSizeBytes").alias("total_size_bytes"), number("securityExchangeCount").alias("pairs"), F.first("last_updated").alias("last_inventory_date"), F.when(F.count("*") == 0, NO_COVERAGE).alias("error"))


def read_documents(table: DataFrame, pk: Column) -> DataFrame:
    """The summary of a key with its dates: pk, summary, coverage (map of date to document); no row for an unknown key."""
    own = table.where(F.col("pk") == pk)
    dates = own.where(F.col("sk").startswith("DATE#")).groupBy("pk").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.substring("sk", 6, 10), "data")))).alias("coverage"))
    return own.where("sk = 'SUMMARY'").select("pk", F.col("data").alias("summary"), F.col("last_updated").alias("last_inventory_date")).join(dates, "pk", "left")
