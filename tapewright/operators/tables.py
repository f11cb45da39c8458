"""Keyed tables on plain Parquet: versions of rows, the latest of each key, and the writes the jobs need.

A table is a set of versioned rows (`version`, a timestamp or a number). Writers append; readers take the latest row of
each key. Partitions by date are replaced as a whole where rows are computed again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(versions: DataFrame, *key: str, version: str = "version") -> DataFrame:
    """The latest row of each key: an aggregate, so that versions are dropped before the shuffle where they can be."""
    rest = [c for c in versions.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(version, *[c for c in rest if c != version and dict(versions.dtypes)[c] in ("string", "int", "bigint")]))
    return versions.groupBy(*key).agg(best.alias("_row")).select(*key, "_row.*").select(*versions.columns)


def insert_if_absent(table: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """Rows of ``new`` whose key the table lacks, one for each key."""
    return new.dropDuplicates(list(key)).join(table.select(*key), list(key), "left_anti")


def put(table: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """The table after full overwrite by key."""
    return table.join(new.select(*key), list(key), "left_anti").unionByName(new)


def put_unreviewed(table: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """As `put`, but reviewed rows stay as they are."""
    keep = table.where("status = 'REVIEWED'")
    fresh = new.join(keep.select(*key), list(key), "left_anti")
    return put(table, fresh, *key)


def merge_statistics(table: DataFrame, new: DataFrame) -> DataFrame:
    """Additive merge of sufficient statistics by listing, date, hour and metric."""
    key = ("listing_id", "date", "hour", "metric")
    return table.unionByName(new).groupBy(*key).agg(*(F.sum(c).alias(c) for c in ("count", "sum", "sum_sq")))


def review(table: DataFrame, updates: DataFrame, key: tuple[str, ...], fields: tuple[str, ...], mark: str | None = None) -> DataFrame:
    """The table after reviews: status REVIEWED, and the fields that an update gives (null: as before).

    Updates lacking a part of the key are left out (see `invalid_updates`); unknown keys are added. A column ``mark``
    tells which rows an update has reached.
    """
    good = valid_updates(updates, key)
    good = good.select(*key, *(F.col(f).alias(f"_{f}") for f in fields), F.lit(True).alias("_hit")).dropDuplicates(list(key))
    joined = table.join(good, list(key), "full")
    columns = []
    for c in table.columns:
        if c in key:
            columns.append(F.col(c))
        elif c == "status":
            columns.append(F.when(F.col("_hit"), F.lit("REVIEWED")).otherwise(F.col("status")).alias(c))
        elif c in fields:
            columns.append(F.coalesce(f"_{c}", c).alias(c))
        else:
            columns.append(F.col(c))
    if mark is not None:
        columns.append(F.coalesce("_hit", F.lit(False)).alias(mark))
    return joined.select(*columns)


def valid_updates(updates: DataFrame, key: tuple[str, ...]) -> DataFrame:
    return updates.where(" and ".join(f"{k} is not null" for k in key))


def invalid_updates(updates: DataFrame, key: tuple[str, ...]) -> DataFrame:
    return updates.where(" or ".join(f"{k} is null" for k in key)).withColumn("error", F.lit(" and ".join(key) + " are required"))


def review_counts(updates: DataFrame, key: tuple[str, ...]) -> DataFrame:
    missing = F.lit(False)
    for k in key:
        missing = missing | F.col(k).isNull()
    return updates.agg(F.count_if(~missing).alias("updated"), F.count_if(missing).alias("errors"))


def delete(table: DataFrame, condition: Column) -> DataFrame:
    return table.where(~F.coalesce(condition, F.lit(False)))


def live(table: DataFrame, as_of: Column) -> DataFrame:
    """Rows that have not expired."""
    return table.where(F.col("expires_at").isNull() | (F.col("expires_at") > F.unix_timestamp(as_of)))


def listed(table: DataFrame, *conditions: Column, by: str = "minute", tie: tuple[str, ...] = (), limit: int = 100, most: int = 100) -> DataFrame:
    """Latest rows first under conditions, at most ``most``: a top-k, not a sort of the table."""
    found = table
    for c in conditions:
        found = found.where(c)
    return found.orderBy(F.col(by).desc(), *(F.col(t).desc() for t in tie)).limit(min(limit, most))


def after(by: str, tie: str, last_by: Column, last_tie: Column) -> Column:
    """Keyset predicate: rows that follow the last one of a page."""
    return (F.col(by) < last_by) | ((F.col(by) == last_by) & (F.col(tie) < last_tie))
