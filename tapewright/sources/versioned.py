"""Tables of versions that stay small: old versions are folded into a base, readers join base and tail.

A table is a folder with `tail/version=n`, written by `streaming.jobs.versions_sink` or `write`, and `base/n`, which holds what
the versions up to n amount to; rows of the base keep the number of the version that they come from. A fold is written
whole before what it replaces is removed, and reading base and tail together gives the same rows at any moment
between, as a row that is there twice is the same key and version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables
from .work import exists, remove, subfolders


def tail(path: str) -> str:
    """Where versions are written."""
    return f"{path}/tail"


def versions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of base and tail, with their version."""
    full = f"{schema}, version int"
    parts = [spark.read.schema(full).parquet(f"{path}/base/{n}") for n in _bases(spark, path)]
    if exists(spark, tail(path)):
        parts.append(spark.read.schema(full).parquet(tail(path)))
    out = parts[0] if parts else spark.createDataFrame([], full)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def current(spark: SparkSession, path: str, schema: str, *key: str) -> DataFrame:
    """The latest row of each key."""
    return tables.latest(versions(spark, path, schema), *key)


def _bases(spark: SparkSession, path: str) -> list[str]:
    """Bases that were written to their end."""
    return sorted((n for n in subfolders(spark, f"{path}/base") if exists(spark, f"{path}/base/{n}/_SUCCESS")), key=int)


def folders(spark: SparkSession, path: str) -> int:
    """How many folders readers look into."""
    return len(_bases(spark, path)) + len(subfolders(spark, tail(path)))


def fold(spark: SparkSession, path: str, schema: str, key: tuple[str, ...], upto: int, keep: Column | None = None) -> None:
    """Fold the versions up to a number into one base, without rows that ``keep`` does not hold for (expired ones).

    A batch that may be repeated must not be folded: give the number of the one before. One fold of a table at a time.
    """
    rows = tables.latest(versions(spark, path, schema).where(F.col("version") <= upto), *key)
    if keep is not None:
        rows = rows.where(F.coalesce(keep, F.lit(True)))
    older = _bases(spark, path)
    rows.write.mode("overwrite").parquet(f"{path}/base/{upto}")
    remove(spark, *(f"{path}/base/{n}" for n in older if int(n) < upto))
    remove(spark, *(f"{tail(path)}/{n}" for n in subfolders(spark, tail(path)) if int(n.partition("=")[2]) <= upto))


def folding(sink: Callable[[DataFrame, int], None], path: str, schema: str, key: tuple[str, ...], every: int = 20, keep: Column | None = None) -> Callable[[DataFrame, int], None]:
    """A sink after which, every so many batches, the versions before its own are folded; so a table never has more than
    ``every`` versions and a base or two."""

    def write(batch: DataFrame, number: int) -> None:
        sink(batch, number)
        if number % every == every - 1:
            fold(batch.sparkSession, path, schema, key, number - 1, keep)

    return write
