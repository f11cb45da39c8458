"""Writes that count what they write, in the same pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def written(df: DataFrame, path: str, *by: str, mode: str = "overwrite", drop: tuple[str, ...] = (), **counters: Column) -> dict[str, int]:
    """Write rows without the columns ``drop`` and return the counters, aggregates over the rows that were written.

    The counters are observed in the tasks that write, of which one for each partition counts: a task that is run again
    after an executor was lost adds nothing twice, as it might in a stage before. Nothing is read a second time.
    """
    seen = Observation()
    named = [F.coalesce(c.cast("long"), F.lit(0)).alias(n) for n, c in counters.items()]
    rows = df.observe(seen, *named)
    # columns are dropped above the observed rows, in the same stage
    out = rows.drop(*drop) if drop else rows
    (out.write.partitionBy(*by) if by else out.write).mode(mode).parquet(path)
    found = seen.get
    return {n: int(found.get(n) or 0) for n in counters}
