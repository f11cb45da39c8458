"""Missing minutes, with a tolerance learned from the listing's own history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from .baseline import asof_sums
from .metrics import combined


def observed(jobs: DataFrame | None, manifest: DataFrame) -> DataFrame:
    """Minutes that are known by the job ledger or by storage: listing_id, minute."""
    found = manifest.select("listing_id", "minute")
    return (found if jobs is None else found.union(jobs.select("listing_id", "minute"))).distinct()


def neighbours(minutes: DataFrame, search_minutes: int = config.GAP_SEARCH_MINUTES) -> DataFrame:
    """Each minute with the one observed before it (`previous`), if within the search span, and the minutes missing between."""
    previous = F.lag("minute").over(Window.partitionBy("listing_id").orderBy("minute"))
    apart = ((F.unix_timestamp("minute") - F.unix_timestamp(previous)) / 60).cast("long")
    found = minutes.withColumn("_apart", apart).withColumn("previous", F.when(apart <= search_minutes, previous))
    return found.withColumn("missing", F.when(F.col("previous").isNotNull(), F.col("_apart") - 1)).drop("_apart")


def tolerance(n: Column, mean: Column, sd: Column) -> Column:
    """Missing minutes that are usual: few samples 1, mean 0 or less a day, else by the mean and its variation."""
    factor = F.when(sd > 0, F.greatest(F.lit(config.TOLERANCE_FACTOR), config.TOLERANCE_FACTOR + 2.0 * F.try_divide(sd, mean))).otherwise(F.lit(config.TOLERANCE_FACTOR))
    # bounded before it becomes an integer
    minutes = F.least(F.ceil(F.least(F.try_divide(F.lit(1.0), mean) * factor, F.lit(float(config.TOLERANCE_MOST)))), F.lit(config.TOLERANCE_MOST))
    learned = F.when(mean <= 0, F.lit(config.TOLERANCE_MOST)).otherwise(F.greatest(minutes, F.lit(config.TOLERANCE_LEAST)))
    return F.when(n < config.TOLERANCE_SAMPLES, F.lit(config.TOLERANCE_LEAST)).otherwise(learned).cast("int")


def tolerances(counts: DataFrame, whole_day: bool = False) -> DataFrame:
    """The tolerance at each observed minute from tickCount values (listing_id, metric, minute, value)."""
    sums = asof_sums(counts.where("metric = 'tickCount'"), config.TOLERANCE_DAYS, 0, day_type=False, whole_day=whole_day)
    mean, sd = combined(F.col("c"), F.col("s"), F.col("q"))
    return sums.select("listing_id", "minute", tolerance(F.col("c"), mean, sd).alias("tolerance"))


def reported(minutes: DataFrame, tolerances_: DataFrame | None = None, search_minutes: int = config.GAP_SEARCH_MINUTES) -> DataFrame:
    """Gaps that reach the tolerance: listing_id, previous, minute, missing, tolerance."""
    found = neighbours(minutes, search_minutes).where("missing > 0")
    if tolerances_ is None:
        found = found.withColumn("tolerance", F.lit(config.TOLERANCE_LEAST))
    else:
        found = found.join(tolerances_, ["listing_id", "minute"], "left").withColumn("tolerance", F.coalesce("tolerance", F.lit(config.TOLERANCE_LEAST)))
    return found.where("missing >= tolerance")


def gap_rows(found: DataFrame, as_of: Column) -> DataFrame:
    """One unreviewed row for each missing minute."""
    step = F.expr("interval 1 minute")
    each = F.explode(F.sequence(F.col("previous") + step, F.col("minute") - step, step))
    return found.select("listing_id", each.alias("minute")).select("listing_id", "minute", F.lit("UNREVIEWED").alias("status"), F.lit("UNKNOWN").alias("reason"), F.lit(False).alias("expected"), F.lit(config.GAP_NOTE).alias("note"), as_of.alias("created_at"))


def detect(minutes: DataFrame, as_of: Column, tolerances_: DataFrame | None = None) -> DataFrame:
    return gap_rows(reported(minutes, tolerances_), as_of)


def resolved(gaps: DataFrame, minutes: DataFrame) -> DataFrame:
    """Gaps with a flag that says whether the minute has come late."""
    late = minutes.select("listing_id", "minute", F.lit(True).alias("_late"))
    return gaps.join(late, ["listing_id", "minute"], "left").withColumn("resolved", F.coalesce("_late", F.lit(False))).drop("_late")
