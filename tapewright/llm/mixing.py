"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Each source has a target in words. Its documents are expected target / source size times in the mix: the whole
part of that is allocated to every document for certain; the fraction is the inclusion probability p of one more
copy. Documents are ranked by random odds divided by inclusion odds, (u/(1-u)) / (p/(1-p)), and taken in this
order while the middle of the document lies within the words that are left, so that each source's words end
nearest to its target. u is a digest of the id and a seed: reruns agree.

The order is cut without sorting a source: words are summed by source and rank bucket (at most 1,048,576 a source),
the bucket in which the target falls is found on those sums, first among spans of 1,024 buckets and then within one,
and only that bucket's documents are put in order, counted by rank, id and size before. What a document gets then follows from
its own rank and tables with a row for each source and for each document at a cut, so documents are not shuffled.

Defined cases: a null text has size 0; a null source is a source of its own, after all others; a null id ranks
as the text 'null'. Repeated rows are documents of their own, but equal ids rank side by side: where the target falls among rows that agree
in id, source and size, however many, they are numbered within the partitions of the input and those with the least numbers are
taken. A document of size 0 ranks as any other, and is copied if its place comes before the target. Sources without words have
target 0. Empty tables give no rows. Columns of the input other than those named are carried by `mixed_rows` only, under
any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import broadcast_if_small, stored

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Rank buckets of a source, and how many of them are one span.
BUCKETS, SPAN = 1 << 20, 1 << 10
WORD = r"[^\x20\x09-\x0D]+"


def uniform(id_col: Column, seed: str) -> Column:
    """A number in (0, 1) from the digest of the id and a seed: 52 bits of MD5, in the middle of their cell."""
    digest = F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(":" + seed)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most_copies: int = MOST_COPIES) -> DataFrame:
    """Targets of sources given (source, source_size): shares by weight, none above most_copies times its size.

    Sources by code point, null last, take the weights in turn. What a capped source cannot take is shared again
    by weight; the end of that is one level L with target = min(cap, weight * L), found by running sums over the
    sources in order of cap / weight. One row per source goes through one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", (F.col("source_size") * most_copies).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = ranked.withColumn("at", F.row_number().over(order)).withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("at", "level"))
    levels = levels.withColumn("level", F.min(fits).over(whole)["level"])
    return levels.select("source", "source_size", F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * F.col("level"))).alias("target"))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, *more: Column) -> DataFrame:
    """What the mix needs of a document, and further columns: id, source, size, u, tie (a hash of the text)."""
    size = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(*more, F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), uniform(F.col(id_col), seed).alias("u"), F.xxhash64(text_col).alias("tie"))


def _by_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows with the columns of a stored table that has one row a source."""
    return rows.join(broadcast_if_small(table.withColumnRenamed("source", "_source")), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def _ranked(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Sized rows with the targets of their source, their rank and its bucket (null where nothing but whole copies is taken)."""
    odds = lambda x: x / (1 - x)
    ranked = _by_source(rows, targets).withColumn("rank", F.when(F.col("p") > 0, odds(F.col("u")) / odds(F.col("p"))))
    return ranked.withColumn("bucket", F.floor(F.col("rank") / (1 + F.col("rank")) * BUCKETS))


def _reaching(sums: DataFrame, at: str) -> DataFrame:
    """Where the words of a source, summed in order of ``at`` from ``base`` on, reach ``rest``: (source, at, before)."""
    upto = F.col("base") + F.sum("words").over(Window.partitionBy("source").orderBy(at))
    reached = sums.withColumn("upto", upto).where("upto >= rest")
    return reached.groupBy("source").agg(F.min(F.struct(at, (F.col("upto") - F.col("words")).alias("before"))).alias("cut")).select("source", f"cut.{at}", "cut.before")


def _plan(slim: DataFrame, weights: tuple[int, ...], share: float, most_copies: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables: targets of sources; the bucket of each source's cut; and of documents in that bucket, counted (n) by
    source, id and size, how many get one more copy (k)."""
    targets = source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most_copies)
    expected = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most_copies)))).otherwise(F.lit(0.0))
    targets = targets.withColumn("whole", F.floor(expected)).withColumn("p", expected - F.col("whole")).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    targets = stored(targets, "targets")
    ranked = _ranked(slim, targets).where("p > 0")
    sums = ranked.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    sums = stored(sums.withColumn("span", F.floor(F.col("bucket") / SPAN)), "bucket-sums")
    spans = sums.groupBy("source", "span").agg(F.sum("words").alias("words"), F.first("rest").alias("rest")).withColumn("base", F.lit(0))
    spans = stored(_reaching(spans, "span").withColumnsRenamed({"span": "at_span", "before": "base"}), "spans")
    cuts = stored(_reaching(_by_source(sums, spans).where("span = at_span"), "bucket").withColumnRenamed("bucket", "cut"), "cuts")
    alike = _by_source(ranked, cuts).where("bucket = cut").groupBy("source", "rank", "id", "size").agg(F.count("*").alias("n"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    run = Window.partitionBy("source").orderBy("rank", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    alike = alike.withColumn("begin", F.col("before") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(run), F.lit(0)))
    # row j of n, from 0, is taken if its middle, begin + j * size + size / 2, is not beyond rest; the quotient may be off by one
    middle = lambda j: F.col("begin") + j * F.col("size") + F.col("size") / 2
    about = F.when(F.col("size") > 0, F.floor((F.col("rest") - middle(F.lit(0))) / F.col("size")) + 1)
    exact = about + (middle(about) <= F.col("rest")).cast("long") - (middle(about - 1) > F.col("rest")).cast("long")
    k = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least("n", exact))).when(F.col("begin") <= F.col("rest"), F.col("n")).otherwise(F.lit(0))
    return targets, cuts, stored(alike.select("source", "id", "size", "n", k.cast("long").alias("k")), "at-cuts")


def _with_copies(rows: DataFrame, targets: DataFrame, cuts: DataFrame, alike: DataFrame) -> DataFrame:
    """Sized rows with source_size, target and copies. Of rows alike at a cut of which only some get one more copy, which are
    those of one id and size a source at most, partitions take the first ones by number."""
    counted = alike.withColumnsRenamed({"source": "_source", "id": "_id", "size": "_size"})
    same = (F.col("bucket") == F.col("cut")) & F.col("source").eqNullSafe(F.col("_source")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("size") == F.col("_size"))
    placed = _by_source(_ranked(rows, targets), cuts).join(broadcast_if_small(counted), same, "left")
    before = F.col("bucket").isNotNull() & (F.col("cut").isNull() | (F.col("bucket") < F.col("cut")))
    clear = placed.withColumn("more", F.when(F.col("k").isNotNull(), F.col("k") == F.col("n")).otherwise(before))
    if alike.where("k > 0 and k < n").take(1):
        some = F.coalesce((F.col("k") > 0) & (F.col("k") < F.col("n")), F.lit(False))
        split = stored(placed.where(some).withColumn("part", F.spark_partition_id()), "split")
        parts = split.groupBy("source", "part").agg(F.count("*").alias("rows"))
        parts = parts.withColumn("start", F.sum("rows").over(Window.partitionBy("source").orderBy("part")) - F.col("rows"))
        parts = stored(parts.select(F.col("source").alias("in_source"), F.col("part").alias("in_part"), "start"), "parts")
        split = split.join(broadcast_if_small(parts), F.col("source").eqNullSafe(F.col("in_source")) & (F.col("part") == F.col("in_part")))
        at = F.col("start") + F.row_number().over(Window.partitionBy("source", "part").orderBy("tie")) - 1
        clear = clear.where(~some).unionByName(split.withColumn("more", at < F.col("k")).select(*clear.columns))
    return clear.withColumn("copies", (F.col("whole") + F.col("more").cast("int")).cast("long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most_copies: int = MOST_COPIES, seed: str = "mix") -> DataFrame:
    """One row per document: id_col, size, source, source_size, target, copies, taken (words, repeats counted)."""
    slim = stored(_sized(docs, id_col, text_col, source_col, seed), "sizes")
    found = _with_copies(slim, *_plan(slim, weights, share, most_copies))
    return found.select(F.col("id").alias(id_col), "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.0, most_copies: int = MOST_COPIES, seed: str = "mix") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns. Rows stay where they are: only sums move."""
    tables = _plan(stored(_sized(docs, id_col, text_col, source_col, seed), "sizes"), weights, share, most_copies)
    found = _with_copies(_sized(docs, id_col, text_col, source_col, seed, F.struct("*").alias("row")), *tables).where("copies > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
