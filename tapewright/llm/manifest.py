"""Merkle manifest of a table: a digest for each row, a tree for each group, one root, and a proof for each row.

H is the lowercase hex SHA-256 of its inputs one after another. A row's leaf is H of its fields, each ``-`` if null, else its
UTF-8 byte count, ``:`` and the value. In each group leaves stand in order; every two consecutive nodes become their H
(a last one alone becomes H of itself) until one is left, the group's subroot. Subroots, in the order of the groups,
become the root in the same way. A proof is the siblings on the way up; `folded` recomputes the root from a leaf and them.

1. Rows are numbered within their group: ranges of (group, order, leaf) are dealt to tasks and sorted there, and the places
   follow from the number of rows of each group in each range. No group is in one task.
2. A tier is ten levels of the tree. Its nodes are cut into blocks of 1,024 by place, so a window never holds more. Level by
   level, `lag` and `lead` at the fixed offset 2^level give siblings, masked by slot and by the length of the run; rows
   of first children hash the parents. All levels share one shuffle and one sort. Roots of blocks are the next
   tier's nodes.
3. Proofs are put together from the top: each block takes what stands above it by one join a tier.

Defined cases: null order values come first, null groups too. Rows that repeat an order value stand by their leaf, so equal rows
may change places without changing anything. An empty table has no rows and no root. A group of one row has
its leaf as subroot; with one group the root is its subroot. Texts of any length are hashed whole. Columns that are no field
are not part of the digest, and may have any names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Work, broadcast_if_small

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a tier; a block has 2^STEP nodes.
STEP = 10
#: Rows of blocks (each with a proof of some kilobytes) that a join may broadcast.
MOST_BLOCKS = 10_000


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """H of the fields of a row."""
    text = [f.cast("string") for f in fields]
    return digest(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text))


def numbered(rows: DataFrame, order: Sequence[str], work: Work, name: str) -> DataFrame:
    """Rows with `at`: their order over all tasks, with the task's own number from bit 33 on. Rows that are alike are parted by
    where they were read, so that no range is too large."""
    tie = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tie.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    return work.stored(dealt.withColumn("at", F.monotonically_increasing_id()), name)


def placed(rows: DataFrame, work: Work, name: str) -> DataFrame:
    """Numbered rows (grp, at, ...) with g (the group's place among groups), n (its rows) and pos (the row's place in it)."""
    part = F.shiftrightunsigned("at", 33)
    runs = work.stored(rows.groupBy(part.alias("part"), "grp").agg(F.count("*").alias("rows"), F.min("at").alias("first")), f"{name}-runs")
    groups = numbered(runs.groupBy("grp").agg(F.sum("rows").alias("n")), ["grp"], work, f"{name}-groups")
    ranges = groups.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    # a row for each task, however many rows there are
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("part", (F.col("first") - before).alias("shift"))
    groups = groups.withColumn("part", part).join(F.broadcast(ranges), "part").select(F.col("grp").alias("_grp"), "n", (F.col("at") - F.col("shift")).alias("g"))
    earlier = F.coalesce(F.sum("rows").over(Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = runs.withColumn("shift", F.col("first") - earlier).join(groups, F.col("grp").eqNullSafe(F.col("_grp")))
    shifts = work.stored(shifts.select(F.col("part").alias("_part"), "_grp", "g", "n", "shift"), f"{name}-places")
    met = rows.join(broadcast_if_small(shifts), (part == F.col("_part")) & F.col("grp").eqNullSafe(F.col("_grp")))
    return met.withColumn("pos", F.col("at") - F.col("shift")).drop("at", "shift", "_part", "_grp")


def tier(rows: DataFrame, step: int = STEP, levels: int = STEP) -> DataFrame:
    """Levels over nodes (g, n, pos, node, ...) in blocks of 2^step: adds `path`, the siblings of each node's ancestors (null
    where a run has none), and `top`, the root of the block, on the block's first row. n is the number of nodes of the
    group; no group has more than 2^levels, unless a tier follows."""
    kept = rows.columns
    block = Window.partitionBy("g", "_block").orderBy("pos")
    down = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumns({"_block": F.shiftright("pos", step), "_node": F.col("node")})
    for level in range(levels):
        apart = 1 << level
        is_node, second, runs_on = F.col("pos") % apart == 0, F.shiftright("pos", level) % 2 == 1, F.col("n") > apart
        out = out.withColumns({"_lag": F.lag("_node", apart).over(block), "_lead": F.lead("_node", apart).over(block)})
        out = out.withColumn("_sibling", F.when(is_node & runs_on, F.when(second, F.col("_lag")).otherwise(F.col("_lead"))))
        parent = F.when(runs_on, digest(F.col("_node"), F.coalesce("_sibling", F.lit("")))).otherwise(F.col("_node"))
        out = out.withColumns({f"_s{level}": F.when(is_node, F.struct("_sibling")), "_node": F.when(is_node & ~second, parent)}).drop("_lag", "_lead", "_sibling")
        # the leaves below take what their ancestor's row has
        out = out.withColumn(f"_s{level}", F.last(f"_s{level}", True).over(down))
    own = sum(((F.col("n") > (1 << level)).cast("int") for level in range(levels)), F.lit(0))
    siblings = F.array(*(F.col(f"_s{level}._sibling") for level in range(levels))).cast("array<string>")
    path = F.slice(siblings, F.lit(1), own)
    return out.select(*kept, path.alias("path"), F.col("_node").alias("top"))


def tree(rows: DataFrame, work: Work, name: str, step: int = STEP) -> list[DataFrame]:
    """The tiers from the leaves up, each stored; the last has one block in each group."""
    most = rows.agg(F.max("n")).first()[0] or 0
    tiers = []
    while True:
        levels = min(step, max(0, most - 1).bit_length())
        tiers.append(work.stored(tier(rows, step, levels), f"{name}-{len(tiers)}"))
        if most <= 1 << step:
            return tiers
        most = -(-most >> step)
        up = F.expr(f"shiftright(n + {(1 << step) - 1}, {step})")
        rows = tiers[-1].where(F.col("pos") % (1 << step) == 0).select("g", up.alias("n"), F.shiftright("pos", step).alias("pos"), F.col("top").alias("node"))


def tops(tiers: list[DataFrame]) -> DataFrame:
    """The root of each group: g, top."""
    return tiers[-1].where("pos = 0").select("g", "top")


def paths(tiers: list[DataFrame], above: DataFrame | None, work: Work, name: str, step: int = STEP) -> DataFrame:
    """The first tier's rows with their whole `path`; above (g, and what rows of the group are to carry, with `rest` as the
    end of their paths) is joined at the top."""
    found = tiers[-1]
    if above is not None:
        found = found.join(broadcast_if_small(above, MOST_BLOCKS), "g")
        found = found.withColumn("path", F.concat("path", "rest")).drop("rest")
    for k in range(len(tiers) - 2, -1, -1):
        upper = work.stored(found.drop("n", "node", "top").withColumnsRenamed({"g": "_g", "pos": "_pos", "path": "rest"}), f"{name}-paths-{k}")
        met = tiers[k].join(broadcast_if_small(upper, MOST_BLOCKS), (F.col("g") == F.col("_g")) & (F.shiftright("pos", step) == F.col("_pos")))
        found = met.withColumn("path", F.concat("path", "rest")).drop("rest", "_g", "_pos")
    return found


def levels_of(n: Column) -> Column:
    """Levels of a tree of n leaves."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(F.lit(0))


def folded(start: Column, path: Column, sides: Column) -> Column:
    """The root that a leaf and its siblings give; bit k of ``sides`` is 1 where the k-th sibling stands at the left."""

    def step(so_far: Column, sibling: Column) -> Column:
        h, side = so_far["h"], so_far["side"]
        inputs = F.when(sibling.isNull(), h).when(side % 2 == 1, F.concat(sibling, h)).otherwise(F.concat(h, sibling))
        return F.struct(F.sha2(inputs, 256).alias("h"), F.shiftrightunsigned(side, 1).alias("side"))

    return F.aggregate(path, F.struct(start.alias("h"), sides.cast("long").alias("side")), step)["h"]


def manifest(docs: DataFrame, changed: Mapping[str, Column] | None = None, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", step: int = STEP) -> DataFrame:
    """One row per row of ``docs``: order, leaf, subroot, root, path (array of siblings, null where a run has none), sides,
    folded_root, verified.

    folded_root is that of the row as ``changed`` gives its fields (as it is, where that makes no difference), with the
    siblings of the table as it is; so a row that was changed is not verified.
    """
    work = Work(docs.sparkSession)
    own = {f: F.col(f"`{f}`") for f in fields}
    other = own | dict(changed or {})
    differs = F.lit(False)
    for f in changed or {}:
        differs = differs | ~own[f].eqNullSafe(other[f])
    leaves = docs.select(
        F.col(f"`{order}`").alias("id"), F.col(f"`{group}`").alias("grp"), leaf([own[f] for f in fields]).alias("node"), F.when(differs, leaf([other[f] for f in fields])).alias("shown")
    )
    rows = numbered(work.stored(leaves, "leaves"), ["grp", "id", "node"], work, "rows")
    work.drop("leaves")
    tiers = tree(placed(rows, work, "rows").drop("grp"), work, "tree", step)
    work.drop_but(*(n for n in work.names if n.startswith("tree-")))
    # groups are the leaves of one more tree, and have their places already
    subroots = work.stored(tops(tiers).withColumn("n", F.lit(1)), "subroots")
    n_groups = subroots.count()
    upper = tree(subroots.select(F.lit(0).alias("g"), F.lit(n_groups).alias("n"), F.col("g").alias("pos"), F.col("top").alias("node"), F.col("g").alias("own")), work, "groups", step)
    root = tops(upper).first()
    root = F.lit(root["top"] if root else None).cast("string")
    above = paths(upper, None, work, "groups", step).select(F.col("own").alias("g"), F.col("node").alias("subroot"), F.col("path").alias("rest"))
    found = paths(tiers, work.stored(above, "above"), work, "tree", step)
    sides = F.col("pos") + F.expr("shiftleft(g, cast(levels as int))")
    found = found.withColumn("levels", levels_of(F.col("n"))).withColumn("sides", sides)
    folded_root = folded(F.coalesce("shown", "node"), F.col("path"), F.col("sides"))
    out = found.select(F.col("id").alias(order), F.col("node").alias("leaf"), "subroot", root.alias("root"), "path", "sides", folded_root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(path: Column) -> Column:
    """H of the siblings of a path."""
    return F.sha2(F.array_join(path, ""), 256)
