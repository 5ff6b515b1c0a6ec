"""Merkle manifest of a dataset: one tree per group of rows, one over their roots, and a proof for every row.

Leaves get their exact places from a range exchange and counts per slab, so a tree of any size is spread over all tasks. Every aligned block of 256
places is one row, and each level inside a block is one string of fixed-width digests: a parent is the hash of a substring, and the
siblings of a node are the substrings on either side of it within its run. The roots of blocks are the leaves of the next tier, until a tree
fits one block; paths then come down tier by tier. Everything is built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import written

#: Children of a node, hex digits of a digest, and leaves of a block (two levels).
WAYS, WIDTH = 16, 64
BLOCK = WAYS * WAYS
PATH = "array<struct<left:binary,right:binary>>"


def sha(value: Column) -> Column:
    """Lower-case hex sha256 as bytes, so that substrings are cut by place and not by counting signs."""
    return F.sha2(value, 256).cast("binary")


def leaf(*values: Column) -> Column:
    """The digest of a row: of each value its UTF-8 length, a colon and itself, or - for null."""
    def field(v: Column) -> Column:
        s = v.cast("string")
        return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def _parents(level: Column) -> Column:
    """The next level: every run of WAYS digests hashed, the last one as short as it is."""
    run = WAYS * WIDTH
    starts = F.sequence(F.lit(1), F.length(level), F.lit(run))
    return F.array_join(F.transform(starts, lambda i: F.sha2(F.substring(level, i, F.lit(run)), 256)), "").cast("binary")


def _beside(level: Column, i: Column) -> Column:
    """What stands left and right of node ``i`` in its run."""
    first = i - F.pmod(i, F.lit(WAYS))
    cut = lambda a, b: F.substring(level, a * WIDTH + 1, (b - a) * WIDTH)
    return F.struct(cut(first, i).alias("left"), cut(i + 1, first + WAYS).alias("right"))


def _numbered(nodes: DataFrame, tree: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``nodes`` with pos, the exact place in the tree from 0, and size, the nodes of the tree.

    ``nodes`` is a written table. Fully equal rows are dealt over slabs by the place they were read from.
    """
    slabs = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = nodes.withColumn("_tie", F.monotonically_increasing_id())
    placed = written(placed.repartitionByRange(slabs, *tree, *order, "_tie").withColumn("_slab", F.spark_partition_id()))
    counts = placed.groupBy(*tree, "_slab").agg(F.count("*").alias("_n"))
    every = Window.partitionBy(*tree)
    counts = counts.select(
        *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tree)], F.col("_slab").alias("_s"),
        (F.sum("_n").over(every.orderBy("_slab")) - F.col("_n")).alias("_before"), F.sum("_n").over(every).alias("size"),
    )
    own = F.row_number().over(Window.partitionBy(*tree, "_slab").orderBy(*order, "_tie")) - 1
    same = (F.col("_slab") == F.col("_s"))
    for i, c in enumerate(tree):
        same &= F.col(c).eqNullSafe(F.col(f"_t{i}"))
    found = placed.withColumn("_own", own).join(counts, same)
    return found.withColumn("pos", F.col("_before") + F.col("_own")).drop("_tie", "_slab", "_s", "_own", "_before", *[f"_t{i}" for i in range(len(tree))])


def _blocks(nodes: DataFrame, tree: Sequence[str]) -> DataFrame:
    """tree, block, size, members (in order), l0, l1, l2 (levels, null where the tree ended before), digest (of the block)."""
    block = F.floor(F.col("pos") / BLOCK).cast("bigint").alias("block")
    found = nodes.groupBy(*tree, block).agg(F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("pos", "digest", "load"))).alias("members"))
    found = found.withColumn("l0", F.array_join(F.col("members.digest"), "").cast("binary"))
    found = found.withColumn("l1", F.when(F.col("size") > 1, _parents(F.col("l0"))))
    found = found.withColumn("l2", F.when(F.col("size") > WAYS, _parents(F.col("l1"))))
    return found.withColumn("digest", F.coalesce("l2", "l1", "l0").cast("string"))


def _tiers(leaves: DataFrame, tree: Sequence[str], order: Sequence[str]) -> list[DataFrame]:
    """Written blocks from the leaves up, until every tree is within one block: two levels a tier, so the tiers are few at any size."""
    numbered = _numbered(leaves, tree, order).select(*tree, "pos", "size", "digest", "load")
    tiers = [written(_blocks(numbered, tree))]
    while (tiers[-1].agg(F.max("size")).first()[0] or 0) > BLOCK:
        below = tiers[-1].where(F.col("size") > BLOCK)
        size = F.ceil(F.col("size") / BLOCK).cast("bigint").alias("size")
        nodes = below.select(*tree, F.col("block").alias("pos"), size, "digest", F.lit(None).cast(leaves.schema["load"].dataType).alias("load"))
        tiers.append(written(_blocks(nodes, tree)))
    return tiers


def _roots(tiers: list[DataFrame], tree: Sequence[str]) -> DataFrame:
    """tree and digest of its root: the block of each tree at the tier where there is but one."""
    found = [t.where(F.col("size") <= BLOCK).select(*tree, "digest") for t in tiers]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _joined(blocks: DataFrame, above: DataFrame, tree: Sequence[str]) -> DataFrame:
    """Blocks with the ``up`` of what stands above them, by tree and block."""
    named = above.select(*[F.col(c).alias(f"_t{i}") for i, c in enumerate(tree)], F.col("pos").alias("_b"), "up")
    same = F.col("block") == F.col("_b")
    for i, c in enumerate(tree):
        same &= F.col(c).eqNullSafe(F.col(f"_t{i}"))
    return blocks.join(named, same).drop("_b", *[f"_t{i}" for i in range(len(tree))])


def _members(blocks: DataFrame, tree: Sequence[str]) -> DataFrame:
    """One row per member: tree, pos, digest, load, up with its own steps put before those of the block."""
    steps = lambda i: F.concat(
        F.when(F.col("l1").isNotNull(), F.array(_beside(F.col("l0"), i))).otherwise(F.array().cast(PATH)),
        F.when(F.col("l2").isNotNull(), F.array(_beside(F.col("l1"), F.floor(i / WAYS).cast("int")))).otherwise(F.array().cast(PATH)),
    )
    each = F.transform("members", lambda m, i: F.struct(m["pos"].alias("pos"), m["digest"].alias("digest"), m["load"].alias("load"), steps(i).alias("steps")))
    found = blocks.select(*tree, "up", F.explode(each).alias("m"))
    up = F.col("up")
    joined = F.struct(F.concat(F.col("m.steps"), up["path"]).alias("path"), up["subroot"].alias("subroot"), up["root"].alias("root"))
    return found.select(*tree, "m.pos", "m.digest", "m.load", joined.alias("up"))


def _paths(tiers: list[DataFrame], above: DataFrame, tree: Sequence[str]) -> DataFrame:
    """Members of the lowest tier with their whole paths; ``above`` has tree and up of each tree."""
    down = None
    for blocks in reversed(tiers):
        known = above.select(*tree, F.lit(0).cast("bigint").alias("pos"), "up")
        single = _members(_joined(blocks.where(F.col("size") <= BLOCK), known, tree), tree)
        if down is not None:
            single = single.unionByName(_members(_joined(blocks.where(F.col("size") > BLOCK), down.select(*tree, "pos", "up"), tree), tree))
        down = single
    return down


def manifest(rows: DataFrame, digest: Column, tree: Column, order: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: the ``keep`` columns, leaf, subroot, root and path (array of left, right from the leaf up to the root).

    Each value of ``tree`` has a tree of its own, null too; its leaves go by ``order`` (null first), then by their digests. While a tree has several
    nodes, every WAYS neighbours become one, a last lone one too; a lone leaf is its own root. The roots go by ``tree`` (null first, bytewise) into one
    more tree. Rows with equal order and digest take any of their places: repeated rows are leaves of their own. An empty table gives no rows.
    """
    # kept columns travel as one struct, so no name of the table meets one of the manifest
    load = F.struct(*[rows[c].alias(f"k{i}") for i, c in enumerate(keep)], F.lit(0).alias("_"))
    leaves = written(rows.select(tree.alias("tree"), order.alias("order"), digest.alias("digest"), load.alias("load")))
    tiers = _tiers(leaves, ["tree"], ["order", "digest"])
    tops = written(_roots(tiers, ["tree"]).select(F.lit(0).alias("all"), "tree", "digest", F.struct("tree", F.col("digest").alias("subroot")).alias("load")))
    over = _tiers(tops, ["all"], ["tree", "digest"])
    root = _roots(over, ["all"]).select("all", F.struct(F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root")).alias("up"))
    above = _paths(over, root, ["all"]).select(
        F.col("load.tree").alias("tree"), F.struct(F.col("up.path").alias("path"), F.col("load.subroot").alias("subroot"), F.col("up.root").alias("root")).alias("up")
    )
    found = _paths(tiers, written(above), ["tree"])
    return found.select(*[F.col(f"load.k{i}").alias(c) for i, c in enumerate(keep)], F.col("digest").alias("leaf"), "up.subroot", "up.root", "up.path")


def proof(path: Column) -> Column:
    """One digest of all siblings, from the leaf up and from left to right."""
    return F.sha2(F.aggregate(path, F.lit(b""), lambda got, s: F.concat(got, s["left"], s["right"])), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that ``digest`` leads to along ``path``."""
    return F.aggregate(path, digest.cast("binary"), lambda got, s: sha(F.concat(s["left"], got, s["right"]))).cast("string")
