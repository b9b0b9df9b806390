"""A Merkle manifest of a table: one tree per source, one tree over the sources.

Leaves are ranked within their source by a range sort, and the rank is written in base
``FAN``. ``DIGITS`` digits address a leaf in its block, the rest is the block's number.
The digit columns are grouped away one after the other, innermost first: every grouping
nests the child structs of a run and adds their hash. So a block ends as one nested
struct of at most ``FAN ** DIGITS`` leaves, whatever the size of the source. The blocks
of a source are the nodes of the next tier, until every source has one block left; the
sources' roots are ranked and rolled up by the same steps.

On the way down a block gets the siblings between it and the root; ``transform`` walks
its nested structs and ``explode`` gives every leaf its own list of siblings. Leaves are
never joined with nodes: only blocks are, with the path that their tier hands them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import settle

#: Consecutive nodes that become one.
FAN = 3
#: Digits of a rank within a block: blocks have up to 81 leaves, and their nested structs four levels.
DIGITS = 4
#: The fields of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Digits of the row number that ``monotonically_increasing_id`` counts within a partition.
_ROW_BITS = 33


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(framed, values)), 256)


def ranked(df: DataFrame, by: str, order: list[str]) -> DataFrame:
    """``df`` with ``rank`` (from 0, in the order of ``order`` among the rows of the same ``by``) and ``n`` (their number).

    The rows are range-partitioned and written in order, so no task holds a whole group: a row's
    rank is its place in its partition plus what earlier partitions hold of its group.
    """
    # rows that agree in all of ``order`` are still dealt to several partitions
    spread = df.withColumn("_draw", F.rand(7))
    keys = [by, *order, "_draw"]
    placed = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_draw")
    placed = settle(placed.withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_place", _ROW_BITS))
    held = placed.groupBy(by, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_held"))
    group = Window.partitionBy(by)  # one row per partition
    before = F.sum("_held").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    held = held.select(by, "_part", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_held").over(group).alias("n"))
    rank = F.col("_place") - F.col("_first") + F.col("_before")
    return placed.join(settle(held), [by, "_part"]).withColumn("rank", rank).drop("_place", "_part", "_first", "_before")


def _tier(nodes: DataFrame) -> DataFrame:
    """key, block, n (blocks of the key), node: nodes (key, rank, n, node with field h) rolled up within blocks.

    A level at which a key has a single node left is no level of its tree; the node is passed on unhashed.
    """
    digits = [f"_d{i}" for i in range(DIGITS)]
    size = FAN**DIGITS
    rows = nodes.select(
        "key", F.floor(F.col("rank") / size).cast("long").alias("block"), "n", "node",
        *(F.floor(F.col("rank") / FAN**i).cast("long") % FAN for i in range(DIGITS)),
    ).toDF("key", "block", "n", "node", *digits).repartition("key", "block")
    for level, digit in enumerate(digits):
        run = F.array_sort(F.collect_list(F.struct(digit, "node")))
        rows = rows.groupBy("key", "block", "n", *digits[level + 1 :]).agg(run.alias("_run"))
        run = F.transform("_run", lambda x: x["node"])
        hashed = F.sha2(F.concat_ws("", F.transform("_run", lambda x: x["node"]["h"])), 256)
        real = F.col("n") > FAN**level  # more than one node is left at this level
        rows = rows.select(
            "key", "block", "n", *digits[level + 1 :],
            F.struct(F.when(real, hashed).otherwise(F.col("_run")[0]["node"]["h"]).alias("h"), real.alias("real"), run.alias("run")).alias("node"),
        )
    return settle(rows.withColumn("n", F.ceil(F.col("n") / size).cast("long")))


def _tiers(nodes: DataFrame) -> list[DataFrame]:
    """Tiers from the leaves up, until every key has one block."""
    tiers = [_tier(nodes)]
    while (most := tiers[-1].agg(F.max("n")).first()[0]) is not None and most > 1:
        above = tiers[-1].select("key", F.col("block").alias("rank"), "n", F.struct(F.col("node.h").alias("h"), F.col("block").alias("id")).alias("node"))
        tiers.append(_tier(above))
    return tiers


def _siblings(node: Column, child: Column, i: Column) -> Column:
    """What stands left and right of child ``i`` in its run."""
    hashes = F.transform(node["run"], lambda c: c["h"])
    joined = [F.array_join(F.filter(hashes, keep), "") for keep in (lambda _, j: j < i, lambda _, j: j > i)]
    return F.struct(joined[0].alias("left"), joined[1].alias("right"))


def _spread(blocks: DataFrame, carry: list[str]) -> DataFrame:
    """Blocks (node, path: siblings of the block, nearest first) to the nodes they hold (leaf, path)."""
    reached = F.array(F.struct("node", "path"))
    for _ in range(DIGITS):
        reached = F.flatten(
            F.transform(
                reached,
                lambda x: F.transform(
                    x["node"]["run"],
                    lambda c, i: F.struct(
                        c.alias("node"),
                        F.when(x["node"]["real"], F.concat(F.array(_siblings(x["node"], c, i)), x["path"])).otherwise(x["path"]).alias("path"),
                    ),
                ),
            )
        )
    return blocks.select(*carry, F.explode(reached).alias("_x")).select(*carry, F.col("_x.node").alias("leaf"), F.col("_x.path").alias("path"))


def _descend(tiers: list[DataFrame], top: DataFrame) -> DataFrame:
    """``top`` (key, path, more columns) handed down to the leaves of its keys: leaf, path, more columns."""
    carry = [c for c in top.columns if c != "path"]
    down = top.withColumn("block", F.lit(0).cast("long"))
    for level, tier in reversed(list(enumerate(tiers))):
        reached = _spread(tier.select("key", "block", "node").join(down, ["key", "block"]), carry)
        if level == 0:
            return reached
        down = settle(reached.select(*carry, F.col("leaf.id").alias("block"), "path"))
    raise AssertionError("a tree has a tier")


def manifest(df: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, siblings, folded_root, verified.

    ``df`` has the columns ``FIELDS``. ``siblings`` lists (left, right) from the leaf's run up to
    the root's; ``folded_root`` is what they make of the hash of the row with ``tampered`` as its
    text (without ``tampered``: the text itself), ``verified`` whether that is the root.

    A null field counts as ``-``, a null source is a source of its own in front of all others, and
    null ids stand in front of a source's other rows. Rows that share an id are ordered by their
    leaves; equal rows are leaves of their own, next to each other. Other columns are not read. An
    empty table gives an empty result.
    """
    other = F.col("text") if tampered is None else tampered
    shown = [F.col(f"`{c}`") for c in FIELDS]
    hashed = settle(
        df.select(*(c.alias(n) for c, n in zip(shown, FIELDS)), other.alias("_other"))
        .select("doc_id", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"),
                leaf_hash(*map(F.col, FIELDS)).alias("leaf"),
                F.when(F.col("_other") != F.col("text"), leaf_hash(*map(F.col, FIELDS[:-1]), F.col("_other"))).alias("other"))
    )
    leaves = ranked(hashed, "key", ["doc_id", "leaf"])
    trees = _tiers(leaves.select("key", "rank", "n", F.struct(F.col("leaf").alias("h"), "doc_id", "other").alias("node")))
    # the tree over the sources: its only key is the empty one
    subroots = settle(trees[-1].select(F.lit("").alias("key"), F.col("key").alias("source"), F.col("node.h").alias("h")))
    sources = ranked(subroots, "key", ["source"])
    over = _tiers(sources.select("key", "rank", "n", F.struct("h", "source").alias("node")))
    none = F.array().cast("array<struct<left:string,right:string>>")
    top = over[-1].select("key", F.col("node.h").alias("root"), none.alias("path"))
    reached = _descend(over, top)
    paths = settle(reached.select(F.col("leaf.source").alias("key"), "root", F.col("leaf.h").alias("subroot"), "path"))
    proven = _descend(trees, paths)
    folded = F.aggregate(
        "path", F.coalesce("leaf.other", "leaf.h"), lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256)
    )
    return proven.select(
        F.col("leaf.doc_id").alias("doc_id"), F.col("leaf.h").alias("leaf"), "subroot", "root", F.col("path").alias("siblings"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )


def proof_text(siblings: Column) -> Column:
    """All siblings of a proof in one string, level by level, left to right."""
    return F.array_join(F.transform(siblings, lambda x: F.concat(x["left"], x["right"])), "")
