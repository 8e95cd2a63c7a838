"""A Merkle manifest of a dataset: one tree per group, their roots in a tree above, a proof for each row.

Every level equijoins its nodes with their siblings by computed index (XOR where runs have two nodes, slot offsets otherwise); the
nodes in slot zero then give the parents. Levels are written to the shared folder, so a lost executor repeats one level. Proofs
come down the same levels: a node's path is its siblings and then its parent's path, which is twice the leaves in rows over all
levels, however many there are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, stored

#: An element of a proof: the digests before and after a node in its run, in order, as one text each.
STEP = "struct<before:string,after:string>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value: no two lists of fields read the same."""
    plain = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def climb(nodes: DataFrame, arity: int, name: str) -> list[DataFrame]:
    """The levels over ``nodes`` (_tree, _i, _n, hash; _n nodes in the tree; further columns stay on level 0), lowest first.

    Each level has ``before`` and ``after``, the siblings' digests; the last one holds a single node of every tree. A tree that is
    finished early is carried along unchanged."""
    tall = nodes.agg(F.max("_n")).first()[0] or 0
    levels = []
    while True:
        slot, run = F.col("_i") % arity, F.expr(f"_i div {arity}")
        wide, found = nodes, []
        if tall > 1:
            for shift in range(1, arity):
                to = F.col("_i").bitwiseXOR(F.lit(1).cast("bigint")) if arity == 2 else run * arity + (slot + shift) % arity
                sibling = nodes.where("_n > 1").select(F.col("_tree").alias("_t"), to.alias("_to"), slot.alias("slot"), F.col("hash").alias("h"))
                sibling = sibling.select("_t", "_to", F.struct("slot", "h").alias(f"_s{shift}"))
                wide = wide.join(sibling, (F.col("_tree") == F.col("_t")) & (F.col("_i") == F.col("_to")), "left").drop("_t", "_to")
                found.append(F.col(f"_s{shift}"))
        others = F.array_sort(F.array_compact(F.array(*found))) if found else F.array().cast("array<struct<slot:bigint,h:string>>")
        side = lambda keep: F.array_join(F.transform(F.filter(others, keep), lambda s: s["h"]), "")
        level = wide.select(*nodes.columns, side(lambda s: s["slot"] < slot).alias("before"), side(lambda s: s["slot"] > slot).alias("after"))
        levels.append(stored(level, f"{name}{len(levels)}"))
        if tall <= 1:
            return levels
        up = levels[-1].where(slot == 0)
        nodes = up.select("_tree", run.alias("_i"), F.ceil(F.col("_n") / arity).alias("_n"),
                          F.when(F.col("_n") == 1, F.col("hash")).otherwise(digest(F.col("hash"), F.col("after"))).alias("hash"))
        tall = -(-tall // arity)


def descend(levels: list[DataFrame], arity: int) -> DataFrame:
    """The rows of the lowest level with ``path``, the steps from each node to the root of its tree."""
    none = F.array().cast(f"array<{STEP}>")
    down = levels[-1].withColumn("path", none)
    for level in levels[-2::-1]:
        above = down.select(F.col("_tree").alias("_t"), F.col("_i").alias("_to"), F.col("path").alias("_up"))
        own = F.when(F.col("_n") > 1, F.array(F.struct("before", "after"))).otherwise(none)
        down = level.join(above, (F.col("_tree") == F.col("_t")) & (F.expr(f"_i div {arity}") == F.col("_to")))
        down = down.withColumn("path", F.concat(own, "_up")).drop("_t", "_to", "_up")
    return down


def manifest(leaves: DataFrame, group: str = "lang", key: str = "doc_id", leaf: str = "leaf", arity: int = 2) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``path`` (the steps from the leaf through its group's root to the root).

    Leaves of a group stand by ``key``, nulls first, and rows that share a key by leaf; repeated rows are leaves of their own. Groups
    stand bytewise, null first. While more than one node remains, each run of ``arity`` (the last may be shorter, even one) becomes
    its digest; a lone leaf is its group's root, a lone group's root the root. A null leaf counts as empty text. An empty table gives
    no rows. Other columns pass through; one that bears a new name, or one of ``_tree _i _n hash before after``, is replaced.

    A group of any size is numbered in sorted ranges; nodes are joined by (tree, index), of which no value repeats."""
    own = ("subroot", "root", "path", "_tree", "_i", "_n", "hash", "before", "after", "_g", "_k", "_h")
    kept = [c for c in leaves.columns if c.lower() not in own]
    rows = leaves.select(*kept, F.col(group).alias("_g"), F.col(key).alias("_k"), F.coalesce(leaf, F.lit("")).alias("_h"))
    placed = numbered(rows, "_g", ["_k", "_h"], [F.col("_k"), F.col("_h")], "leaves")
    trees = placed.groupBy("_g").agg((F.max("_i") + 1).alias("_n")).withColumn("_all", F.lit(0))
    trees = numbered(trees, "_all", ["_g"], [F.col("_g")], "trees").select(F.col("_g").alias("_name"), F.col("_i").alias("_tree"), "_n")
    nodes = placed.join(trees, F.col("_g").eqNullSafe(F.col("_name"))).select("_tree", "_i", "_n", F.col("_h").alias("hash"), *kept)
    levels = climb(nodes, arity, "level")
    roots = levels[-1].select("_tree", F.col("hash").alias("subroot"))
    total = F.lit(trees.count()).cast("bigint")
    top = climb(roots.select(F.lit(0).cast("bigint").alias("_tree"), F.col("_tree").alias("_i"), total.alias("_n"), F.col("subroot").alias("hash"), "subroot"), arity, "top")
    ends = descend(top, arity).select(F.col("_i").alias("_of"), "subroot", F.col("path").alias("_top"))
    root = top[-1].select("hash").first()
    below = descend(levels, arity).join(ends, F.col("_tree") == F.col("_of"))
    return below.select(*kept, "subroot", F.lit(root and root.hash).cast("string").alias("root"), F.concat("path", "_top").alias("path"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a path, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")
