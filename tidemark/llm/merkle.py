"""Merkle manifest of a dataset: a hash tree for each group of rows and one over the groups.

Every row is a leaf. The leaves of a group stand in order of their key; two neighbours and
then two neighbouring nodes become one, a last one alone as well, until one is left, the
group's root. The group roots, in order of the groups, make the dataset's root the same way.

A superblock is 2^bits neighbours of one level. The tree is first reduced from superblock to
superblock, which leaves a thousandth of the nodes each time. On the way back the nodes of a
superblock meet, in one cogrouped exchange, the one row of outer nodes on the way from
it to the root; its task rebuilds the levels inside, joins inner and outer
siblings to proofs and folds them. So no task holds more than a superblock, however large
a group is, and the number of exchanges grows with the logarithm of the rows.

A null group comes first and is a group of its own; a null key comes first in it. Rows
of equal key stand in order of their leaves; repeated rows are leaves of their own.
Fields that are null or empty, texts of any length: see ``leaf``. An empty table gives no
rows. Columns that are not named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import prepared
from tidemark.operators.order import global_positions, ordered_segments
from tidemark.session import stored

BITS = 10
_OUTER = "tree string, pos long, proof string, sides string, subroot string, root string"


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def parent(nodes: Sequence[str]) -> str:
    """Digest of one or more neighbouring nodes, all in lower-case hex."""
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def _levels(nodes: list[str], size: int, bits: int) -> list[list[str]]:
    """All levels of a superblock in a tree level of ``size`` nodes, up to the one node it becomes."""
    levels = [nodes]
    while len(levels) <= bits if size > 1 << bits else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([parent(below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def _path(levels: list[list[str]], at: int) -> tuple[str, str]:
    """Siblings on the way up from a node, and for each level the side: l, r, or - if it is alone."""
    proof, sides = [], []
    for level in levels[:-1]:
        other = at ^ 1
        if other < len(level):
            proof.append(level[other])
        sides.append("-" if other >= len(level) else "l" if other < at else "r")
        at >>= 1
    return "".join(proof), "".join(sides)


def fold(node: str, proof: str, sides: str) -> str:
    """The root that a leaf and its proof lead to."""
    at = 0
    for side in sides:
        if side == "-":
            node = parent([node])
            continue
        other = proof[at : at + 64]
        at += 64
        node = parent([other, node] if side == "l" else [node, other])
    return node


def _reduced(nodes: DataFrame, bits: int) -> DataFrame:
    """Each superblock of (tree, pos, digest, size) as one node of the next level."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        size, pos = int(block["size"].iloc[0]), int(block["pos"].iloc[0])
        root = _levels(block["digest"].tolist(), size, bits)[-1][0]
        return pd.DataFrame({"tree": [block["tree"].iloc[0]], "pos": [pos >> bits], "digest": [root], "size": [-(-size >> bits)]})

    blocks = nodes.select("tree", "pos", "digest", "size", F.shiftright("pos", bits).alias("block"))
    made = blocks.groupBy("tree", "block").applyInPandas(run, "tree string, pos long, digest string, size long")
    return stored(made, "merkle")


def _pyramid(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """``nodes`` and the levels above them, superblock by superblock, up to one node a tree."""
    levels = [nodes]
    size = nodes.agg(F.max("size")).first()[0] or 0
    while size > 1:
        levels.append(_reduced(levels[-1], bits))
        size = -(-size >> bits)
    return levels


def _extended(nodes: DataFrame, outer: DataFrame, bits: int) -> DataFrame:
    """The way to the root of every node below those of ``outer``."""

    def run(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        levels = _levels(block["digest"].tolist(), int(block["size"].iloc[0]), bits)
        up = above.iloc[0]
        paths = [_path(levels, at) for at in range(len(block))]
        return pd.DataFrame(
            {
                "tree": block["tree"].to_numpy(),
                "pos": block["pos"].to_numpy(),
                "proof": [p + up["proof"] for p, _ in paths],
                "sides": [s + up["sides"] for _, s in paths],
                "subroot": up["subroot"],
                "root": up["root"],
            }
        )

    return _cogrouped(nodes.select("tree", "pos", "digest", "size"), outer, bits).applyInPandas(run, _OUTER)


def _cogrouped(nodes: DataFrame, outer: DataFrame, bits: int):
    below = nodes.withColumn("block", F.shiftright("pos", bits)).groupBy("tree", "block")
    return below.cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block"))


def _roots_above(top: DataFrame, bits: int) -> DataFrame:
    """For the one node of every tree, the way to the dataset's root."""
    placed = global_positions(top.select(F.col("tree").alias("name"), F.col("digest")), ["name"], "pos")
    forest = stored(placed.select(F.lit("").alias("tree"), (F.col("pos") - 1).alias("pos"), "digest", "name"), "merkle")
    forest = forest.withColumn("size", F.lit(forest.count()).cast("long"))
    levels = _pyramid(forest, bits)
    nothing = F.lit("")
    outer = levels[-1].select("tree", "pos", nothing.alias("proof"), nothing.alias("sides"), nothing.alias("subroot"), F.col("digest").alias("root"))
    for nodes in levels[-2::-1]:
        outer = _extended(nodes, outer, bits)
    names = forest.select("pos", F.col("name").alias("tree"), F.col("digest").alias("subroot"))
    return outer.drop("tree", "subroot").join(names, "pos").select("tree", F.lit(0).cast("long").alias("pos"), "proof", "sides", "subroot", "root")


def manifest(
    rows: DataFrame, fields: Sequence[str], group: str, key: str, claimed: Mapping[str, Column] | None = None, bits: int = BITS
) -> DataFrame:
    """(key, group, position, leaf, subroot, root, proof, sides, folded_root, verified) of every row.

    ``proof`` is the digests of the siblings one after the other, ``sides`` where each
    stands. ``claimed`` replaces fields by what a holder of the data shows: the claimed leaf is
    folded with the true siblings, and ``verified`` says whether that leads to the root.
    """
    prepared(rows.sparkSession)
    claimed = claimed or {}
    changed = leaf([claimed.get(f, F.col(f)) for f in fields])
    # The group as a text that is never null and sorts as the group does.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = rows.select(F.col(key).alias("key"), tree.alias("tree"), leaf([F.col(f) for f in fields]).alias("digest"), changed.alias("claim"))
    leaves = leaves.withColumn("claim", F.when(F.col("claim") != F.col("digest"), F.col("claim")))
    # Numbered, so that not even equal rows are one key of the range exchange.
    leaves = stored(leaves.withColumn("tie", F.monotonically_increasing_id()), "merkle")
    placed = _positions(leaves)

    levels = _pyramid(placed, bits)
    outer = _roots_above(levels[-1], bits)
    for nodes in levels[-2:0:-1]:
        outer = _extended(nodes, outer, bits)

    def run(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        levels, up = _levels(block["digest"].tolist(), int(block["size"].iloc[0]), bits), above.iloc[0]
        paths = [_path(levels, at) for at in range(len(block))]
        proofs, sides = [p + up["proof"] for p, _ in paths], [s + up["sides"] for _, s in paths]
        shown = block["claim"].where(block["claim"].notna(), block["digest"])
        folded = [fold(*x) for x in zip(shown, proofs, sides)]
        return pd.DataFrame(
            {
                "key": block["key"],
                "tree": block["tree"],
                "position": block["pos"],
                "leaf": block["digest"],
                "subroot": up["subroot"],
                "root": up["root"],
                "proof": proofs,
                "sides": sides,
                "folded_root": folded,
                "verified": [f == up["root"] for f in folded],
            }
        )

    schema = "key string, tree string, position long, leaf string, subroot string, root string, proof string, sides string, folded_root string, verified boolean"
    made = _cogrouped(placed, outer, bits).applyInPandas(run, schema)
    named = F.when(F.col("tree") != "", F.substr("tree", F.lit(2)))
    kept = ["position", "leaf", "subroot", "root", "proof", "sides", "folded_root", "verified"]
    return made.select(F.col("key").cast(rows.schema[key].dataType).alias(key), named.cast(rows.schema[group].dataType).alias(group), *kept)


def _positions(leaves: DataFrame) -> DataFrame:
    """``leaves`` with their place in their tree, from 0, and the size of the tree."""
    parts = ordered_segments(leaves, ["tree", "key", "digest", "tie"])
    runs = parts.groupBy("tree", "_seg").agg(F.min("_idx").alias("_low"), F.count(F.lit(1)).alias("_n"))
    in_tree = Window.partitionBy("tree")  # a row for each range partition that the tree reaches into
    before = in_tree.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree", "_seg", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift"), F.sum("_n").over(in_tree).alias("size")
    )
    return parts.join(runs, ["tree", "_seg"]).select(
        "tree", (F.col("_idx") + F.col("_shift")).alias("pos"), "digest", "size", F.col("key").cast("string"), "claim"
    )
