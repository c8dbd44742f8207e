"""Merkle manifest of a dataset, and verification of rows against it.

Every row is a leaf, every group of rows (a language) a tree of ``FAN`` children per node, and
the groups' roots are the leaves of the tree above. Leaves get their places by a range partition
over (group, identifier) and sums of the partitions' counts, so no group is sorted in one task.
Places are cut into aligned blocks of ``FAN ** BLOCK_LEVELS`` leaves, whole subtrees of their group's tree; the
roots of the blocks are nodes of the next levels, cut into blocks again, until one node is left.

Within a block the tree is persistent: nodes never change, and a changed leaf makes a new version
that copies the leaf's ancestors and shares all other nodes with the first version. The version's
block root then goes on through the levels above, beside the siblings it meets there.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.spread import lookup_join

from .common import Scratch

# Children of a node, and levels of the tree inside a block.
FAN = 8
BLOCK_LEVELS = 3

# Columns of a leaf, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

PATH = "array<struct<left: string, right: string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value: Column) -> Column:
    """A value as it goes into a leaf: ``-`` if null, else its UTF-8 bytes' number and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    """The digest of a row's values."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


class PersistentTree:
    """A tree over digests whose nodes never change; a version is the number of its root."""

    def __init__(self, leaves: list[str], levels: int) -> None:
        self.digests = list(leaves)
        self.children: list[tuple[int, ...]] = [()] * len(leaves)
        self.levels = levels
        level = list(range(len(leaves)))
        for _ in range(levels):
            level = [self._node(tuple(level[k : k + FAN])) for k in range(0, len(level), FAN)]
        (self.root,) = level

    def _node(self, children: tuple[int, ...]) -> int:
        self.digests.append(digest("".join([self.digests[c] for c in children])))
        self.children.append(children)
        return len(self.digests) - 1

    def _way(self, root: int, at: int) -> list[tuple[int, int]]:
        """From the root down to the leaf in place ``at``: nodes, and which child comes next."""
        way, node = [], root
        for level in reversed(range(self.levels)):
            slot = at // FAN**level % FAN
            way.append((node, slot))
            node = self.children[node][slot]
        return way

    def replaced(self, root: int, at: int, new: str) -> int:
        """The version in which the leaf in place ``at`` has another digest. Only the leaf and
        its ancestors are copied; with the same digest it is the same version."""
        way = self._way(root, at)
        old = self.children[way[-1][0]][way[-1][1]] if way else root
        if self.digests[old] == new:
            return root
        self.digests.append(new)
        self.children.append(())
        node = len(self.digests) - 1
        for above, slot in reversed(way):
            beside = self.children[above]
            node = self._node((*beside[:slot], node, *beside[slot + 1 :]))
        return node

    def siblings(self, root: int, at: int) -> list[tuple[str, str]]:
        """What stands left and right of the leaf's ancestors, from the leaf upwards."""
        out = []
        for node, slot in reversed(self._way(root, at)):
            beside = [self.digests[c] for c in self.children[node]]
            out.append(("".join(beside[:slot]), "".join(beside[slot + 1 :])))
        return out


def numbered(rows: DataFrame, group: str, order: list[str], scratch: Scratch) -> DataFrame:
    """Rows with their place in their group, from 0 (``pos``), and the group's rows (``total``).

    Rows are range-partitioned over (group, order); a partition's rows are numbered among
    themselves, and the counts of the group's partitions before it are added. Rows equal in the
    order are interchangeable, so they may fall either way.
    """
    keys = [group, *order]
    placed = scratch.write(
        rows.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys]).withColumn(
            "part", F.spark_partition_id()
        )
    )
    before = Window.partitionBy(group).orderBy("part")
    counts = placed.groupBy(group, "part").agg(F.count(F.lit(1)).alias("rows_here"))
    offsets = counts.select(
        group,
        "part",
        (F.sum("rows_here").over(before) - F.col("rows_here")).alias("offset"),
        F.sum("rows_here").over(Window.partitionBy(group)).alias("total"),
    )
    here = Window.partitionBy(group, "part").orderBy(*[F.col(k).asc_nulls_first() for k in order])
    return (
        placed.withColumn("nth", F.row_number().over(here) - 1)
        .join(offsets, [group, "part"])
        .withColumn("pos", (F.col("offset") + F.col("nth")).cast("long"))
        .drop("part", "nth", "offset")
    )


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes with their aligned block, and the levels of the block's tree (``levels``, or less
    where the whole tree has less)."""
    deep = sum((F.col("total") > FAN**k).cast("int") for k in range(levels))
    return nodes.withColumn("block", F.floor(F.col("pos") / FAN**levels).cast("long")).withColumn(
        "levels", deep
    )


def _above(blocks: DataFrame, levels: int) -> DataFrame:
    """The roots of blocks as nodes of the next level."""
    return blocks.select(
        "tree",
        F.col("block").alias("pos"),
        F.ceil(F.col("total") / FAN**levels).cast("long").alias("total"),
        F.col("root").alias("node"),
    )


def _ways(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
    """What each node of one block meets on its way to the block's root, and that root."""
    nodes = nodes.sort_values("pos")
    tree = PersistentTree(nodes["node"].tolist(), int(nodes["levels"].iloc[0]))
    ways = [tree.siblings(tree.root, k) for k in range(len(nodes))]
    return nodes[["tree", "block", "total", "pos"]].assign(
        root=tree.digests[tree.root],
        path=[[{"left": a, "right": z} for a, z in way] for way in ways],
    )


def trunk(nodes: DataFrame, levels: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """For nodes (tree, pos, total, node), a written table: the roots (tree, root), and for each
    node its way there (tree, pos, path). One round of blocks for every ``levels`` levels."""
    if (nodes.agg(F.max("total")).first()[0] or 0) <= 1:
        none = F.array().cast(PATH).alias("path")
        return nodes.select("tree", F.col("node").alias("root")), nodes.select("tree", "pos", none)
    blocks = _in_blocks(nodes, levels).groupBy("tree", "block")
    inner = scratch.write(
        blocks.applyInPandas(
            _ways, f"tree string, block long, total long, pos long, root string, path {PATH}"
        )
    )
    firsts = inner.where(F.col("pos") == F.col("block") * FAN**levels)
    roots, ways = trunk(scratch.write(_above(firsts, levels)), levels, scratch)
    above = ways.select("tree", F.col("pos").alias("block"), F.col("path").alias("rest"))
    return roots, inner.join(above, ["tree", "block"]).select(
        "tree", "pos", F.concat("path", "rest").alias("path")
    )


def _leaf_root(key: tuple, leaves: pd.DataFrame) -> pd.DataFrame:
    """The root of one block of leaves."""
    total, levels = int(leaves["total"].iloc[0]), int(leaves["levels"].iloc[0])
    tree = PersistentTree(leaves.sort_values("pos")["leaf"].tolist(), levels)
    return pd.DataFrame([(*key, total, tree.digests[tree.root])], columns=["tree", "block", "total", "root"])


def _verify_block(key: tuple, leaves: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Rows of one block, each claim folded from a version of its own."""
    leaves = leaves.sort_values("pos")
    (up,) = above.itertuples(index=False)
    way = [(step["left"], step["right"]) for step in up.path]
    beyond = "".join([a + z for a, z in way])
    tree = PersistentTree(leaves["leaf"].tolist(), int(leaves["levels"].iloc[0]))
    folded: dict[str, str] = {}  # block roots of versions that have gone on upwards
    proofs, roots = [], []
    for at, claim in enumerate(leaves["claimed"].tolist()):
        version = tree.replaced(tree.root, at, claim) if isinstance(claim, str) else tree.root
        start = tree.digests[version]
        if start not in folded:
            node = start
            for left, right in way:
                node = digest(left + node + right)
            folded[start] = node
        roots.append(folded[start])
        inside = "".join([a + z for a, z in tree.siblings(tree.root, at)])
        proofs.append(digest(inside + beyond))
    return leaves[["id", "leaf"]].assign(
        subroot=up.subroot, root=up.root, proof_sha256=proofs, folded_root=roots,
        verified=[r == up.root for r in roots],
    )


def verify(
    docs: DataFrame,
    claimed: dict[str, Column] | None = None,
    when: Column | None = None,
    columns: tuple[str, ...] = COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``claimed`` gives other values for some columns of the rows for which ``when`` is true (all,
    if None): each such row's digest is put in its leaf's place in a version of its own, and
    ``folded_root`` is the root which that version reaches beside the manifest's siblings; for
    other rows it is folded from the leaf as it is. ``verified`` tells whether that is the root.

    Nulls are values of their own. Groups are ordered by UTF-8 bytes, the null group first;
    rows by identifier, a null one first, and by digest where identifiers are equal. Repeated
    rows are leaves each. An empty table gives an empty result. Other columns play no part.
    """
    scratch = Scratch(docs.sparkSession)
    kept = {c: F.col(f"`{c}`") for c in columns}
    digests = [leaf(list(kept.values())).alias("leaf")]
    if claimed:
        other = leaf(list((kept | claimed).values()))
        digests.append((other if when is None else F.when(when, other)).alias("claimed"))
    else:
        digests.append(F.lit(None).cast("string").alias("claimed"))
    # '-' sorts before '=', so the null group comes first
    group = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("-"))
    leaves = docs.select(group.alias("tree"), F.col(f"`{id_col}`").alias("id"), *digests)
    placed = scratch.write(
        _in_blocks(numbered(leaves, "tree", ["id", "leaf"], scratch), block_levels)
    )
    roots = placed.drop("id", "claimed").groupBy("tree", "block").applyInPandas(
        _leaf_root, "tree string, block long, total long, root string"
    )
    subroots, ways = trunk(scratch.write(_above(roots, block_levels)), block_levels, scratch)
    tops = numbered(
        subroots.select(F.lit("").alias("all"), F.col("tree").alias("group"), "root"),
        "all", ["group"], scratch,
    )
    tops = scratch.write(
        tops.select(F.col("all").alias("tree"), "pos", "total", F.col("root").alias("node"), "group")
    )
    whole, upper = trunk(tops.drop("group"), block_levels, scratch)
    # one row per group: its subroot, its way to the root, and the root
    groups = scratch.write(
        tops.join(upper, ["tree", "pos"])
        .join(whole, "tree")
        .select(
            F.col("group").alias("tree"), F.col("node").alias("subroot"), "root",
            F.col("path").alias("rest"),
        )
    )
    ways = lookup_join(
        ways.select("tree", F.col("pos").alias("block"), "path"), groups, ["tree"], "inner"
    ).select("tree", "block", "subroot", "root", F.concat("path", "rest").alias("path"))
    schema = f"""id {dict(leaves.dtypes)["id"]}, leaf string, subroot string, root string,
                 proof_sha256 string, folded_root string, verified boolean"""
    return (
        placed.groupBy("tree", "block")
        .cogroup(ways.groupBy("tree", "block"))
        .applyInPandas(_verify_block, schema)
        .withColumnRenamed("id", id_col)
    )


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "lang",
) -> DataFrame:
    """The manifest's lists: ``verify`` without claims (id, leaf, subroot, root, proof)."""
    return verify(docs, None, None, columns, id_col, group_col).drop("folded_root", "verified")


def every_third(id_col: str = "doc_id") -> Column:
    """Rows whose identifier, written as a decimal, has an unsigned crc32 divisible by three."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 0
