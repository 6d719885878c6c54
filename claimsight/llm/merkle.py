"""Merkle manifest of a table: blocks of ternary trees in van Emde Boas order.

Every group of rows (source) is a tree over its rows in key order, and the trees' roots are the
leaves of one more tree. A tree is cut into aligned blocks of ``HEIGHT`` levels. The nodes of a
block lie in one byte string in van Emde Boas order: the upper half of the levels first, then
each lower subtree, all of them recursively in the same order. Addresses come from arithmetic
alone, for building as well as for finding siblings. The roots of the blocks are the leaves of
the next round, until each tree has one block. Proofs come from the same blocks, from the top
down: what lies above a block is found once per block, not once per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.session import materialize

FAN = 3
#: Levels of a block below its root: at most FAN ** HEIGHT = 729 leaves.
HEIGHT = 6
DIGEST = 32

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# Van Emde Boas order -----------------------------------------------------------------------


@cache
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Place of every node of a complete tree: one array per level, the root's first.

    The upper ``levels // 2`` levels come first, then the subtrees below them from left to
    right; upper part and subtrees are laid out in the same way.
    """
    if levels == 1:
        return (np.zeros(1, np.int64),)
    upper = levels // 2
    top, low = addresses(upper), addresses(levels - upper)
    size = (FAN ** (levels - upper) - 1) // (FAN - 1)
    first = (FAN**upper - 1) // (FAN - 1) + size * np.arange(FAN**upper, dtype=np.int64)
    return (*top, *[(first[:, None] + below).ravel() for below in low])


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    height = 0
    while FAN**height < leaves:
        height += 1
    return height


def joined(digests: list[str]) -> str:
    """Hash of digests written one after the other as hex text."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class Block:
    """The nodes of a block, read and written at their addresses."""

    def __init__(self, leaves: int, height: int, nodes: bytes | None = None):
        self.places = addresses(height + 1)
        self.height = height
        self.widths = [leaves]
        for _ in range(height):
            self.widths.append(-(-self.widths[-1] // FAN))
        self.widths.reverse()
        size = DIGEST * int(self.places[-1][-1] + 1 if height else 1)
        self.nodes = bytearray(nodes) if nodes is not None else bytearray(size)

    def get(self, level: int, index: int) -> str:
        at = DIGEST * int(self.places[level][index])
        return self.nodes[at : at + DIGEST].hex()

    def put(self, level: int, index: int, digest: str) -> None:
        at = DIGEST * int(self.places[level][index])
        self.nodes[at : at + DIGEST] = bytes.fromhex(digest)

    def run(self, level: int, index: int) -> tuple[int, list[str]]:
        """Place of a node in its run of siblings, and the others of the run."""
        start = index - index % FAN
        stop = min(start + FAN, self.widths[level])
        return index - start, [self.get(level, k) for k in range(start, stop) if k != index]

    def build(self, leaves: list[str]) -> str:
        """Fill all levels from the leaves up; returns the root."""
        for k, leaf in enumerate(leaves):
            self.put(self.height, k, leaf)
        row = leaves
        for level in range(self.height - 1, -1, -1):
            row = [joined(row[k : k + FAN]) for k in range(0, len(row), FAN)]
            for k, digest in enumerate(row):
                self.put(level, k, digest)
        return row[0]

    def path(self, index: int) -> list[tuple[int, list[str]]]:
        """Runs beside a leaf and beside all above it, without the block's root."""
        found = []
        for level in range(self.height, 0, -1):
            found.append(self.run(level, index))
            index //= FAN
        return found


def fold(leaf: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and the siblings on its way up give."""
    for place, others in path:
        leaf = joined([*others[:place], leaf, *others[place:]])
    return leaf


def _packed(path: list[tuple[int, list[str]]]) -> bytes:
    """Place and number of the others in a byte each, then the digests, level by level."""
    return b"".join(
        bytes([place, len(others)]) + bytes.fromhex("".join(others)) for place, others in path
    )


def _unpacked(path: bytes) -> list[tuple[int, list[str]]]:
    found, at = [], 0
    while at < len(path):
        place, n = path[at], path[at + 1]
        at += 2
        found.append((place, [path[at + DIGEST * k : at + DIGEST * (k + 1)].hex() for k in range(n)]))
        at += DIGEST * n
    return found


# Trees as tables ---------------------------------------------------------------------------


def ranked(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """Rows of every tree with ``idx``, their place in it, and ``total``, its leaves.

    A sort by ranges deals out rows of one tree to as many tasks as it takes. A task's rows
    are numbered as they are written; the numbers before a task are summed per tree and task,
    at most one row for each task that a tree meets.
    """
    numbered = materialize(
        rows.repartitionByRange(tree, *order)
        .sortWithinPartitions(tree, *order)
        .withColumn("_at", F.monotonically_increasing_id()),
        name,
    )
    numbered = numbered.withColumn("_task", F.shiftright("_at", 33))
    parts = numbered.groupBy(tree, "_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    of_tree = Window.partitionBy(tree)
    earlier = of_tree.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        tree,
        "_task",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(of_tree).alias("total"),
    )
    return (
        numbered.join(parts, [tree, "_task"])
        .withColumn("idx", F.col("_at") + F.col("_shift"))
        .drop("_at", "_task", "_shift", *order)
    )


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """One round: nodes ``tree, idx, digest, total`` to blocks with their node store.

    What else a node carries (``own``) is kept in the block, in leaf order.
    """
    span = FAN**HEIGHT
    out = T.StructType(
        [
            T.StructField("tree", T.StringType()),
            T.StructField("block", T.LongType()),
            T.StructField("total", T.LongType()),
            T.StructField("leaves", T.LongType()),
            T.StructField("nodes", T.BinaryType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("own", T.ArrayType(nodes.schema["own"].dataType)),
        ]
    )

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("idx")
        total = group["total"][0].as_py()
        block = Block(group.num_rows, min(HEIGHT, height_of(total)))
        root = block.build([d.hex() for d in group["digest"].to_pylist()])
        own = group["own"].combine_chunks()
        return pa.table(
            {
                "tree": group["tree"].slice(0, 1),
                "block": group["block"].slice(0, 1),
                "total": group["total"].slice(0, 1),
                "leaves": pa.array([group.num_rows], pa.int64()),
                "nodes": pa.array([bytes(block.nodes)], pa.binary()),
                "digest": pa.array([bytes.fromhex(root)], pa.binary()),
                "own": pa.ListArray.from_arrays(pa.array([0, group.num_rows], pa.int32()), own),
            }
        )

    dealt = nodes.withColumn("block", F.floor(F.col("idx") / span).cast("long"))
    return materialize(dealt.groupBy("tree", "block").applyInArrow(build, out), name)


def forest(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of all trees, round by round, and the trees' roots ``tree, digest``.

    A round takes 729 nodes to one, so there are log(rows) / log(729) of them.
    """
    span = FAN**HEIGHT
    rounds, tops = [], []
    while True:
        blocks = _blocks(nodes, f"{name}-{len(rounds)}")
        rounds.append(blocks)
        tops.append(blocks.filter(F.col("total") <= span).select("tree", "digest"))
        higher = blocks.filter(F.col("total") > span)
        if higher.isEmpty():
            break
        nodes = higher.select(
            "tree",
            F.col("block").alias("idx"),
            "digest",
            F.ceil(F.col("total") / span).cast("long").alias("total"),
            F.lit(0).alias("own"),
        )
    roots = tops[0]
    for more in tops[1:]:
        roots = roots.unionByName(more)
    return rounds, roots


def _paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """One round down: ways of the blocks' leaves to the root, as blocks of the round below.

    ``above`` holds the way of every block of this round: ``tree, block, way, subroot, root``.
    """
    out = "tree string, block long, way binary, subroot binary, root binary"

    def prove(group: pa.Table) -> pa.Table:
        row = group.to_pylist()[0]
        block = Block(row["leaves"], min(HEIGHT, height_of(row["total"])), row["nodes"])
        n = row["leaves"]
        start = row["block"] * FAN**HEIGHT
        return pa.table(
            {
                "tree": pa.array([row["tree"]] * n, pa.string()),
                "block": pa.array(range(start, start + n), pa.int64()),
                "way": pa.array([_packed(block.path(k)) + row["way"] for k in range(n)], pa.binary()),
                "subroot": pa.array([row["subroot"]] * n, pa.binary()),
                "root": pa.array([row["root"]] * n, pa.binary()),
            }
        )

    rows = blocks.drop("own", "digest").join(above, ["tree", "block"])
    return rows.groupBy("tree", "block").applyInArrow(prove, out)


def _descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Ways of all blocks of the first round, from the ways of the trees' roots.

    ``tops`` has one row per tree: ``tree, way, subroot, root``.
    """
    span = FAN**HEIGHT
    top = tops.withColumn("block", F.lit(0).cast("long"))
    below = None
    for k in range(len(rounds) - 1, -1, -1):
        starts = rounds[k].filter(F.col("total") <= span).select("tree")
        above = top.join(starts, "tree").select("tree", "block", "way", "subroot", "root")
        if below is not None:
            above = above.unionByName(below)
        if k == 0:
            return above
        below = materialize(_paths(rounds[k], above), f"ways-{k}")
    raise ValueError("no rounds")


def leaf_digest(fields: list[Column]) -> Column:
    """Hash of the fields: ``-`` for null, else number of UTF-8 bytes, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    key: str = "doc_id",
    group: str = "source",
    seen: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Every row as a leaf, with its proof and the result of verifying it.

    Gives ``key, leaf, subroot, root, proof_sha256, folded_root, verified`` and ``siblings``,
    the digests of the proof in order. The tree of a group takes its rows by key (null first;
    rows of one key by their leaf); the tree of the roots takes the groups bytewise, null
    first. ``seen`` gives columns as the verifier finds them, as expressions over the row; the
    leaf is then recomputed from these and folded with the siblings of the manifest.

    Null fields are part of the leaf. Repeated rows are leaves of their own. A table without
    rows gives none. Long texts are hashed inside Spark and never leave it. Only the named
    columns are read; other columns may have any names.
    """
    seen = seen or {}
    kind = docs.schema[key].dataType
    kept = leaf_digest([F.col(f) for f in fields])
    found = leaf_digest([seen.get(f, F.col(f)) for f in fields]) if seen else kept
    leaves = docs.select(
        F.when(F.col(group).isNotNull(), F.concat(F.lit("="), F.col(group).cast("string")))
        .otherwise("")
        .alias("tree"),
        F.col(key).alias("key"),
        kept.alias("digest"),
        found.alias("seen"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Hashes are stored before the sort: finding its ranges would compute them once more.
    stored = materialize(
        leaves.select("*", F.struct("key", "seen").alias("own")).drop("seen"), "merkle-leaves"
    )
    # The row number parts equal leaves, so that any number of copies spreads over tasks.
    in_tree = ranked(stored.withColumn("leaf", F.col("digest")), "tree", ["key", "leaf", "row"], "merkle-order")
    rounds, roots = forest(in_tree, "merkle-blocks")

    named = roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", F.struct("tree").alias("own"))
    over_groups = ranked(named, "tree", ["name"], "merkle-groups")
    top_rounds, top_root = forest(over_groups, "merkle-top")
    root = top_root.select(
        "tree", F.lit(b"").alias("way"), F.col("digest").alias("subroot"), F.col("digest").alias("root")
    )
    ways = _descend(top_rounds, root)
    tops = _leaf_ways(top_rounds[0], ways)
    above = _descend(rounds, tops.join(roots.withColumnRenamed("digest", "subroot"), "tree"))
    return _proofs(rounds[0], above, key, kind)


def _leaf_ways(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Ways of the groups: the leaves of the top tree, with the name that each stands for."""
    out = "tree string, way binary, root binary"

    def prove(group: pa.Table) -> pa.Table:
        row = group.to_pylist()[0]
        block = Block(row["leaves"], min(HEIGHT, height_of(row["total"])), row["nodes"])
        names = [o["tree"] for o in row["own"]]
        return pa.table(
            {
                "tree": pa.array(names, pa.string()),
                "way": pa.array([_packed(block.path(k)) + row["way"] for k in range(len(names))], pa.binary()),
                "root": pa.array([row["root"]] * len(names), pa.binary()),
            }
        )

    rows = blocks.drop("digest").join(above, ["tree", "block"])
    return materialize(rows.groupBy("tree", "block").applyInArrow(prove, out), "merkle-ways")


def _proofs(blocks: DataFrame, above: DataFrame, key: str, kind: T.DataType) -> DataFrame:
    """Proof and verification of every leaf of the first round."""
    texts = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    out = T.StructType([T.StructField(key, kind)])
    for name in texts:
        out = out.add(name, T.StringType())
    out = out.add("verified", T.BooleanType()).add("siblings", T.ArrayType(T.StringType()))

    def prove(group: pa.Table) -> pa.Table:
        keys = group["own"].combine_chunks().flatten().field("key")
        row = group.to_pylist()[0]
        block = Block(row["leaves"], min(HEIGHT, height_of(row["total"])), row["nodes"])
        upper = _unpacked(row["way"])
        root, subroot = row["root"].hex(), row["subroot"].hex()
        cols: dict[str, list] = {n: [] for n in (*texts, "verified", "siblings")}
        for k, own in enumerate(row["own"]):
            path = block.path(k) + upper
            siblings = [d for _, others in path for d in others]
            folded = fold(own["seen"].hex(), path)
            values = (block.get(block.height, k), subroot, root, joined(siblings), folded, folded == root, siblings)
            for name, value in zip(cols, values, strict=True):
                cols[name].append(value)
        kinds = {"verified": pa.bool_(), "siblings": pa.list_(pa.string())}
        return pa.table(
            {key: keys} | {n: pa.array(v, kinds.get(n, pa.string())) for n, v in cols.items()}
        )

    rows = blocks.drop("digest").join(above, ["tree", "block"])
    return rows.groupBy("tree", "block").applyInArrow(prove, out)
