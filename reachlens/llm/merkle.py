"""Merkle manifest of a dataset, stored in van Emde Boas order.

Every row is a leaf; every 16 consecutive nodes become one of the next level,
first within each source, then over the sources' roots. A tree is cut into
aligned subtrees (blocks) of 16^3 leaves. A block is built in one task and kept
as one row: its nodes stand in van Emde Boas order, that is, the tree is split at
half its height, the top half first and then each lower subtree, all by the same
rule. The place of a node follows from its level and number by arithmetic alone,
and a run of 16 siblings always stands next to its parent. The roots of the
blocks are the leaves of the next, 4096 times smaller tier, which is built alike,
until one node is left.

Proofs go the other way: a tier's siblings of a block's root are handed down to
the block, whose leaves add their own. So no task ever holds more than a block
and one path, and no source needs to fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import sequence
from .common import prepare, stored

#: Children of a node, as a power of two.
FAN_BITS = 4
FAN = 1 << FAN_BITS
#: Levels of a block above its leaves; it has up to FAN ** BLOCK_LEVELS leaves.
BLOCK_LEVELS = 3
DIGEST = 32


def leaf_digest(columns: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the row: each value as its UTF-8 byte count, ``:`` and itself, or ``-`` if null."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


# address arithmetic

def tree_size(levels: int) -> int:
    """Nodes of a whole tree with ``levels`` levels."""
    return (FAN ** levels - 1) // (FAN - 1)


def address(levels: int, depth: int, number: int) -> int:
    """Place of the ``number``-th node at ``depth`` (root: 0) of a tree with ``levels`` levels."""
    base = 0
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        # the lower subtrees have their roots at depth ``top``
        depth -= top
        which = number >> (FAN_BITS * depth)
        base += tree_size(top) + which * tree_size(levels - top)
        number -= which << (FAN_BITS * depth)
        levels -= top
    return base


def joined(digests: list[bytes]) -> bytes:
    """SHA-256 of the digests, concatenated as hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


class Block:
    """Aligned subtree over up to FAN ** BLOCK_LEVELS leaves, ``height`` levels high, in van Emde Boas order."""

    def __init__(self, height: int, count: int, nodes: bytearray | bytes = b""):
        self.height, self.count = height, count
        self.nodes = nodes

    @classmethod
    def build(cls, leaves: list[bytes], height: int) -> Block:
        """From digests; a last run may be short, and even a single node is hashed."""
        block = cls(height, len(leaves))
        last = max(address(height + 1, depth, block.width(depth) - 1) for depth in range(height + 1))
        block.nodes = bytearray((last + 1) * DIGEST)
        row = leaves
        for depth in range(height, -1, -1):
            for i, digest in enumerate(row):
                at = address(height + 1, depth, i) * DIGEST
                block.nodes[at:at + DIGEST] = digest
            row = [joined(row[i:i + FAN]) for i in range(0, len(row), FAN)]
        return block

    def width(self, depth: int) -> int:
        """Nodes at ``depth``."""
        below = FAN ** (self.height - depth)
        return -(-self.count // below)

    def node(self, depth: int, number: int) -> bytes:
        at = address(self.height + 1, depth, number) * DIGEST
        return bytes(self.nodes[at:at + DIGEST])

    def run(self, depth: int, number: int) -> list[bytes]:
        """The node's run: itself and its siblings, in order."""
        first = number >> FAN_BITS << FAN_BITS
        return [self.node(depth, i) for i in range(first, min(first + FAN, self.width(depth)))]


def height_of(leaves: int, whole: int) -> int:
    """Levels of a block in a tree of ``whole`` leaves: all BLOCK_LEVELS if there are more blocks, else up to the single node."""
    if whole > FAN ** BLOCK_LEVELS:
        return BLOCK_LEVELS
    height = 0
    while leaves > FAN ** height:
        height += 1
    return height


def path_bytes(place: int, run: list[bytes]) -> bytes:
    """A step of a path: the node's place in its run, the length of the run, and the siblings."""
    return bytes([place, len(run)]) + b"".join(d for i, d in enumerate(run) if i != place)


def steps(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(path):
        place, size = path[at], path[at + 1]
        at += 2
        yield place, [path[at + i * DIGEST:at + (i + 1) * DIGEST] for i in range(size - 1)]
        at += (size - 1) * DIGEST


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that follows from a leaf and its path."""
    for place, others in steps(path):
        leaf = joined([*others[:place], leaf, *others[place:]])
    return leaf


def proof_digest(path: bytes) -> str:
    return joined([d for _, others in steps(path) for d in others]).hex()


# tiers of blocks

def _cut(text: str) -> list[bytes]:
    """Digests from their concatenated hex text."""
    raw = bytes.fromhex(text)
    return [raw[i:i + DIGEST] for i in range(0, len(raw), DIGEST)]


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with ``nodes`` in van Emde Boas order instead of ``leaves``, and their roots; further columns stay."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            leaves, whole = row["leaves"][0].as_py(), row["whole"][0].as_py()
            leaves = _cut(leaves)
            block = Block.build(leaves, height_of(len(leaves), whole))
            new = {"height": pa.array([block.height], pa.int32()), "count": pa.array([block.count], pa.int64()),
                   "nodes": pa.array([bytes(block.nodes)], pa.binary()), "root": pa.array([block.node(0, 0).hex()])}
            keep = [c for c in batch.schema.names if c != "leaves"]
            yield pa.RecordBatch.from_arrays([*[row[c] for c in keep], *new.values()], names=[*keep, *new])


def _tier(nodes: DataFrame, more: dict[str, str], name: str) -> DataFrame:
    """Stored blocks over ``nodes`` (tree, number, digest, whole, and the columns ``more``: name to type).

    A block gathers at most FAN ** BLOCK_LEVELS rows; of ``more`` it has arrays in leaf order.
    """
    blocks = nodes.withColumn("block", F.shiftright("number", FAN_BITS * BLOCK_LEVELS)).groupBy("tree", "block").agg(
        F.max("whole").alias("whole"), F.sort_array(F.collect_list(F.struct("number", "digest", *more))).alias("rows"))
    blocks = blocks.select("tree", "block", "whole", F.array_join(F.col("rows.digest"), "").alias("leaves"), *[F.col(f"rows.`{c}`").alias(c) for c in more])
    kept = ", ".join(["tree long, block long, whole long", *[f"`{c}` array<{t}>" for c, t in more.items()], "height int, count long, nodes binary, root string"])
    return stored(blocks.mapInArrow(_built, kept), name)


def _tiers(leaves: DataFrame, more: dict[str, str], name: str) -> list[DataFrame]:
    """Tiers of blocks, lowest first, until every tree has one block; each is the next one's leaves, cut by the same rule."""
    tiers = [_tier(leaves, more, f"{name}-0")]
    while True:
        on = tiers[-1].filter(F.col("whole") > FAN ** BLOCK_LEVELS)
        if on.isEmpty():
            return tiers
        up = on.select("tree", F.col("block").alias("number"), F.col("root").alias("digest"), F.ceil(F.col("whole") / F.lit(FAN ** BLOCK_LEVELS)).cast("long").alias("whole"))
        tiers.append(_tier(up, {}, f"{name}-{len(tiers)}"))


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """tree, root: from the tier in which the tree has one block."""
    return reduce(DataFrame.unionByName, [t.filter(F.col("whole") <= FAN ** BLOCK_LEVELS).select("tree", "root") for t in tiers])


def _leaf_paths(block: Block, up: bytes) -> Iterator[bytes]:
    """Path of every leaf of a block whose root has the path ``up``. Leaves of one run share what is above it."""
    rest = b""
    for i in range(block.count):
        if not block.height:
            yield up
            continue
        if i % FAN == 0:
            number, rest = i >> FAN_BITS, []
            for depth in range(block.height - 1, 0, -1):
                rest.append(path_bytes(number & FAN - 1, block.run(depth, number)))
                number >>= FAN_BITS
            rest, run = b"".join(rest) + up, block.run(block.height, i)
        yield path_bytes(i & FAN - 1, run) + rest


def _handed_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of the leaves of blocks."""
    for batch in batches:
        for row in batch.to_pylist():
            first = row["block"] << FAN_BITS * BLOCK_LEVELS
            paths = list(_leaf_paths(Block(row["height"], row["count"], row["nodes"]), row["path"]))
            for k in range(0, len(paths), 256):
                part = paths[k:k + 256]
                yield pa.RecordBatch.from_arrays([pa.array([row["tree"]] * len(part), pa.int64()), pa.array(range(first + k, first + k + len(part)), pa.int64()),
                                                  pa.array(part, pa.binary())], names=["tree", "block", "path"])


def _with_paths(tiers: list[DataFrame], roots: DataFrame) -> DataFrame:
    """The lowest tier's blocks with ``path``, from the block's root up. ``roots``: tree, path of the tree's root."""
    handed = None
    for tier in reversed(tiers):
        above = roots.withColumn("block", F.lit(0).cast("long"))
        if handed is not None:
            above = above.join(tier.filter(F.col("whole") <= FAN ** BLOCK_LEVELS).select("tree"), "tree", "left_semi").unionByName(handed)
        blocks = tier.join(above, ["tree", "block"])
        handed = blocks.select("tree", "block", "height", "count", "nodes", "path").mapInArrow(_handed_down, "tree long, block long, path binary")
    return blocks


class Manifest:
    """Stored trees: ``tiers`` of the sources' blocks and ``top_tiers`` over their roots, all with nodes in van Emde Boas
    order; ``sources`` (source, tree, whole). The lowest tier also has its rows' ids and changed digests."""

    def __init__(self, tiers: list[DataFrame], top_tiers: list[DataFrame], sources: DataFrame, id_type: str):
        self.tiers, self.top_tiers, self.sources, self.id_type = tiers, top_tiers, sources, id_type

    def root(self) -> str | None:
        """Root of the dataset; None for an empty one."""
        row = _roots(self.top_tiers).select("root").first()
        return row and row.root

    def checked(self) -> DataFrame:
        """Per row: id, leaf, subroot, root, proof_sha256, folded_root, verified.

        Siblings come from the stored blocks by address; the changed digest,
        where there is one, takes the leaf's place in the fold.
        """
        subroots = _roots(self.tiers)
        top = _with_paths(self.top_tiers, _roots(self.top_tiers).select("tree", F.lit(b"").alias("path")))
        above = top.select("tree", "block", "height", "count", "nodes", "path").mapInArrow(_handed_down, "tree long, block long, path binary")
        above = above.select(F.col("block").alias("tree"), "path")
        blocks = _with_paths(self.tiers, above).join(subroots.withColumnRenamed("root", "subroot"), "tree")
        # one row: the root of the single top tree
        blocks = blocks.drop("root").crossJoin(F.broadcast(_roots(self.top_tiers).select("root")))
        names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    row = batch.slice(k, 1)
                    get = {c: row[c][0].as_py() for c in ("height", "count", "nodes", "path", "changed", "subroot", "root")}
                    block = Block(get["height"], get["count"], get["nodes"])
                    leaves = [block.node(block.height, i) for i in range(block.count)]
                    proofs, folded = [], []
                    for leaf, other, path in zip(leaves, get["changed"], _leaf_paths(block, get["path"])):
                        proofs.append(proof_digest(path))
                        folded.append(fold(bytes.fromhex(other) if other else leaf, path).hex())
                    n = block.count
                    yield pa.RecordBatch.from_arrays([row["ids"].flatten(), pa.array([x.hex() for x in leaves]), pa.array([get["subroot"]] * n), pa.array([get["root"]] * n),
                                                      pa.array(proofs), pa.array(folded), pa.array([x == get["root"] for x in folded])], names=names)

        return blocks.select("height", "count", "nodes", "path", "changed", "ids", "subroot", "root").mapInArrow(
            check, f"id {self.id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def build(docs: DataFrame, leaf: Column, source: Column, id_col: str = "doc_id", changed: Column | None = None) -> Manifest:
    """Manifest of ``docs``. ``leaf`` is a row's digest (hex), ``changed`` that of what is to be checked instead (null: the leaf).

    Leaves ascend by id within their source, null ids first, equal ids by their
    digest; so repeated rows are leaves of their own and reruns agree. A null
    source is a source of its own, before all others. An empty table has no
    root. Columns other than those named are not looked at.
    """
    prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    changed = F.lit(None).cast("string") if changed is None else changed
    rows = stored(docs.select(F.col(id_col).alias("ids"), source.cast("string").alias("source"), leaf.alias("digest"), changed.alias("changed")), "leaves")
    counts = rows.groupBy("source").agg(F.count("*").alias("whole"))
    sources = stored(sequence(counts, [], ["source"], seq_col="n").select("source", (F.col("n") - 1).alias("tree"), "whole"), "sources")
    placed = sequence(rows, ["source"], ["ids", "digest", "changed"], seq_col="n").withColumn("number", F.col("n") - 1)
    named = placed.join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
    tiers = _tiers(named.select("tree", "number", "digest", "whole", "ids", "changed"), {"ids": id_type, "changed": "string"}, "merkle")
    whole = sources.count()
    top = _roots(tiers).select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("number"), F.col("root").alias("digest"), F.lit(whole).cast("long").alias("whole"))
    return Manifest(tiers, _tiers(top, {}, "merkle-top"), sources, id_type)
