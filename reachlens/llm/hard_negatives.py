"""Hard negatives by exact matrix products in a residue number system.

Vectors are scaled to integers. A block of rows is multiplied with all anchors
modulo several small primes: residues stay so small that float32 products and
sums are exact, and the signed score comes back by Chinese remaindering. As many
primes are used as the block's norms demand, so scores are exact at any size
that fits a long.

Rows are dealt evenly to blocks by a hash of their number, whatever their label;
the anchors, a stated query set, visit every block. Two passes: the first finds
each anchor's best rows of its own label, the second the best rows of other
labels inside every positive's score band. A block reports only its best few of
each, and windows select among the blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stored

SCALE = 256
#: Rows and anchors multiplied at once.
ROWS, ANCHORS = 8192, 256
#: Numbers (rows x components) that a block may hold.
BLOCK_NUMBERS = 1 << 23
#: Primes under this; residues are at most half as large.
TOP_PRIME = 1024


def primes_below(n: int) -> list[int]:
    """Descending."""
    return [p for p in range(n - 1, 2, -1) if all(p % q for q in range(2, math.isqrt(p) + 1))]


PRIMES = primes_below(TOP_PRIME)[:8]


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Residues between -p/2 and p/2 of whole doubles, as float32."""
    r = np.fmod(x, p)
    half = p // 2
    r[r > half] -= p
    r[r < -half] += p
    return r.astype(np.float32)


class Vectors:
    """Whole-number vectors and their residues, computed once a prime."""

    def __init__(self, x: np.ndarray, cache: dict | None = None, at: slice | np.ndarray = slice(None)):
        self.x, self.cache, self.at = x, {} if cache is None else cache, at

    def part(self, at) -> Vectors:
        """Rows of this matrix that share its residues."""
        return Vectors(self.x, self.cache, at)

    def norm(self) -> float:
        rows = self.x[self.at]
        return math.sqrt(np.square(rows).sum(axis=1).max(initial=0.0)) if rows.size else 0.0

    def modulo(self, p: int) -> np.ndarray:
        if p not in self.cache:
            self.cache[p] = residues(self.x, p)
        return self.cache[p][self.at]


def exact_scores(a: Vectors, b: Vectors) -> np.ndarray:
    """Inner products of all rows of ``a`` and ``b``, as int64. Missing components count as 0."""
    dims = min(a.x.shape[1], b.x.shape[1])
    # Cauchy-Schwarz, with room for the rounding of the norms
    bound = int(a.norm() * b.norm() * (1 + 1e-9)) + 1
    if bound >= 1 << 62:
        raise ArithmeticError("vectors are too long: their scores may not fit a long")
    total, modulus = None, 1
    for p in PRIMES:
        if modulus > 2 * bound + 1:
            break
        # so many products of residues sum up within the 24 bits that float32 holds exactly
        step = (1 << 24) // (p // 2) ** 2
        left, right = a.modulo(p), b.modulo(p)
        r = np.zeros((left.shape[0], right.shape[0]), np.int32)
        for k in range(0, dims, step):
            r += (left[:, k:min(k + step, dims)] @ right[:, k:min(k + step, dims)].T).astype(np.int32) % p
        # next digit of the mixed radix form, between -p/2 and p/2, so that signs come right
        digit = (r if total is None else (r - total % p) * pow(modulus, -1, p)) % p
        digit = digit.astype(np.int64)
        digit[digit > p // 2] -= p
        # sums wrap at 64 bits, which does no harm: the whole sum fits
        total = digit if total is None else total + digit * np.int64(modulus)
        modulus *= p
    return total


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of doubles as floored, scaled rows; shorter ones are filled with 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), int(size.max(initial=0))))
    out[np.arange(out.shape[1]) < size[:, None]] = np.floor(flat * SCALE)
    return out


class _Block:
    """Rows of one block in ascending order of their ids, nulls last."""

    def __init__(self, batches: list[pa.RecordBatch]):
        t = pa.Table.from_batches(batches)
        no_id = t["id"].is_null().to_numpy()
        ids = t["id"].fill_null(0).to_numpy()
        order = np.lexsort((ids, no_id))
        self.ids, self.no_id = ids[order], no_id[order]
        self.label = t["label"].to_numpy()[order]
        self.rows = Vectors(_matrix(t["vector"])[order])

    def id_at(self, i: int):
        return None if self.no_id[i] else int(self.ids[i])


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, earlier places first among equals."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        return at[np.argsort(-scores[at], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")[:k]


def _own_label(block: _Block, anchors: pa.RecordBatch, k: int) -> Iterator[tuple]:
    """The block's best k rows of each anchor's label: (rid, anchor, positive, score)."""
    vectors, labels = Vectors(_matrix(anchors["vector"])), anchors["label"].to_numpy()
    ids, rids = anchors["id"].to_pylist(), anchors["rid"].to_pylist()
    for label in np.unique(labels):
        mine = np.flatnonzero(block.label == label)
        asked = np.flatnonzero(labels == label)
        for some in (asked[i:i + ANCHORS] for i in range(0, len(asked), ANCHORS)):
            held: list[list[tuple]] = [[] for _ in some]
            for part in (mine[i:i + ROWS] for i in range(0, len(mine), ROWS)):
                scores = exact_scores(vectors.part(some), block.rows.part(part))
                for j, a in enumerate(some):
                    keep = np.flatnonzero((block.ids[part] != ids[a]) | block.no_id[part])
                    best = keep[_best(scores[j, keep], k)]
                    # a stable sort keeps earlier, smaller ids before equal scores of later parts
                    held[j] = sorted(held[j] + [(int(scores[j, i]), int(part[i])) for i in best], key=lambda x: -x[0])[:k]
            for a, found in zip(some, held):
                for score, i in found:
                    yield rids[a], ids[a], block.id_at(i), score


def _other_labels(block: _Block, anchors: pa.RecordBatch, k: int, low: int, high: int) -> Iterator[tuple]:
    """The block's best k rows of other labels in each positive's band: (rid, place, anchor, positive, positive score, negative, score)."""
    vectors, labels = Vectors(_matrix(anchors["vector"])), anchors["label"].to_numpy()
    ids, rids, positives = anchors["id"].to_pylist(), anchors["rid"].to_pylist(), anchors["positives"].to_pylist()
    for some in (np.arange(i, min(i + ANCHORS, len(ids))) for i in range(0, len(ids), ANCHORS)):
        held = {(a, j): [] for a in some for j in range(len(positives[a]))}
        # least score that still counts, and the highest: 100 s >= low p and 100 s <= high p in whole numbers
        floor = {(a, j): -(-low * positives[a][j]["score"] // 100) for a, j in held}
        roof = {(a, j): high * positives[a][j]["score"] // 100 for a, j in held}
        for start in range(0, len(block.ids), ROWS):
            part = slice(start, min(start + ROWS, len(block.ids)))
            scores = exact_scores(vectors.part(some), block.rows.part(part))
            for n, a in enumerate(some):
                if not positives[a]:
                    continue
                least = min(floor[a, j] for j in range(len(positives[a])))
                most = max(roof[a, j] for j in range(len(positives[a])))
                near = np.flatnonzero((scores[n] >= least) & (scores[n] <= most) & (block.label[part] != labels[a]))
                near = near[(block.ids[part][near] != ids[a]) | block.no_id[part][near]]
                own = scores[n, near]
                for j in range(len(positives[a])):
                    inside = near[(own >= floor[a, j]) & (own <= roof[a, j])]
                    if len(inside):
                        best = inside[_best(scores[n, inside], k)]
                        have = sorted(held[a, j] + [(int(scores[n, i]), start + int(i)) for i in best], key=lambda x: -x[0])[:k]
                        held[a, j] = have
                        if len(have) == k:  # later rows have larger ids, so an equal score comes too late
                            floor[a, j] = max(floor[a, j], have[-1][0] + 1)
        for (a, j), found in held.items():
            p = positives[a][j]
            for score, i in found:
                yield rids[a], j, ids[a], p["id"], p["score"], block.id_at(i), score


def _in_blocks(kernel, names: list[str], schema: pa.Schema):
    """Arrow function over partitions sorted by (block, is_query): holds a block's rows, then streams its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, block = None, [], None
        for batch in batches:
            numbers = batch["block"].to_numpy()
            query = batch["is_query"].to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((np.diff(numbers) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if numbers[lo] != at:
                    at, rows, block = numbers[lo], [], None
                if not query[lo]:
                    rows.append(part)
                    continue
                if block is None and rows:
                    block, rows = _Block(rows), []
                if block is not None:
                    found = list(kernel(block, part))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), schema.types)], names=names)

    return run


def _blocked(rows: DataFrame, queries: DataFrame, blocks: int) -> DataFrame:
    """Rows of each block, then all queries, in one partition a block."""
    every = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return rows.withColumn("is_query", F.lit(False)).unionByName(every.withColumn("is_query", F.lit(True)), allowMissingColumns=True) \
        .repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "is_query")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """Hard negatives of every anchor's positives.

    Returns anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for each anchor and each of its first ``positives`` other
    rows of the same label, the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score.
    First means higher integer inner product of floor(256 * x), ties by smaller
    id (null ids last).

    Rows with a null label, a null vector, or a null or non-finite component
    take no part. A missing component counts as 0, so vectors may differ in
    length. Rows with the anchor's own id are not its other rows; an anchor
    that occurs several times has its rows several times. A null id is no
    anchor. Scores that may not fit a long are an error. An empty table gives
    no rows; other columns are not looked at.
    """
    prepare(vectors.sparkSession)
    label = F.col("label") if label is None else label
    base = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"), is_anchor.alias("anchor"))
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x * SCALE) < float("inf")), F.lit(False)))
    base = stored(base.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    n, dims = base.agg(F.count("*"), F.max(F.size("vector"))).first()
    # the square root balances the rows a task holds against the copies of the anchors
    blocks = max(math.ceil(math.sqrt((n or 0) / ANCHORS)), math.ceil((n or 0) * max(dims or 0, 1) / BLOCK_NUMBERS), 1)
    rows = base.select(F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int").alias("block"), "id", "label", "vector")
    anchors = base.filter("anchor and id is not null").select("rid", "id", "label", "vector")

    names = ["rid", "anchor_id", "positive_id", "score"]
    schema = pa.schema([(x, pa.int64()) for x in names])
    found = _blocked(rows, anchors, blocks).mapInArrow(
        _in_blocks(lambda b, a: _own_label(b, a, positives), names, schema), ", ".join(f"{x} long" for x in names))
    order = [F.col("score").desc(), F.col("positive_id").asc_nulls_last()]
    first = found.withColumn("place", F.row_number().over(Window.partitionBy("rid").orderBy(*order))).filter(F.col("place") <= positives)
    bands = first.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("place", F.col("positive_id").alias("id"), "score"))).alias("positives"))
    asked = stored(anchors.join(bands, "rid"), "anchors")

    names = ["rid", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    schema = pa.schema([(x, pa.int64()) for x in names])
    near = _blocked(rows, asked, blocks).mapInArrow(
        _in_blocks(lambda b, a: _other_labels(b, a, negatives, low, high), names, schema), ", ".join(f"{x} long" for x in names))
    order = [F.col("negative_score").desc(), F.col("negative_id").asc_nulls_last()]
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("rid", "place").orderBy(*order))).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
