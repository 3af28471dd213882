"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of bytes. Blocks are sorted within
buckets of their hash and get an integer name, their dense rank: equal blocks
share a name, different blocks never do. Names of adjacent blocks are then named
pairwise, level by level, until each text has one name. Texts are equal exactly
if their names and numbers of blocks are; nothing rests on hash equality.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, packed, prepare, stored, unpacked

#: Buckets in which blocks are sorted; a name is bucket * RANKS + rank.
BUCKETS = 1 << 16
RANKS = 1 << 40
#: A block that makes up over 1 / HOT of all blocks is named apart; there are fewer than HOT such blocks.
HOT = 256
#: The missing second half of a pair at the end of an odd level.
NONE = -(1 << 62)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _first_names(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``name`` instead of ``block``.

    Hot blocks (known from hash counts, pre-aggregated before the shuffle) are
    reduced to their distinct contents, under HOT rows and broadcast. All
    others are shuffled once by bucket and ranked there.
    """
    counts = blocks.groupBy(F.xxhash64("block").alias("h")).count()
    counts = stored(counts, "block-counts")
    n = counts.agg(F.sum("count")).first()[0] or 0
    hot = [r["h"] for r in counts.filter(F.col("count") > max(n / HOT, 8)).select("h").collect()]
    rest = [c for c in blocks.columns if c != "block"]
    is_hot = F.xxhash64("block").isin(hot) if hot else F.lit(False)
    bucket = F.pmod(F.xxhash64("block"), F.lit(BUCKETS))
    ranked = blocks.filter(~is_hot).withColumn("bucket", bucket).select(
        *rest, (F.col("bucket") * RANKS + F.dense_rank().over(
            Window.partitionBy("bucket").orderBy("block"))).alias("name"))
    if not hot:
        return ranked
    names = stored(blocks.filter(is_hot).select("block").distinct().withColumn(
        "name", -1 - F.monotonically_increasing_id()), "hot-names")
    return ranked.unionByName(blocks.filter(is_hot).join(F.broadcast(names), "block").select(*rest, "name"))


def name_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 16384) -> DataFrame:
    """One row per input row: rid, doc_id, sha, blocks, name (stored).

    (blocks, name) is the identity of the normalised text; rid numbers the rows.
    """
    prepare(docs.sparkSession)
    base = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    base = base.select("rid", "doc_id", F.sha2("norm", 256).alias("sha"), F.col("norm").cast("binary").alias("b"))
    base = base.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.octet_length("b") / block_bytes)).cast("int"))
    cut = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: F.struct(i.alias("pos"), F.substring(F.col("b"), i * block_bytes + 1, F.lit(block_bytes)).alias("block")))
    cells = base.select("rid", "doc_id", "sha", "blocks", F.explode(cut).alias("x"))
    cells = cells.select("rid", F.col("x.pos").alias("pos"), "blocks", *[F.when(F.col("x.pos") == 0, F.col(c)).alias(c) for c in ("doc_id", "sha")], F.col("x.block").alias("block"))
    first = stored(_first_names(cells), "level")
    depth = first.agg(F.max("blocks")).first()[0] or 1
    heads = first.filter("pos = 0 and blocks > 1").select("rid", "doc_id", "sha")
    level = first.filter("blocks > 1").select("rid", "blocks", F.col("blocks").alias("n"), "pos", "name")
    done = []
    while depth > 1:
        pairs = stored(level.groupBy("rid", "blocks", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NONE)).alias("right")), "pairs")
        names = stored(pairs.select("left", "right").distinct().withColumn("name", F.monotonically_increasing_id()), "names")
        level = pairs.join(names, ["left", "right"]).select("rid", "blocks", "n", "pos", "name")
        done.append(level.filter("n = 1").select("rid", "blocks", "name"))
        level = level.filter("n > 1")
        depth = (depth + 1) // 2
    out = first.filter("blocks = 1").select("rid", "doc_id", "sha", "blocks", "name")
    if done:
        long = reduce(DataFrame.unionByName, done)
        out = out.unionByName(heads.join(long, "rid").select("rid", "doc_id", "sha", "blocks", "name"))
    return stored(out, "identities")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 16384) -> DataFrame:
    """Groups of equal texts: doc_id, keep_id, group_size, kept, text_sha256, one row per input row.

    Texts are equal if identical after each run of white space became one
    space; null counts as empty. The row with the smallest doc_id stays. Null
    ids come last; of repeated rows with the smallest id exactly one stays.
    An empty table gives no rows.
    """
    named = name_texts(docs, id_col, text_col, block_bytes)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("rid")))
    groups = stored(named.groupBy("blocks", "name").agg(first.alias("keep"), F.count("*").alias("group_size")), "groups")
    return named.join(groups, ["blocks", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("keep.rid")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 16384) -> DataFrame:
    """``docs`` without the rows that ``exact_duplicates`` does not keep; any further columns stay."""
    kept = stored(exact_duplicates(docs, id_col, text_col, block_bytes).filter("kept").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("kid"), F.col("text_sha256").alias("ksha")), "kept")
    rows = docs.select(packed(docs), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("kid"), F.sha2(normalised(F.col(text_col)), 256).alias("ksha"))
    rows = rows.join(kept, ["kid", "ksha"], "left_semi")
    # repeated rows with the same id and text
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy("kid", "ksha").orderBy(F.lit(0)))).filter("copy = 1")
    return unpacked(rows, docs.columns)
