"""Helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize, ship_package

#: White space between words and inside normalised texts: [\x20\x09-\x0D].
SPACES = "[ \\t-\\r]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Shared folder for stored tables; the package on every executor."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and read again."""
    return materialize(df, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns as one struct, so that helper columns cannot clash with them."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(name)


def unpacked(df: DataFrame, columns: list[str], name: str = "row") -> DataFrame:
    return df.select(*[F.col(f"{name}.`{c}`").alias(c) for c in columns])


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest reachable vertex of every vertex that has an edge.

    ``edges`` has long columns ``a`` and ``b``. Alternates the large-star and
    small-star steps (Kiveris et al., 2014) until nothing changes: rounds grow
    with the logarithm of the size, a vertex's neighbours meet only in
    ``min`` aggregates, and every round is written to the shared folder.
    Returns ``v``, ``root``.
    """
    def star(e: DataFrame, small: bool) -> DataFrame:
        if small:
            near = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("w"))
        else:
            near = e.select(F.col("a").alias("u"), F.col("b").alias("w")).unionByName(
                e.select(F.col("b").alias("u"), F.col("a").alias("w")))
        low = near.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m"))
        low = stored(low, f"{name}-low")
        out = near.join(low, "u")
        if small:
            moved = out.select(F.col("w").alias("a"), F.col("m").alias("b")).unionByName(
                low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        else:
            moved = out.filter("w > u").select(F.col("w").alias("a"), F.col("m").alias("b"))
        return moved.filter("a != b").distinct()

    current = stored(edges.select("a", "b").filter("a != b").distinct(), f"{name}-edges")
    last = None
    while True:
        current = stored(star(stored(star(current, False), f"{name}-large"), True), f"{name}-small")
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == last:
            break
        last = seen
    roots = current.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("v"), "root").distinct())
