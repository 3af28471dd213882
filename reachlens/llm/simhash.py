"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into two 32-bit segments, and there is a table of
fingerprints by each segment. Two fingerprints within two bits agree in one
segment up to one bit, or in the other exactly. So each fingerprint enumerates
the Hamming ball of radius 1 around its first segment, and takes its second
segment as it is, fetches the table's rows with those keys and compares whole
fingerprints. Of two segments one bit apart one has a 0 where the other has a 1;
only flips from 0 to 1 are enumerated, so each pair is met once.

A table bucket with many fingerprints is not compared pair by pair: there the
ball is enumerated in the rest of the fingerprint too, and rows that meet in the
same whole value are linked through the smallest of them. Both ways find
exactly the links of at most two bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, packed, prepare, stored, unpacked

SHINGLE, BITS, SEED = 3, 2, 42
#: Buckets with more fingerprints are linked through shared ball members.
BUCKET = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the lower-cased text's word shingles (unsigned)."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    n = max(1, len(found) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends = ends[min(shingle, len(found)) - 1:]
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        parts = map(joined.__getitem__, map(slice, starts[i:min(n, i + (1 << 16))].tolist(), ends[i:i + (1 << 16)].tolist()))
        h = np.array(list(map(xxhash.xxh64_intdigest, parts, repeat(SEED))), ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, keep: tuple = ()) -> DataFrame:
    """doc_id, fp (signed long) of every row, and the columns ``keep``."""
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col(id_col).alias("doc_id"), F.pandas_udf(of, "long")(F.col(text_col)).alias("fp"), *keep)


def _flips(col, bits: range, zeros_only: bool):
    """Array of ``col`` with one of ``bits`` changed; only from 0 to 1 if ``zeros_only``."""
    every = F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)) for b in bits])
    if zeros_only:
        every = F.filter(every, lambda m: col.bitwiseAND(m) == 0)
    return F.transform(every, lambda m: col.bitwiseXOR(m))


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links a, b between distinct fingerprints (column ``fp``) at most two bits apart.

    All links of buckets of at most ``bucket`` rows; of larger buckets enough to connect what is linked.
    """
    high, low = F.lit(-(1 << 32)), F.lit((1 << 32) - 1)
    fp = F.col("fp")
    table = fps.select("fp", F.explode(F.array(F.struct(F.lit(0).alias("seg"), fp.bitwiseAND(high).alias("key")), F.struct(F.lit(1).alias("seg"), fp.bitwiseAND(low).alias("key")))).alias("x")).select("x.seg", "x.key", "fp")
    table = stored(table, "segments")
    crowded = stored(table.groupBy("seg", "key").count().filter(F.col("count") > bucket).select("seg", "key"), "crowded")
    thin = table.join(crowded, ["seg", "key"], "left_anti")
    near = F.concat(F.array(F.struct(F.lit(0).alias("seg"), fp.bitwiseAND(high).alias("key"))),
                    F.array(F.struct(F.lit(1).alias("seg"), fp.bitwiseAND(low).alias("key"))),
                    F.transform(_flips(fp.bitwiseAND(high), range(32, 64), True), lambda k: F.struct(F.lit(0).alias("seg"), k.alias("key"))))
    probes = fps.select(fp.alias("a"), F.explode(near).alias("x")).select("x.seg", "x.key", "a")
    met = probes.join(thin.withColumnRenamed("fp", "b"), ["seg", "key"])
    same = F.col("a").bitwiseAND(F.when(F.col("seg") == 0, high).otherwise(low)) == F.col("key")
    found = met.filter((F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS) & (~same | (F.col("a") < F.col("b")))).select("a", "b")
    # every link with an end in a crowded bucket: both ends, or one and its neighbour, share a value one bit away or less
    members = stored(table.join(crowded, ["seg", "key"], "left_semi").select("fp").distinct(), "crowded-members")
    around = members.unionByName(_neighbours(members, probes, crowded)).distinct()
    balls = around.select("fp", F.explode(F.concat(F.array(fp), _flips(fp, range(64), False))).alias("value"))
    stars = balls.groupBy("value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").select("value", "a")
    stars = balls.join(stored(stars, "stars"), "value").filter("fp != a").select("a", F.col("fp").alias("b")).distinct()
    return stored(found.unionByName(stars), "links")


def _neighbours(members: DataFrame, probes: DataFrame, crowded: DataFrame) -> DataFrame:
    """Fingerprints whose probes reach a crowded bucket from outside."""
    return probes.join(crowded, ["seg", "key"], "left_semi").select(F.col("a").alias("fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bucket: int = BUCKET, keep: tuple = ()) -> DataFrame:
    """doc_id, fingerprint, component_id of every row, and the columns ``keep``.

    Documents are linked if their fingerprints differ in at most two bits;
    component_id is the smallest doc_id reachable (nulls never count, unless
    there is nothing else). Null and wordless texts have fingerprint zero.
    Copies share a fingerprint and meet as one row from the start. Texts of any
    length are read whole; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    own = stored(fingerprints(docs, id_col, text_col, shingle, keep), "fingerprints")
    distinct = stored(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = stored(connected_components(links(distinct.select("fp"), bucket), "simhash"), "simhash-roots")
    linked = distinct.join(roots, distinct["fp"] == roots["v"]).select("fp", "first", "root")
    low = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = distinct.join(stored(linked.join(stored(low, "lows"), "root").select("fp", "component_id"), "classes"), "fp", "left")
    classes = stored(classes.select("fp", F.coalesce("component_id", "first").alias("component_id")), "fingerprint-classes")
    return own.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *keep)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that with the smallest doc_id.

    A row is told by its id and its text's MD5, as ids may repeat: rows that
    repeat both collapse, and of rows that share that id and a fingerprint one
    stays. Rows without an id go if an id is reachable; else one row of each of
    their fingerprints stays. Columns of any name stay as they are; an empty
    table gives no rows.
    """
    text = F.md5(F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")))
    kid = F.coalesce(F.col(f"row.`{id_col}`").cast("string"), F.lit(""))
    rows = docs.select(packed(docs)).withColumn("kid", kid).withColumn("ktext", text)
    found = near_duplicates(rows, f"row.`{id_col}`", f"row.`{text_col}`", keep=("kid", "ktext"), **options)
    heads = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("kid", "fingerprint").agg(F.min("ktext").alias("ktext"))
    heads = stored(heads.select("kid", "ktext").distinct(), "heads")
    rows = rows.join(heads, ["kid", "ktext"], "left_semi").withColumn("copy", F.row_number().over(Window.partitionBy("kid", "ktext").orderBy(F.lit(0)))).filter("copy = 1")
    return unpacked(rows, docs.columns)
