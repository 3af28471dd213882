"""Named queries: each is a function (spark, sf_dir) -> DataFrame built from the
package operators over the driver's tables, optionally paired with DuckDB SQL
that computes the same result independently.

Doubles are rounded to ``DIGITS`` decimals on both sides so that summation
order does not change the compared values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachlens.session import ensure_checkpoint_dir, ship_package

DIGITS = 6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def prepare(spark: SparkSession) -> None:
    """Session settings every query relies on: UTC wall clock and a
    checkpoint folder (the cluster's ``spark.checkpoint.dir`` when set)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def finish(df: DataFrame, digits: int = DIGITS, per_col: dict | None = None) -> DataFrame:
    per_col = per_col or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), per_col.get(f.name, digits)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def rounded_sql(sql: str, round_cols, digits: int = DIGITS) -> str:
    if not round_cols:
        return sql
    per_col = round_cols if isinstance(round_cols, dict) else {c: digits for c in round_cols}
    repl = ", ".join(f"ROUND({c}, {d}) AS {c}" for c, d in per_col.items())
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"


def register(name: str, sql: str | None = None, round_cols=(), headline: bool = False,
             digits: int = DIGITS):
    """Register a query under ``name`` (lower-case survey ID + short name)."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return finish(fn(spark, sf_dir), digits, round_cols if isinstance(round_cols, dict) else None)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = rounded_sql(sql, round_cols, digits)
        if headline:
            HEADLINE.append(name)
        return fn

    return deco
