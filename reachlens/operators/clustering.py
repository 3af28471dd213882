"""K-means with many starts in one loop (M7).

All starts move together: a round is one pass in which every batch of rows adds
up, for each start, the rows nearest to each of its centres, and one aggregate
of these partial sums. The number of jobs is that of the slowest start's rounds,
not the sum over starts. Only centres and sums (starts x k rows) reach the
driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlens.session import stored_for_fit


def _uniform(h: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) from row hashes and a salt: a 64-bit mix of both."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) + 0.5) / 2.0 ** 53


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances: rows x centres."""
    # a dimension at a time: no rows x centres x dims block and no sums along its short axis
    out = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        out += np.square(x[:, j, None] - centres[None, :, j])
    return out


def _seeds(rows: DataFrame, k: int, starts: int) -> np.ndarray:
    """First centres (starts x k x dims), each drawn with a chance in proportion to the squared distance to those before.

    The draw is a race: the row with the least exponential clock wins, so one
    minimum a start replaces prefix sums over the rows."""
    chosen = None
    for turn in range(k):
        def race(batches: Iterator[pd.DataFrame], chosen=chosen, turn=turn) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if not len(pdf):
                    continue
                x, h = np.stack(pdf["x"].to_numpy()), pdf["h"].to_numpy()
                out = []
                for s in range(starts):
                    weight = np.ones(len(x)) if chosen is None else _distances(x, chosen[s]).min(axis=1)
                    with np.errstate(divide="ignore"):
                        clock = -np.log(_uniform(h, s * k + turn)) / weight
                    i = int(np.argmin(clock))
                    out.append((s, float(clock[i]), x[i].tolist()))
                yield pd.DataFrame(out, columns=["start", "clock", "x"])

        won = rows.mapInPandas(race, "start int, clock double, x array<double>").groupBy("start").agg(F.min_by("x", F.struct("clock", "x")).alias("x")).collect()
        new = np.array([r["x"] for r in sorted(won, key=lambda r: r["start"])], float)[:, None, :]
        chosen = new if chosen is None else np.concatenate([chosen, new], axis=1)
    return chosen


def k_means(df: DataFrame, cols: list[str], key: str, k: int, starts: int = 10, seed: int = 42, max_rounds: int = 300,
            tol: float = 1e-9) -> tuple[DataFrame, np.ndarray, float, int]:
    """Best of ``starts`` runs of Lloyd's rounds from k-means++ seeds.

    Returns the rows with ``cluster``, the centres, the cost (sum of squared
    distances), and the number of rounds. A start is done when its cost falls
    by less than ``tol`` of itself; an empty cluster keeps its centre; equal
    distances go to the smaller cluster number. An empty frame is an error."""
    rows = df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("x"), F.xxhash64(F.col(key), F.lit(seed)).alias("h"))
    rows = stored_for_fit(rows)
    if rows.isEmpty():
        raise ValueError("k-means needs at least one row")
    centres = _seeds(rows, k, starts)
    cost, live, rounds = np.full(starts, np.inf), list(range(starts)), 0
    while live and rounds < max_rounds:
        rounds += 1

        def add_up(batches: Iterator[pd.DataFrame], centres=centres, live=tuple(live)) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if not len(pdf):
                    continue
                x, out = np.stack(pdf["x"].to_numpy()), []
                for s in live:
                    d = _distances(x, centres[s])
                    near = d.argmin(axis=1)
                    d = d[np.arange(len(x)), near]
                    for c in np.unique(near):
                        own = near == c
                        out.append((s, int(c), int(own.sum()), float(d[own].sum()), x[own].sum(axis=0).tolist()))
                yield pd.DataFrame(out, columns=["start", "cluster", "n", "cost", "x"])

        sums = rows.mapInPandas(add_up, "start int, cluster int, n long, cost double, x array<double>").groupBy("start", "cluster").agg(
            F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(F.col("x")[i]).alias(f"x{i}") for i in range(len(cols))]).collect()
        new = dict.fromkeys(live, 0.0)
        for r in sums:
            new[r["start"]] += r["cost"]
            centres[r["start"], r["cluster"]] = np.array([r[f"x{i}"] for i in range(len(cols))]) / r["n"]
        done = [s for s in live if cost[s] - new[s] <= tol * cost[s]] if rounds > 1 else []
        for s in live:
            cost[s] = new[s]
        live = [s for s in live if s not in done]
    best = int(np.argmin(cost))
    dist = F.array(*[sum(((F.col(f"`{c}`") - F.lit(float(v))) * (F.col(f"`{c}`") - F.lit(float(v))) for c, v in zip(cols, centre)), F.lit(0.0)) for centre in centres[best]])
    return df.withColumn("cluster", (F.array_position(dist, F.array_min(dist)) - 1).cast("int")), centres[best], float(cost[best]), rounds
