"""Approximate nearest neighbours by seeded orders of projections, for more rows than an exact search can take.

Each order sorts the rows by the cells of two random projections and then by a third one, so rows near each other tend to
stand near each other in some order. A row is compared with a fixed window of rows on both sides in every order; the best of
all orders are its neighbours. The work is rows times orders times window, whatever the data looks like: no bucket is ever
compared with itself. Orders are cut into blocks that share a border of one window, so no neighbour is lost between tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.positions import positions
from riskframe.spec import CREDIT, SEED, SMOTE_NEIGHBOURS

ORDERS, WINDOW, BLOCK = 16, 64, 4_096
PROJECTIONS = 3


def weights(columns: Sequence[str], orders: int = ORDERS, seed: int = SEED) -> np.ndarray:
    """Standard normal weight of every column in each order's projections, from digests."""
    def draw(*parts: object) -> float:
        h = hashlib.md5(":".join(map(str, [*parts, seed])).encode()).hexdigest()
        a, b = int(h[:12], 16) / 16**12, int(h[12:24], 16) / 16**12
        return math.sqrt(-2 * math.log(1 - a)) * math.cos(2 * math.pi * b)

    return np.array([[[draw(o, p, c) for c in columns] for p in range(PROJECTIONS)] for o in range(orders)])


def added(terms: Iterator[np.ndarray], n: int) -> np.ndarray:
    """Sum from left to right, as SQL adds."""
    out = np.zeros(n)
    for t in terms:
        out = out + t
    return out


def near_by_projections(
    df: DataFrame, columns: Sequence[str], key: str = CREDIT.key, k: int = SMOTE_NEIGHBOURS, orders: int = ORDERS,
    window: int = WINDOW, seed: int = SEED, block: int = BLOCK,
) -> DataFrame:
    """(key, rank, neighbour, distance): up to ``k`` near other rows of every row; keys are unique, values not null.

    Distances are exact, ties go to the smaller key. Rows in windows that hold fewer than ``k`` others have fewer.
    """
    if window >= block:
        raise ValueError("a block must be larger than the window")
    columns = list(columns)
    w = weights(columns, orders, seed)
    rows = df.select(F.col(key).alias("id"), F.array(*(F.col(c).cast("double") for c in columns)).alias("x"))
    spread = [r or 0.0 for r in df.agg(*(F.var_pop(F.col(c).cast("double")) for c in columns)).first()]
    # Cells are as wide as the projection would spread if columns were independent.
    width = [[math.sqrt(sum(v * s * s for v, s in zip(spread, p, strict=True))) or 1.0 for p in o] for o in w.tolist()]

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.stack(b["x"].to_list()) if len(b) else np.zeros((0, len(columns)))
            for o in range(orders):
                p = [added((x[:, j] * w[o, i, j] for j in range(len(columns))), len(x)) for i in range(PROJECTIONS)]
                yield pd.DataFrame({
                    "o": o, "c1": np.floor(p[0] / width[o][0]).astype(np.int64), "c2": np.floor(p[1] / width[o][1]).astype(np.int64),
                    "p": p[2], "id": b["id"], "x": b["x"],
                })

    kind = df.schema[key].dataType.simpleString()
    spun = rows.mapInPandas(project, f"o int, c1 long, c2 long, p double, id {kind}, x array<double>")
    placed = positions(spun, ["o", "c1", "c2", "p", "id"])
    number, inside = F.floor(F.col("position") / block), F.col("position") % block
    shared = F.array_compact(F.array(number, F.when((inside < window) & (number > 0), number - 1), F.when(inside >= block - window, number + 1)))
    blocks = placed.select("o", "id", "x", "position", F.explode(shared).alias("block"))

    def search(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("position")
        o, ids, x = part["o"].to_numpy(), part["id"].to_numpy(), np.stack(part["x"].to_list())
        own = np.flatnonzero(part["position"].to_numpy() // block == part["block"].iloc[0])
        n = len(part)
        found = np.full((n, 2 * window), np.inf)
        for s in range(1, min(window, n - 1) + 1):
            d = added(((x[s:, j] - x[:-s, j]) ** 2 for j in range(x.shape[1])), n - s)
            d[o[s:] != o[:-s]] = np.inf
            found[:-s, s - 1], found[s:, window + s - 1] = d, d
        out = []
        for i in own:
            at = np.flatnonzero(found[i] < np.inf)
            other = np.where(at < window, i + at + 1, i - (at - window) - 1)
            best = np.lexsort((ids[other], found[i][at]))[:k]
            out.extend((ids[i], ids[other[j]], found[i][at[j]]) for j in best)
        return pd.DataFrame(out, columns=["id", "neighbour", "d2"])

    some = blocks.groupBy("block").applyInPandas(search, f"id {kind}, neighbour {kind}, d2 double")
    merged = some.groupBy("id", "neighbour").agg(F.min("d2").alias("d2"))  # orders times k rows of a key at most
    rank = F.row_number().over(Window.partitionBy("id").orderBy("d2", "neighbour"))
    return merged.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        F.col("id").alias(key), "rank", "neighbour", F.sqrt("d2").alias("distance")
    )
