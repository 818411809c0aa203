"""Whitening of embeddings by the covariance of distinct vectors, weighted by how often they occur.

Equal quantised vectors are grouped first, so copies cost one row and a count. The distinct vectors give the sums, then
the centred second moments, both as partial products per task that Spark adds up. The driver sees width and width squared
numbers, never vectors. Every distinct vector is projected once, and the projections are joined back to the rows; a vector
that many rows share is spread over several tasks for that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import packed_vectors, stored, unpacked

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
#: A vector with more than this share of the rows is joined in pieces of at most that share.
HOT_SHARE = 1 / 256
#: Directions with less than this share of the greatest variance count as without variance.
NO_VARIANCE = 1e-11

Read = Callable[[pa.RecordBatch], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """``n`` times the mean per dimension, and unit eigenvectors (columns) with their variances, greatest first."""

    n: int
    totals: np.ndarray
    vectors: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.variances]


def shifted(x: np.ndarray, n: int, totals: np.ndarray) -> np.ndarray:
    """n * x - totals, exact; Python integers where 64 bits are too few."""
    if x.size and n * int(np.abs(x).max()) + max(map(abs, totals.tolist())) >= 2**63:
        x = x.astype(object)
    return n * x - totals


def squares(d: np.ndarray) -> list[int]:
    """Exact sums of squares per row."""
    if d.size and d.dtype != object and float(np.abs(d).max()) ** 2 * d.shape[1] >= 2**62:
        d = d.astype(object)
    return [int(v) for v in (d * d).sum(1)]


def weighted_totals(vectors: DataFrame, read: Read, width: int, kind: str) -> np.ndarray:
    """Weighted sum of every dimension; ``width`` rows per task, and as many in the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64 if kind == "long" else np.float64)
        for b in batches:
            total += b.column("weight").to_numpy() @ read(b)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["i", "v"])

    rows = vectors.mapInArrow(add, f"i long, v {kind}").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(width, np.int64 if kind == "long" else np.float64)
    for r in rows:
        out[r["i"]] = r["v"]
    return out


def second_moments(vectors: DataFrame, centred: Read, width: int) -> np.ndarray:
    """Weighted sum of the outer products of centred vectors; half a matrix per task, and one in the driver."""
    upper = np.triu_indices(width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            c = centred(b)
            total += (c * b.column("weight").to_numpy()[:, None]).T @ c
        yield pa.RecordBatch.from_arrays([pa.array(upper[0]), pa.array(upper[1]), pa.array(total[upper])], ["i", "j", "v"])

    out = np.zeros((width, width))
    for r in vectors.mapInArrow(add, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def fit(vectors: DataFrame, k: int = COMPONENTS, offset: int = OFFSET) -> Whitening | None:
    """Mean and main directions of distinct vectors (x, weight); None without vectors or variance."""
    size, n = vectors.agg(F.max(F.octet_length("x")), F.sum("weight")).first()
    width, n = (size or 0) // 8, int(n or 0)
    if not width:
        return None
    totals = weighted_totals(vectors, lambda b: unpacked(b.column("x").to_pylist(), width, offset), width, "long")
    covariance = second_moments(
        vectors, lambda b: shifted(unpacked(b.column("x").to_pylist(), width, offset), n, totals).astype(np.float64) / n, width
    ) / n
    variances, directions = np.linalg.eigh(covariance)
    order = np.argsort(-variances, kind="stable")[:k]
    order = order[variances[order] > NO_VARIANCE * variances.max()]
    if not len(order):
        return None
    return Whitening(n, totals, directions[:, order], variances[order], float(np.trace(covariance)))


def project(vectors: DataFrame, fitted: Whitening, offset: int = OFFSET) -> DataFrame:
    """Adds ``whitened`` and the exact ``deviation`` (sum of (n * x - totals)^2) to distinct vectors."""
    w = fitted.vectors / np.sqrt(fitted.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = shifted(unpacked(b.column("x").to_pylist(), len(fitted.totals), offset), fitted.n, fitted.totals)
            z = (d.astype(np.float64) / fitted.n) @ w
            ends = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1])
            yield pa.RecordBatch.from_arrays([
                *b.select(["x", "times", "weight"]).columns, pa.array([Decimal(v) for v in squares(d)], pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(ends, pa.array(z.ravel())),
            ], ["x", "times", "weight", "deviation", "whitened"])

    return vectors.mapInArrow(run, "x binary, times long, weight long, deviation decimal(38,0), whitened array<double>")


def identity_error(projected: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    width = len(fitted.variances)
    read: Read = lambda b: b.column("whitened").flatten().to_numpy().reshape(b.num_rows, width)
    mean = weighted_totals(projected, read, width, "double") / fitted.n
    covariance = second_moments(projected, lambda b: read(b) - mean, width) / fitted.n
    return float(np.abs(covariance - np.eye(width)).max())


def joined_back(rows: DataFrame, projected: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """Every row with its vector's projection. Vectors above ``share`` of the rows, fewer than 1 / share, are split."""
    size = projected.agg(F.sum("times")).scalar()
    pieces = F.ceil(F.col("times") / F.greatest(size * share, F.lit(1.0)))
    hot = projected.filter(F.col("times") > size * share).select(F.col("x").alias("h_x"), pieces.alias("h_pieces"))
    piece = F.pmod("spread", F.coalesce("h_pieces", F.lit(1)))
    dealt = rows.join(F.broadcast(hot), F.col("x") == F.col("h_x"), "left").select("vec_id", "x", piece.alias("piece"))
    number = F.when(F.col("times") > size * share, pieces).otherwise(1)
    copies = projected.select("x", "deviation", "whitened", F.explode(F.sequence(F.lit(0).cast("long"), number - 1)).alias("piece"))
    return dealt.join(copies, ["x", "piece"]).select("vec_id", "deviation", "whitened")


def whiten(
    embeddings: DataFrame, k: int = COMPONENTS, weights: str = "count", scale: int = SCALE, offset: int = OFFSET
) -> tuple[DataFrame, Whitening | None, float]:
    """Rows (vec_id, deviation, whitened), the fitted whitening, and its identity error.

    ``weights``: "count" fits every row, "one" every distinct vector once. Rows whose vector is null or holds null or
    non-finite entries go; a null id stays, rows that repeat stay as often. Shorter vectors count as filled with entries 0.
    Directions without variance give no component, so a table of equal vectors, of empty ones or without any gives an
    empty result, no whitening and an error of 0. Other columns are ignored. Entries must be below 2^53 / scale.
    """
    if weights not in ("count", "one"):
        raise ValueError(f"weights must be count or one, not {weights}")
    rows = stored(packed_vectors(embeddings, ["vec_id"], scale, offset), "whiten-rows")
    weight = F.col("times") if weights == "count" else F.lit(1).cast("long")
    vectors = stored(rows.groupBy("x").agg(F.count(F.lit(1)).alias("times")).withColumn("weight", weight), "whiten-vectors")
    fitted = fit(vectors, k, offset)
    if fitted is None:
        empty = rows.limit(0).select("vec_id", F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"))
        return empty, None, 0.0
    projected = stored(project(vectors, fitted, offset), "whiten-projected")
    return joined_back(rows, projected), fitted, identity_error(projected, fitted)


def component_rows(embeddings: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """One row per embedding and component, with the figures of the fit."""
    rows, fitted, error = whiten(embeddings, k)
    explained = F.array(*(F.lit(v) for v in (fitted.explained if fitted else [0.0])))
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n if fitted else 0).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"), "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
