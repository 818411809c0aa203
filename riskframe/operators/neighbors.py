"""Exact k nearest neighbours, block against block.

Equal vectors are collapsed first. A bounded sample of vectors serves as pivots; vectors of the same pivot stand together in
blocks of bounded size, packed as one row each, with their centre and radius. Searching the own block gives each vector an
upper bound on its k-th distance. Then groups of blocks meet each other, one task a pair of groups: a vector visits only
blocks whose ball reaches into its bound, matrix products leave out what is surely beyond it, and the bound shrinks on the
way. What is left is measured exactly: distances add up squared differences column by column; ties go to the smaller key.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.draws import digest, prefix_share
from riskframe.operators.skew import salted_join
from riskframe.session import cut_lineage
from riskframe.spec import CREDIT, SEED, SMOTE_NEIGHBOURS

MAX_PIVOTS = 4_096
BLOCK = 2_048
CHUNK = 65_536
#: Blocks, and groups of blocks, that a table is cut into if it has so many rows.
PARTS = 12
PACKED = "block long, names array<string>, copies binary, vecs binary, limits binary, centre binary, radius double"


def distinct_vectors(df: DataFrame, columns: Sequence[str], key: str, k: int) -> DataFrame:
    """(vec, ids): each different vector with the k + 1 smallest of its keys.

    Ranking is limited to k + 1 rows per vector in every task before the shuffle, so a vector with
    very many copies stays small.
    """
    rows = df.select(F.array(*(F.col(c).cast("double") for c in columns)).alias("vec"), F.col(key).alias("id"))
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def pick_pivots(vectors: DataFrame, n: int, wanted: int, seed: int) -> np.ndarray:
    """The ``wanted`` vectors of ``n`` with the smallest digests.

    Only about twice as many pass the filter, so the ordering is over a few rows however many tasks there are.
    """
    drawn = vectors.select("vec", digest(F.element_at("ids", 1), "pivot", seed).alias("draw"))
    if n > 4 * wanted + 64:
        drawn = drawn.filter(prefix_share(F.col("draw"), (2 * wanted + 32) / n))
    rows = drawn.orderBy("draw").limit(wanted).select("vec").collect()
    return np.array([r["vec"] for r in rows], dtype="float64")


def pieces(n: int, size: int = 1_024) -> Iterator[slice]:
    return (slice(i, i + size) for i in range(0, n, size))


def products(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of rows of x and y by a matrix product, and how far each row of them may be off."""
    a, b = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
    out = x @ y.T
    out *= -2
    out += a[:, None]
    out += b[None, :]
    return out, 4 * (x.shape[1] + 8) * np.finfo("float64").eps * (a + b.max())


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances row by row, added up column by column."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += (x[:, j] - y[:, j]) ** 2
    return out


def bounds(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """Upper bounds on the squared distance of the (k + 1)-th row of y from the rows of x."""
    out = np.full(len(x), np.inf)
    if len(y) > k:
        for s in pieces(len(x)):
            d, off = products(x[s], y)
            out[s] = np.partition(d, k, axis=1)[:, k] + off
    return out


class Best:
    """The k + 1 smallest (distance, place of the key) of every row of a block, and the bound they set."""

    def __init__(self, limits: np.ndarray, k: int):
        self.limits, self.k = limits.copy(), k
        self.d2 = np.full((len(limits), k + 1), np.inf)
        self.place = np.full((len(limits), k + 1), np.iinfo("int64").max)

    def add(self, row: np.ndarray, d2: np.ndarray, place: np.ndarray) -> None:
        known = np.unique(row)
        row = np.concatenate([row, np.repeat(known, self.k + 1)])
        d2, place = np.concatenate([d2, self.d2[known].ravel()]), np.concatenate([place, self.place[known].ravel()])
        order = np.lexsort((place, d2, row))
        row = row[order]
        at = np.arange(len(row)) - np.searchsorted(row, row)
        first = at <= self.k
        self.d2[row[first], at[first]], self.place[row[first], at[first]] = d2[order[first]], place[order[first]]
        self.limits[known] = np.minimum(self.limits[known], self.d2[known, self.k])


def meet(best: Best, x: np.ndarray, y: np.ndarray, copies: np.ndarray, places: np.ndarray, centre: np.ndarray, radius: float) -> int:
    """Bring the keys of one block of vectors y into the best of x; returns how many pairs were measured exactly."""
    away, off = products(x, centre[None, :])
    reach = radius + np.sqrt(best.limits)
    near = np.flatnonzero(~(away[:, 0] - off > reach**2 * (1 + 1e-9)))
    starts, measured = np.cumsum(copies) - copies, 0
    for s in pieces(len(near)):
        at = near[s]
        d, off = products(x[at], y)
        limits = best.limits[at]
        if len(y) > best.k and not (known := np.isfinite(limits)).all():
            limits = np.where(known, limits, np.inf)
            limits[~known] = np.partition(d[~known], best.k, axis=1)[:, best.k] + off[~known]
        row, col = np.nonzero(~(d > (limits + off)[:, None]))
        exact = squared(x[at[row]], y[col])
        measured += len(row)
        use = exact <= best.limits[at[row]]
        row, col, exact = at[row[use]], col[use], exact[use]
        if len(row):
            times = copies[col]
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            best.add(np.repeat(row, times), np.repeat(exact, times), places[np.repeat(starts[col], times) + step])
    return measured


def nearest(df: DataFrame, columns: Sequence[str], key: str = CREDIT.key, k: int = SMOTE_NEIGHBOURS,
            seed: int = SEED, max_pivots: int = MAX_PIVOTS, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(key, rank, neighbour, distance) for the k nearest other rows of every row; keys are unique."""
    columns = list(columns)
    width = len(columns)
    # Read several times below; the checkpoint also survives lost executors.
    vectors = cut_lineage(distinct_vectors(df, columns, key, k).select("vec", F.col("ids").cast("array<string>").alias("ids")))
    n, held_keys = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()
    if held_keys <= k:
        raise ValueError(f"{held_keys} rows are too few for {k} neighbours")
    size = min(block, max(256, math.ceil(n / PARTS)))
    pivots = pick_pivots(vectors, n, max(1, min(max_pivots, n // size)), seed)
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(pivots)  # at most MAX_PIVOTS vectors

    def assign(frames):
        for pdf in frames:
            if len(pdf):
                x = np.stack(pdf["vec"].to_numpy())
                yield pdf.assign(cell=np.concatenate([products(x[s], shared.value)[0].argmin(axis=1) for s in pieces(len(x))]))

    placed_schema = "vec array<double>, ids array<string>, cell int"
    placed = cut_lineage(vectors.mapInPandas(assign, placed_schema))

    # One row per pivot. A crowded cell is cut into several blocks.
    blocks = np.zeros(len(pivots), "int64")
    for r in placed.groupBy("cell").count().collect():
        blocks[r["cell"]] = -(-r["count"] // size)
    layout = spark.sparkContext.broadcast((blocks, np.cumsum(blocks) - blocks))
    total = int(blocks.sum())
    groups = max(min(total, PARTS), math.ceil(total * size / chunk))

    def number(frames):
        """Put every vector into a block of its cell."""
        count, first = layout.value
        for pdf in frames:
            if len(pdf):
                spread = pd.util.hash_array(pdf["ids"].str[0].to_numpy(dtype=object)) >> np.uint64(8)
                cell = pdf["cell"].to_numpy()
                yield pdf[["vec", "ids"]].assign(block=first[cell] + (spread % count[cell].astype("uint64")).astype("int64"))

    def pack(pdf):
        x = np.stack(pdf["vec"].to_numpy())
        centre = x.mean(axis=0)
        copies = pdf["ids"].str.len().to_numpy(dtype="int64")
        radius = float(np.sqrt(squared(x, np.broadcast_to(centre, x.shape)).max()) * (1 + 1e-9))
        return pd.DataFrame({
            "block": [pdf["block"].iloc[0]], "names": [np.concatenate(pdf["ids"].to_numpy())], "copies": [copies.tobytes()],
            "vecs": [x.tobytes()], "limits": [bounds(x, x, k).tobytes()], "centre": [centre.tobytes()], "radius": [radius],
        })

    packed = cut_lineage(placed.mapInPandas(number, "vec array<double>, ids array<string>, block long").groupBy("block").applyInPandas(pack, PACKED))

    def search(asks, answers):
        """The k + 1 best keys for every vector of some blocks among the vectors of other blocks, its own copies included."""
        parts = [pd.DataFrame({"qid": [], "nid": [], "d2": []}, dtype="object")]
        if not len(asks) or not len(answers):
            return parts[0]
        names = np.concatenate([np.asarray(x, dtype=object) for x in answers["names"]])
        order = np.argsort(names)
        names, places = names[order], np.argsort(order)
        held, done = [], 0
        for a in answers.itertuples():
            held.append((np.frombuffer(a.vecs).reshape(-1, width), np.frombuffer(a.copies, "int64"), places[done : done + len(a.names)], np.frombuffer(a.centre), a.radius))
            done += len(a.names)
        centres = np.array([h[3] for h in held])
        for q in asks.itertuples():
            x = np.frombuffer(q.vecs).reshape(-1, width)
            copies = np.frombuffer(q.copies, "int64")
            best = Best(np.frombuffer(q.limits), k)
            for i in products(np.frombuffer(q.centre)[None, :], centres)[0][0].argsort():
                meet(best, x, *held[i])
            row, at = np.nonzero(np.isfinite(best.d2))
            own = np.asarray(q.names, dtype=object)[np.cumsum(copies) - copies]
            parts.append(pd.DataFrame({"qid": own[row], "nid": names[best.place[row, at]], "d2": best.d2[row, at]}))
        return pd.concat(parts[1:], ignore_index=True)

    other = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    own_group = (F.col("block") % groups).cast("int")
    asks = packed.select(own_group.alias("asking"), other.alias("asked"), "names", "copies", "vecs", "limits", "centre")
    answers = packed.select(other.alias("asking"), own_group.alias("asked"), "names", "copies", "vecs", "centre", "radius")
    place = ["asking", "asked"]
    found = asks.groupBy(*place).cogroup(answers.groupBy(*place)).applyInPandas(search, "qid string, nid string, d2 double")
    best = Window.partitionBy("qid").orderBy("d2", "nid")
    top = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)

    # Every row takes over the list of its vector, without itself.
    owners = row_owners(df, columns, key)
    own_rank = Window.partitionBy("id").orderBy("d2", "nid")
    listed = owners.join(top, "qid").filter(F.col("id") != F.col("nid"))
    ranked = listed.withColumn("rank", F.row_number().over(own_rank)).filter(F.col("rank") <= k)
    return ranked.select(
        F.col("id").alias(key), F.col("rank").cast("int").alias("rank"), F.col("nid").alias("neighbour"),
        F.sqrt("d2").alias("distance"),
    )


def row_owners(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """(id, qid): every row with the smallest key among its copies; very frequent vectors are salted."""
    rows = df.select(
        F.array(*(F.col(c).cast("double") for c in columns)).alias("vec"), F.col(key).cast("string").alias("id")
    )
    first = rows.groupBy("vec").agg(F.min("id").alias("qid"), F.count(F.lit(1)).alias("n"))
    copied = first.filter(F.col("n") > 1).select("vec", "qid")
    joined = salted_join(rows, copied, "vec", "id")
    return joined.select("id", F.coalesce("qid", "id").alias("qid"))
