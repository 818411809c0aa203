"""Hard negatives of anchors, with score bounds along spanning trees of anchors.

Anchors near the same pivot form groups of bounded size, all rows form blocks of bounded size. A block is shipped to a
group only if the group's and the block's middle and radius leave room for a wanted score. Inside, a spanning tree of least
edges joins the anchors of the group. The root scores every candidate; a candidate's score with a child lies within edge
length times candidate norm of its score, or its bounds, with the parent. Only candidates whose bounds overlap what the
child still looks for are scored anew: first for the positives (best of the same label), then for the windows below every
positive's score (best of other labels inside).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import packed_vectors, stored, unpacked

SCALE = 256
BLOCK_ROWS = 1024
GROUP_ANCHORS = 512
SLICE_BLOCKS = 16
CHUNK = 256
PIVOTS = 64

LEAST, GREATEST = -math.inf, math.inf
BLOCK = "block long, rows binary, ids binary, labels binary, m binary, seeds binary, mid binary, radius double, norm double"


@dataclass
class Candidates:
    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    m: np.ndarray

    def __post_init__(self) -> None:
        self.norms = norms(self.m)
        self.most = int(np.abs(self.m).max()) if self.m.size else 0
        self.real = self.m.astype(np.float64)

    def scores(self, a: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Inner products with ``a``; floating point where every sum is exact there."""
        top = self.most * (int(np.abs(a).max()) if a.size else 0) * self.m.shape[1]
        if top >= 2**63:
            raise ValueError("scores must fit into 64 bits")
        m = self.real if top < 2**53 else self.m
        return ((m if at is None else m[at]) @ a.astype(m.dtype)).astype(np.int64)


def norms(m: np.ndarray) -> np.ndarray:
    """Upper bounds of the lengths of rows."""
    return np.sqrt((m.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)


def spanning_tree(m: np.ndarray) -> list[tuple[int, int, float]]:
    """(node, parent, upper bound of the edge's length) of a least spanning tree, parents first; the root, the row next to
    the mean, has parent -1."""
    real = m.astype(np.float64)
    squares = (real**2).sum(1)
    root = int(((real - real.mean(0)) ** 2).sum(1).argmin())
    out, left = [(root, -1, 0.0)], np.ones(len(m), bool)
    left[root] = False
    near, parent = np.full(len(m), np.inf), np.full(len(m), root)
    last = root
    while left.any():
        d = squares + squares[last] - 2 * real @ real[last]
        closer = left & (d < near)
        near[closer], parent[closer] = d[closer], last
        last = int(np.where(left, near, np.inf).argmin())
        left[last] = False
        edge = math.sqrt(float(((real[last] - real[parent[last]]) ** 2).sum())) * (1 + 1e-9)
        out.append((last, int(parent[last]), edge))
    return out


def walk(anchors: np.ndarray, candidates: Candidates, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, places, scores) of the candidates that ``wanted(anchor, lowest, highest)`` asks for, along the tree."""
    tree = spanning_tree(anchors)
    children = np.bincount([p for _, p, _ in tree if p >= 0], minlength=len(tree))
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for node, parent, edge in tree:
        if parent < 0:
            exact = candidates.scores(anchors[node])
            low, high = exact.astype(np.float64), exact.astype(np.float64)
            at = np.flatnonzero(wanted(node, low, high))
            found = exact[at]
        else:
            low, high = bounds[parent]
            slack = edge * candidates.norms
            margin = 1e-9 * (np.abs(low) + np.abs(high)) + 1e-6  # rounding of the bounds themselves
            low, high = low - slack - margin, high + slack + margin
            at = np.flatnonzero(wanted(node, low, high))
            found = candidates.scores(anchors[node], at if 2 * len(at) < len(low) else None)
            found = found if 2 * len(at) < len(low) else found[at]
            low[at] = high[at] = found
            children[parent] -= 1
            if not children[parent]:
                del bounds[parent]
        if children[node]:
            bounds[node] = (low, high)
        yield node, at, found


def kth(values: np.ndarray, k: int) -> float:
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else LEAST


def best(found: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(found) > 4 * k:
        use = np.flatnonzero(found >= kth(found, k))
        return use[np.lexsort((ids[use], -found[use]))[:k]]
    return np.lexsort((ids, -found))[:k]


def packed_blocks(vectors: DataFrame, width: int, n: int, every: int, k: int, block_rows: int) -> tuple[DataFrame, np.ndarray]:
    """One row per block near a pivot, with its middle, radius and norm, and a score that the k-th positive of each of its
    anchors reaches at least (seeds); and the pivots, a bounded sample: any pivots give the same results."""
    few = min(PIVOTS, math.ceil(n / block_rows))
    sample = vectors.orderBy(F.xxhash64("row")).limit(few).select("x").collect()
    pivots = unpacked([r[0] for r in sample], width).astype(np.float64)
    place = nearest(pivots)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(pivot=place(unpacked(list(b["x"]), width)))

    placed = stored(vectors.mapInPandas(near, "row long, vec_id long, label long, x binary, pivot long"), "negatives-placed")
    sizes = placed.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("pieces"))  # one row per pivot
    block = F.col("pivot") + few * F.pmod(F.xxhash64("row"), "pieces")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row")
        c = Candidates(*(rows[x].to_numpy(np.int64) for x in ("row", "vec_id", "label")), unpacked(list(rows["x"]), width))
        seeds = np.full(len(rows), LEAST)
        for i in np.flatnonzero(c.ids % every == 0):
            same = c.labels == c.labels[i]
            same[i] = False
            seeds[i] = kth(c.scores(c.m[i], np.flatnonzero(same)), k)
        mid = c.real.mean(0)
        return pd.DataFrame({
            "block": [rows["block"].iloc[0]], "rows": [c.rows.tobytes()], "ids": [c.ids.tobytes()], "labels": [c.labels.tobytes()],
            "m": [c.m.tobytes()], "seeds": [seeds.tobytes()], "mid": [mid.tobytes()], "radius": [float(norms(c.real - mid).max())],
            "norm": [float(c.norms.max())],
        })

    blocked = placed.join(F.broadcast(sizes), "pivot").withColumn("block", block).drop("pivot", "pieces")
    return stored(blocked.groupBy("block").applyInPandas(pack, BLOCK), "negatives-blocks"), pivots


def nearest(pivots: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    return lambda m: ((pivots**2).sum(1)[None, :] - 2 * m.astype(np.float64) @ pivots.T).argmin(1)


def opened(b) -> Candidates:
    """The candidates of some packed blocks."""
    rows, ids, labels = (np.frombuffer(b"".join(b[x]), "<i8") for x in ("rows", "ids", "labels"))
    return Candidates(rows, ids, labels, np.frombuffer(b"".join(b["m"]), "<i8").reshape(len(rows), -1) if len(rows) else np.zeros((0, 0), np.int64))


def grouped_anchors(blocks: DataFrame, pivots: np.ndarray, anchors: int, every: int, group: int) -> DataFrame:
    """(row, vec_id, label, x, seed, g): anchors near the same pivot share a group of about ``group``."""
    place = nearest(pivots[: max(1, min(len(pivots), anchors // group))])

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(len(b)):
                c = opened(b.iloc[i : i + 1])
                at = np.flatnonzero(c.ids % every == 0)
                yield pd.DataFrame({
                    "row": c.rows[at], "vec_id": c.ids[at], "label": c.labels[at], "x": [v.tobytes() for v in c.m[at]],
                    "seed": np.frombuffer(b["seeds"].iloc[i])[at], "pivot": place(c.m[at]),
                })

    found = stored(blocks.mapInPandas(find, "row long, vec_id long, label long, x binary, seed double, pivot long"), "negatives-anchors")
    sizes = found.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / group).alias("pieces"))  # one row per pivot
    g = F.col("pivot") + PIVOTS * F.pmod(F.xxhash64("row"), "pieces")
    return found.join(F.broadcast(sizes), "pivot").withColumn("g", g).drop("pivot", "pieces")


def open_pairs(anchors: DataFrame, blocks: DataFrame, width: int) -> DataFrame:
    """(g, block, slice): blocks that may hold a score between ``least`` and ``most`` of some anchor of the group, in slices
    of about SLICE_BLOCKS. Only middles and radii meet, in chunks of groups and blocks."""
    def summary(rows: pd.DataFrame) -> pd.DataFrame:
        m = unpacked(list(rows["x"]), width).astype(np.float64)
        mid = m.mean(0)
        return pd.DataFrame({
            "g": [rows["g"].iloc[0]], "mid": [mid.tobytes()], "radius": [float(norms(m - mid).max())], "norm": [float(norms(m).max())],
            "least": [rows["least"].min()], "most": [rows["most"].max()],
        })

    groups = stored(anchors.groupBy("g").applyInPandas(summary, "g long, mid binary, radius double, norm double, least double, most double"), "negatives-groups")
    counts = [max(1, math.ceil(t.count() / CHUNK)) for t in (groups, blocks)]
    chunk = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = groups.withColumn("gc", chunk("g", counts[0])).withColumn("bc", every(counts[1]))
    right = blocks.select("block", "mid", "radius", "norm").withColumn("bc", chunk("block", counts[1])).withColumn("gc", every(counts[0]))

    def meet(g: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if g.empty or b.empty:
            return pd.DataFrame(columns=["g", "block"])
        u, v = (np.frombuffer(b"".join(t["mid"])).reshape(len(t), -1) for t in (g, b))
        middle = u @ v.T
        # a.c = u.v + (a - u).v + a.(c - v)
        room = (g["radius"].to_numpy()[:, None] * norms(v)[None, :] + g["norm"].to_numpy()[:, None] * b["radius"].to_numpy()[None, :]) * (1 + 1e-9)
        room = room + 1e-9 * np.abs(middle) + 1e-3
        i, j = np.nonzero((middle + room >= g["least"].to_numpy()[:, None]) & (middle - room <= g["most"].to_numpy()[:, None]))
        return pd.DataFrame({"g": g["g"].to_numpy()[i], "block": b["block"].to_numpy()[j]})

    pairs = stored(left.groupBy("gc", "bc").cogroup(right.groupBy("gc", "bc")).applyInPandas(meet, "g long, block long"), "negatives-pairs")
    slices = pairs.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / SLICE_BLOCKS).alias("slices"))
    return pairs.join(slices, "g").withColumn("slice", F.pmod(F.xxhash64("block"), "slices"))


def met(anchors: DataFrame, blocks: DataFrame, width: int, run: Callable, schema: str) -> DataFrame:
    """``run(anchors of a group, candidates of a slice of its open blocks)`` over all of them."""
    pairs = stored(open_pairs(anchors, blocks, width), "negatives-slices")
    asks = anchors.join(pairs.select(F.col("g").alias("s_g"), F.col("slice").alias("s")).distinct(), F.col("g") == F.col("s_g"))
    answers = blocks.select("block", "rows", "ids", "labels", "m").join(pairs, "block")

    def both(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        rows = run(a.reset_index(drop=True), opened(b)) if len(a) and len(b) else []
        return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return asks.groupBy("s_g", "s").cogroup(answers.groupBy("g", "slice")).applyInPandas(both, schema)


def ranked(found: DataFrame, by: list[str], score: str, ident: str, row: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), ident, row)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def positives(anchors: DataFrame, blocks: DataFrame, width: int, k: int) -> DataFrame:
    """(row, rank, positive_id, score): the k best other rows of each anchor's label."""
    def run(a: pd.DataFrame, c: Candidates) -> list[tuple]:
        rows, labels, seeds = a["row"].to_numpy(), a["label"].to_numpy(), a["least"].to_numpy()

        def wanted(i: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            same = (c.labels == labels[i]) & (c.rows != rows[i])
            return same & (high >= max(seeds[i], kth(low[same], k)))

        out = []
        for i, at, found in walk(unpacked(list(a["x"]), width), c, wanted):
            for j in best(found, c.ids[at], k):
                out.append((rows[i], c.rows[at[j]], c.ids[at[j]], found[j]))
        return out

    seeded = anchors.withColumn("least", F.col("seed")).withColumn("most", F.lit(GREATEST))
    found = met(seeded, blocks, width, run, "row long, positive_row long, positive_id long, score long")
    return stored(ranked(found, ["row"], "score", "positive_id", "positive_row", k).select("row", "rank", "positive_id", "score"), "negatives-positives")


def window(score: Column, low: int, high: int) -> tuple[Column, Column]:
    """Least and greatest whole score between ``low`` and ``high`` percent of a whole score."""
    whole = lambda x: ((x - F.pmod(x, F.lit(100))) / 100).cast("long")
    return -whole(-low * score), whole(high * score)


def hard_negatives(
    embeddings: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90,
    block_rows: int = BLOCK_ROWS, group: int = GROUP_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score from (vec_id, label, embedding).

    Anchors are rows whose id is divisible by ``every``; positives the best ``n_positives`` other rows of their label;
    negatives the best ``n_negatives`` rows of other labels scoring ``low`` to ``high`` percent of the positive. Scores are
    inner products of floor(256 * x); ties go to the smaller id. Rows with a null id, label, vector or component, or a
    non-finite one, take no part. Rows that repeat an id, wholly or not, are rows of their own: each is a candidate, and
    each an anchor. Shorter vectors count as filled with zeros, empty ones score 0. Fewer rows than asked are returned as
    they are; without anchors or positives the result is empty. Other columns are ignored.
    """
    given = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    packed = packed_vectors(given.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()), ["vec_id", "label"], SCALE)
    # Numbered once and stored, so that rows are told apart in the same way ever after.
    vectors = stored(packed.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "x"), "negatives-rows")
    n, anchors_n, size = vectors.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0), F.max(F.octet_length("x"))).first()
    width = (size or 0) // 8
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not anchors_n:
        return embeddings.sparkSession.createDataFrame([], schema)
    blocks, pivots = packed_blocks(vectors, width, n, every, n_positives, block_rows)
    anchors = stored(grouped_anchors(blocks, pivots, anchors_n, every, group), "negatives-grouped")
    chosen = positives(anchors, blocks, width, n_positives)
    least, most = window(F.col("score"), low, high)
    windows = chosen.withColumn("least", least).withColumn("most", most).filter(F.col("least") <= F.col("most")).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_id", "score", "least", "most"))).alias("w")  # n_positives at most
    )
    asking = stored(anchors.join(windows, "row").select(
        "row", "vec_id", "label", "x", "g", *(F.col(f"w.{f}").alias(f"w_{f}") for f in ("rank", "least", "most")),
        F.array_min("w.least").cast("double").alias("least"), F.array_max("w.most").cast("double").alias("most"),
    ), "negatives-asking")

    def run(a: pd.DataFrame, c: Candidates) -> list[tuple]:
        rows, labels = a["row"].to_numpy(), a["label"].to_numpy()
        spans = [[(int(x), int(y), int(z)) for x, y, z in zip(*s, strict=True)] for s in zip(a["w_rank"], a["w_least"], a["w_most"], strict=True)]

        def wanted(i: int, lowest: np.ndarray, highest: np.ndarray) -> np.ndarray:
            other = c.labels != labels[i]
            out = np.zeros(len(other), bool)
            for _, first, last in spans[i]:
                sure = other & (lowest >= first) & (highest <= last)
                out |= other & (highest >= max(first, kth(lowest[sure], n_negatives))) & (lowest <= last)
            return out

        out = []
        for i, at, found in walk(unpacked(list(a["x"]), width), c, wanted):
            for rank, first, last in spans[i]:
                use = np.flatnonzero((found >= first) & (found <= last))
                for j in use[best(found[use], c.ids[at[use]], n_negatives)]:
                    out.append((rows[i], rank, c.rows[at[j]], c.ids[at[j]], found[j]))
        return out

    found = met(asking, blocks, width, run, "row long, positive_rank int, negative_row long, negative_id long, negative_score long")
    best_rows = ranked(found, ["row", "positive_rank"], "negative_score", "negative_id", "negative_row", n_negatives)
    named = anchors.select("row", F.col("vec_id").alias("anchor_id")).join(chosen.withColumnRenamed("rank", "positive_rank"), "row")
    return best_rows.join(named, ["row", "positive_rank"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"
    )
