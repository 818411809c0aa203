"""Exact top-k inner products with block-at-a-time pruning.

Vectors near the same pivot stand in document-range blocks of bounded size. A block keeps its forward index (ids and
components) and the least and greatest value of each component; their products with a query, summed over the components,
bound every score inside. The queries of a block first score their own block, which gives each a k-th score to beat.
Then groups of queries meet shards of blocks: every query takes the blocks of the shard in the order of its own bounds and
stops where they fall below its k-th score. Queries that take the same block at the same step are scored together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import stored

BLOCK_ROWS = 1024
SHARD_BLOCKS = 32
GROUP_QUERIES = 1024
PIVOTS = 64

LEAST = np.iinfo(np.int64).min
BLOCK = "block long, ids array<long>, nums array<long>, rows array<array<long>>, queries array<long>, kth array<long>"


def quantised(embedding: Column) -> Column:
    """floor(256 * x) of every component, x as double; null for vectors that take no part."""
    whole = embedding.isNotNull() & F.forall(embedding, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.when(whole, F.transform(embedding, lambda x: F.floor(x.cast("double") * 256)))


def matrix(rows, width: int | None = None) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    width = max((len(r) for r in rows), default=0) if width is None else width
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : min(width, len(r))] = r[:width]
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T; in floating point where every sum is exact there."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k highest, ties to the smaller id."""
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def blocks_of(vectors: DataFrame, every: int, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per block: ids, vectors, and its queries with the k-th score each has inside the block (LEAST: fewer others)."""
    # A bounded sample; any pivots give the same results.
    pivots = matrix([r[0] for r in vectors.orderBy(F.xxhash64("num")).limit(PIVOTS).select("v").collect()])
    if not len(pivots):
        pivots = np.zeros((1, 0), np.int64)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            m = matrix(b["v"], pivots.shape[1]).astype(np.float64)
            near = ((pivots.astype(np.float64) ** 2).sum(1)[None, :] - 2 * m @ pivots.T.astype(np.float64)).argmin(1)
            yield b.assign(pivot=near)

    placed = stored(vectors.mapInPandas(nearest, "num long, vec_id long, v array<long>, pivot long"), "topk-placed")
    sizes = placed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"))
    pieces = F.ceil(F.col("n") / block_rows)
    blocked = placed.join(F.broadcast(sizes), "pivot").withColumn("block", F.col("pivot") + PIVOTS * F.pmod(F.xxhash64("num"), pieces))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("num")
        ids, m = rows["vec_id"].to_numpy(), matrix(rows["v"])
        queries = np.flatnonzero(ids % every == 0)
        kth = []
        for q in queries:
            score = np.delete(products(m[q : q + 1], m)[0], q)
            kth.append(int(np.partition(score, len(score) - k)[len(score) - k]) if len(score) >= k else LEAST)
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "ids": [ids], "nums": [rows["num"].to_numpy()], "rows": [list(rows["v"])], "queries": [rows["num"].to_numpy()[queries]], "kth": [kth]})

    return stored(blocked.groupBy("block").applyInPandas(pack, BLOCK), "topk-blocks")


def block_bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Bound of every query (row) for every block (column): positive components meet the greatest values."""
    return products(np.maximum(queries, 0), high) + products(np.minimum(queries, 0), low)


def search(nums: np.ndarray, queries: np.ndarray, kth: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int):
    """(query's number, vec_id, score) of the best k per query in these blocks (ids, numbers, vectors) that reach the
    query's k-th score; blocks scored."""
    bounds = block_bounds(queries, np.array([m.max(0) for _, _, m in blocks]), np.array([m.min(0) for _, _, m in blocks]))
    order = np.argsort(-bounds, axis=1, kind="stable")
    floor_ = kth.copy()
    held_ids: list[np.ndarray] = [np.zeros(0, np.int64)] * len(nums)
    held: list[np.ndarray] = [np.zeros(0, np.int64)] * len(nums)
    scored, going = 0, np.arange(len(nums))
    for step in range(len(blocks)):
        going = going[bounds[going, order[going, step]] >= floor_[going]]  # no later block has a greater bound
        if not len(going):
            break
        for b in np.unique(order[going, step]):
            open_ = going[order[going, step] == b]
            block_ids, block_nums, rows = blocks[b]
            scored += len(open_)
            scores = products(queries[open_], rows)
            for place, q in enumerate(open_):
                use = (scores[place] >= floor_[q]) & (block_nums != nums[q])
                if use.any():
                    held_ids[q], held[q] = best(np.concatenate([held[q], scores[place][use]]), np.concatenate([held_ids[q], block_ids[use]]), k)
                    if len(held[q]) == k:
                        floor_[q] = max(floor_[q], held[q][-1])
    return [(int(nums[q]), int(i), int(s)) for q in range(len(nums)) for i, s in zip(held_ids[q], held[q], strict=True)], scored


def top_inner_products(embeddings: DataFrame, k: int = 5, every: int = 50, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for every row whose id is divisible by ``every``.

    Vectors that are null, hold null or non-finite components or have no id take no part; shorter vectors count as
    filled with zeros, empty ones score 0. Rows that repeat an id, wholly or not, are rows of their own: each is a candidate
    for every other row, and each such query is answered. Ties go to the smaller id; with fewer than k others all are
    returned. An empty table gives an empty result; other columns are ignored.
    """
    vectors = stored(
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("v"))
        .filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull()).select(F.monotonically_increasing_id().alias("num"), "vec_id", "v"),
        "topk-vectors",
    )
    blocks = blocks_of(vectors, every, k, block_rows)
    # One row per block: neighbouring blocks, of the same pivot mostly, make up a shard and a group of queries.
    place = F.row_number().over(Window.orderBy(F.col("block") % PIVOTS, "block")) - 1
    group_blocks = max(1, GROUP_QUERIES * every // block_rows)
    places = blocks.select("block", F.floor(place / SHARD_BLOCKS).alias("shard"), F.floor(place / group_blocks).alias("g"))
    total = places.count()
    shards, groups = (max(1, math.ceil(total / x)) for x in (SHARD_BLOCKS, group_blocks))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    placed = blocks.join(places, "block")
    asks = placed.select("g", F.explode(F.arrays_zip("queries", "kth")).alias("q"), "nums", "rows").select(
        "g", F.col("q.queries").alias("num"), F.col("q.kth").alias("kth"),
        F.element_at("rows", F.array_position("nums", F.col("q.queries")).cast("int")).alias("v"),
    ).withColumn("shard", numbers(shards))
    answers = placed.select("shard", "ids", "nums", "rows").withColumn("g", numbers(groups))

    def run(ask: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(ask) and len(answer):
            width = max(max(map(len, ask["v"])), max(len(r) for rows in answer["rows"] for r in rows))
            forward = [(np.asarray(i), np.asarray(n), matrix(r, width)) for i, n, r in zip(answer["ids"], answer["nums"], answer["rows"], strict=True)]
            out, _ = search(ask["num"].to_numpy(), matrix(ask["v"], width), ask["kth"].to_numpy(), forward, k)
        return pd.DataFrame(out, columns=["query", "vec_id", "score"])

    pairs = asks.groupBy("g", "shard").cogroup(answers.groupBy("g", "shard"))
    found = pairs.applyInPandas(run, "query long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    first = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    named = vectors.filter(F.col("vec_id") % every == 0).select(F.col("num").alias("query"), F.col("vec_id").alias("query_id"))
    return first.join(named, "query").select("query_id", "rank", "vec_id", "score")
