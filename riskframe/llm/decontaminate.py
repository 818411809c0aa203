"""Benchmark decontamination by windows of item size.

A benchmark item of n words is compared with all windows of n words of a document (the whole document, if shorter).
Windows and items carry SimHash fingerprints of their words; tables over blocks of the fingerprint bits yield every item
within the radius of a window, because an item within it differs in few bits of at least one block. Those pairs are
verified exactly: the weight of the item's distinct word shingles that the window holds, as a share of the weight of
all of them; a shingle weighs its number of bytes. Sizes of which the whole text cannot hold an item, and windows whose
shingles cannot reach the threshold, which a running sum tells, get no fingerprint; that loses nothing.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskframe.llm.common import shingle_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 24
#: Bounds of one part of the benchmark; larger benchmarks are taken in several parts, each against all documents.
PART_ITEMS = 20_000
PART_CHARS = 16_000_000
#: Bytes that do not count, wherever they stand.
TRIM = b".,;:!?\"'()[]{}*#%&$|-_"
BLOCKS = 8
BLOCK_VALUES = np.arange(256, dtype=np.uint8)


def plain_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(None, TRIM).lower().split() if text else []


def votes(hashes: np.ndarray) -> np.ndarray:
    """One row per word: +1 or -1 for each of 64 bits."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


class SizeIndex:
    """All items of one number of words, with their fingerprints in block tables."""

    def __init__(self, size: int, radius: int) -> None:
        self.size, self.k, self.radius = size, min(SHINGLE, size), radius
        self.ids: list[int | None] = []
        self.prints: list[int] = []
        self.shingles: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []

    def add(self, item_id: int | None, words: list[bytes]) -> None:
        hashes = word_hashes(words)
        shingles, first = np.unique(shingle_hashes(hashes, SHINGLE), return_index=True)
        lengths = np.array([len(w) for w in words])
        self.ids.append(item_id)
        self.prints.append(int(fingerprints(votes(hashes).sum(0, keepdims=True))[0]))
        self.shingles.append(shingles)
        self.weights.append(np.array([lengths[i : i + self.k].sum() for i in first], float))

    def close(self) -> None:
        """tables[block, value]: bit set of the items whose block is near enough to the value."""
        own = np.array(self.prints, "<u8")
        self.own = own
        self.totals = np.array([w.sum() for w in self.weights])
        blocks = own.view(np.uint8).reshape(-1, 8)
        apart = np.bitwise_count(BLOCK_VALUES[None, :, None] ^ blocks.T[:, None, :])
        self.tables = np.packbits(apart <= self.radius // BLOCKS, axis=2)

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item) whose fingerprints differ in at most ``radius`` bits."""
        near = np.zeros((len(prints), self.tables.shape[2]), np.uint8)
        blocks = prints.astype("<u8").view(np.uint8).reshape(-1, 8)
        for b in range(BLOCKS):
            near |= self.tables[b, blocks[:, b]]
        window, item = np.nonzero(np.unpackbits(near, axis=1, count=len(self.own)))
        close = np.bitwise_count(prints[window] ^ self.own[item]) <= self.radius
        return window[close], item[close]


class Index:
    """A part of the benchmark: items by size, and the weights of all their shingles by shingle length."""

    def __init__(self, items: list[tuple[int | None, str | None]], threshold: float = THRESHOLD, radius: int = RADIUS) -> None:
        self.threshold = threshold
        sizes: dict[int, SizeIndex] = {}
        for item_id, text in items:
            if words := plain_words(text):
                sizes.setdefault(len(words), SizeIndex(len(words), radius)).add(item_id, words)
        by_k = defaultdict(list)
        for s in sizes.values():
            s.close()
            by_k[s.k].append(s)
        self.groups = []
        for k, group in by_k.items():
            shingles = np.concatenate([x for s in group for x in s.shingles])
            weights = np.concatenate([x for s in group for x in s.weights])
            owner = np.repeat(np.arange(sum(len(s.ids) for s in group)), [len(x) for s in group for x in s.shingles])
            order = np.argsort(shingles, kind="stable")
            known, first, count = np.unique(shingles[order], return_index=True, return_counts=True)
            members = (first, count, owner[order], weights[order])
            self.groups.append((k, known, weights[order][first], members, group))

    def hits(self, hashes: np.ndarray) -> list[tuple[int | None, float, int, int]]:
        """(item, similarity, first word, words) of the best window of every item that the text holds."""
        best: dict[tuple[int, int], tuple[float, int]] = {}
        running = None
        for k, known, weights, members, group in self.groups:
            if len(hashes) < k:
                continue
            shingles = shingle_hashes(hashes, k)
            at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
            found = known[at] == shingles
            if not found.any():
                continue
            held_by = np.where(found, weights[at], 0.0)
            # A shingle that repeats the one before counts at the first place only, or where a window begins.
            again = np.concatenate([[False], shingles[1:] == shingles[:-1]])
            upto = np.concatenate([[0.0], np.cumsum(np.where(again, 0.0, held_by))])
            opening = np.where(again, held_by, 0.0)
            wanted = self._reachable(np.unique(at[found]), members, group)
            for s, items in zip(group, wanted, strict=True):
                if not len(items):
                    continue
                width = min(s.size, len(hashes)) - k + 1
                held = upto[width:] - upto[:-width] + opening[: len(shingles) - width + 1]
                starts = np.flatnonzero(held >= self.threshold * s.totals[items].min() - 1e-6)
                if not len(starts):
                    continue
                if running is None:
                    running = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(votes(hashes), 0, dtype=np.int32)])
                ends = np.minimum(starts + s.size, len(hashes))
                window, item = s.within(fingerprints(running[ends] - running[starts]))
                for i in np.intersect1d(items, item):
                    if alike := self._best(s, int(i), starts[window[item == i]], shingles, again, width):
                        best[s.size, int(i)] = alike
        by_size = {s.size: s for *_, group in self.groups for s in group}
        return [(by_size[z].ids[i], round(a, 6), start, z) for (z, i), (a, start) in sorted(best.items())]

    def _reachable(self, found: np.ndarray, members: tuple, group: list[SizeIndex]) -> list[np.ndarray]:
        """Per size, the items of which the whole text holds enough shingles for some window to reach the threshold."""
        first, count, owner, weight = members
        many = count[found]
        at = np.repeat(first[found] - np.cumsum(many) + many, many) + np.arange(many.sum())
        held = np.bincount(owner[at], weight[at], minlength=sum(len(s.ids) for s in group))
        out, start = [], 0
        for s in group:
            out.append(np.flatnonzero(held[start : start + len(s.ids)] >= self.threshold * s.totals - 1e-6))
            start += len(s.ids)
        return out

    def _best(self, s: SizeIndex, i: int, starts: np.ndarray, shingles: np.ndarray, again: np.ndarray, width: int) -> tuple[float, int] | None:
        """Similarity and start of the first best window for one item, if it reaches the threshold."""
        low = starts[0]
        part, repeats = shingles[low : starts[-1] + width], again[low : starts[-1] + width]
        at = np.minimum(np.searchsorted(s.shingles[i], part), len(s.shingles[i]) - 1)
        own = np.where(s.shingles[i][at] == part, s.weights[i][at], 0.0)
        upto = np.concatenate([[0.0], np.cumsum(np.where(repeats, 0.0, own))])
        begins = starts - low
        most = upto[begins + width] - upto[begins] + np.where(repeats, own, 0.0)[begins]
        top = (0.0, 0)
        for start in starts[most >= self.threshold * s.totals[i] - 1e-6]:
            inside = np.isin(s.shingles[i], shingles[start : start + width])
            alike = float(s.weights[i][inside].sum() / s.totals[i])
            if alike > top[0]:
                top = (alike, int(start))
        return top if top[0] >= self.threshold else None

    def hits_of(self, texts) -> list[list[tuple[int | None, float, int, int]]]:
        """Hits of every text; words of many texts are hashed together."""
        out, batch, lengths = [], [], []

        def flush() -> None:
            hashes, start = word_hashes(batch), 0
            for n in lengths:
                out.append(self.hits(hashes[start : start + n]))
                start += n
            batch.clear(), lengths.clear()

        for text in texts:
            words = plain_words(text)
            batch.extend(words), lengths.append(len(words))
            if len(batch) >= 400_000:
                flush()
        flush()
        return out


def indexes(benchmark: DataFrame, threshold: float = THRESHOLD, radius: int = RADIUS) -> Iterator[Index]:
    """The benchmark in parts of bounded size, as many as it needs. Items without words match nothing."""
    n, chars = benchmark.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = max(math.ceil(n / PART_ITEMS), math.ceil(chars / PART_CHARS))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts)))
    for i in range(parts):
        yield Index([tuple(r) for r in benchmark.filter(part == i).select("item_id", "text").collect()], threshold, radius)


def find_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, similarity, start_word, n_words: the best window of every item in every document that holds it.

    Null or empty texts and items give no rows, repeated documents or items give repeated rows, ties take the first
    window, empty tables give an empty result; other columns are ignored. Words are counted without those that are
    punctuation only.
    """
    schema = "doc_id long, item_id long, similarity double, start_word long, n_words long"
    found = docs.sparkSession.createDataFrame([], schema)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for index in indexes(benchmark, **options):

        def run(batches: Iterator[pd.DataFrame], index: Index = index) -> Iterator[pd.DataFrame]:
            for b in batches:
                hits = index.hits_of(b["text"])
                out = [(d, *h) for d, found in zip(b["doc_id"], hits, strict=True) for h in found]
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "similarity", "start_word", "n_words"])

        found = found.unionByName(rows.mapInPandas(run, schema))
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs``, all columns, that hold no benchmark item."""
    for index in indexes(benchmark, **options):
        docs = docs.filter(_clean(index)(F.col("text")))
    return docs


def _clean(index: Index):
    """A function of a text column: whether the text holds no item of this part."""

    @pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not h for h in index.hits_of(texts)], dtype=bool)

    return clean
