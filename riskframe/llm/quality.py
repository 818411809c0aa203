"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are taken inside tasks from the whole text; the trees are fitted on a bounded sample of labelled rows and
flattened into arrays, through which numpy sends all rows of a batch at once, one level a step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskframe.llm.common import id_remainder, stored

#: The trees are fitted on at most so many labelled rows, those with the smallest digests of their ids.
SAMPLE_ROWS = 20_000
HELD_OUT_MODULUS = 5
THRESHOLD = 0.3
STATISTICS = (
    "words bytes_per_word upper digits symbols stops newlines other_bytes distinct repeats shouted_line symbol_line "
    "symbol_lines long_word blank_share repeated_lines"
).split()
SPACE, BREAK, UPPER, LOWER, DIGIT, STOP, SYMBOL, HIGH = range(8)


def _byte_classes() -> np.ndarray:
    table = np.full(256, SYMBOL, np.uint8)
    table[[9, 11, 12, 13, 32]] = SPACE
    table[10] = BREAK
    table[65:91], table[97:123], table[48:58] = UPPER, LOWER, DIGIT
    table[[ord(c) for c in ".,;:?'\"()-"]] = STOP
    table[128:] = HIGH
    return table


CLASSES = _byte_classes()


def statistics(text: str | None) -> list[float]:
    """Figures of one text; a null or empty text has zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    kinds = CLASSES[np.frombuffer(raw, np.uint8)]
    total, count = np.bincount(kinds, minlength=8), len(words)
    inked = max(1, len(raw) - total[SPACE] - total[BREAK])
    letters = max(1, total[UPPER] + total[LOWER])
    starts = np.concatenate([[0], np.flatnonzero(kinds == BREAK) + 1])
    starts = starts[starts < len(raw)]
    per_line = lambda mask: np.add.reduceat(mask, starts, dtype=np.int64)
    line_upper, line_lower = per_line(kinds == UPPER), per_line(kinds == LOWER)
    line_symbol, line_ink = per_line(kinds == SYMBOL), per_line((kinds != SPACE) & (kinds != BREAK))
    enough = line_ink >= 30
    share = np.where(enough, line_symbol / np.maximum(line_ink, 1), 0)
    shout = np.where(enough, line_upper / np.maximum(line_upper + line_lower, 1), 0)
    lines = [x for x in raw.split(b"\n") if x]
    return [
        float(np.log1p(count)), inked / count, total[UPPER] / letters, total[DIGIT] / inked, total[SYMBOL] / inked,
        total[STOP] / inked, total[BREAK] / count, total[HIGH] / inked, len(set(words)) / count,
        sum(map(eq, words, words[1:])) / count, float(shout.max()), float(share.max()),
        float(line_ink[share > 0.08].sum() / inked), float(min(200, max(map(len, words)))), total[SPACE] / len(raw),
        1 - len(set(lines)) / max(1, len(lines)),
    ]


def statistics_of(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, len(STATISTICS))


@dataclass
class Forest:
    """Complete binary trees of one depth as arrays: node i has its children at 2i + 1 and 2i + 2."""

    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray  # trees x inner nodes; values above it go right
    value: np.ndarray  # trees x leaves
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of every row."""
        trees, inner = self.feature.shape
        out = np.full(len(x), self.start)
        if not trees:
            return 1 / (1 + np.exp(-out))
        tree, row = np.arange(trees)[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), trees), np.int64)
        for _ in range(int(np.log2(inner + 1))):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.limit[tree, node])
        return 1 / (1 + np.exp(-(out + self.value[tree, node - inner].sum(1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.12, bins: int = 64, ridge: float = 4.0) -> Forest:
    """Boosting on the logistic loss; each level of a tree takes one histogram of gradients over (node, feature, bin).

    Without rows, or with labels of one class only, there are no trees and the score is the clipped share of label 1
    (one half without rows).
    """
    inner = 2**depth - 1
    mean = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
    start = float(np.log(mean / (1 - mean)))
    if len(y) == 0 or y.min() == y.max():
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), start)
    width = x.shape[1]
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], 1)
    base = binned + np.arange(width) * bins
    margin = np.full(len(y), start)
    features, limits, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (width * bins) + base).ravel()
            sums = [
                np.bincount(at, np.repeat(v, width), many * width * bins).reshape(many, width, bins).cumsum(2)
                for v in (slope, bend)
            ]
            (g, h), (gt, ht) = sums, [s[:, :, -1:] for s in sums]
            gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
            gain[(h < 1) | (ht - h < 1)] = 0
            best = gain.reshape(many, -1).argmax(1)
            for k in range(many):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-6 and b < len(cuts[f]):
                    feature[first + k], limit[first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > limit[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, bend, inner + 1) + ridge)
        margin += value[leaf]
        features.append(feature), limits.append(limit), values.append(value)
    return Forest(np.array(features), np.array(limits), np.array(values), start)


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, stats) of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "stats": list(statistics_of(b["text"]))})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (id_remainder(F.col("doc_id"), HELD_OUT_MODULUS) == 0).alias("held_out"), "text")
    return rows.mapInPandas(run, "doc_id long, held_out boolean, stats array<double>")


def train(stats: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Fits on labelled rows that are not held out, at most ``sample_rows`` of them (stated bound).

    Several labels of a document: the lowest counts; null labels and ids do not count.
    """
    marks = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = (
        stats.filter(~F.col("held_out")).join(marks, "doc_id")
        .select(F.md5(F.col("doc_id").cast("string")).alias("at"), "stats", "quality")
        .orderBy("at", "stats").limit(sample_rows).toPandas()
    )
    if rows.empty:
        return fit(np.zeros((0, len(STATISTICS))), np.zeros(0))
    return fit(np.stack(rows["stats"].to_numpy()), (rows["quality"].to_numpy() >= 1).astype(float))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Null and empty texts are scored from zero statistics; repeated rows get equal scores; an empty table gives an empty
    result; other columns are ignored.
    """
    stats = stored(with_statistics(docs), "quality-statistics")
    forest = train(stats, labels)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.stack(b["stats"].to_numpy()) if len(b) else np.zeros((0, len(STATISTICS)))
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "score": forest.score(x)})

    scored = stats.mapInPandas(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores at least ``threshold``."""
    forest = train(with_statistics(docs), labels)

    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(forest.score(statistics_of(texts)))

    return docs.filter(score(F.col("text")) >= threshold)
