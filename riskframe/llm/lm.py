"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs of the training texts are quantised on a geometric scale; a pair of n-gram and level is
inserted for every level up to its own. A count is read back by probing level 1, 2, ... until a probe fails. The filter
is cut into segments by hash range, each as large as what it holds asks for, and each beside the exact counts of its
words, which the unigram base score needs. Small models are broadcast and texts are scored where they are read. Every Python
worker holds a copy of a broadcast, so beyond a few MB lots of texts send each segment the n-grams they hold and get levels
and counts back: a task then holds one lot or one segment, whatever the size of the table. Both ways give the same scores.

The model is a bigram with a Dirichlet prior: P(w | v) = (c(v, w) + m * P(w)) / (C(v) + m), where P(w) is the add-one share of
the quantised unigram counts and C(v) is never below the sum of the quantised counts of the pairs (v, .), so that
probabilities sum to at most one, but for false positives of the filter.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import MIX_A, MIX_B, hashed_texts, id_remainder, mix, stored

HELD_OUT_MODULUS, HELD_OUT = 7, 2
#: Bits per inserted level; every level sets 4 bits in each of 2 words of 64.
BITS = 12
RATIO = 1.25
PRIOR = 200.0
SEGMENT_CHARS = 4_000_000
LOT_CHARS = 4_000_000
#: Bytes of all segments that may be broadcast: the driver holds them several times, every Python worker once.
BROADCAST_BYTES = 16 * 2**20
FLUSH_TOKENS = 2_000_000
SCORE_TOKENS = 200_000
END, START = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"", b" "))
LOW, HALF, SIX, ONE = np.uint64(0xFFFFFFFF), np.uint64(32), np.uint64(63), np.uint64(1)


def count_levels(ratio: float = RATIO, top: float = 2.0**40) -> np.ndarray:
    """Smallest count of every level from 1: a geometric scale of whole numbers."""
    out, x = [1], 1.0
    while out[-1] < top:
        x *= ratio
        out.append(max(out[-1] + 1, math.ceil(x)))
        x = max(x, float(out[-1]))
    return np.array(out, np.int64)


LEVELS = count_levels()


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, counts, side="right")


def least_count(levels: np.ndarray) -> np.ndarray:
    """Smallest count of a level; 0 for level 0."""
    return np.concatenate([[0], LEVELS])[levels]


def greatest_count(levels: np.ndarray) -> np.ndarray:
    return np.concatenate([[1], LEVELS[1:], [2 * LEVELS[-1]]])[levels] - 1


def pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mix(before * MIX_A + after + MIX_B)


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    """Ranges of the keys' order."""
    return ((keys >> HALF) * np.uint64(segments) >> HALF).astype(np.int64)


def _places(low: np.ndarray, level: np.ndarray | int, sizes: np.ndarray | int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word, mask) twice for every n-gram of a segment at a level."""
    out = []
    x = mix(low.astype(np.uint64) * MIX_B + np.asarray(level).astype(np.uint64))
    for _ in range(2):
        bits = x
        mask = np.zeros(len(x), np.uint64)
        for _ in range(4):
            mask |= ONE << (bits & SIX)
            bits = bits >> np.uint64(6)
        out.append((((x >> HALF) * np.asarray(sizes).astype(np.uint64) >> HALF).astype(np.int64), mask))
        x = mix(x + MIX_A)
    return out


def segment_filter(low: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words of the filter that holds these n-grams (low halves of their keys) with their levels."""
    levels = level_of(counts)
    total = int(levels.sum())
    words = np.zeros(total * BITS // 64 + 1, np.uint64)
    each = np.repeat(low, levels)
    level = np.arange(total) - np.repeat(np.cumsum(levels) - levels, levels) + 1
    for at, mask in _places(each, level, len(words)):
        np.bitwise_or.at(words, at, mask)
    return words


class Segments:
    """Some or all segments, for lookups: ``first`` is the number of the first of a run of consecutive ones."""

    def __init__(self, segments: int, first: int, words: list[np.ndarray], keys: list[np.ndarray], counts: list[np.ndarray]) -> None:
        self.segments, self.first = segments, first
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words, self.keys, self.counts = (np.concatenate(x) for x in (words, keys, counts))

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels of n-grams, by probes until one fails."""
        segment = segment_of(keys, self.segments) - self.first
        return self.probe(keys & LOW, segment)

    def probe(self, low: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Levels of n-grams by the low halves of their keys, in segments counted from the first."""
        start, size = self.starts[segment], self.sizes[segment]
        out = np.zeros(len(low), np.int64)
        alive = np.arange(len(low))
        for level in range(1, len(LEVELS) + 1):
            held = np.ones(len(alive), bool)
            for at, mask in _places(low[alive], level, size[alive]):
                held &= self.words[start[alive] + at] & mask == mask
            alive = alive[held]
            if not len(alive):
                break
            out[alive] = level
        return out

    def known(self, keys: np.ndarray) -> np.ndarray:
        """Exact counts of words."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)


class Answers:
    """Looked-up levels and counts of the n-grams of one lot."""

    def __init__(self, keys: np.ndarray, levels: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        self.own, self.level, self.count = keys[order], levels[order], counts[order]

    def levels(self, keys: np.ndarray) -> np.ndarray:
        return self.level[np.searchsorted(self.own, keys)]

    def known(self, keys: np.ndarray) -> np.ndarray:
        return self.count[np.searchsorted(self.own, keys)]


def gather(docs: DataFrame, segments: int) -> DataFrame:
    """One row per segment: filter words, word keys and exact counts, and sums over its words."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pd.DataFrame:
            flat = np.concatenate(held)
            held.clear()
            inner = flat[1:] != START
            sides = [(*np.unique(flat, return_counts=True), "w"), (*np.unique(pair_keys(flat[:-1][inner], flat[1:][inner]), return_counts=True), "p")]
            out = []
            for keys, n, kind in sides:
                bounds = np.searchsorted(segment_of(keys, segments), np.arange(segments + 1))
                for s in np.flatnonzero(bounds[1:] > bounds[:-1]):
                    part, many = keys[bounds[s] : bounds[s + 1]], n[bounds[s] : bounds[s + 1]]
                    stored_as = part.astype("<u8") if kind == "w" else (part & LOW).astype("<u4")
                    out.append((int(s), kind, stored_as.tobytes(), many.astype("<u4").tobytes()))
            return pd.DataFrame(out, columns=["segment", "kind", "keys", "counts"])

        for b in batches:
            for _, hashes in hashed_texts(b["text"]):
                held.append(np.concatenate([[START], hashes, [END]]))
                size += len(held[-1])
                if size >= FLUSH_TOKENS:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    def summed(rows: pd.DataFrame, kind: str, dtype: str) -> tuple[np.ndarray, np.ndarray]:
        part = rows[rows["kind"] == kind]
        if part.empty:
            return np.zeros(0, dtype), np.zeros(0, np.int64)
        keys, counts = (np.concatenate([np.frombuffer(x, t) for x in part[c]]) for c, t in (("keys", dtype), ("counts", "<u4")))
        order = np.argsort(keys, kind="stable")
        keys, first = np.unique(keys[order], return_index=True)
        return keys, np.add.reduceat(counts[order].astype(np.int64), first)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        words, n = summed(rows, "w", "<u8")
        pairs, m = summed(rows, "p", "<u4")
        bits = segment_filter(np.concatenate([words & LOW, pairs.astype(np.uint64)]), np.concatenate([n, m]))
        real = words != START
        return pd.DataFrame({
            "segment": [int(rows["segment"].iloc[0])], "bits": [bits.tobytes()],
            "keys": [words[real].astype("<u8").tobytes()], "counts": [n[real].astype("<i8").tobytes()],
            "tokens": [int(n[real].sum())], "types": [int(real.sum())], "quantised": [int(least_count(level_of(n[real])).sum())],
        })

    parts = docs.select("text").mapInPandas(count, "segment long, kind string, keys binary, counts binary")
    built = parts.groupBy("segment").applyInPandas(
        build, "segment long, bits binary, keys binary, counts binary, tokens long, types long, quantised long"
    )
    return stored(built, "lm-segments")


def _segments(rows, segments: int, first: int, last: int) -> Segments:
    """Rows of segments first..last, missing ones empty."""
    found = {r["segment"]: r for r in rows}
    get = lambda s, c, t: np.frombuffer(found[s][c], t) if s in found else np.zeros(1 if c == "bits" else 0, t)
    every = range(first, last + 1)
    return Segments(segments, first, *([get(s, c, t) for s in every] for c, t in (("bits", "<u8"), ("keys", "<u8"), ("counts", "<i8"))))


class Scorer:
    """Scores of texts from sums over the training texts and a source of levels and counts."""

    def __init__(self, tokens: int, types: int, quantised: int, prior: float = PRIOR) -> None:
        self.tokens, self.types, self.quantised, self.prior = tokens, types, quantised, prior

    def keys(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all tokens but starts, and the key of each one's pair with the token before."""
        use = np.flatnonzero(flat != START)
        return use, pair_keys(flat[use - 1], flat[use])

    def score(self, texts: list[np.ndarray], source) -> pd.DataFrame:
        """n_tokens, n_known, base_score, score of each text (word hashes)."""
        flat = framed(texts)
        lengths = np.array([len(t) + 1 for t in texts])
        use, pairs = self.keys(flat)
        distinct, place = np.unique(flat, return_inverse=True)
        level, exact = source.levels(distinct), source.known(distinct)
        own_pairs, pair_place = np.unique(pairs, return_inverse=True)
        now, before = place[use], place[use - 1]
        pair_count = least_count(source.levels(own_pairs))[pair_place]
        pair_count = np.minimum(pair_count, np.minimum(greatest_count(level[now]), greatest_count(level[before])))
        single = (least_count(level[now]) + 1) / (self.quantised + self.types + 1)
        likely = (pair_count + self.prior * single) / (greatest_count(level[before]) + self.prior)
        base = np.log10((exact[now] + 1) / (self.tokens + self.types + 1))
        ends = np.cumsum(lengths)
        total = lambda x: np.add.reduceat(x, ends - lengths)
        return pd.DataFrame({
            "n_tokens": lengths, "n_known": total((exact[now] > 0).astype(np.int64)), "base_score": total(base), "score": total(np.log10(likely)),
        })


def framed(texts: list[np.ndarray]) -> np.ndarray:
    """Word hashes of all texts, each between a start and an end."""
    return np.concatenate([x for t in texts for x in ([START], t, [END])]).astype(np.uint64)


def _batches(hashed: Iterable[np.ndarray], most: int = SCORE_TOKENS) -> Iterator[list[np.ndarray]]:
    batch, size = [], 0
    for hashes in hashed:
        batch.append(hashes)
        size += len(hashes) + 2
        if size >= most:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


SCORES = "n_tokens long, n_known long, base_score double, score double"


def _broadcast_scores(rows: DataFrame, scorer: Scorer, model: DataFrame, segments: int) -> DataFrame:
    found = [r.asDict() for r in model.select("segment", "bits", "keys", "counts").toLocalIterator()]
    shared = rows.sparkSession.sparkContext.broadcast(_segments(found, segments, 0, segments - 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            scores = [scorer.score(t, shared.value) for t in _batches(h for _, h in hashed_texts(b["text"], SCORE_TOKENS))]
            if scores:
                yield pd.concat([b[["doc_id", "held_out"]].reset_index(drop=True), pd.concat(scores, ignore_index=True)], axis=1)

    return rows.mapInPandas(run, f"doc_id long, held_out boolean, {SCORES}")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated rows of a batch become one row with their number, as a row that fills a large part of the table would fill its lot."""
    for b in batches:
        if pc.count_distinct(b.column("doc_id"), mode="all").as_py() == b.num_rows:
            yield b.append_column("times", pa.array(np.ones(b.num_rows, np.int64)))
        else:
            counted = pa.Table.from_batches([b]).group_by(b.schema.names, use_threads=False).aggregate([([], "count_all")])
            yield from counted.rename_columns([*b.schema.names, "times"]).to_batches()


def _distinct(keys: np.ndarray) -> np.ndarray:
    """np.unique by sorting; its hash table takes many times longer where most keys differ."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def _lot_keys(scorer: Scorer, hashed: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words and pairs of a lot in order, so that both who asks and who scores know the order of the answers."""
    flat = framed(hashed)
    return _distinct(flat), _distinct(scorer.keys(flat)[1])


def _routed_scores(rows: DataFrame, scorer: Scorer, model: DataFrame, segments: int, lots: int) -> DataFrame:
    dealt = rows.withColumn("lot", F.pmod(F.xxhash64("doc_id", "text"), F.lit(lots))).mapInArrow(
        _counted, "doc_id long, held_out boolean, text string, lot long, times long"
    )

    def hashed(part: pd.DataFrame) -> list[np.ndarray]:
        return [h for _, h in hashed_texts(part["text"], SCORE_TOKENS)]

    def ask(part: pd.DataFrame) -> pd.DataFrame:
        words, pairs = _lot_keys(scorer, hashed(part))
        at, to = (np.searchsorted(segment_of(k, segments), np.arange(segments + 1)) for k in (words, pairs))
        full = np.flatnonzero((at[1:] > at[:-1]) | (to[1:] > to[:-1]))
        words, pairs = words.astype("<u8"), (pairs & LOW).astype("<u4")
        return pd.DataFrame({
            "lot": part["lot"].iloc[0], "segment": full, "words": [words[at[s] : at[s + 1]].tobytes() for s in full],
            "pairs": [pairs[to[s] : to[s + 1]].tobytes() for s in full],
        })

    def answer(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asked.empty:
            return pd.DataFrame(columns=["lot", "segment", "words", "pairs", "counts"])
        s = int(asked["segment"].iloc[0])
        source = _segments(held.to_dict("records"), segments, s, s)
        words, pairs = (np.frombuffer(b"".join(asked[c]), t) for c, t in (("words", "<u8"), ("pairs", "<u4")))
        of_words, of_pairs = (source.probe(k, np.zeros(len(k), np.int64)).astype(np.uint8) for k in (words & LOW, pairs))
        counts = source.known(words).astype("<i8")
        at, to = (np.concatenate([[0], np.cumsum([len(x) // n for x in asked[c]])]) for c, n in (("words", 8), ("pairs", 4)))
        cut = lambda x, ends: [x[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:])]
        return asked[["lot", "segment"]].assign(words=cut(of_words, at), pairs=cut(of_pairs, to), counts=cut(counts, at))

    def score(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if part.empty:
            return pd.DataFrame(columns=["doc_id", "held_out", "times", "n_tokens", "n_known", "base_score", "score"])
        texts = hashed(part)
        words, pairs = _lot_keys(scorer, texts)
        answers = answers.sort_values("segment")
        of_words, of_pairs, counts = (np.frombuffer(b"".join(answers[c]), t) for c, t in (("words", np.uint8), ("pairs", np.uint8), ("counts", "<i8")))
        if (len(of_words), len(of_pairs), len(counts)) != (len(words), len(pairs), len(words)):
            raise ValueError("a lot has other n-grams than it asked for")
        own = Answers(np.concatenate([words, pairs]), np.concatenate([of_words, of_pairs]), np.concatenate([counts, np.zeros(len(pairs), np.int64)]))
        scores = pd.concat([scorer.score(t, own) for t in _batches(texts)], ignore_index=True)
        return pd.concat([part[["doc_id", "held_out", "times"]].reset_index(drop=True), scores], axis=1)

    asked = dealt.groupBy("lot").applyInPandas(ask, "lot long, segment long, words binary, pairs binary")
    answered = asked.groupBy("segment").cogroup(model.groupBy("segment")).applyInPandas(
        answer, "lot long, segment long, words binary, pairs binary, counts binary"
    )
    scored = dealt.groupBy("lot").cogroup(answered.groupBy("lot")).applyInPandas(score, f"doc_id long, held_out boolean, times long, {SCORES}")
    once = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return scored.withColumn("one", once).drop("one", "times")


def score_documents(docs: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, prior: float = PRIOR) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Null and empty texts have one token, the end. A null id is never held out. Repeated rows count and are scored each.
    Without training texts nothing is known and every base score is 0. An empty table gives an empty result; other
    columns are ignored. Words are told apart by 64-bit hashes.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (id_remainder(F.col("doc_id"), HELD_OUT_MODULUS) == HELD_OUT).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    segments, lots = (max(1, math.ceil(chars / x)) for x in (SEGMENT_CHARS, LOT_CHARS))
    model = gather(rows.filter(~F.col("held_out")), segments)
    size, *sums = model.agg(F.sum(F.length("bits") + F.length("keys") + F.length("counts")), F.sum("tokens"), F.sum("types"), F.sum("quantised")).first()
    scorer = Scorer(*(int(x or 0) for x in sums), prior)
    if (size or 0) <= broadcast_bytes:
        scored = _broadcast_scores(rows, scorer, model, segments)
    else:
        scored = _routed_scores(rows, scorer, model, segments, lots)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(scorer.tokens).cast("long").alias("train_tokens"), "base_score", "score")
