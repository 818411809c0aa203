"""Removal of lines that many documents share, kept up to date as documents come and go.

The ledger holds an exact reference count per line key (how many documents have it) and, per shard of keys, a cuckoo
filter of the keys at or above the limit. Inserting or deleting documents adds to or takes from the counts; keys that cross
the limit are put into their shard's filter or taken out of it. A filter also lists the counted keys that it wrongly
claims, so for documents of the ledger its answers are exact. Texts are never changed in the ledger: when documents go and
a line falls below the limit, cleaning keeps it again.

Keys are known by 128-bit digests.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import mix, stored

LEAST = 10
BLANK = b" \t\n\v\f\r"
SHARD_KEYS = 500_000
PIECE_PROBES = 1_000_000
#: All filters together are broadcast up to this size; beyond it line keys are routed to their shards.
BROADCAST_BYTES = 256 * 2**20
HOT_SHARE = 1 / 256
SLOTS, FULLEST, MOST_KICKS = 4, 0.85, 200
FILTER = "shard long, slots binary, wrong binary"
COUNTS = "hi long, lo long, n long"


def keys_of(text: str | None) -> list[bytes]:
    """The key of every line: stripped of space and tab to carriage return, A-Z in lower case."""
    return [x.strip(BLANK) for x in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n")]


def digests(keys: list[bytes]) -> np.ndarray:
    """Two 64-bit numbers per key."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").astype(np.uint64).reshape(len(keys), 2)


class Cuckoo:
    """16-bit fingerprints in buckets of four; every key has two buckets, each known from the other and the fingerprint."""

    def __init__(self, slots: np.ndarray) -> None:
        self.slots = slots.reshape(-1, SLOTS)

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1 << max(0, math.ceil(math.log2(max(1, keys) / (SLOTS * FULLEST))))
        return cls(np.zeros(buckets * SLOTS, np.uint16))

    def places(self, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets of digests."""
        prints = (d[:, 1] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        first = (d[:, 0] & np.uint64(len(self.slots) - 1)).astype(np.int64)
        return prints, first, self.other(prints, first)

    def other(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        return buckets ^ (mix(prints.astype(np.uint64)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def holds(self, d: np.ndarray) -> np.ndarray:
        prints, one, two = self.places(d)
        return ((self.slots[one] == prints[:, None]) | (self.slots[two] == prints[:, None])).any(1)

    def insert(self, d: np.ndarray) -> bool:
        """Adds distinct keys; False if there is no room, and the filter is then of no use."""
        prints, one, two = self.places(d)
        prints, one = self._settle(prints, one)
        two = self.other(prints, one)
        prints, buckets = self._settle(prints, two)
        for kick in range(MOST_KICKS):
            if not len(prints):
                return True
            # One print a bucket takes the place of another, which goes to its own second bucket.
            _, use = np.unique(buckets, return_index=True)
            slot = (kick + np.arange(len(use))) % SLOTS
            moved = self.slots[buckets[use], slot]
            self.slots[buckets[use], slot] = prints[use]
            rest = np.setdiff1d(np.arange(len(prints)), use)
            prints = np.concatenate([moved, prints[rest]])
            buckets = np.concatenate([self.other(moved, buckets[use]), buckets[rest]])
            prints, buckets = self._settle(prints, buckets)
        return not len(prints)

    def _settle(self, prints: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Puts prints into free slots of their buckets and returns the rest."""
        for slot in range(SLOTS):
            free = np.flatnonzero(self.slots[buckets, slot] == 0)
            _, first = np.unique(buckets[free], return_index=True)
            use = free[first]
            self.slots[buckets[use], slot] = prints[use]
            rest = np.ones(len(prints), bool)
            rest[use] = False
            prints, buckets = prints[rest], buckets[rest]
        return prints, buckets

    def delete(self, d: np.ndarray) -> None:
        """Takes out keys that were inserted."""
        prints, buckets, _ = self.places(d)
        for _ in range(2):
            for slot in range(SLOTS):
                same = np.flatnonzero(self.slots[buckets, slot] == prints)
                _, first = np.unique(buckets[same], return_index=True)
                use = same[first]
                self.slots[buckets[use], slot] = 0
                rest = np.ones(len(prints), bool)
                rest[use] = False
                prints, buckets = prints[rest], buckets[rest]
            buckets = self.other(prints, buckets)


@dataclass
class Filters:
    """The filters of some shards, with the keys that they wrongly claim."""

    bits: int
    cuckoo: dict[int, Cuckoo]
    wrong: dict[int, set[bytes]]

    @classmethod
    def read(cls, bits: int, rows: list[dict]) -> Filters:
        cuckoo = {r["shard"]: Cuckoo(np.frombuffer(r["slots"], "<u2")) for r in rows}
        return cls(bits, cuckoo, {r["shard"]: {r["wrong"][i : i + 16] for i in range(0, len(r["wrong"]), 16)} for r in rows})

    def holds(self, d: np.ndarray) -> np.ndarray:
        out = np.zeros(len(d), bool)
        shards = d[:, 0] >> np.uint64(64 - self.bits) if self.bits else np.zeros(len(d), np.uint64)
        order = np.argsort(shards, kind="stable")
        names, starts = np.unique(shards[order], return_index=True)
        for name, at in zip(names.tolist(), np.split(order, starts[1:]), strict=True):
            if name in self.cuckoo:
                at = at[self.cuckoo[name].holds(d[at])]
                if wrong := self.wrong[name]:
                    at = at[[d[i].tobytes() not in wrong for i in at]]
                out[at] = True
        return out


@dataclass(frozen=True)
class Ledger:
    """Stored reference counts (hi, lo, n) and filters (shard, slots, wrong) of 2 ** bits shards."""

    counts: DataFrame
    filters: DataFrame
    bits: int
    least: int


def shard(bits: int) -> Column:
    return F.shiftrightunsigned("hi", 64 - bits) if bits else F.lit(0).cast("long")


def empty_ledger(spark: SparkSession, least: int = LEAST) -> Ledger:
    return Ledger(spark.createDataFrame([], COUNTS), spark.createDataFrame([], FILTER), 0, least)


def references(docs: DataFrame) -> DataFrame:
    """(hi, lo, n): in how many rows of ``docs`` each line key, the empty one left out, is found."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys: list[bytes] = []
            for text in b.column(0).to_pylist():
                keys.extend(set(keys_of(text)) - {b""})
            d = digests(keys).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(d[:, 0]), pa.array(d[:, 1])], ["hi", "lo"])

    return docs.select("text").mapInArrow(find, "hi long, lo long").groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"))


def changed(ledger: Ledger, docs: DataFrame, sign: int, shard_keys: int = SHARD_KEYS) -> Ledger:
    """The ledger after documents came (sign 1) or went (-1)."""
    least = ledger.least
    change = references(docs).select(F.col("hi").alias("c_hi"), F.col("lo").alias("c_lo"), (F.col("n") * sign).alias("change"))
    both = ledger.counts.join(change, (F.col("hi") == F.col("c_hi")) & (F.col("lo") == F.col("c_lo")), "full")
    before, after = F.coalesce("n", F.lit(0)), F.coalesce("n", F.lit(0)) + F.coalesce("change", F.lit(0))
    gone = F.raise_error(F.lit("documents were deleted that the ledger does not hold")).cast("long")
    counted = stored(both.select(
        F.coalesce("hi", "c_hi").alias("hi"), F.coalesce("lo", "c_lo").alias("lo"), before.alias("before"),
        F.when(after < 0, gone).otherwise(after).alias("n"),
    ), "lines-counts")
    bits = max(0, math.ceil(math.log2(max(1, counted.count()) / shard_keys)))
    old = ledger.filters if bits == ledger.bits else ledger.filters.limit(0)
    fresh = bits != ledger.bits

    def update(keys: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if keys.empty:
            return held
        d = np.stack([keys["hi"].to_numpy(np.int64), keys["lo"].to_numpy(np.int64)], 1).view(np.uint64)
        was, now = (keys[c].to_numpy() >= least for c in ("before", "n"))
        cuckoo = None if fresh or held.empty else Cuckoo(np.frombuffer(held["slots"].iloc[0], "<u2").copy())
        if cuckoo is not None:
            cuckoo.delete(d[was & ~now])
            if now.sum() > FULLEST * cuckoo.slots.size or not cuckoo.insert(d[now & ~was]):
                cuckoo = None
        size = int(now.sum())
        while cuckoo is None:  # built anew from the counts, with more room each time
            cuckoo = Cuckoo.sized(size)
            if not cuckoo.insert(d[now]):
                cuckoo, size = None, 2 * size
        rare = d[~now & (keys["n"].to_numpy() > 0)]
        wrong = rare[cuckoo.holds(rare)]
        name = int(d[0, 0] >> np.uint64(64 - bits)) if bits else 0
        return pd.DataFrame({"shard": [name], "slots": [cuckoo.slots.tobytes()], "wrong": [wrong.tobytes()]})

    keyed = counted.select(shard(bits).alias("shard"), "hi", "lo", "before", "n")
    filters = keyed.groupBy("shard").cogroup(old.groupBy("shard")).applyInPandas(update, FILTER)
    return Ledger(counted.filter("n > 0").select("hi", "lo", "n"), stored(filters, "lines-filters"), bits, least)


def insert(ledger: Ledger, docs: DataFrame, shard_keys: int = SHARD_KEYS) -> Ledger:
    """Documents come. Every row counts, also one that repeats another."""
    return changed(ledger, docs, 1, shard_keys)


def delete(ledger: Ledger, docs: DataFrame, shard_keys: int = SHARD_KEYS) -> Ledger:
    """Documents go, given with the texts they came with; deleting what never came is an error."""
    return changed(ledger, docs, -1, shard_keys)


KEPT = "n_lines long, n_dropped long, kept string"


def kept_rows(docs: DataFrame, frequent: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], np.ndarray], given: str) -> DataFrame:
    """(doc, n_lines, n_dropped, kept) from rows (doc, text, ...). ``frequent(batch, row, digests)`` says which lines go;
    row is the place of each line's document in the batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(t or "").split("\n") for t in b.column("text").to_pylist()]
            sizes = np.array([len(t) for t in texts], np.int64)
            keys = [x.encode("utf-8", "surrogatepass").strip(BLANK).lower() for t in texts for x in t]
            full = np.fromiter(map(bool, keys), bool, len(keys))
            row = np.repeat(np.arange(len(texts)), sizes)
            drop = np.zeros(len(keys), bool)
            d = digests([k for k in keys if k])
            drop[full] = frequent(b, row[full], d)
            dropped = np.bincount(row[drop], minlength=len(texts))
            ends = np.cumsum(sizes).tolist()
            marks = drop.tolist()
            kept = [
                "\n".join(x for x, gone in zip(t, marks[end - len(t) : end], strict=True) if not gone) if n else "\n".join(t)
                for t, end, n in zip(texts, ends, dropped.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array(sizes), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], ["doc", "n_lines", "n_dropped", "kept"]
            )

    return docs.mapInArrow(run, f"doc {given}, {KEPT}")


def clean_lines(docs: DataFrame, ledger: Ledger, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc, n_lines, n_dropped, kept): every row of ``docs``, its columns in the struct ``doc``, without the lines whose key
    is in ``ledger.least`` documents of the ledger or more.

    The documents must be in the ledger; others lose nothing they should not but for one key in about 8,000 never counted.
    A null or empty text is one empty line, which stays. If all lines go, ``kept`` is empty. Rows that repeat are cleaned
    each. An empty table gives an empty result.
    """
    rows = docs.select(F.struct("*").alias("doc"), "text")
    given = rows.schema["doc"].dataType.simpleString()
    size = ledger.filters.agg(F.sum(F.octet_length("slots") + F.octet_length("wrong"))).first()[0] or 0
    if size > broadcast_bytes:
        return _routed(rows, ledger, given)
    held = [r.asDict() for r in ledger.filters.toLocalIterator()]
    shared, bits = docs.sparkSession.sparkContext.broadcast([(r["shard"], bytes(r["slots"]), bytes(r["wrong"])) for r in held]), ledger.bits

    def frequent() -> Callable:
        read: list[Filters] = []

        def ask(_: pa.RecordBatch, __: np.ndarray, d: np.ndarray) -> np.ndarray:
            if not read:
                read.append(Filters.read(bits, [dict(zip(("shard", "slots", "wrong"), r, strict=True)) for r in shared.value]))
            return read[0].holds(d)

        return ask

    return kept_rows(rows, frequent(), given)


def _routed(rows: DataFrame, ledger: Ledger, given: str, pieces_of: int = PIECE_PROBES) -> DataFrame:
    """Each distinct text asks the shards of its keys, in pieces of bounded size; answers come back by text."""
    bits = ledger.bits

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, packed = [], []
            for text in b.column(0).to_pylist():
                names.append(xxhash.xxh3_128_digest((text or "").encode("utf-8", "surrogatepass")))
                packed.append(digests(sorted(set(keys_of(text)) - {b""})).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(packed, pa.binary())], ["t", "keys"])

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, keys = b.column(0).to_pylist(), b.column(1).to_pylist()
            d = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            owner = np.repeat(np.arange(len(keys)), [len(k) // 16 for k in keys])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()).take(pa.array(owner)), pa.array(d[:, 0]), pa.array(d[:, 1])], ["t", "hi", "lo"])

    def answer(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or held.empty:
            return pd.DataFrame(columns=["t", "key"])
        d = np.stack([asked["hi"].to_numpy(np.int64), asked["lo"].to_numpy(np.int64)], 1).view(np.uint64)
        at = Filters.read(bits, held.to_dict("records")).holds(d)
        return pd.DataFrame({"t": asked["t"].to_numpy()[at], "key": [x.tobytes() for x in d[at]]})

    asks = rows.select("text").mapInArrow(ask, "t binary, keys binary")
    texts = stored(asks.groupBy("t").agg(F.first("keys").alias("keys"), F.count(F.lit(1)).alias("times")), "lines-texts")
    probes = texts.select("t", "keys").mapInArrow(single, "t binary, hi long, lo long").withColumn("shard", shard(bits))
    sizes = ledger.counts.groupBy(shard(bits).alias("shard")).agg(F.ceil(F.sum("n") / pieces_of).alias("pieces"))
    pieced = probes.join(sizes, "shard").withColumn("piece", F.pmod(F.xxhash64("t"), "pieces"))
    copies = sizes.select(F.col("shard").alias("f_shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("f_piece"))
    filters = ledger.filters.join(copies, F.col("shard") == F.col("f_shard")).select("f_shard", "f_piece", *ledger.filters.columns)
    answered = pieced.groupBy("shard", "piece").cogroup(filters.groupBy("f_shard", "f_piece")).applyInPandas(answer, "t binary, key binary")
    gone = answered.groupBy("t").agg(F.collect_list("key").alias("gone"))  # a text's own keys at most
    # Texts with many copies are split: fewer than 1 / HOT_SHARE.
    total = texts.agg(F.sum("times")).scalar()
    pieces = F.when(F.col("times") > total * HOT_SHARE, F.ceil(F.col("times") / (total * HOT_SHARE))).otherwise(1)
    verdicts = stored(gone.join(texts.select("t", pieces.alias("copies")), "t"), "lines-verdicts")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [xxhash.xxh3_128_digest((x or "").encode("utf-8", "surrogatepass")) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.binary()), pa.array(np.arange(len(names)))], ["doc", "text", "r_t", "r_spread"])

    named = rows.mapInArrow(name, f"doc {given}, text string, r_t binary, r_spread long")
    hot = verdicts.filter("copies > 1").select(F.col("t").alias("h_t"), F.col("copies").alias("h_copies"))
    dealt = named.join(F.broadcast(hot), F.col("r_t") == F.col("h_t"), "left").withColumn("r_piece", F.pmod("r_spread", F.coalesce("h_copies", F.lit(1))))
    spread = verdicts.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    joined = dealt.join(spread, (F.col("r_t") == F.col("t")) & (F.col("r_piece") == F.col("piece")), "left").select("doc", "text", "gone")

    def frequent(b: pa.RecordBatch, row: np.ndarray, d: np.ndarray) -> np.ndarray:
        own = [set(x or ()) for x in b.column("gone").to_pylist()]
        return np.fromiter((k.tobytes() in own[r] for r, k in zip(row.tolist(), d, strict=True)), bool, len(d))

    return kept_rows(joined, frequent, given)


def digest_columns(kept: DataFrame) -> DataFrame:
    return kept.select("doc.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
