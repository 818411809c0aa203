"""Helpers that several operators share: words, word hashes, shingles, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
EXACT_BELOW = 2**53
S29, S31, S32 = np.uint64(29), np.uint64(31), np.uint64(32)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written to a new folder below the shared one and read again: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, by ``modulus``; -1 for a null id, which therefore is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words as UTF-8; bytes.lower and bytes.split know ASCII letters and spaces only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (wraps around by intent)."""
    x = (x ^ (x >> S32)) * MIX_A
    x = (x ^ (x >> S29)) * MIX_B
    return x ^ (x >> S31)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash for each word; hashing every one is cheaper than finding the distinct ones first."""
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)


def hashed_texts(texts, most: int = 400_000) -> Iterator[tuple[int, np.ndarray]]:
    """(position, word hashes) of every text in order; texts are hashed together in batches of about ``most`` words."""
    batch: list[bytes] = []
    ends: list[tuple[int, int]] = []
    for i, text in enumerate(texts):
        batch.extend(words_of(text))
        ends.append((i, len(batch)))
        if len(batch) >= most:
            yield from _cut(batch, ends)
            batch, ends = [], []
    yield from _cut(batch, ends)


def _cut(batch: list[bytes], ends: list[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray]]:
    hashes, start = word_hashes(batch), 0
    for i, end in ends:
        yield i, hashes[start:end]
        start = end


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words in order; a shorter, non-empty text is one shingle of all its words."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(k, n)
    out = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        out = mix(out + hashes[j : n - size + 1 + j])
    return out


def strings_or_empty(series: pd.Series) -> list[str]:
    return [x if isinstance(x, str) else "" for x in series]


def packed_vectors(embeddings: DataFrame, keep: list[str], scale: int, offset: int = 0) -> DataFrame:
    """(keep..., spread, x) of rows whose embedding is not null and holds no null or non-finite entry.

    x: floor(scale * c) + offset of every entry c, as packed 64-bit integers; spread: a number that differs between the
    rows of one task. Entries must be below 2^53 / scale.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for b in batches:
            b = b.filter(pc.is_valid(b.column("c")))
            c = b.column("c").flatten().to_numpy(zero_copy_only=False)  # null entries become NaN
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(b.column("c")).to_numpy())]).astype(np.int64)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(c))])
            whole = bad[ends[1:]] == bad[ends[:-1]]
            c = c[np.repeat(whole, np.diff(ends))]
            if c.size and np.abs(c).max() * scale + abs(offset) >= EXACT_BELOW:
                raise ValueError("an entry is too large to be a whole number here")
            x = np.floor(c * scale).astype("<i8") + offset
            ends = np.concatenate([[0], np.cumsum(np.diff(ends)[whole])]).astype(np.int32) * 8
            packed = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(x.tobytes())])
            spread = pa.array(np.arange(seen, seen + len(packed)), pa.int64())
            seen += len(packed)
            kept = b.select(keep).filter(pa.array(whole))
            yield pa.RecordBatch.from_arrays([*kept.columns, spread, packed], [*keep, "spread", "x"])

    given = embeddings.select(*keep, F.col("embedding").cast("array<double>").alias("c"))
    kinds = ", ".join(f"{k} {given.schema[k].dataType.simpleString()}" for k in keep)
    return given.mapInArrow(pack, f"{kinds}, spread long, x binary")


def unpacked(rows: list[bytes], width: int, fill: int = 0) -> np.ndarray:
    """Packed vectors as rows; shorter ones are filled up."""
    if all(len(r) == 8 * width for r in rows):
        return np.frombuffer(b"".join(rows), "<i8").reshape(len(rows), width)
    out = np.full((len(rows), width), fill, np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r) // 8] = np.frombuffer(r, "<i8")
    return out
