"""Removal of repeated byte strings by suffix arrays.

A string of ``LENGTH`` bytes that also starts earlier is removed, wherever it stands. Positions picked by content, so that
any two equal strings hold the same picks at the same places, route the work: picks whose bytes occur once take no
further part; of the others, the bytes around each go to the shard of the pick. A shard keeps each distinct context with
its earliest place, sorts the suffixes of these contexts by Larsson-Sadakane refinement, and finds by Kasai's common
prefixes which strings are equal; all but the earliest are marked. Where a pick has more contexts than a shard should
hold, they are dealt to several shards; each passes on its sorted distinct strings, and these are merged across shards
by binary search. What repeats within the texts that a task holds at once is settled there and travels once, so a
passage that stands in every text gives one row per such lot. Exact copies of a text count once; all but the first are
removed whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import mix, stored

LENGTH = 100
GRAM = 40
#: Text bytes per range of pick digests, and contexts that a shard should hold.
SEGMENT_BYTES = 16_000_000
SHARD_PICKS = 40_000
#: Picks and contexts that a task holds at once, contexts in a row, and strings per range when shards are merged.
FLUSH_PICKS = 200_000
FLUSH_CONTEXTS = 60_000
ROW_CONTEXTS = 5_000
MERGE_STRINGS = 300_000
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
LOW, HALF = np.uint64(0xFFFFFFFF), np.uint64(32)
NULL_ID = 2**63 - 1


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Picks:
    """Picks of texts; powers are kept for the longest text so far."""

    def __init__(self, length: int, gram: int) -> None:
        self.length, self.gram = length, gram
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, digests) of the picks: starts of grams whose digest is the least of all grams of some string of
        ``length`` bytes."""
        n = len(raw)
        if n < self.length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if len(self.up) < n:
            self.up, self.down = _powers(BASE, 2 * n), _powers(INVERSE, 2 * n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[:n], dtype=np.uint64)])
        grams = n - self.gram + 1
        digest = mix((sums[self.gram :] - sums[: grams]) * self.down[:grams])
        width = self.length - self.gram + 1
        least = _sliding(digest, width, np.minimum)
        # The greatest of the least values of all strings around a gram equals its own digest where it is one of them.
        around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        at = np.flatnonzero(_sliding(around, width, np.maximum) == digest)
        return at, mix(digest[at])  # least digests are small; spread again, they fill ranges evenly


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op over every ``width`` neighbours, in steps that double."""
    out, have = x, 1
    while have * 2 <= width:
        out, have = op(out[:-have], out[have:]), have * 2
    rest = width - have
    return op(out[: len(out) - rest], out[rest:]) if rest else out


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes: Larsson-Sadakane refinement.

    Ranks of h bytes give those of 2h bytes; only groups of more than one suffix are sorted again.
    """
    n, h = len(text), 7
    padded = np.concatenate([text, np.zeros(h, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(h):
        key = (key << np.uint64(8)) | padded[j : n + j]
    key = (key << np.uint64(8)) | np.minimum(h, n - np.arange(n)).astype(np.uint64)  # an ended suffix is the smaller one
    order = np.argsort(key)
    fresh = _changes(key[order])
    del key, padded
    # A group's rank is the place of its first member.
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    open_ = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    while len(open_):
        at = order[open_]
        ahead = np.where(at + h < n, rank[np.minimum(at + h, n - 1)] + 1, 0)
        both = rank[at] * (n + 1) + ahead
        again = np.argsort(both)
        order[open_] = at = at[again]
        new = _changes(both[again])
        rank[at] = open_[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        open_ = open_[~(new & np.append(new[1:], True))]
        h *= 2
    return order


def _changes(x: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before it."""
    return np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]])


def common_prefixes(text: np.ndarray, order: np.ndarray, width: int, rows: int, length: int) -> np.ndarray:
    """Bytes, ``length`` at most, that the suffix at each place of the first ``rows`` rows shares with the one before it in order.

    Kasai's recurrence: the next suffix of a row shares at most one byte less. All rows take their steps together.
    """
    before = np.full(len(text), -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([text, np.zeros(length, np.uint8)])
    common = np.zeros(len(text), np.int32)
    start, shared = np.arange(rows) * width, np.zeros(rows, np.int64)
    for j in range(width):
        at = start + j
        other = before[at]
        shared = np.where(other < 0, 0, np.maximum(shared - 1, 0))
        live = np.flatnonzero((other >= 0) & (shared < length))
        while len(live):
            live = live[padded[at[live] + shared[live]] == padded[other[live] + shared[live]]]
            shared[live] += 1
            live = live[shared[live] < length]
        common[at] = shared
    return common


def runs(starts: np.ndarray, length: int) -> np.ndarray:
    """[begin, end) of the bytes that strings at these sorted starts cover."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    apart = np.flatnonzero(np.diff(starts) > length)
    return np.stack([starts[np.concatenate([[0], apart + 1])], starts[np.concatenate([apart, [len(starts) - 1]])] + length], 1)


Strings = tuple[np.ndarray, np.ndarray, np.ndarray]


def repeated_starts(doc: np.ndarray, pos: np.ndarray, left: np.ndarray, right: np.ndarray, contexts: np.ndarray, length: int, alone: bool) -> tuple[np.ndarray, np.ndarray, Strings | None]:
    """(row, start) of strings that an earlier place has, too; if not ``alone``, also (bytes, row, start) of the earliest
    place of each distinct string, sorted by bytes.

    doc, pos: place of the first byte of each context; left, right: bytes at its sides that are not the text's. ``alone``:
    no other shard has contexts of these picks.
    """
    n, width = contexts.shape
    order, later = first_contexts(doc, pos, left, right, contexts)
    offsets = np.arange(width - length + 1)

    def all_starts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row, at = np.repeat(rows, len(offsets)), np.tile(offsets, len(rows))
        valid = (at >= left[row]) & (at + length <= width - right[row])
        return row[valid], at[valid]

    heads, (out_row, out_start) = order, all_starts(later)
    if alone and len(heads):
        # A pick with one context only has no other place left to compare. Its bytes stand in the middle of the context.
        middle = np.ascontiguousarray(contexts[heads, width - length : length]).view(f"V{2 * length - width}").ravel()
        _, which, count = np.unique(middle, return_inverse=True, return_counts=True)
        heads = heads[count[which.ravel()] > 1]
    if not len(heads):
        return out_row, pos[out_row] + out_start, None
    text = np.concatenate([contexts[heads].ravel(), np.zeros(length, np.uint8)])
    number = np.empty(n, np.int64)
    number[heads] = np.arange(len(heads))
    head_row, head_at = all_starts(heads)
    place = np.full(len(text), -1, np.int64)
    place[number[head_row] * width + head_at] = np.arange(len(head_row))
    sorted_ = suffix_order(text)
    group = np.cumsum(common_prefixes(text, sorted_, width, len(heads), length)[sorted_] < length)
    entry = place[sorted_]
    group, entry = group[entry >= 0], entry[entry >= 0]
    row, start = head_row[entry], pos[head_row[entry]] + head_at[entry]
    # Places of one group in their order; the first one leads.
    by = np.lexsort((start, doc[row], group))
    group, entry, row, start = group[by], entry[by], row[by], start[by]
    lead = _changes(group)
    which = np.cumsum(lead) - 1
    late = (doc[row] != doc[row][lead][which]) | (start != start[lead][which])
    rows, starts = np.concatenate([out_row, row[late]]), np.concatenate([pos[out_row] + out_start, start[late]])
    if alone:
        return rows, starts, None
    windows = np.lib.stride_tricks.sliding_window_view(text, length)
    return rows, starts, (windows[number[row[lead]] * width + head_at[entry[lead]]], row[lead], start[lead])


def first_contexts(doc: np.ndarray, pos: np.ndarray, left: np.ndarray, right: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the earliest place of each distinct context, and all other rows."""
    order = np.lexsort((pos, doc))
    marked = np.concatenate([left[:, None], right[:, None], contexts], 1).astype(np.uint8)[order]
    _, first, back = np.unique(marked.view(f"V{marked.shape[1]}").ravel(), return_index=True, return_inverse=True)
    return order[first], order[np.flatnonzero(first[back.ravel()] != np.arange(len(order)))]


def merged_runs(found: list[tuple[np.ndarray, np.ndarray]], length: int) -> np.ndarray:
    """Places (doc, ref, start) of strings for which another run has an earlier place.

    found: runs of distinct strings, sorted by bytes, with a place each. Two runs at a time become one: each string of
    the smaller run is searched in the larger one.
    """
    late, kind = [], f"S{length}"
    held = [(np.ascontiguousarray(x).view(kind).ravel(), p) for x, p in found if len(x)]
    while len(held) > 1:
        held.sort(key=lambda x: -len(x[0]))
        nxt = []
        for (a, pa), (b, pb) in zip(held[::2], held[1::2], strict=False):
            at = np.searchsorted(a, b)
            hit = np.flatnonzero(a[np.minimum(at, len(a) - 1)] == b)
            mine, theirs = pa[at[hit]], pb[hit]
            sooner = _before(theirs, mine)
            differ = (mine != theirs).any(1)
            late.append(np.where(sooner[:, None], mine, theirs)[differ])
            pa = pa.copy()
            pa[at[hit][sooner]] = theirs[sooner]
            new = np.ones(len(b), bool)
            new[hit] = False
            nxt.append((np.insert(a, at[new], b[new]), np.insert(pa, at[new], pb[new], axis=0)))
        held = nxt + ([held[-1]] if len(held) % 2 else [])
    return np.concatenate(late) if late else np.zeros((0, 3), np.int64)


def _before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of ``a`` come before those of ``b``, column by column."""
    out = np.zeros(len(a), bool)
    for j in reversed(range(a.shape[1])):
        out = (a[:, j] < b[:, j]) | ((a[:, j] == b[:, j]) & out)
    return out


def _by_row(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """[begin, end) of runs of equal rows."""
    if len(ids):
        cuts = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(1), [True]]))
        yield from zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


def span_rows(doc: np.ndarray, ref: np.ndarray, start: np.ndarray, length: int) -> list[tuple[int, int, bytes]]:
    """(doc, ref, packed runs) of the strings at these starts."""
    order = np.lexsort((start, ref, doc))
    ids, start = np.stack([doc, ref], 1)[order], start[order]
    return [(int(ids[a, 0]), int(ids[a, 1]), runs(start[a:b], length).astype("<i8").tobytes()) for a, b in _by_row(ids)]


def byte_keys(rows: np.ndarray) -> np.ndarray:
    """A 64-bit key for each row of bytes."""
    words = -(-rows.shape[1] // 8)
    padded = np.zeros((len(rows), 8 * words), np.uint8)
    padded[:, : rows.shape[1]] = rows
    padded = padded.view("<u8")
    key = np.full(len(rows), rows.shape[1], np.uint64)
    for j in range(words):
        key = mix(key + padded[:, j])
    return key


def repeated_picks(rows: DataFrame, segments: int, length: int, gram: int) -> DataFrame:
    """(ref, picks, at): picks of a text that occur again, as packed positions (u4) or as one position in a row.

    Picks that repeat within a lot of texts are given out at once, packed, and one of each goes on, marked as repeated.
    The others come singly: rows packed by text would grow with texts times ranges of digests.
    """

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        picks, held, size = Picks(length, gram), {}, 0

        def flush() -> pd.DataFrame:
            refs = np.array(list(held), "<i8")
            at, digest = (np.concatenate(x) for x in zip(*held.values(), strict=True))
            index = np.repeat(np.arange(len(held)), [len(p) for p, _ in held.values()])
            held.clear()
            order = np.argsort(digest)
            fresh = _changes(digest[order])
            lone = fresh & np.append(fresh[1:], True)
            again = np.sort(order[~lone])
            out = [(*[None] * 6, *x) for x in _positions(refs[index[again]], at[again])]
            order, many = order[fresh], ~lone[fresh]
            # In order of digest, so ranges of digests are runs of rows.
            bounds = np.searchsorted(((digest[order] >> HALF) * np.uint64(segments) >> HALF).astype(np.int64), np.arange(segments + 1))
            for s in np.flatnonzero(bounds[1:] > bounds[:-1]):
                part = order[bounds[s] : bounds[s + 1]]
                used, local = np.unique(index[part], return_inverse=True)
                out.append((int(s), refs[used].tobytes(), local.astype("<u4").tobytes(), at[part].astype("<u4").tobytes(), (digest[part] & LOW).astype("<u4").tobytes(), many[bounds[s] : bounds[s + 1]].astype("u1").tobytes(), None, None))
            return pd.DataFrame(out, columns=PICK_COLUMNS, dtype=object)

        for b in batches:
            for ref, text in zip(b["ref"], b["text"], strict=True):
                if ref in held:
                    continue
                at, digest = picks.of(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))
                if len(at):
                    held[ref] = at, digest
                    size += len(at)
                if size >= FLUSH_PICKS:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    def again(parts: pd.DataFrame) -> pd.DataFrame:
        get = lambda c, t: [np.frombuffer(x, t) for x in parts[c]]
        ref = np.concatenate([r[i] for r, i in zip(get("refs", "<i8"), get("local", "<u4"), strict=True)])
        at, low, many = (np.concatenate(get(c, t)) for c, t in (("at", "<u4"), ("low", "<u4"), ("many", "u1")))
        order = np.lexsort((at, ref, low))
        ref, at, low, many = ref[order], at[order], low[order], many[order] > 0
        fresh = _changes(low)
        # Copies have the same picks at the same places and count once.
        other = fresh | (ref != np.roll(ref, 1)) | (at != np.roll(at, 1))
        first = np.flatnonzero(fresh)
        repeated = (np.add.reduceat(other.astype(np.int64), first) > 1) | np.logical_or.reduceat(many, first)
        use = np.flatnonzero(repeated[np.cumsum(fresh) - 1] & other & ~many)
        return pd.DataFrame({"ref": ref[use], "at": at[use].astype(np.int64)})

    parts = stored(rows.select("ref", "text").mapInPandas(pick, PICK_SCHEMA), "suffix-parts")
    lone = parts.filter("segment is not null").select("segment", "refs", "local", "at", "low", "many").groupBy("segment")
    single = lone.applyInPandas(again, "ref long, at long")
    return stored(single.unionByName(parts.filter("segment is null").select("ref", "picks"), allowMissingColumns=True), "suffix-picks")


PICK_COLUMNS = ["segment", "refs", "local", "at", "low", "many", "ref", "picks"]
PICK_SCHEMA = "segment long, refs binary, local binary, at binary, low binary, many binary, ref long, picks binary"


def _positions(ref: np.ndarray, at: np.ndarray) -> list[tuple[int, bytes]]:
    order = np.argsort(ref, kind="stable")
    ref, at = ref[order], at[order].astype("<u4")
    return [(int(ref[a]), at[a:b].tobytes()) for a, b in _by_row(ref[:, None])]


def around_picks(texts: DataFrame, shards: int, length: int, gram: int) -> DataFrame:
    """What shards need: (shard, n, docs, refs, pos, left, right, contexts) of picks, and (doc, ref, spans) of contexts that
    an earlier place of the same lot has, too."""
    side, width = length - gram, 2 * length - gram

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def flush() -> pd.DataFrame:
            doc, ref, pos, left, right, context = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            first, later = first_contexts(place_ranks(doc, ref), pos, left, right, context)
            later = later[left[later] + length <= width - right[later]]
            begin, end = pos[later] + left[later], pos[later] + width - right[later]
            order = np.lexsort((begin, ref[later], doc[later]))
            ids, spans = np.stack([doc[later], ref[later]], 1)[order], np.stack([begin, end], 1)[order].astype("<i8")
            out = [(*[None] * 8, int(ids[a, 0]), int(ids[a, 1]), spans[a:b].tobytes()) for a, b in _by_row(ids)]
            shard = (byte_keys(context[first, side : side + gram]) % np.uint64(shards)).astype(np.int64)
            first, shard = first[order := np.argsort(shard, kind="stable")], shard[order]
            for x, y in _by_row(shard[:, None]):
                for z in range(x, y, ROW_CONTEXTS):
                    p = first[z : min(y, z + ROW_CONTEXTS)]
                    out.append((int(shard[x]), len(p), doc[p].astype("<i8").tobytes(), ref[p].astype("<i8").tobytes(), pos[p].astype("<i8").tobytes(), left[p].astype("u1").tobytes(), right[p].astype("u1").tobytes(), context[p].tobytes(), None, None, None))
            return pd.DataFrame(out, columns=CONTEXT_COLUMNS, dtype=object)  # whole numbers beside nulls stay whole

        for b in batches:
            for doc, ref, text, found, single in zip(b["doc"], b["ref"], b["text"], b["picks"], b["at"], strict=True):
                raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                every = np.unique(np.concatenate([np.asarray(single, np.int64), *[np.frombuffer(x, "<u4") for x in found]]).astype(np.int64))
                every = every[every + gram <= len(raw)]
                padded = np.concatenate([np.zeros(side, np.uint8), raw, np.zeros(side + width, np.uint8)])
                windows = np.lib.stride_tricks.sliding_window_view(padded, width)
                for a in range(0, len(every), FLUSH_CONTEXTS):
                    at = every[a : a + FLUSH_CONTEXTS]
                    held.append((np.full(len(at), doc), np.full(len(at), ref), at - side, np.maximum(0, side - at), np.maximum(0, at + gram + side - len(raw)), windows[at]))
                    size += len(at)
                    if size >= FLUSH_CONTEXTS:
                        yield flush()
                        size = 0
        if held:
            yield flush()

    return stored(texts.mapInPandas(cut, CONTEXT_SCHEMA), "suffix-contexts")


CONTEXT_COLUMNS = ["shard", "n", "docs", "refs", "pos", "left", "right", "contexts", "doc", "ref", "spans"]
CONTEXT_SCHEMA = "shard long, n long, docs binary, refs binary, pos binary, left binary, right binary, contexts binary, doc long, ref long, spans binary"


def place_ranks(doc: np.ndarray, ref: np.ndarray) -> np.ndarray:
    """Ranks of (doc, ref)."""
    return np.unique(np.stack([doc, ref], 1), axis=0, return_inverse=True)[1].ravel()


def late_spans(parts: DataFrame, length: int, gram: int, shard_picks: int) -> DataFrame:
    """(doc, ref, spans) of strings that have an earlier place."""
    width = 2 * length - gram
    contexts = parts.filter("shard is not null").drop("doc", "ref", "spans")
    # Shards that hold much more than their share, as one of their picks is frequent, are divided.
    loads = contexts.groupBy("shard").agg(F.sum("n").alias("load")).filter(F.col("load") > 2 * shard_picks)
    loads = stored(loads.select("shard", F.ceil(F.col("load") / shard_picks).alias("subs"), "load"), "suffix-loads")
    strings = (loads.agg(F.sum("load")).first()[0] or 0) * (length - gram + 1)
    buckets = max(1, math.ceil(strings / MERGE_STRINGS))
    dealt = contexts.join(loads.drop("load"), "shard", "left").withColumn("sub", F.coalesce(F.pmod(F.xxhash64("docs", "pos"), "subs"), F.lit(0)))

    def settle(blobs: pd.DataFrame) -> pd.DataFrame:
        get = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in blobs[c]])
        doc, ref, pos = get("docs", "<i8"), get("refs", "<i8"), get("pos", "<i8")
        left, right = get("left", "u1").astype(np.int64), get("right", "u1").astype(np.int64)
        alone = bool(pd.isna(blobs["subs"].iloc[0]))
        row, start, distinct = repeated_starts(place_ranks(doc, ref), pos, left, right, get("contexts", "u1").reshape(-1, width), length, alone)
        out = [(*x, *[None] * 3) for x in span_rows(doc[row], ref[row], start, length)]
        if distinct:
            found, row, start = distinct
            places = np.stack([doc[row], ref[row], start], 1).astype("<i8")
            bucket = (byte_keys(found) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # strings of a bucket stay sorted
            out += [(None, None, None, int(bucket[order[a]]), found[order[a:b]].tobytes(), places[order[a:b]].tobytes()) for a, b in _by_row(bucket[order][:, None])]
        return pd.DataFrame(out, columns=["doc", "ref", "spans", "bucket", "strings", "places"], dtype=object)

    settled = stored(
        dealt.groupBy("shard", "sub").applyInPandas(settle, "doc long, ref long, spans binary, bucket long, strings binary, places binary"), "suffix-settled"
    )

    def merge(found: pd.DataFrame) -> pd.DataFrame:
        held = [
            (np.frombuffer(x, "u1").reshape(-1, length), np.frombuffer(p, "<i8").reshape(-1, 3))
            for x, p in zip(found["strings"], found["places"], strict=True)
        ]
        late = merged_runs(held, length)
        return pd.DataFrame(span_rows(late[:, 0], late[:, 1], late[:, 2], length), columns=["doc", "ref", "spans"])

    across = settled.filter("bucket is not null").select("bucket", "strings", "places").groupBy("bucket").applyInPandas(merge, "doc long, ref long, spans binary")
    here = [x.filter("doc is not null").select("doc", "ref", "spans") for x in (parts, settled)]
    return here[0].unionByName(here[1]).unionByName(across)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_picks: int = SHARD_PICKS) -> DataFrame:
    """doc_id, n_bytes, spans (begin, end of the maximal removed runs) and kept (the remaining bytes) of every document.

    Removed is each byte that a string of ``length`` bytes covers which also starts earlier: in a document of smaller
    id or earlier in the same one, judged on the input. Null ids come after all others. Rows that repeat an id come
    in the order of their texts' digests; of rows equal in both one is the first. Null and empty texts stay empty; an
    empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), F.md5("text").alias("key"), F.octet_length("text").cast("long").alias("n_bytes"), "text"
    )
    ref = F.conv(F.substring("key", 1, 15), 16, 10).cast("long")
    rows = rows.withColumn("ref", ref)
    size = rows.agg(F.sum("n_bytes")).first()[0] or 0
    picks = repeated_picks(rows, max(1, math.ceil(size / SEGMENT_BYTES)), length, gram)
    total = picks.agg(F.sum(F.when(F.col("at").isNotNull(), 1).otherwise(F.octet_length("picks") / 4))).first()[0] or 0
    per_text = picks.groupBy("ref").agg(F.collect_list("picks").alias("picks"), F.collect_list("at").alias("at"))
    # How many rows share id and text; texts too short for a string are kept beside them.
    ids = stored(
        rows.groupBy("key", "ref", "doc", "doc_id").agg(
            F.count(F.lit(1)).alias("same"), F.first("n_bytes").alias("n_bytes"), F.first(F.when(F.col("n_bytes") < length, F.col("text"))).alias("short")
        ),
        "suffix-ids",
    )
    firsts = stored(ids.groupBy("key", "ref").agg(F.min(F.struct("doc", "doc_id")).alias("f")).select("key", "ref", "f.doc", "f.doc_id"), "suffix-texts")
    wanted = firsts.join(per_text, "ref").select("key", "doc", "picks", "at")
    # Rows that repeat in id and text come once: at equal places none of them is the later one.
    texts = rows.select("key", "doc", "ref", "text").join(wanted.hint("shuffle_hash"), ["key", "doc"]).dropDuplicates(["key", "doc"])
    parts = around_picks(texts, max(1, math.ceil(total / shard_picks)), length, gram)
    removed = late_spans(parts, length, gram, shard_picks).groupBy("doc", "ref").agg(F.collect_list("spans").alias("spans"))
    removed = stored(removed, "suffix-spans").select(F.col("doc").alias("r_doc"), F.col("ref").alias("r_ref"), "spans")
    status = firsts.join(removed, (F.col("doc") == F.col("r_doc")) & (F.col("ref") == F.col("r_ref")), "left").select("key", "doc", F.col("doc_id").alias("f_id"), "spans")
    first = rows.select("key", "doc", "n_bytes", "text").join(status.hint("shuffle_hash"), ["key", "doc"]).dropDuplicates(["key", "doc"])
    first = first.select(F.col("f_id").alias("doc_id"), "n_bytes", "text", F.lit(False).alias("whole"), "spans")
    # All other rows need no texts: strings of theirs all have an earlier place.
    own = firsts.select(F.col("key").alias("f_key"), F.col("doc").alias("f_doc"), F.col("doc_id").alias("f_id"))
    kept = (F.col("key") == F.col("f_key")) & (F.col("doc") == F.col("f_doc")) & F.col("doc_id").eqNullSafe(F.col("f_id"))
    more = F.col("same") - F.when(F.col("f_key").isNotNull(), 1).otherwise(0)
    others = ids.join(own, kept, "left").filter(more > 0).select(
        "doc_id", "n_bytes", F.coalesce("short", F.lit("")).alias("text"), (F.col("n_bytes") >= length).alias("whole"), F.lit(None).cast("array<binary>").alias("spans"),
        F.explode(F.sequence(F.lit(1).cast("long"), more)).alias("i"),
    ).drop("i")

    def strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, n, whole, spans in zip(b["text"], b["n_bytes"], b["whole"], b["spans"], strict=True):
                out.append(([{"begin": 0, "end": n}], b"") if whole else kept_bytes(text.encode("utf-8", "surrogatepass"), spans))
            yield pd.concat([b[["doc_id", "n_bytes"]].reset_index(drop=True), pd.DataFrame(out, columns=["spans", "kept"])], axis=1)

    return first.unionByName(others).mapInPandas(
        strip, "doc_id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"
    )


def digest_columns(removed: DataFrame) -> DataFrame:
    return removed.select(
        "doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["begin"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def kept_bytes(raw: bytes, spans) -> tuple[list[dict], bytes]:
    """(maximal removed runs, remaining bytes)."""
    if spans is None or not len(spans):
        return [], raw
    pairs = np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 2) for x in spans])
    change = np.zeros(len(raw) + 1, np.int64)
    np.add.at(change, pairs[:, 0], 1)
    np.add.at(change, pairs[:, 1], -1)
    gone = np.concatenate([[0], np.cumsum(change)[:-1] > 0, [0]])
    edges = np.diff(gone.astype(np.int8))
    found = [{"begin": int(x), "end": int(y)} for x, y in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)]
    return found, np.frombuffer(raw, np.uint8)[gone[1:-1] == 0].tobytes()
