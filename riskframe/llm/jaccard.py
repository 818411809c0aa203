"""Exact n-gram Jaccard join by a token-group matrix.

Documents of equal shingle sets form one class. First, classes with an equal min-hash, by each of three, stand in groups of
bounded size and are linked inside them; a full group shares one class with the next. What is linked so far is contracted:
from here on, groups hold classes of one component. The matrix says which groups hold a token. It is kept for the tokens of
every set's prefix only: in an order of all tokens with the most frequent last, two sets similar enough share one of their
first few tokens, so a group that shares none with a query group, or only such as leave too few behind them, cannot qualify,
and groups of one component need not meet, however many near copies they hold. Parities of tokens by hash bound how many tokens two sets can share; of a pair of
groups, the sets that this leaves are opened: the tokens that a set shares with the union of the other group bound its
overlap with any member, and what remains is counted exactly, as products of incidence matrices. Numbers of links, where
they are asked for, are counted at the end between the groups of each final component.

Nothing is capped: the order of tokens is a matter of speed, any order gives the same links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_hexdigest

from riskframe.llm.common import hashed_texts, shingle_hashes, stored
from riskframe.llm.components import components

GROUP_SETS = 256
GROUP_TOKENS = 400_000
#: Tokens of at least so many documents come last in the order, up to the bound of the list that is sent to all tasks.
FREQUENT = 32
MOST_FREQUENT = 1_000_000
SEGMENT_CHARS = 8_000_000
#: Keys of opened texts are broadcast up to this number, after a count.
BROADCAST_KEYS = 200_000
MATRIX_COLUMNS = 16_384
#: Sets are handed on in batches of so many.
SET_ROWS = 1_000
SET_COLUMNS = ["cls", "n", "m0", "m1", "m2", "rare", "often", "bits"]
SET_TYPES = [pa.string(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 2, pa.binary()]
FLUSH = 1_500_000
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
LOW = np.uint64(0xFFFFFFFF)


def token_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingle_hashes(hashes, k))


def frequent_tokens(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted codes of the frequent tokens with the number of documents of each, and the number of segments.

    Tasks send each segment of the hash range the low halves of its hashes with counts; a segment adds them up. All
    documents count. The code of a token is its segment and low half.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    segments = max(1, math.ceil(chars / SEGMENT_CHARS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            codes, n = np.unique(_codes(np.concatenate(held), segments), return_counts=True)
            held.clear()
            which = (codes >> np.uint64(32)).astype(np.int64)
            bounds = np.searchsorted(which, np.arange(segments + 1))
            spans = [(s, a, b) for s, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if b > a]
            return pa.RecordBatch.from_pydict({
                "segment": pa.array([s for s, _, _ in spans], pa.int64()),
                "codes": pa.array([packed(codes[a:b]) for _, a, b in spans], pa.binary()),
                "counts": pa.array([n[a:b].astype("<u4").tobytes() for _, a, b in spans], pa.binary()),
            })

        for b in batches:
            # Texts leave the Arrow batch one by one, so that no second copy of all of them is held.
            for _, hashes in hashed_texts(x.as_py() for x in b.column("text")):
                held.append(token_set(hashes, k))
                size += len(held[-1])
                if size > FLUSH:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        codes = np.concatenate([unpacked(x) for x in rows["codes"]])
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in rows["counts"]])
        order = np.argsort(codes, kind="stable")
        codes, first = np.unique(codes[order], return_index=True)
        total = np.add.reduceat(counts[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        many = total >= FREQUENT
        code = (np.int64(rows["segment"].iloc[0]) << np.int64(32)) + codes[many].astype(np.int64)
        return pd.DataFrame({"code": code, "n": total[many]})

    parts = docs.select("text").mapInArrow(count, "segment long, codes binary, counts binary")
    found = parts.groupBy("segment").applyInPandas(add, "code long, n long")
    top = found.orderBy(F.col("n").desc(), "code").limit(MOST_FREQUENT).orderBy("code").toPandas()
    return top["code"].to_numpy(np.uint64), top["n"].to_numpy(np.int64), segments


def packed(codes: np.ndarray) -> bytes:
    """Low halves of ascending codes of one segment as steps, their bytes by significance, which shuffles compress."""
    steps = np.diff(codes & LOW, prepend=np.uint64(0)).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view("<u4").ravel(), dtype=np.uint64).astype("<u4")


def _codes(hashes: np.ndarray, segments: int) -> np.ndarray:
    high = (hashes >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)
    return (high << np.uint64(32)) | (hashes & LOW)


def prefix(tokens: np.ndarray, percent: int, frequent: np.ndarray, counts: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of a set, one of which any set that is similar enough must share: rare ones by hash, then
    frequent ones by count."""
    n = len(tokens)
    size = max(0, n - (percent * n + 99) // 100 + 1)
    if n == 0 or not len(frequent):
        return tokens[:size], tokens[:0]
    codes = _codes(tokens, segments)
    at = np.minimum(np.searchsorted(frequent, codes), len(frequent) - 1)
    rank = np.where(frequent[at] == codes, counts[at], 0)
    first = np.argsort(rank, kind="stable")[:size]
    return tokens[first[rank[first] == 0]], tokens[first[rank[first] > 0]]


def parity_bits(tokens: np.ndarray) -> bytes:
    """Parities of the tokens that fall on each of at least twice as many bits: two sets differ in at least as many
    tokens as bits."""
    bits = max(512, 1 << (2 * len(tokens)).bit_length())
    return np.packbits(np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def differences(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Least numbers of tokens in which sets differ; of two lengths, the longer parities are folded to the shorter."""
    out = np.zeros((len(left), len(right)), np.int64)
    of_size = lambda side: {z: np.array([i for i, x in enumerate(side) if len(x) == z]) for z in {len(x) for x in side}}

    def folded(side: list[bytes], rows: np.ndarray, size: int, to: int) -> np.ndarray:
        return np.bitwise_xor.reduce(np.array([np.frombuffer(side[i], "<u8") for i in rows]).reshape(len(rows), size // to, to // 8), axis=1)

    for p, rows in of_size(left).items():
        for q, columns in of_size(right).items():
            x, y = folded(left, rows, p, min(p, q)), folded(right, columns, q, min(p, q))
            out[np.ix_(rows, columns)] = [np.bitwise_count(row[None, :] ^ y).sum(1, dtype=np.int64) for row in x]
    return out


def sets_of(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """One row per document: doc_id, key (digest of the text), cls (digest of the set), n, m0..m2 (min-hashes), the
    prefix (rare and often tokens) and the parity bits."""
    frequent, counts, segments = frequent_tokens(docs, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, hashes in hashed_texts(x.as_py() for x in b.column("text")):
                tokens = token_set(hashes, k)
                low = [int((tokens * m).min().astype(np.int64)) if len(tokens) else 0 for m in MULTIPLIERS]
                rare, often = prefix(tokens, percent, frequent, counts, segments)
                out.append((xxh3_128_hexdigest(tokens.tobytes()), len(tokens), *low, rare.astype(np.int64), often.astype(np.int64), parity_bits(tokens)))
                if len(out) == SET_ROWS or i == b.num_rows - 1:
                    ids = b.select(["doc_id", "key"]).slice(i + 1 - len(out), len(out))
                    columns = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), SET_TYPES, strict=True)]
                    yield pa.RecordBatch.from_arrays([*ids.columns, *columns], ["doc_id", "key", *SET_COLUMNS])
                    out = []

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.coalesce("text", F.lit(""))).alias("key"), "text")
    schema = "doc_id long, key string, cls string, n long, m0 long, m1 long, m2 long, rare array<long>, often array<long>, bits binary"
    return stored(rows.mapInArrow(run, schema), "jaccard-sets")


def first_row() -> Column:
    """Orders rows by id, null last, and text."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")


def classes_of(sets: DataFrame) -> DataFrame:
    """(cls, doc_id, key, copies, n, m0, m1, m2) of every class with tokens: its first row, rows, size and min-hashes."""
    classes = sets.filter("n > 0").groupBy("cls").agg(
        F.min(first_row()).alias("head"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
        *(F.first(f"m{i}").alias(f"m{i}") for i in range(3)),
    )
    return stored(classes.select("cls", "head.doc_id", "head.key", "copies", "n", "m0", "m1", "m2"), "jaccard-heads")


def cut(classes: DataFrame, same: list[str], then: list[str], alone: bool = True, chained: bool = False) -> DataFrame:
    """(bin, and the columns of classes that members need): groups of bounded size of classes that are equal in ``same``,
    in the order of ``then``.

    Without ``alone`` a class on its own is left out; ``chained`` groups begin with the last class of the group before if
    both are equal.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[str, int]] = []
        tokens, last = 0, None

        def group() -> list[tuple[str, int]]:
            return [(name, number) for name, _ in held] if alone or len(held) > 1 else []

        for b in batches:
            out = []
            for name, n, *low in zip(b["cls"], b["n"].tolist(), *(b[c] for c in same), strict=True):
                if held and (low != last or len(held) >= GROUP_SETS or tokens + n > GROUP_TOKENS):
                    out += group()
                    number += 1
                    held = held[-1:] if chained and low == last else []
                    tokens = held[0][1] if held else 0
                held.append((name, n))
                tokens, last = tokens + n, low
            yield pd.DataFrame(out, columns=["cls", "bin"])
        yield pd.DataFrame(group(), columns=["cls", "bin"])

    order = [*same, *then]
    ranged = classes.repartitionByRange(*order).sortWithinPartitions(*order).select("cls", "n", *(c for c in same if c != "cls"))
    return ranged.mapInPandas(run, "cls string, bin long")


def members(sets: DataFrame, groups: DataFrame, *columns: str) -> DataFrame:
    """bin and ``columns`` of the first row of every class; rows that repeat in id and text repeat."""
    extra = [c for c in ("label",) if c in groups.columns]
    head = groups.select(F.col("cls").alias("h_cls"), F.col("doc_id").alias("h_id"), F.col("key").alias("h_key"), "bin", *extra)
    same = (F.col("cls") == F.col("h_cls")) & (F.col("key") == F.col("h_key")) & F.col("doc_id").eqNullSafe(F.col("h_id"))
    return sets.join(head.hint("shuffle_hash"), same).select("bin", *columns, *extra)


def qualifying(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of groups of different components whose prefixes share a token and whose set sizes allow the
    similarity. ``groups`` has the component as ``label``."""
    token = Window.partitionBy("token")
    # A rare token is in fewer than FREQUENT documents, or in fewer than each of the MOST_FREQUENT listed ones.
    rare = (
        members(sets, groups, "rare", "n").select("bin", "label", "n", F.posexplode("rare").alias("at", "token"))
        .select("*", F.min("label").over(token).alias("x"), F.max("label").over(token).alias("y")).filter("x < y").drop("x", "y")
    )
    often = members(sets.filter(F.size("often") > 0), groups, "often", "n", "rare").select(
        "bin", "label", "n", F.size("rare").alias("before"), F.posexplode("often").alias("at", "token")
    ).withColumn("at", F.col("at") + F.col("before")).drop("before")
    # How many tokens of a set follow its token at place ``at``: what two sets share after their first common token.
    held = lambda rows: rows.groupBy("token", "bin", "label").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("at")).alias("rest")
    )
    shared = stored(held(rare).unionByName(held(often)), "jaccard-matrix")
    side = lambda x: shared.select("token", *(F.col(c).alias(f"{x}_{c}") for c in ("bin", "lo", "hi", "rest", "label")))
    left, right = side("a"), side("b")
    fits = (F.col("a_hi") * 100 >= F.col("b_lo") * percent) & (F.col("b_hi") * 100 >= F.col("a_lo") * percent)
    enough = F.least("a_rest", "b_rest") * (100 + percent) >= (F.col("a_lo") + F.col("b_lo")) * percent
    apart = (F.col("a_bin") < F.col("b_bin")) & (F.col("a_label") != F.col("b_label"))
    across = left.join(right, (left["token"] == right["token"]) & apart & fits & enough)
    return stored(across.select(F.col("a_bin").alias("a"), F.col("b_bin").alias("b")).distinct(), "jaccard-pairs")


def inside(groups: DataFrame) -> DataFrame:
    """Every group of two classes or more with itself."""
    return groups.groupBy("bin").count().filter("count > 1").select(F.col("bin").alias("a"), F.col("bin").alias("b"))


def within_reach(sets: DataFrame, groups: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b, side, cls): the sets of each pair of groups that their parity bits allow to be similar to one of the other
    group; side 0 is a, 1 is b, and 2 stands for both in a pair of a group with itself."""
    # Fixed-width columns end to end: a group of a pair is three binary values, not a list of rows.
    bits = members(sets, groups, "cls", "n", "bits").distinct().groupBy("bin").agg(
        F.array_sort(F.collect_list(F.struct("cls", "n", "bits"))).alias("s")
    ).select(
        "bin", F.unhex(F.array_join("s.cls", "")).alias("names"), F.col("s.n").alias("sizes"),
        F.transform("s.bits", lambda x: F.length(x)).alias("widths"), F.unhex(F.array_join(F.transform("s.bits", lambda x: F.hex(x)), "")).alias("bits"),
    )

    def cut(side: dict) -> list[bytes]:
        ends = np.cumsum(side["widths"]).tolist()
        return [side["bits"][x:y] for x, y in zip([0, *ends], ends, strict=False)]

    def name(side: dict, i: int) -> str:
        return side["names"][16 * i : 16 * i + 16].hex()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for a, b, left, right in zip(batch["a"], batch["b"], batch["left"], batch["right"], strict=True):
                n, m = (np.asarray(side["sizes"]) for side in (left, right))
                both = n[:, None] + m[None, :]
                apart = differences(cut(left), cut(right))
                # Common tokens are at most half of what the sets hold together less what they differ in.
                possible = 100 * (both - apart) >= percent * (both + apart)
                if a == b:
                    np.fill_diagonal(possible, False)
                    out += [(a, b, 2, name(left, i)) for i in np.flatnonzero(possible.any(1))]
                else:
                    out += [(a, b, 0, name(left, i)) for i in np.flatnonzero(possible.any(1))]
                    out += [(a, b, 1, name(right, i)) for i in np.flatnonzero(possible.any(0))]
            yield pd.DataFrame(out, columns=["a", "b", "side", "cls"])

    held = F.struct("names", "sizes", "widths", "bits")
    left, right = bits.select(F.col("bin").alias("a"), held.alias("left")), bits.select(F.col("bin").alias("b"), held.alias("right"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return stored(rows.mapInPandas(run, "a long, b long, side long, cls string"), "jaccard-open")


def rebuilt(docs: DataFrame, groups: DataFrame, opened: DataFrame, k: int) -> DataFrame:
    """(cls, copies, tokens) of every set that some pair opens, from one text per class."""
    wanted = stored(groups.join(opened.select("cls").distinct(), "cls", "left_semi").select("key", "cls", "copies").distinct(), "jaccard-wanted")
    texts = docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("key"), "text")
    # Few texts are opened as a rule; the others then stay where they are.
    rows = texts.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted.hint("shuffle_hash"), "key")

    def token_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tokens = [token_set(h, k).tobytes() for _, h in hashed_texts(b["text"])]
            yield pd.DataFrame({"cls": b["cls"], "copies": b["copies"], "tokens": tokens})

    once = rows.mapInPandas(token_rows, "cls string, copies long, tokens binary").groupBy("cls").agg(
        F.first("copies").alias("copies"), F.first("tokens").alias("tokens")
    )
    return stored(once, "jaccard-tokens")


def _rows_in(tokens: list[np.ndarray], columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every token of the sets that is among the sorted ``columns``."""
    flat = np.concatenate(tokens)
    row = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    at = np.minimum(np.searchsorted(columns, flat), len(columns) - 1)
    held = columns[at] == flat
    return row[held], at[held]


def overlaps(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Sizes of all intersections that can matter; 0 where the bound by the other group's union rules a set out."""
    out = np.zeros((len(left), len(right)), np.int64)
    common = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    if not len(common):
        return out
    (lr, lc), (rr, rc) = _rows_in(left, common), _rows_in(right, common)
    held_l, held_r = np.bincount(lr, minlength=len(left)), np.bincount(rr, minlength=len(right))
    keep_l = np.flatnonzero(held_l * 100 >= percent * np.array([len(t) for t in left]))
    keep_r = np.flatnonzero(held_r * 100 >= percent * np.array([len(t) for t in right]))
    if not len(keep_l) or not len(keep_r):
        return out
    place_l, place_r = np.full(len(left), -1), np.full(len(right), -1)
    place_l[keep_l], place_r[keep_r] = np.arange(len(keep_l)), np.arange(len(keep_r))
    total = np.zeros((len(keep_l), len(keep_r)), np.float64)
    for start in range(0, len(common), MATRIX_COLUMNS):
        width = min(MATRIX_COLUMNS, len(common) - start)
        a, b = np.zeros((len(keep_l), width), np.float32), np.zeros((len(keep_r), width), np.float32)
        for m, place, row, col in ((a, place_l, lr, lc), (b, place_r, rr, rc)):
            use = (col >= start) & (col < start + width) & (place[row] >= 0)
            m[place[row[use]], col[use] - start] = 1
        total += a @ b.T
    out[np.ix_(keep_l, keep_r)] = total.astype(np.int64)
    return out


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether 100 * intersection >= percent * union, for every pair of sets."""
    inter = overlaps(left, right, percent)
    union = np.array([len(t) for t in left])[:, None] + np.array([len(t) for t in right])[None, :] - inter
    return 100 * inter >= percent * union


def opened_links(opened: DataFrame, tokens: DataFrame, percent: int, counted: bool) -> DataFrame:
    """(a, b, n): edges a - b that connect what the opened pairs link or, if ``counted``, n linked documents per class a."""

    def spanning(names_l: list[str], names_r: list[str], link: np.ndarray) -> list[tuple[str, str, int]]:
        parent: dict[str, str] = {}

        def root(x: str) -> str:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        edges = []
        for i, j in zip(*np.nonzero(link), strict=True):
            x, y = root(names_l[i]), root(names_r[j])
            if x != y:
                parent[max(x, y)] = min(x, y)
                edges.append((min(x, y), max(x, y), 0))
        return edges

    def open_pair(rows: pd.DataFrame) -> pd.DataFrame:
        inside = bool((rows["side"] == 2).any())
        sides = [rows if inside else rows[rows["side"] == i] for i in (0, 1)]
        if not len(sides[0]) or not len(sides[1]):
            return pd.DataFrame(columns=["a", "b", "n"])
        sets = [[np.frombuffer(t, np.uint64) for t in side["tokens"]] for side in sides]
        names, copies = [list(side["cls"]) for side in sides], [side["copies"].to_numpy() for side in sides]
        link = linked(*sets, percent)
        if inside:
            np.fill_diagonal(link, False)
        counts = [(0, link @ copies[1])] if inside else [(0, link @ copies[1]), (1, link.T @ copies[0])]
        out = [(names[s][i], None, int(n[i])) for s, n in counts for i in np.flatnonzero(n)] if counted else spanning(*names, link)
        return pd.DataFrame(out, columns=["a", "b", "n"])

    # At most two groups' sets come together.
    rows = opened.join(tokens, "cls").groupBy("a", "b").applyInPandas(open_pair, "a string, b string, n long")
    return stored(rows, "jaccard-links")


def links_of(docs: DataFrame, sets: DataFrame, groups: DataFrame, pairs: DataFrame, k: int, percent: int, counted: bool = False) -> DataFrame:
    """``opened_links`` of the pairs of groups."""
    opened = within_reach(sets, groups, pairs, percent)
    return opened_links(opened, rebuilt(docs, groups, opened, k), percent, counted)


def labelled_classes(docs: DataFrame, sets: DataFrame, k: int, percent: int) -> DataFrame:
    """(cls, doc_id, key, copies, n, label): every class with the component that links reach."""
    classes = classes_of(sets)
    by_hash = F.inline(F.array(*(F.struct(F.lit(i).alias("way"), F.col(f"m{i}").alias("low")) for i in range(3))))
    ways = classes.select("cls", "n", "m0", "m1", "m2", by_hash)
    near = stored(cut(ways, ["way", "low"], ["m0", "m1", "m2", "cls"], alone=False, chained=True).join(classes.select("cls", "doc_id", "key", "copies"), "cls"), "jaccard-near")
    first = links_of(docs, sets, near, inside(near), k, percent).select("a", "b")

    def labelled(rows: DataFrame, edges: DataFrame) -> DataFrame:
        """Rows whose label is that of the component their label belongs to, by edges between labels."""
        found = components(edges).select(F.col("node").alias("l_node"), F.col("label").alias("l_label"))
        moved = rows.join(found, F.col("label") == F.col("l_node"), "left")
        return stored(moved.select("cls", "doc_id", "key", "copies", "n", F.coalesce("l_label", "label").alias("label")), "jaccard-labels")

    contracted = labelled(classes.withColumn("label", F.col("cls")), first)
    groups = by_label(contracted)
    across = links_of(docs, sets, groups, qualifying(sets, groups, percent), k, percent)
    of = lambda x: contracted.select(F.col("cls").alias(x), F.col("label").alias(f"{x}_label"))
    between = across.select("a", "b").join(of("a"), "a").join(of("b"), "b").select(F.col("a_label").alias("a"), F.col("b_label").alias("b"))
    return labelled(contracted, between)


def by_label(classes: DataFrame) -> DataFrame:
    """Groups of bounded size of the classes of each component, with ``label``."""
    bins = cut(classes.select("cls", "n", "label"), ["label"], ["cls"])
    return stored(bins.join(classes.select("cls", "doc_id", "key", "copies", "label"), "cls"), "jaccard-groups")


def numbers_of_links(docs: DataFrame, sets: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(cls, others): documents of other classes that each class is linked with; those without links are left out."""
    groups = by_label(classes)
    bins = groups.select("bin", "label").distinct()
    other = bins.select(F.col("bin").alias("b"), F.col("label").alias("b_label"))
    # All groups of a component; links never leave it.
    apart = bins.join(other, (F.col("label") == F.col("b_label")) & (F.col("bin") < F.col("b"))).select(F.col("bin").alias("a"), "b")
    pairs = stored(apart.unionByName(inside(groups)), "jaccard-count-pairs")
    counted = links_of(docs, sets, groups, pairs, k, percent, counted=True)
    return counted.groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("others"))


def similar_documents(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, key (md5 of the text), n_shingles, n_links, component_id of every document.

    Two documents are linked when 100 * intersection >= ``percent`` * union of their sets of ``k``-word shingles.
    n_links counts linked documents, copies included; component_id is the smallest doc_id that links reach (null if
    all of them are null). Texts without words (null, empty, blank) have no shingles and no links; with fewer than ``k``
    words the whole sequence is the shingle. Repeated rows are linked with each other. An empty table gives an empty
    result; other columns are ignored.
    """
    sets = sets_of(docs, k, percent)
    classes = labelled_classes(docs, sets, k, percent)
    degrees = numbers_of_links(docs, sets, classes, k, percent)
    return documents_of(sets, classes.join(degrees, "cls", "left").withColumn("n_links", F.coalesce("others", F.lit(0)) + F.col("copies") - 1)).drop("label")


def documents_of(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """doc_id, key, n_shingles, n_links, component_id, label of every document; label tells components apart that share
    their smallest id."""
    heads = classes.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    known = stored(classes.select("cls", "n_links", "label").join(heads, "label"), "jaccard-classes")
    rows = sets.select("doc_id", "key", "cls", F.col("n").alias("n_shingles"))
    full = rows.filter("n_shingles > 0").join(known, "cls").select("doc_id", "key", "n_shingles", "n_links", "component_id", "label")
    bare = rows.filter("n_shingles = 0").select("doc_id", "key", "n_shingles", F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"), F.lit(None).cast("string").alias("label"))
    return full.unionByName(bare)


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs``, all columns: of each group of near duplicates, the one with the smallest id.

    Documents without words have no duplicates and stay. Of rows that repeat in id and text one stays.
    """
    sets = sets_of(docs, k, percent)
    heads = stored(
        labelled_classes(docs, sets, k, percent).groupBy("label").agg(F.min(first_row()).alias("head")).select("head.*"), "near-duplicates"
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = docs.select(
        F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"), F.md5(text).alias("key"), (~text.rlike(r"[^\x20\x09-\x0D]")).alias("bare"),
    )
    named = heads.select(F.col("doc_id").alias("h_id"), F.col("key").alias("h_key")).hint("shuffle_hash")
    chosen = marked.filter(~F.col("bare")).join(named, (F.col("key") == F.col("h_key")) & F.col("id").eqNullSafe(F.col("h_id")), "left_semi")
    kept = chosen.dropDuplicates(["id", "key"]).unionByName(marked.filter("bare"))
    return kept.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))
