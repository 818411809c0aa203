"""Mixing sources to target weights.

Every document gets a hash-random key. Within a source the documents stand in the order of their keys, in ranges that
the key's first digits name; word counts are summed per range, prefix sums over the ranges find the range that holds
the end of the source's budget, and only that range is sorted to find the exact key of the cut. A budget above the
source's own size takes all documents once or more before the cut ("epochs").
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import WORD, stored

BROADCAST_SOURCES = 100_000
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = 29
#: Documents that one key range holds on average; the number of ranges follows from the number of documents.
RANGE_ROWS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_key(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """Hash-random key; equal only for rows of equal id and text."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit("~"))
    return F.md5(F.concat_ws(":", part(doc_id), F.md5(part(text)), F.lit(str(seed))))


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, m_source, m_key, size) of every document, without its text."""
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("m_source"),
        mix_key(F.col("doc_id"), F.col("text"), seed).alias("m_key"), word_count(F.col("text")).alias("size"),
    )


def source_targets(
    slim: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """One row per source: m_source, source_size, m_rows, target, m_budget (whole words).

    Sources in code point order, null last, weigh ``weights`` in turn. Sources in the order of limit / weight reach
    their limit first, so a running sum says which of them do, and what is left for the others.
    """
    totals = slim.groupBy("m_source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("m_rows"))
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("m_source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    # Windows over the table of sources: one row per source, whatever the number of documents.
    ranked = totals.select("*", weight.cast("double").alias("m_weight")).select(
        "*", (F.sum("source_size").over(everything) * F.lit(share)).alias("m_all"),
        F.sum("m_weight").over(everything).alias("m_weights"),
        (F.lit(float(most_epochs)) * F.col("source_size")).alias("m_limit"),
    )
    order = Window.orderBy(F.col("m_limit") / F.col("m_weight"), F.col("m_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    run = ranked.select(
        "*", (F.col("m_all") - F.coalesce(F.sum("m_limit").over(before), F.lit(0.0))).alias("m_left"),
        (F.col("m_weights") - F.coalesce(F.sum("m_weight").over(before), F.lit(0.0))).alias("m_left_weight"),
    ).withColumn("m_full", F.col("m_left") * F.col("m_weight") > F.col("m_limit") * F.col("m_left_weight"))
    # All sources before the first that stays below its limit are full.
    first_open = F.min_by(F.struct("m_left", "m_left_weight"), F.struct(F.col("m_limit") / F.col("m_weight"), F.col("m_source").isNull(), "m_source"))
    opened = run.filter(~F.col("m_full")).agg(first_open.alias("o"))
    rate = F.col("o.m_left") / F.col("o.m_left_weight")
    target = F.when(F.col("m_full"), F.col("m_limit")).otherwise(F.least("m_limit", rate * F.col("m_weight")))
    return run.join(F.broadcast(opened)).select(
        "m_source", "source_size", "m_rows", target.alias("target"), F.floor(target + F.lit(1e-9)).cast("long").alias("m_budget")
    )


def source_cuts(slim: DataFrame, targets: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Targets with m_epochs, m_cut (key of the document at the cut, null: none), m_part (words of that document)."""
    rows = targets.agg(F.max("m_rows")).first()[0] or 0
    digits = max(1, math.ceil(math.log(max(1, rows / range_rows), 16)))
    part = F.substring("m_key", 1, digits)
    budget = targets.select(
        "m_source", F.when(F.col("source_size") > 0, F.floor(F.col("m_budget") / F.col("source_size"))).otherwise(0).cast("long").alias("m_epochs"),
        F.when(F.col("source_size") > 0, F.col("m_budget") % F.col("source_size")).otherwise(0).alias("m_rest"),
    )
    same = lambda a, b: a["m_source"].eqNullSafe(b["m_source"])
    ranges = slim.groupBy("m_source", part.alias("m_range")).agg(F.sum("size").alias("m_words"))
    upto = Window.partitionBy("m_source").orderBy("m_range")
    ranges = ranges.select("*", (F.sum("m_words").over(upto) - F.col("m_words")).alias("m_before"))
    cut_range = ranges.join(budget, same(ranges, budget)).drop(budget["m_source"]).filter(
        (F.col("m_rest") > F.col("m_before")) & (F.col("m_rest") <= F.col("m_before") + F.col("m_words"))
    ).select("m_source", "m_range", (F.col("m_rest") - F.col("m_before")).alias("m_need"))
    keyed = slim.select("m_source", "m_key", "size", part.alias("m_range"))
    inside = Window.partitionBy("m_source", "m_range").orderBy("m_key")
    cut = (
        keyed.join(cut_range, same(keyed, cut_range) & (keyed["m_range"] == cut_range["m_range"]))
        .groupBy(keyed["m_source"], keyed["m_range"], keyed["m_key"], "m_need")
        .agg(F.sum("size").alias("m_words"), F.count(F.lit(1)).alias("m_ties"))
        .withColumn("m_upto", F.sum("m_words").over(inside))
        .filter((F.col("m_upto") >= F.col("m_need")) & (F.col("m_upto") - F.col("m_words") < F.col("m_need")))
        .select("m_source", F.col("m_key").alias("m_cut"),
                F.floor((F.col("m_need") - F.col("m_upto") + F.col("m_words")) / F.col("m_ties")).cast("long").alias("m_part"))
    )
    cut = cut.withColumnRenamed("m_source", "c_source")
    budget = budget.withColumnRenamed("m_source", "b_source")
    return (
        targets.join(budget, targets["m_source"].eqNullSafe(budget["b_source"]))
        .join(cut, targets["m_source"].eqNullSafe(cut["c_source"]), "left")
        .select(targets["m_source"].alias("t_source"), "source_size", "target", "m_epochs", "m_cut", "m_part")
    )


def in_epoch() -> Column:
    """Words of a document below or at the cut."""
    return (
        F.when(F.col("m_cut").isNull() | (F.col("m_key") > F.col("m_cut")), F.lit(0).cast("long"))
        .when(F.col("m_key") < F.col("m_cut"), F.col("size"))
        .otherwise(F.least("size", "m_part"))
    )


def with_cuts(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows with their source's cut. The cuts, one row per source, are broadcast after a check of their number; with more
    sources than that none is joined by hash alone either, adaptive execution splits a large one."""
    few = cuts.count() <= BROADCAST_SOURCES
    return rows.join(F.broadcast(cuts) if few else cuts, F.col("m_source").eqNullSafe(F.col("t_source")))


def mix_documents(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most_epochs: int = MOST_EPOCHS, seed: int = SEED
) -> DataFrame:
    """Words that the mix takes of each document: doc_id, size, source_size, target, taken.

    Null or empty text: size 0, nothing taken. Null source: a source of its own. Rows with equal id and text stand at
    the same place; at a cut they share the rest evenly. An empty table gives an empty result. Other columns are
    ignored. Reruns agree, because keys depend on id, text and seed alone. A source's taken words equal its target
    rounded down (less the remainder when repeated rows share a cut).
    """
    slim = stored(sized(docs, seed), "mix-sizes")
    targets = stored(source_targets(slim, weights, share, most_epochs), "mix-targets")
    cuts = stored(source_cuts(slim, targets), "mix-cuts")
    taken = F.col("m_epochs") * F.col("size") + in_epoch()
    return with_cuts(slim, cuts).select(
        "doc_id", "size", "source_size", "target", taken.alias("taken")
    )


def mixed_rows(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The mix itself: every document once per epoch that takes words of it.

    Columns of ``docs`` whose names do not clash, then size, source_size, target, epoch (from 0) and taken, the
    words of this row's text that belong to the mix: all of them but for the one document at its source's cut. Its text
    stays whole. Documents of which nothing is taken are left out.
    """
    slim = stored(sized(docs, seed), "mix-sizes")
    targets = stored(source_targets(slim, **options), "mix-targets")
    cuts = stored(source_cuts(slim, targets), "mix-cuts")
    added = ["size", "source_size", "target", "epoch", "taken"]
    kept = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in added]
    rows = docs.select(
        F.struct("*").alias("doc"), F.col("source").cast("string").alias("m_source"), mix_key(F.col("doc_id"), F.col("text"), seed).alias("m_key"),
        word_count(F.col("text")).alias("size"),
    )
    takes = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("m_epochs")),
        lambda e: F.struct(e.alias("epoch"), F.when(e < F.col("m_epochs"), F.col("size")).otherwise(in_epoch()).alias("taken")),
    )
    taken = with_cuts(rows, cuts).select("doc", "size", "source_size", "target", F.inline(takes)).filter("taken > 0")
    return taken.select(*kept, *added)
