"""Monitoring rows and the quality, profile, drift and latency figures over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.ratios import count_where, long_form, ratio
from riskframe.operators.ordered import quantiles, quartiles
from riskframe.operators.positions import running
from riskframe.schemas import REQUEST_ID
from riskframe.spec import ALERT_BELOW_PERCENT, CREDIT, MONITOR_WINDOW, TableSpec


def known_labels(*tables: DataFrame, spec: TableSpec = CREDIT) -> DataFrame:
    """One label per key; where several tables know the key, the earliest table wins."""
    ranked = None
    for i, t in enumerate(tables):
        rows = t.select(spec.key, F.col(spec.label).cast("double").alias("label"), F.lit(i).alias("place"))
        ranked = rows if ranked is None else ranked.unionByName(rows)
    # Partial aggregation keeps one candidate per key and task.
    return (
        ranked.filter(F.col("label").isNotNull())
        .groupBy(spec.key)
        .agg(F.min(F.struct("place", "label"))["label"].alias("default"))
    )


def monitoring_rows(
    parsed: DataFrame, labels: Sequence[DataFrame], features: DataFrame | None = None, spec: TableSpec = CREDIT
) -> DataFrame:
    """Parsed log rows that have a prediction and a known label, with their features if given.

    Labels and features are brought together per key first, so the log, where one key may be very frequent, is joined once;
    adaptive execution splits the log rows of such a key.
    """
    reference = known_labels(*labels, spec=spec)
    if features is not None:
        reference = reference.join(features.select(*spec.clean), spec.key, "left")
    usable = parsed.withColumn("prediction", F.col("prediction").cast("double")).dropna(
        subset=["prediction", spec.key]
    )
    joined = usable.join(reference, spec.key)
    return joined.select(*parsed.columns, "default", *(spec.features if features is not None else ()))


def monitoring_incremental(rows: DataFrame, stored: DataFrame, keys: Sequence[str] = (REQUEST_ID,)) -> DataFrame:
    """Rows whose ``keys`` are not stored yet; a rerun adds nothing. Rows without a request id go by their time as well."""
    unnamed = F.when(F.col(REQUEST_ID).isNull(), F.col("timestamp_ms"))
    there = stored.select(*keys, unnamed.alias("at")).distinct()
    there = there.select(*(F.col(c).alias(f"_there_{c}") for c in there.columns))
    same = unnamed.eqNullSafe(F.col("_there_at"))
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_there_{k}"))
    return rows.join(there, same, "left_anti")


def windowed(width: str = MONITOR_WINDOW, time: str = "timestamp") -> Column:
    return F.window(time, width)["start"].alias("window_start")


def quality_profile(rows: DataFrame, width: str = MONITOR_WINDOW) -> DataFrame:
    """Per window and model: rows, confusion counts, accuracy, precision, recall, F1."""
    hit = F.col("prediction") == 1
    bad = F.col("default") == 1
    counts = rows.groupBy(windowed(width), "model_name").agg(
        F.count(F.lit(1)).alias("rows"),
        count_where(hit & bad).alias("tp"), count_where(hit & ~bad).alias("fp"),
        count_where(~hit & bad).alias("fn"), count_where(~hit & ~bad).alias("tn"),
    )
    return rates(counts)


def rates(counts: DataFrame) -> DataFrame:
    """Add the rates that follow from confusion counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({
        "accuracy_score": ratio(tp + tn, F.col("rows")),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    })


def accuracy_alert(profile: DataFrame, below_percent: float = ALERT_BELOW_PERCENT) -> DataFrame:
    """Windows whose accuracy in percent is under the threshold."""
    percent = F.col("accuracy_score") * 100
    return profile.select("window_start", "model_name", percent.alias("accuracy_percentage")).filter(
        F.col("accuracy_percentage") < below_percent
    )


def window_column_profile(rows: DataFrame, columns: Sequence[str], width: str = MONITOR_WINDOW) -> DataFrame:
    """Per window, model and column: rows, nulls, mean, deviation, min, max and exact quartiles."""
    figures = {
        "rows": lambda v: F.count(F.lit(1)), "nulls": lambda v: count_where(v.isNull()), "mean": F.avg,
        "std": F.stddev_samp, "min": F.min, "max": F.max,
    }
    return quartiles(rows.select(windowed(width), "model_name", *columns), columns, ["window_start", "model_name"], figures)


def bin_edges(baseline: DataFrame, columns: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Inner bin limits per column at exact baseline quantiles; bins - 1 numbers per column."""
    shares = [i / bins for i in range(1, bins)]
    found = quantiles(baseline, columns, shares).collect()
    return {r["column"]: sorted({q for q in r["quantiles"] if q is not None}) for r in found}


def bin_of(value: Column, edges: Sequence[float]) -> Column:
    """How many of the limits the value is above."""
    place = F.lit(0)
    for e in edges:
        place = place + F.when(value.cast("double") > e, 1).otherwise(0)
    return place


def binned_shares(baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """(column, bin, base_share, now_share): bin i holds the values above i of the limits."""
    edges = bin_edges(baseline, columns, bins)
    side = [baseline.withColumn("_now", F.lit(0)), current.withColumn("_now", F.lit(1))]
    cells = [F.struct(F.lit(c).alias("column"), F.when(F.col(c).isNotNull(), bin_of(F.col(c), edges.get(c, []))).alias("bin")) for c in columns]
    both = side[0].select("_now", *columns).unionByName(side[1].select("_now", *columns))
    counts = (
        both.select("_now", F.inline(F.array(*cells)))
        .filter(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(count_where(F.col("_now") == 0).alias("base"), count_where(F.col("_now") == 1).alias("now"))
    )
    whole = Window.partitionBy("column")
    return counts.select(
        "column", "bin",
        ratio(F.col("base"), F.sum("base").over(whole)).alias("base_share"),
        ratio(F.col("now"), F.sum("now").over(whole)).alias("now_share"),
    )


def drift_psi(baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10, floor: float = 1e-6):
    """Population stability index per column over baseline quantile bins; empty shares count as ``floor``."""
    b = F.greatest(F.col("base_share"), F.lit(floor))
    n = F.greatest(F.col("now_share"), F.lit(floor))
    return binned_shares(baseline, current, columns, bins).groupBy("column").agg(
        F.sum((n - b) * F.log(n / b)).alias("psi")
    )


def drift_ks(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact two-sample Kolmogorov-Smirnov statistic per column: the largest gap between the two distributions.

    Both sides collapse to distinct values with two counts; running counts over key ranges give both distributions at every
    value. Nulls take no part. A column without values on one side has no statistic.
    """
    sides = [t.select(F.lit(i).alias("_now"), *columns).select(*long_form(list(columns), "_now")) for i, t in enumerate((baseline, current))]
    both = sides[0].unionByName(sides[1]).filter(F.col("value").isNotNull())
    counted = both.groupBy("column", "value").agg(
        count_where(F.col("_now") == 0).alias("base"), count_where(F.col("_now") == 1).alias("now")
    )
    placed = running(counted, ["column"], "value", ["base", "now"])
    gap = F.abs(F.try_divide("base_upto", F.col("base_all")) - F.try_divide("now_upto", F.col("now_all")))
    return placed.groupBy("column").agg(F.max(gap).alias("ks"))


def drift_shift(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Change of mean and of null share per column."""
    def stats(df: DataFrame, name: str) -> DataFrame:
        return df.select(*long_form(list(columns))).groupBy("column").agg(
            F.avg("value").alias(f"mean_{name}"),
            ratio(count_where(F.col("value").isNull()), F.count(F.lit(1))).alias(f"nulls_{name}"),
        )

    both = stats(baseline, "base").join(stats(current, "now"), "column")
    return both.select(
        "column", (F.col("mean_now") - F.col("mean_base")).alias("mean_shift"),
        (F.col("nulls_now") - F.col("nulls_base")).alias("null_share_shift"),
    )


def window_drift(rows: DataFrame, columns: Sequence[str], width: str = MONITOR_WINDOW, bins: int = 10, floor: float = 1e-6) -> DataFrame:
    """(window_start, model_name, column, psi, mean_shift): every window against the model's window before it.

    The window before is the last one that has rows, however long ago. Bins end at exact quantiles of all rows; windows keep
    only their counts per bin, value sums and row counts, which later rows can be added to. A column without values in one
    of the two windows has no row, nor has a model's first window.
    """
    edges = bin_edges(rows, columns, bins)
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"), bin_of(F.col(c), edges.get(c, [])).alias("bin")) for c in columns
    ]
    timed = rows.select(windowed(width), "model_name", *columns)
    binned = timed.select("window_start", "model_name", F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    kept = binned.groupBy("model_name", "window_start", "column", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    # One row per model and window.
    following = timed.select("model_name", "window_start").distinct().withColumn(
        "next_start", F.lead("window_start").over(Window.partitionBy("model_name").orderBy("window_start"))
    ).filter(F.col("next_start").isNotNull())
    zero, nothing = F.lit(0).cast("long"), F.lit(0.0)
    now = kept.select("model_name", "window_start", "column", "bin", F.col("n").alias("now"), F.col("total").alias("now_total"), zero.alias("base"), nothing.alias("base_total"))
    base = kept.join(following, ["model_name", "window_start"]).select(
        "model_name", F.col("next_start").alias("window_start"), "column", "bin", zero.alias("now"), nothing.alias("now_total"), F.col("n").alias("base"), F.col("total").alias("base_total")
    )
    by = ["model_name", "window_start", "column"]
    sums = ["now", "now_total", "base", "base_total"]
    paired = now.unionByName(base).groupBy(*by, "bin").agg(*(F.sum(c).alias(c) for c in sums))
    whole = Window.partitionBy(*by)  # a row per bin
    shares = paired.withColumns({f"{s}_all": F.sum(s).over(whole) for s in sums}).filter((F.col("now_all") > 0) & (F.col("base_all") > 0))
    n, b = (F.greatest(F.col(s) / F.col(f"{s}_all"), F.lit(floor)) for s in ("now", "base"))
    shift = F.first(F.col("now_total_all") / F.col("now_all") - F.col("base_total_all") / F.col("base_all"))
    return shares.groupBy("window_start", "model_name", "column").agg(F.sum((n - b) * F.log(n / b)).alias("psi"), shift.alias("mean_shift"))


def latency_profile(log: DataFrame, width: str = MONITOR_WINDOW) -> DataFrame:
    """Per window: requests, mean and largest execution time, exact median and 95th percentile."""
    from riskframe.operators.payload import log_second

    timed = log.select(log_second(F.col("timestamp_ms")).alias("timestamp"), "execution_time_ms").select(
        windowed(width), "execution_time_ms"
    )
    figures = {"requests": lambda v: F.count(F.lit(1)), "mean_ms": F.avg, "max_ms": F.max}
    q = quantiles(timed, ["execution_time_ms"], [0.5, 0.95], ["window_start"], also=figures)
    return q.select(
        "window_start", "requests", "mean_ms", F.col("max_ms").cast("bigint").alias("max_ms"),
        F.col("quantiles")[0].alias("p50_ms"), F.col("quantiles")[1].alias("p95_ms"),
    )
