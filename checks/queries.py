"""Every registered query: (spark, sf_dir) -> DataFrame over the given tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.views import credit, credit_raw, part, payload, table
from riskframe.operators import balance, clean, features, metrics, models, monitor, ordered, profile, scale, split, synth
from riskframe.operators.payload import parse_bodies, parse_payload, payload_json, quarantine
from riskframe.operators.projections import near_by_projections
from riskframe.plans import compare, ingest, prepare, refresh
from riskframe.schemas import RECORDS, REQUEST_ID, feature_table_schema, log_schema
from riskframe.session import scratch_path
from riskframe.sources import scan, tables
from riskframe.spec import CREDIT, FEATURES, RAW_TARGET, ROBUST
from riskframe.streaming import ingest as stream_in
from riskframe.streaming import quality as stream_q
from riskframe.streaming import upsert as stream_up
from riskframe.streaming.sinks import file_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
AS_OF = datetime(2024, 1, 1)
LOADED_BEFORE = "2001-01-01"


def tidy(df: DataFrame) -> DataFrame:
    """Engine-neutral values: bigint, doubles of 6 places, text for times and arrays."""
    out = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.BooleanType):
            c = c.cast("int").cast("bigint")
        elif isinstance(t, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(t, T.FractionalType):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(t, T.TimestampType | T.TimestampNTZType):
            c = F.date_format(c, TIME)
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: tidy(query(spark, sf_dir))
        return query

    return add


def parts(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    rows = credit(spark, sf_dir)
    return [part(rows, n) for n in names]


def stored(df: DataFrame, purpose: str, files: int | None = None) -> DataFrame:
    """The rows as a table in the shared folder, as the jobs keep them between steps."""
    path = scratch_path(df.sparkSession, purpose)
    (df.repartition(files) if files else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- monitoring ---------------------------------------------------------------------------------

LABELS = ("train", "normal", "skewed")


@register("parse_payload")
def _(spark, d):
    return parse_payload(payload(spark, d), first_prediction=True)


@register("parse_payload_multi")
def _(spark, d):
    """Three-record requests, one per event, with two predictions each."""
    e = table(spark, d, "events")
    i = F.col("event_id")
    records = F.array(*(F.struct((F.col("user_id") + n).cast("string").alias("Id")) for n in range(3)))
    request_id = F.concat(F.lit("req-"), i.cast("string"))
    log = e.select(
        request_id.alias("databricks_request_id"),
        F.expr("unix_micros(CAST(ts AS TIMESTAMP)) div 1000").alias("timestamp_ms"),
        (i % 200).alias("execution_time_ms"),
        F.to_json(F.struct(records.alias("dataframe_records"))).alias("request"),
        F.format_string('{"predictions": [%d.0, %d.0]}', i % 2, (i + 1) % 2).alias("response"),
    )
    return parse_payload(log, with_position=True)


@register("payload_quarantine")
def _(spark, d):
    return quarantine(payload(spark, d)).select("databricks_request_id", "reason")


@register("monitoring_rows")
def _(spark, d):
    return refresh.monitored(payload(spark, d), parts(spark, d, *LABELS))


@register("monitoring_with_features")
def _(spark, d):
    known = scan.conform(credit(spark, d), feature_table_schema())
    return refresh.monitored(payload(spark, d), parts(spark, d, *LABELS), known)


@register("monitoring_incremental")
def _(spark, d):
    rows = refresh.monitored(payload(spark, d), parts(spark, d, *LABELS))
    stored = rows.filter(F.col("timestamp") < "2024-01-10")
    return monitor.monitoring_incremental(rows, stored)


@register("quality_profile")
def _(spark, d):
    return refresh.quality(payload(spark, d), parts(spark, d, *LABELS))


@register("accuracy_alert")
def _(spark, d):
    return monitor.accuracy_alert(refresh.quality(payload(spark, d), parts(spark, d, *LABELS)))


@register("window_column_profile")
def _(spark, d):
    known = scan.conform(credit(spark, d), feature_table_schema())
    rows = refresh.monitored(payload(spark, d), parts(spark, d, *LABELS), known)
    model = F.concat_ws("_", "model_name", (F.col("execution_time_ms") % 2).cast("string"))  # two models
    rows = stored(rows.withColumn("model_name", model), "monitoring")
    return monitor.window_column_profile(rows, ["prediction", *FEATURES])


@register("drift_psi")
def _(spark, d):
    base, now = parts(spark, d, "normal", "skewed")
    return monitor.drift_psi(base, clean.inject_drift(now), FEATURES)


@register("drift_ks")
def _(spark, d):
    base, now = parts(spark, d, "normal", "skewed")
    return monitor.drift_ks(base, clean.inject_drift(now), FEATURES)


@register("drift_shift")
def _(spark, d):
    base, now = parts(spark, d, "normal", "skewed")
    return monitor.drift_shift(base, clean.inject_drift(now), FEATURES)


@register("window_drift")
def _(spark, d):
    """Four-hour windows of two models, each against the one before."""
    known = scan.conform(credit(spark, d), feature_table_schema())
    rows = refresh.monitored(payload(spark, d), parts(spark, d, *LABELS), known)
    model = F.concat_ws("_", "model_name", (F.col("execution_time_ms") % 2).cast("string"))
    return monitor.window_drift(stored(rows.withColumn("model_name", model), "monitoring"), ["prediction", *ROBUST], "4 hours")


@register("latency_profile")
def _(spark, d):
    return monitor.latency_profile(payload(spark, d))


@register("payload_json")
def _(spark, d):
    return payload_json(credit(spark, d))


@register("payload_read_back")
def _(spark, d):
    """The records of the request bodies, as the log parser reads them."""
    log = payload_json(credit(spark, d)).select("request", F.lit(None).cast("string").alias("response"))
    return parse_bodies(log).select(F.inline(f"request_body.{RECORDS}"))


# --- scanning, cleaning, gates ------------------------------------------------------------------


@register("scan_csv")
def _(spark, d):
    path = scratch_path(spark, "extract")
    credit_raw(spark, d).write.option("header", True).csv(path)
    return scan.scan_csv(spark, path).withColumnRenamed(RAW_TARGET, "target")


@register("conform_schema")
def _(spark, d):
    return scan.conform(credit(spark, d), feature_table_schema())


@register("rename_capitalize")
def _(spark, d):
    return clean.rename_capitalize(credit_raw(spark, d))


@register("value_corrections")
def _(spark, d):
    return clean.correct_values(clean.rename_capitalize(credit_raw(spark, d)))


@register("clean")
def _(spark, d):
    return clean.require_clean(clean.clean(credit_raw(spark, d)))


@register("ints_to_double")
def _(spark, d):
    return clean.ints_to_double(credit(spark, d).drop("Default", CREDIT.updated_at))


@register("drop_select")
def _(spark, d):
    return credit(spark, d).drop(CREDIT.updated_at).select(*CREDIT.clean)


@register("null_profile")
def _(spark, d):
    return clean.null_profile(with_nulls(credit(spark, d)))


def with_nulls(df: DataFrame) -> DataFrame:
    """Ages of every 7th customer unknown."""
    return df.withColumn("Age", F.when(F.col("Id").cast("bigint") % 7 != 0, F.col("Age")))


@register("domain_violations")
def _(spark, d):
    return clean.domain_violations(clean.rename_capitalize(credit_raw(spark, d)))


@register("inject_drift")
def _(spark, d):
    return clean.inject_drift(credit(spark, d))


# --- profiles and keys --------------------------------------------------------------------------


@register("unique_values")
def _(spark, d):
    return profile.unique_values(credit(spark, d), [*CREDIT.categories, "Default", "Limit_bal"])


@register("column_profile")
def _(spark, d):
    return profile.column_profile(with_nulls(credit(spark, d)), [*FEATURES, "Default"])


@register("quartiles")
def _(spark, d):
    return ordered.quartiles(credit(spark, d), ROBUST)


@register("row_counts")
def _(spark, d):
    names = ["train", "test", "normal", "skewed"]
    return profile.row_counts(**dict(zip(names, parts(spark, d, *names), strict=True)))


@register("id_set")
def _(spark, d):
    return profile.id_set(*parts(spark, d, "train", "test", "train"))


@register("duplicate_rows")
def _(spark, d):
    return profile.duplicate_rows(
        table(spark, d, "lineitem"), "l_orderkey", ["l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    ).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")


@register("pk_violations")
def _(spark, d):
    return profile.pk_violations(table(spark, d, "lineitem"), "l_orderkey")


@register("head_rows")
def _(spark, d):
    return split.head_rows(credit(spark, d), 5)


@register("tail_rows")
def _(spark, d):
    return split.head_rows(credit(spark, d), 5, tail=True)


@register("row_slice")
def _(spark, d):
    return split.row_slice(credit(spark, d), 112, 113)


@register("union_by_name")
def _(spark, d):
    train, test = parts(spark, d, "train", "test")
    return profile.union_by_name(train, test.select(*reversed(test.columns)))


@register("union_inference")
def _(spark, d):
    return profile.union_by_name(*parts(spark, d, "normal", "skewed")).select("Id", "Default")


# --- splits, samples, keys ----------------------------------------------------------------------


@register("split_exact")
def _(spark, d):
    return split.split_exact(credit(spark, d)).select("Id", "Default", "split")


@register("split_bernoulli")
def _(spark, d):
    return split.split_bernoulli(credit(spark, d)).select("Id", "split")


@register("split_stratified")
def _(spark, d):
    return split.split_stratified(credit(spark, d)).select("Id", "Default", "split")


@register("stamp_split")
def _(spark, d):
    return prepare.prepared(credit_raw(spark, d), AS_OF)


@register("sample_with_replacement")
def _(spark, d):
    return split.sample_with_replacement(credit(spark, d), 1000)


@register("new_ids")
def _(spark, d):
    normal, skewed, train = parts(spark, d, "normal", "skewed", "train")
    return features.new_ids(skewed.select("Id", "Limit_bal"), normal, train, skewed)


# --- incremental features -----------------------------------------------------------------------


def loaded(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All rows as source; train and test rows loaded before a date."""
    rows = credit(spark, d)
    old = rows.filter(F.col(CREDIT.updated_at) < LOADED_BEFORE)
    return rows, part(old, "train"), part(old, "test")


@register("high_water_mark")
def _(spark, d):
    _, train, test = loaded(spark, d)
    return features.high_water_mark(train, test)


@register("new_rows")
def _(spark, d):
    return features.new_rows(*loaded(spark, d))


@register("ingest_rows")
def _(spark, d):
    return ingest.incoming(*loaded(spark, d)).select("Id", CREDIT.updated_at, "split")


@register("feature_insert")
def _(spark, d):
    """Every new row of the source was loaded, into train or test."""
    source, train, test = loaded(spark, d)
    batch = ingest.incoming(source, train, test)
    of = {p: batch.filter(F.col("split") == p).drop("split") for p in ("train", "test")}
    mark = features.high_water_mark(train, test)
    return ingest.feature_rows(source, train.unionByName(of["train"]), test.unionByName(of["test"]), mark)


@register("insert_delta")
def _(spark, d):
    source, train, test = loaded(spark, d)
    return features.insert_delta(profile.union_by_name(train, test), features.new_rows(source, train, test))


@register("feature_lookup")
def _(spark, d):
    (train,) = parts(spark, d, "train")
    store = scan.conform(part(credit(spark, d), "train"), feature_table_schema()).filter(F.col("Age") > 30)
    return features.feature_lookup(train, store, FEATURES, [CREDIT.updated_at])


@register("training_set")
def _(spark, d):
    (train,) = parts(spark, d, "train")
    return prepare.training_set(train, scan.conform(credit(spark, d), feature_table_schema()))


@register("point_lookup")
def _(spark, d):
    return features.point_lookup(scan.conform(credit(spark, d), feature_table_schema()), ["17", "112", "1003", "x"])


def snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two states of a keyed table: the second lost every 11th key, gained every 13th, and doubled some limits."""
    rows = credit(spark, d)
    n = F.col("Id").cast("bigint")
    limit = F.when(n % 5 == 0, F.col("Limit_bal") * 2).otherwise(F.col("Limit_bal"))
    return rows.filter(n % 13 != 0), rows.filter(n % 11 != 0).withColumn("Limit_bal", limit)


@register("change_feed")
def _(spark, d):
    return features.change_feed(*snapshots(spark, d))


def versions(spark: SparkSession, d: str, marked: bool = False) -> DataFrame:
    """Every order is a new version of its customer's row."""
    extra = [(F.col("o_orderstatus") == "P").alias("gone")] if marked else []
    return table(spark, d, "orders").select(
        F.col("o_custkey").cast("string").alias("Id"), "o_orderkey", "o_totalprice",
        F.col("o_orderdate").cast("timestamp").alias(CREDIT.updated_at), *extra,
    )


@register("upsert_latest")
def _(spark, d):
    old = F.col(CREDIT.updated_at) < "1999-01-01"
    changes = versions(spark, d, marked=True).filter(~old)
    return features.upsert_latest(versions(spark, d).filter(old), changes, deletes="gone")


# --- scaling and metrics ------------------------------------------------------------------------


@register("robust_scale")
def _(spark, d):
    train, test = parts(spark, d, "train", "test")
    return scale.robust_scale(train, test)


@register("auc_exact")
def _(spark, d):
    rows = table(spark, d, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_extendedprice", "l_quantity", "l_discount"
    )
    return metrics.auc(rows, ["l_extendedprice", "l_quantity", "l_discount"], "y")


@register("auc_documents")
def _(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id")
    return metrics.auc(rows, "n_chars", "quality")


def judged(spark: SparkSession, d: str) -> DataFrame:
    """Test rows with two hand-made risk scores and a hard class."""
    (test,) = parts(spark, d, "test")
    new = F.round((F.col("Pay_0") * 8 + F.col("Pay_2") * 2 + F.col("Age") / 10.0) / 100.0, 4)
    old = F.round((F.col("Pay_3") * 6 + F.col("Pay_0") * 3) / 100.0, 4)
    rows = test.select("Id", "Default", new.alias("new"), old.alias("old"))
    return rows.withColumn("prediction", F.when(F.col("new") > 0.4, 1.0).otherwise(0.0))


@register("auc_hard_labels")
def _(spark, d):
    return metrics.auc(judged(spark, d), "prediction")


@register("confusion_matrix")
def _(spark, d):
    return metrics.confusion_matrix(judged(spark, d))


@register("classification_report")
def _(spark, d):
    return metrics.classification_report(judged(spark, d))


@register("log_loss")
def _(spark, d):
    return metrics.log_loss(judged(spark, d), "Default", "new")


def two_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = judged(spark, d)
    return metrics.score_join(
        rows.select("Id", "Default"),
        rows.select("Id", F.col("new").alias("prediction")),
        rows.select("Id", F.col("old").alias("prediction")),
    )


@register("score_join")
def _(spark, d):
    return two_scores(spark, d)


@register("champion_challenger")
def _(spark, d):
    return metrics.champion_challenger(two_scores(spark, d))


# --- balancing and synthesis --------------------------------------------------------------------


@register("smote_neighbors")
def _(spark, d):
    return balance.smote_neighbors(*parts(spark, d, "train"))


@register("smote_balance")
def _(spark, d):
    return balance.smote_balance(*parts(spark, d, "train"))


@register("smote_lsh")
def _(spark, d):
    """Neighbours of minority rows by projection orders."""
    return balance.smote_neighbors(*parts(spark, d, "train"), search=near_by_projections)


@register("embedding_neighbors")
def _(spark, d):
    """Five nearest vectors of every embedding, on its 64 numbers."""
    e = table(spark, d, "embeddings")
    numbers = e.select(
        F.col("vec_id").cast("string").alias("Id"),
        *(F.element_at("embedding", i + 1).cast("double").alias(f"x{i}") for i in range(64)),
    )
    from riskframe.operators.neighbors import nearest

    return nearest(numbers, [f"x{i}" for i in range(64)])


def made(spark: SparkSession, d: str, drift: bool) -> DataFrame:
    train, test = parts(spark, d, "train", "test")
    return synth.synthesize(profile.union_by_name(train, test), 1000, drift=drift, as_of=AS_OF)


@register("synthetic_rows")
def _(spark, d):
    return made(spark, d, False)


@register("synthetic_skewed")
def _(spark, d):
    return made(spark, d, True)


# --- models and scoring -------------------------------------------------------------------------


@lru_cache(maxsize=4)
def fit_rows(spark: SparkSession, d: str) -> tuple[DataFrame, models.Scaling]:
    """Training rows and their scaling, fitted once for all models."""
    (rows,) = parts(spark, d, "train")
    return rows, models.fit_scaling(rows)


MODELS: dict[tuple[str, str, float], models.RiskModel] = {}


def trained(spark: SparkSession, d: str, *rates: float) -> list[models.RiskModel]:
    """A model per learning rate, trained once and shared by the scoring queries; those still missing side by side."""
    key = lambda rate: (spark.sparkContext.applicationId, d, rate)
    if missing := {r: r for r in rates if key(r) not in MODELS}:
        rows, scaling = fit_rows(spark, d)
        MODELS.update({key(r): m for r, m in models.train_variants(rows, missing, scaling=scaling).items()})
    return [MODELS[key(r)] for r in rates]


def model_a(spark: SparkSession, d: str) -> models.RiskModel:
    return trained(spark, d, 0.05)[0]


def both_models(spark: SparkSession, d: str) -> list[models.RiskModel]:
    return trained(spark, d, 0.05, 0.1)


@register("train_score")
def _(spark, d):
    scored = model_a(spark, d).score(*parts(spark, d, "test"))
    return scored.select("Id", "Default", "prediction", "probability")


@register("train_evaluate")
def _(spark, d):
    return models.evaluate(model_a(spark, d).score(*parts(spark, d, "test")))


@register("train_local")
def _(spark, d):
    """The local training job: losses by round and confusion counts of its validation rows."""
    return compare.training_report(*parts(spark, d, "train"))


@register("top_features")
def _(spark, d):
    return models.top_features(*parts(spark, d, "train"))


@register("score_batch")
def _(spark, d):
    (test,) = parts(spark, d, "test")
    store = scan.conform(credit(spark, d), feature_table_schema())
    return models.score_batch(model_a(spark, d), test.select("Id", "Default"), store).select(
        "Id", "Default", "prediction", "probability"
    )


@register("score_python_model")
def _(spark, d):
    def linear(batch):
        return batch["Pay_0"] * 0.1 + batch["Age"] * 0.01 + batch["Limit_bal"] / 1e4

    return models.score_with(credit(spark, d), linear, FEATURES, ["Id", "Default"])


@register("ab_route")
def _(spark, d):
    return models.ab_route(credit(spark, d).select("Id"))


@register("ab_score")
def _(spark, d):
    scored = models.ab_score(parts(spark, d, "test")[0], *both_models(spark, d))
    return scored.select("Id", "route", "prediction", "probability")


@register("ab_compare")
def _(spark, d):
    both = dict(zip("AB", both_models(spark, d), strict=True))
    return models.ab_compare(both, parts(spark, d, "test")[0])


@register("model_decision")
def _(spark, d):
    store = scan.conform(credit(spark, d), feature_table_schema())
    a, b = both_models(spark, d)
    return compare.compare(b, a, parts(spark, d, "test")[0], store)


@register("prediction_table")
def _(spark, d):
    return models.prediction_table(model_a(spark, d), *parts(spark, d, "train", "test"))


# --- streams ------------------------------------------------------------------------------------


def staged(df: DataFrame, purpose: str, files: int = 4) -> str:
    """Rows written to files of the shared folder for a stream to pick up."""
    path = scratch_path(df.sparkSession, purpose)
    df.repartition(files).write.parquet(path)
    return path


def two_versions(rows: DataFrame) -> DataFrame:
    """Every third row has an earlier version with another limit."""
    old = rows.filter(F.col("Id").cast("bigint") % 3 == 0).withColumns({
        "Limit_bal": F.col("Limit_bal") / 2, CREDIT.updated_at: F.col(CREDIT.updated_at) - F.expr("INTERVAL 1 DAY")})
    return rows.unionByName(old)


def streamed_in(spark: SparkSession, d: str) -> str:
    """Root of a load in batches; both versions of a key may come in any order."""
    rows = two_versions(credit(spark, d))
    root, mark = scratch_path(spark, "ingest"), scratch_path(spark, "mark")
    stream = file_stream(spark, staged(rows, "source"), rows.schema, files_per_batch=2)
    stream_in.stream_ingest(stream, root, mark)
    return root


@register("stream_ingest")
def _(spark, d):
    return stream_in.ingested(spark, streamed_in(spark, d)).select("Id", "Default", "Limit_bal", "split")


@register("stream_ingest_features")
def _(spark, d):
    return stream_in.streamed_features(spark, streamed_in(spark, d))


def log_stream(spark: SparkSession, d: str) -> DataFrame:
    """The log, every request twice, in as many files as its size asks for, picked up in four batches."""
    path = scratch_path(spark, "log")
    log = payload(spark, d).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(2))))
    log.repartition("copy", REQUEST_ID).drop("copy").write.parquet(path)
    files = len(spark.read.parquet(path).inputFiles())
    return file_stream(spark, path, log_schema(), files_per_batch=max(1, math.ceil(files / 4)))


@register("stream_payload")
def _(spark, d):
    out = scratch_path(spark, "parsed")
    stream_q.drain_payload(log_stream(spark, d), out, scratch_path(spark, "mark"))
    return stream_q.parsed_records(spark, out)


@register("stream_quality")
def _(spark, d):
    out = scratch_path(spark, "quality")
    stream_q.drain_quality(log_stream(spark, d), parts(spark, d, *LABELS), out, scratch_path(spark, "mark"))
    return stream_q.window_quality(spark, out)


@register("stream_upsert")
def _(spark, d):
    """Two runs of a change stream with removals, and a snapshot between them."""
    rows = versions(spark, d, marked=True)
    root, mark, path = scratch_path(spark, "latest"), scratch_path(spark, "mark"), scratch_path(spark, "changes")
    for half in range(2):
        rows.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == half).write.mode("append").parquet(path)
        files = len(spark.read.parquet(path).inputFiles())
        stream = file_stream(spark, path, rows.schema, files_per_batch=max(1, math.ceil(files / 4)))
        stream_up.stream_upsert(stream, root, mark, deletes="gone")
        if half == 0:
            stream_up.compact(spark, root)
    return stream_up.latest(spark, root)


# --- whole jobs ---------------------------------------------------------------------------------


def job_tables(spark: SparkSession) -> str:
    """A new database below the shared folder."""
    path = scratch_path(spark, "job")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


@register("job_refresh")
def _(spark, d):
    """Three runs: half of the log with some labels, all of the log, and all labels."""
    db = job_tables(spark)
    log = refresh.with_day(payload(spark, d))
    tables.overwrite_table(scan.conform(credit(spark, d), feature_table_schema()), f"{db}.features")
    for n, rows in zip(LABELS, parts(spark, d, *LABELS), strict=True):
        tables.overwrite_table(rows, f"{db}.{n}")
    run = lambda names: refresh.refresh_monitor(spark, f"{db}.log", [f"{db}.{n}" for n in names], f"{db}.features", f"{db}.monitoring")
    early = F.col("day") < "2024-01-16"
    tables.overwrite_partitions(log.filter(early), f"{db}.log", "day")
    run(LABELS[:2])
    tables.overwrite_partitions(log.filter(~early), f"{db}.log", "day")
    run(LABELS[:2])
    run(LABELS)
    return scan.scan_table(spark, f"{db}.monitoring").drop("day", "position")


@register("job_ingest")
def _(spark, d):
    """The features after a load, repeated once, of everything newer than the loaded rows."""
    db = job_tables(spark)
    source, train, test = loaded(spark, d)
    for name, rows in (("source", two_versions(source)), ("train", train), ("test", test)):
        tables.overwrite_table(rows, f"{db}.{name}")
    store = scan.conform(train.unionByName(test), feature_table_schema())
    tables.overwrite_table(store, f"{db}.features")
    for _ in range(2):
        ingest.ingest(spark, *(f"{db}.{n}" for n in ("source", "train", "test", "features")))
    return scan.scan_table(spark, f"{db}.features")
