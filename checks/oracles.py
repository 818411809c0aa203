"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from checks.views import CREDIT_RAW_SQL, CREDIT_SQL, PAYLOAD_SQL
from riskframe.operators import projections
from riskframe.spec import CATEGORIES, DRIFT_COLUMNS, FEATURES, RAW_COLUMNS, RAW_INTEGER, ROBUST

ORACLES: dict[str, str] = {}
WINDOW = "time_bucket(INTERVAL 30 MINUTES, {t})"
AS_OF = "TIMESTAMP '2024-01-01'"
LOADED = "TIMESTAMP '2001-01-01'"
DOUBLES = [c for c in FEATURES if c not in CATEGORIES]
CLEAN = ["Id", *FEATURES]


def add(key: str, body: str, ctes: str, **kinds: str | list[str]) -> None:
    """Wrap ``body`` so that its columns come out as engine-neutral values, by kind.

    Kinds: ``i`` bigint, ``d`` double of 6 places, ``t`` time as text, ``s`` as it is.
    """
    out = []
    for kind, names in kinds.items():
        for n in names.split() if isinstance(names, str) else names:
            q = f'"{n}"'
            form = {
                "i": f"CAST({q} AS BIGINT)",
                "d": f"ROUND(CAST({q} AS DOUBLE), 6) + 0.0",
                "t": f"strftime({q}, '%Y-%m-%d %H:%M:%S.%f')",
                "s": q,
            }[kind]
            out.append(f"{form} AS {q}")
    head = f"WITH {ctes}, result AS" if ctes else "WITH result AS"
    ORACLES[key] = f"{head} ({body}) SELECT {', '.join(out)} FROM result"


def struct_rows(columns: list[str], source: str, keep: str = "") -> str:
    """(keep, column, value) rows of a table."""
    keep = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"""SELECT {keep}'{c}' AS "column", CAST("{c}" AS DOUBLE) AS value FROM {source}""" for c in columns
    )


# --- monitoring ---------------------------------------------------------------------------------

PARSED_SQL = f"""{PAYLOAD_SQL},
valid AS (SELECT * FROM payload WHERE json_valid(request)),
parsed AS (
  SELECT date_trunc('second', make_timestamp(timestamp_ms * 1000)) AS "timestamp", timestamp_ms,
         databricks_request_id, execution_time_ms,
         json_extract_string(request, '$.dataframe_records[0].Id') AS Id,
         CAST(json_extract_string(response, '$.predictions[0]') AS DOUBLE) AS prediction,
         'risk_model' AS model_name
  FROM valid
)"""
add("parse_payload", "SELECT * FROM parsed", PARSED_SQL, t="timestamp", i="timestamp_ms execution_time_ms",
    s="databricks_request_id Id model_name", d="prediction")
add("payload_read_back", "SELECT * FROM credit", CREDIT_SQL, s="Id", d=FEATURES)
add("parse_payload_multi", """
    SELECT date_trunc('second', make_timestamp(epoch_us(ts) // 1000 * 1000)) AS "timestamp",
           epoch_us(ts) // 1000 AS timestamp_ms, concat('req-', CAST(event_id AS VARCHAR)) AS databricks_request_id,
           event_id % 200 AS execution_time_ms, CAST(user_id + position AS VARCHAR) AS Id,
           CASE position WHEN 0 THEN event_id % 2 WHEN 1 THEN (event_id + 1) % 2 END AS prediction,
           'risk_model' AS model_name, position
    FROM events, (VALUES (0), (1), (2)) p(position)""", "",
    t="timestamp", i="timestamp_ms execution_time_ms position", s="databricks_request_id Id model_name", d="prediction")
add("payload_quarantine", """
    SELECT databricks_request_id,
           CASE WHEN NOT json_valid(request) THEN 'no records' ELSE 'no predictions' END AS reason
    FROM payload WHERE NOT json_valid(request) OR json_array_length(response, '$.predictions') = 0""", PAYLOAD_SQL,
    s="databricks_request_id reason")

MONITORED_SQL = f"""{CREDIT_SQL}, {PARSED_SQL},
labels_known AS (SELECT Id, CAST("Default" AS DOUBLE) AS "default" FROM credit
                 WHERE CAST(Id AS BIGINT) % 10 IN (0, 1, 2, 3, 4, 7, 8, 9)),
monitored AS (SELECT p.*, k."default" FROM parsed p JOIN labels_known k ON p.Id = k.Id WHERE prediction IS NOT NULL),
stored AS (SELECT * FROM monitored WHERE "timestamp" < TIMESTAMP '2024-01-10'),
featured AS (SELECT m.*, {", ".join(f"CAST(c.{f} AS DOUBLE) AS {f}" for f in FEATURES)},
                    {WINDOW.format(t='m."timestamp"')} AS window_start
             FROM monitored m LEFT JOIN credit c ON m.Id = c.Id)"""
LOG_KINDS = dict(t="timestamp", i="timestamp_ms execution_time_ms", s="databricks_request_id Id model_name")
add("monitoring_rows", "SELECT * FROM monitored", MONITORED_SQL, **LOG_KINDS, d="prediction default")
add("monitoring_with_features", "SELECT * FROM featured", MONITORED_SQL, **LOG_KINDS,
    d=["prediction", "default", *FEATURES])
add("job_refresh", "SELECT * EXCLUDE (window_start) FROM featured", MONITORED_SQL, **LOG_KINDS, d=["prediction", "default", *FEATURES])
add("monitoring_incremental", """
    SELECT * FROM monitored m WHERE NOT EXISTS (
      SELECT 1 FROM stored s WHERE s.databricks_request_id = m.databricks_request_id)""",
    MONITORED_SQL, **LOG_KINDS, d="prediction default")

COUNTED = """
    SELECT {w} AS window_start, model_name, COUNT(*) AS "rows",
           COUNT(*) FILTER (prediction = 1 AND "default" = 1) AS tp,
           COUNT(*) FILTER (prediction = 1 AND "default" <> 1) AS fp,
           COUNT(*) FILTER (prediction <> 1 AND "default" = 1) AS fn,
           COUNT(*) FILTER (prediction <> 1 AND "default" <> 1) AS tn
    FROM {source} GROUP BY ALL"""
RATED = """
    SELECT *, (tp + tn) / "rows" AS accuracy_score, COALESCE(tp / NULLIF(tp + fp, 0), 0) AS "precision",
           COALESCE(tp / NULLIF(tp + fn, 0), 0) AS recall, COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0) AS f1
    FROM counted"""
QUALITY_SQL = f"""{MONITORED_SQL},
counted AS ({COUNTED.format(w=WINDOW.format(t='"timestamp"'), source="monitored")}),
quality AS ({RATED})"""
QUALITY_KINDS = dict(t="window_start", i="rows tp fp fn tn", s="model_name", d="accuracy_score precision recall f1")
add("quality_profile", "SELECT * FROM quality", QUALITY_SQL, **QUALITY_KINDS)
add("accuracy_alert", """
    SELECT window_start, model_name, accuracy_score * 100 AS accuracy_percentage FROM quality
    WHERE accuracy_score * 100 < 42""", QUALITY_SQL, t="window_start", s="model_name", d="accuracy_percentage")
add("stream_quality", "SELECT * FROM quality", QUALITY_SQL, **QUALITY_KINDS)
add("stream_payload", """SELECT *, 0 AS "position" FROM parsed""", PARSED_SQL, t="timestamp",
    i="timestamp_ms execution_time_ms position", s="databricks_request_id Id model_name", d="prediction")

PROFILED = ["prediction", *FEATURES]
add("window_column_profile", """
    SELECT window_start, model_name, "column", COUNT(*) AS "rows", COUNT(*) - COUNT(value) AS nulls, AVG(value) AS mean,
           STDDEV_SAMP(value) AS std, MIN(value) AS "min", MAX(value) AS "max",
           quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75
    FROM cells GROUP BY ALL""",
    f"""{MONITORED_SQL},
    two AS (SELECT * REPLACE (concat(model_name, '_', CAST(execution_time_ms % 2 AS VARCHAR)) AS model_name) FROM featured),
    cells AS ({struct_rows(PROFILED, "two", "window_start, model_name")})""",
    t="window_start", s="column model_name", i="rows nulls", d="mean std min max q25 q50 q75")

DRIFTED = ", ".join(f"{c} * 1.5 AS {c}" if c in DRIFT_COLUMNS else c for c in FEATURES)
# Equal limits count once, as the limits of one column are distinct values.
BIN = "len(list_filter(edges, lambda e: value > e))"
DRIFT_SQL = f"""{CREDIT_SQL},
drifted AS (SELECT {DRIFTED} FROM skewed),
base_cells AS ({struct_rows(FEATURES, "normal")}), now_cells AS ({struct_rows(FEATURES, "drifted")}),
limits AS (SELECT "column", list_distinct([{", ".join(f"quantile_cont(value, {i / 10})" for i in range(1, 10))}])
             AS edges FROM base_cells GROUP BY ALL),
binned AS (
  SELECT "column", {BIN} AS bin, 1 AS base, 0 AS now FROM base_cells JOIN limits USING ("column")
  UNION ALL SELECT "column", {BIN}, 0, 1 FROM now_cells JOIN limits USING ("column")),
counted AS (SELECT "column", bin, SUM(base) AS base, SUM(now) AS now FROM binned GROUP BY ALL),
shares AS (SELECT "column", bin, base / SUM(base) OVER (PARTITION BY "column") AS b,
                  now / SUM(now) OVER (PARTITION BY "column") AS n FROM counted)"""
add("drift_psi", """
    SELECT "column", SUM((GREATEST(n, 1e-6) - GREATEST(b, 1e-6)) * LN(GREATEST(n, 1e-6) / GREATEST(b, 1e-6))) AS psi
    FROM shares GROUP BY ALL""", DRIFT_SQL, s="column", d="psi")
add("drift_ks", """
    SELECT "column", MAX(ABS(b / b_all - n / n_all)) AS ks FROM (
      SELECT "column", SUM(base) OVER w AS b, SUM(now) OVER w AS n,
             SUM(base) OVER (PARTITION BY "column") AS b_all, SUM(now) OVER (PARTITION BY "column") AS n_all
      FROM (SELECT "column", value, SUM(base) AS base, SUM(now) AS now
            FROM (SELECT *, 1 AS base, 0 AS now FROM base_cells UNION ALL SELECT *, 0, 1 FROM now_cells)
            WHERE value IS NOT NULL GROUP BY ALL)
      WINDOW w AS (PARTITION BY "column" ORDER BY value)) GROUP BY ALL""", DRIFT_SQL, s="column", d="ks")
add("drift_shift", """
    SELECT b."column", n.m - b.m AS mean_shift, n.z - b.z AS null_share_shift
    FROM (SELECT "column", AVG(value) AS m, (COUNT(*) - COUNT(value)) / COUNT(*) AS z FROM base_cells GROUP BY ALL) b
    JOIN (SELECT "column", AVG(value) AS m, (COUNT(*) - COUNT(value)) / COUNT(*) AS z FROM now_cells GROUP BY ALL) n
      USING ("column")""", DRIFT_SQL, s="column", d="mean_shift null_share_shift")
DRIFT_WINDOW = "time_bucket(INTERVAL 4 HOURS, \"timestamp\")"
PROFILE_COLUMNS = ["prediction", *ROBUST]
add("window_drift", """
    SELECT n.w AS window_start, n.model_name, n."column",
           SUM((GREATEST(n.s, 1e-6) - GREATEST(n.b, 1e-6)) * LN(GREATEST(n.s, 1e-6) / GREATEST(n.b, 1e-6))) AS psi,
           ANY_VALUE(n.mean_now - n.mean_base) AS mean_shift
    FROM (SELECT k.w, k.model_name, k."column", bins.bin, COALESCE(h.n, 0) / k.n AS s, COALESCE(p.n, 0) / f.n AS b, k.mean AS mean_now, f.mean AS mean_base
          FROM cols k JOIN steps USING (w, model_name) JOIN cols f ON f.w = before AND f.model_name = k.model_name AND f."column" = k."column"
          JOIN (SELECT DISTINCT w, model_name, "column", bin FROM hist UNION
                SELECT DISTINCT s.w, h.model_name, "column", bin FROM hist h JOIN steps s ON s.before = h.w AND s.model_name = h.model_name) bins
            ON bins.w = k.w AND bins.model_name = k.model_name AND bins."column" = k."column"
          LEFT JOIN hist h ON h.w = k.w AND h.model_name = k.model_name AND h."column" = k."column" AND h.bin = bins.bin
          LEFT JOIN hist p ON p.w = before AND p.model_name = k.model_name AND p."column" = k."column" AND p.bin = bins.bin) n
    GROUP BY ALL""",
    f"""{MONITORED_SQL},
    two AS (SELECT * REPLACE (concat(model_name, '_', CAST(execution_time_ms % 2 AS VARCHAR)) AS model_name), {DRIFT_WINDOW} AS w FROM featured),
    cells AS ({struct_rows(PROFILE_COLUMNS, "two", "w, model_name")}),
    limits AS (SELECT "column", list_distinct([{", ".join(f"quantile_cont(value, {i / 10})" for i in range(1, 10))}]) AS edges FROM cells GROUP BY ALL),
    hist AS (SELECT w, model_name, "column", {BIN} AS bin, COUNT(*) AS n FROM cells JOIN limits USING ("column") WHERE value IS NOT NULL GROUP BY ALL),
    cols AS (SELECT w, model_name, "column", COUNT(value) AS n, AVG(value) AS mean FROM cells WHERE value IS NOT NULL GROUP BY ALL),
    steps AS (SELECT w, model_name, LAG(w) OVER (PARTITION BY model_name ORDER BY w) AS before FROM (SELECT DISTINCT w, model_name FROM two))""",
    t="window_start", s="column model_name", d="psi mean_shift")
add("latency_profile", f"""
    SELECT {WINDOW.format(t="date_trunc('second', make_timestamp(timestamp_ms * 1000))")} AS window_start,
           COUNT(*) AS requests, AVG(execution_time_ms) AS mean_ms, MAX(execution_time_ms) AS max_ms,
           quantile_cont(execution_time_ms, 0.5) AS p50_ms, quantile_cont(execution_time_ms, 0.95) AS p95_ms
    FROM payload GROUP BY ALL""", PAYLOAD_SQL, t="window_start", i="requests max_ms", d="mean_ms p50_ms p95_ms")

# --- scanning, cleaning, gates ------------------------------------------------------------------

RAW_DOUBLES = [c for c in RAW_COLUMNS if c not in RAW_INTEGER]
CREDIT_KINDS = dict(s="Id", i=[*CATEGORIES, "Default"], d=DOUBLES, t="Update_timestamp_utc")
add("scan_csv", 'SELECT *, "default.payment.next.month" AS target FROM credit_raw', CREDIT_RAW_SQL,
    i=[*RAW_INTEGER, "target"], d=RAW_DOUBLES)
add("conform_schema", "SELECT * FROM credit", CREDIT_SQL, s="Id", d=FEATURES)
RENAMED_SQL = f"""{CREDIT_RAW_SQL},
renamed AS (SELECT {", ".join("CAST(ID AS VARCHAR) AS Id" if c == "ID" else f'{c} AS "{c.capitalize()}"'
                              for c in RAW_COLUMNS)}, "default.payment.next.month" AS "Default" FROM credit_raw)"""
add("rename_capitalize", "SELECT * FROM renamed", RENAMED_SQL, s="Id", i=[*CATEGORIES, "Default"], d=DOUBLES)
for name in ("value_corrections", "clean"):
    add(name, "SELECT * FROM credit", CREDIT_SQL, s="Id", i=[*CATEGORIES, "Default"], d=DOUBLES)
add("ints_to_double", "SELECT * FROM credit", CREDIT_SQL, s="Id", d=FEATURES)
add("drop_select", "SELECT * FROM credit", CREDIT_SQL, s="Id", i=CATEGORIES, d=DOUBLES)
NULLS_SQL = f"""{CREDIT_SQL},
gaps AS (SELECT * REPLACE (CASE WHEN CAST(Id AS BIGINT) % 7 <> 0 THEN Age END AS Age) FROM credit)"""
add("null_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) AS "rows", COUNT(*) - COUNT("{c}") AS nulls FROM gaps"""
    for c in [*CLEAN, "Default", "Update_timestamp_utc"]), NULLS_SQL, s="column", i="rows nulls")
add("domain_violations", """
    SELECT 'Education' AS "column", Education AS value, COUNT(*) AS "rows" FROM renamed
    WHERE Education NOT IN (1, 2, 3, 4) GROUP BY ALL
    UNION ALL SELECT 'Marriage', Marriage, COUNT(*) FROM renamed WHERE Marriage NOT IN (1, 2, 3) GROUP BY ALL
    UNION ALL SELECT 'Pay_6', Pay_6, COUNT(*) FROM renamed WHERE Pay_6 NOT BETWEEN 0 AND 8 GROUP BY ALL""",
    RENAMED_SQL, s="column", d="value", i="rows")
DRIFTED_CREDIT = ", ".join(f"{c} * 1.5 AS {c}" for c in DRIFT_COLUMNS)
add("inject_drift", f"""SELECT * EXCLUDE ({", ".join(DRIFT_COLUMNS)}), {DRIFTED_CREDIT} FROM credit""", CREDIT_SQL,
    s="Id", t="Update_timestamp_utc", d=[*DOUBLES, "Age", "Pay_0"],
    i=[c for c in [*CATEGORIES, "Default"] if c not in DRIFT_COLUMNS])
# payload_json has no counterpart here: the engines write doubles differently; a test reads its text back.

# --- profiles and keys --------------------------------------------------------------------------

add("unique_values", " UNION ALL ".join(
    f"""SELECT DISTINCT '{c}' AS "column", "{c}" AS value FROM credit WHERE "{c}" IS NOT NULL"""
    for c in [*CATEGORIES, "Default", "Limit_bal"]), CREDIT_SQL, s="column", d="value")
add("column_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) AS "rows", COUNT(*) - COUNT("{c}") AS nulls, AVG("{c}") AS mean,
        STDDEV_SAMP("{c}") AS std, MIN("{c}") AS "min", MAX("{c}") AS "max",
        COUNT(DISTINCT "{c}") + CAST(COUNT(*) > COUNT("{c}") AS INT) AS "distinct",
        COUNT(DISTINCT "{c}") + CAST(COUNT(*) > COUNT("{c}") AS INT) <= 10 AS discrete FROM gaps"""
    for c in [*FEATURES, "Default"]), NULLS_SQL, s="column", i="rows nulls distinct discrete", d="mean std min max")
add("quartiles", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
        quantile_cont({c}, 0.75) AS q75 FROM credit""" for c in ROBUST), CREDIT_SQL, s="column", d="q25 q50 q75")
add("row_counts", " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", COUNT(*) AS "rows" FROM {t}""" for t in ["train", "test", "normal", "skewed"]),
    CREDIT_SQL, s="table", i="rows")
add("id_set", "SELECT Id FROM train UNION SELECT Id FROM test", CREDIT_SQL, s="Id")
LINE = "l_partkey, l_suppkey, l_linenumber, l_extendedprice"
add("duplicate_rows", f"""
    SELECT l_orderkey, {LINE} FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {LINE}) AS place FROM lineitem) WHERE place > 1""",
    "", i="l_orderkey l_partkey l_suppkey l_linenumber", d="l_extendedprice")
add("pk_violations", 'SELECT l_orderkey, COUNT(*) AS "rows" FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1', "",
    i="l_orderkey rows")
add("head_rows", "SELECT * FROM credit ORDER BY Id LIMIT 5", CREDIT_SQL, **CREDIT_KINDS)
add("tail_rows", "SELECT * FROM credit ORDER BY Id DESC LIMIT 5", CREDIT_SQL, **CREDIT_KINDS)
add("row_slice", "SELECT * FROM credit ORDER BY Id LIMIT 1 OFFSET 112", CREDIT_SQL, **CREDIT_KINDS)
add("union_by_name", "SELECT * FROM train UNION ALL SELECT * FROM test", CREDIT_SQL, **CREDIT_KINDS)
add("union_inference", 'SELECT Id, "Default" FROM normal UNION ALL SELECT Id, "Default" FROM skewed', CREDIT_SQL,
    s="Id", i="Default")

# --- splits, samples, keys ----------------------------------------------------------------------

SPLIT_SQL = f"""{CREDIT_SQL},
split AS (
  SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY md5(concat(Id, ':42'))) <= CEIL(ROUND(0.2 * COUNT(*) OVER (), 6))
                 THEN 'test' ELSE 'train' END AS split FROM credit)"""
add("split_exact", "SELECT * FROM split", SPLIT_SQL, s="Id split", i="Default")
add("stamp_split", f"SELECT * REPLACE ({AS_OF} AS Update_timestamp_utc) FROM split", SPLIT_SQL,
    **{**CREDIT_KINDS, "s": "Id split"})
BERNOULLI = "CASE WHEN substr(md5(concat(Id, ':42')), 1, 8) < 'cccccccd' THEN 'train' ELSE 'test' END AS split"
add("split_bernoulli", f"SELECT Id, {BERNOULLI} FROM credit", CREDIT_SQL, s="Id split")
VERSIONED_SQL = f"""{CREDIT_SQL},
versioned AS (SELECT * FROM credit UNION ALL
  SELECT * REPLACE (Limit_bal / 2 AS Limit_bal, Update_timestamp_utc - INTERVAL 1 DAY AS Update_timestamp_utc)
  FROM credit WHERE CAST(Id AS BIGINT) % 3 = 0)"""
add("stream_ingest", f'SELECT Id, "Default", Limit_bal, {BERNOULLI} FROM versioned', VERSIONED_SQL, s="Id split", i="Default",
    d="Limit_bal")
add("stream_ingest_features", """
    SELECT * FROM versioned QUALIFY ROW_NUMBER() OVER (PARTITION BY Id ORDER BY Update_timestamp_utc DESC) = 1""", VERSIONED_SQL,
    s="Id", i=CATEGORIES, d=DOUBLES)
add("split_stratified", """
    SELECT Id, "Default", CASE WHEN place <= CEIL(ROUND(0.15 * n, 6)) THEN 'test'
                               WHEN place <= CEIL(ROUND(0.3 * n, 6)) THEN 'val' ELSE 'train' END AS split
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "Default" ORDER BY md5(concat(Id, ':42'))) AS place,
                 COUNT(*) OVER (PARTITION BY "Default") AS n FROM credit)""", CREDIT_SQL, s="Id split", i="Default")


def below(text: str, bound: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 12))::BIGINT % {bound}"


def unit(text: str, first: int = 1) -> str:
    return f"('0x' || substr(md5({text}), {first}, 12))::BIGINT / 281474976710656.0::DOUBLE"


add("sample_with_replacement", f"""
    SELECT d.draw, r.* EXCLUDE (place)
    FROM (SELECT draw, {below("concat(draw, ':draw:42')", "(SELECT COUNT(*) FROM credit)")} AS place
          FROM range(1000) g(draw)) d
    JOIN (SELECT *, ROW_NUMBER() OVER (ORDER BY md5(concat(Id, ':42'))) - 1 AS place FROM credit) r USING (place)""",
    CREDIT_SQL, **{**CREDIT_KINDS, "i": ["draw", *CATEGORIES, "Default"]})
add("new_ids", """
    SELECT CAST((SELECT MAX(CAST(Id AS BIGINT)) FROM credit WHERE CAST(Id AS BIGINT) % 10 NOT IN (5, 6))
                + ROW_NUMBER() OVER (ORDER BY md5(concat(Id, ':42'))) AS VARCHAR) AS Id, Id AS source_key, Limit_bal
    FROM skewed""", CREDIT_SQL, s="Id source_key", d="Limit_bal")

# --- incremental features -----------------------------------------------------------------------

LOADED_SQL = f"""{CREDIT_SQL},
loaded AS (SELECT * FROM credit WHERE CAST(Id AS BIGINT) % 10 < 7 AND Update_timestamp_utc < {LOADED}),
mark AS (SELECT MAX(Update_timestamp_utc) AS high_water_mark FROM loaded),
fresh AS (SELECT * FROM credit WHERE Update_timestamp_utc > (SELECT high_water_mark FROM mark))"""
add("high_water_mark", "SELECT * FROM mark", LOADED_SQL, t="high_water_mark")
add("new_rows", "SELECT * FROM fresh", LOADED_SQL, **CREDIT_KINDS)
add("ingest_rows", f"SELECT *, {BERNOULLI} FROM fresh", LOADED_SQL, s="Id split", t="Update_timestamp_utc")
add("feature_insert", f"SELECT DISTINCT {', '.join(CLEAN)} FROM fresh", LOADED_SQL, s="Id", i=CATEGORIES, d=DOUBLES)
add("job_ingest", f"""
    SELECT * FROM (
      SELECT *, 0 AS side FROM loaded
      UNION ALL SELECT *, 1 FROM ({{versioned}}) WHERE Update_timestamp_utc > (SELECT high_water_mark FROM mark))
    QUALIFY ROW_NUMBER() OVER (PARTITION BY Id ORDER BY side DESC, Update_timestamp_utc DESC) = 1""".format(versioned="""
      SELECT * FROM credit UNION ALL
      SELECT * REPLACE (Limit_bal / 2 AS Limit_bal, Update_timestamp_utc - INTERVAL 1 DAY AS Update_timestamp_utc)
      FROM credit WHERE CAST(Id AS BIGINT) % 3 = 0"""), LOADED_SQL, s="Id", d=FEATURES)
add("insert_delta", """
    SELECT (SELECT COUNT(*) FROM loaded) AS rows_before, (SELECT COUNT(*) FROM fresh) AS inserted,
           (SELECT COUNT(*) FROM loaded) + (SELECT COUNT(*) FROM fresh) AS rows_after""", LOADED_SQL,
    i="rows_before inserted rows_after")
add("feature_lookup", f"""
    SELECT t.Id, t."Default", {", ".join(f"s.{c}" for c in FEATURES)}
    FROM train t LEFT JOIN (SELECT * FROM train WHERE Age > 30) s ON t.Id = s.Id""", CREDIT_SQL, s="Id", i="Default",
    d=FEATURES)
add("training_set", "SELECT * FROM train", CREDIT_SQL, s="Id", i="Default", d=FEATURES)
add("point_lookup", "SELECT * FROM credit WHERE Id IN ('17', '112', '1003', 'x')", CREDIT_SQL, s="Id", d=FEATURES)
CHANGE_SQL = f"""{CREDIT_SQL},
a AS (SELECT * FROM credit WHERE CAST(Id AS BIGINT) % 13 <> 0),
z AS (SELECT * REPLACE (CASE WHEN CAST(Id AS BIGINT) % 5 = 0 THEN Limit_bal * 2 ELSE Limit_bal END AS Limit_bal)
      FROM credit WHERE CAST(Id AS BIGINT) % 11 <> 0)"""
add("change_feed", """
    SELECT z.*, 'insert' AS _change_type FROM z WHERE Id NOT IN (SELECT Id FROM a)
    UNION ALL SELECT a.*, 'delete' FROM a WHERE Id NOT IN (SELECT Id FROM z)
    UNION ALL SELECT z.*, 'update' FROM z JOIN a USING (Id) WHERE z.Limit_bal <> a.Limit_bal""", CHANGE_SQL,
    **{**CREDIT_KINDS, "s": "Id _change_type"})
VERSIONS_SQL = """
versions AS (SELECT CAST(o_custkey AS VARCHAR) AS Id, o_orderkey, o_totalprice, o_orderdate AS Update_timestamp_utc,
                    o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '1999-01-01' AS gone,
                    CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 0 ELSE 1 END AS side FROM orders)"""
NEWEST = """
    SELECT * FROM versions QUALIFY ROW_NUMBER() OVER (
      PARTITION BY Id ORDER BY Update_timestamp_utc DESC, side DESC, o_orderkey DESC, o_totalprice DESC) = 1"""
VERSION_KINDS = dict(s="Id", i="o_orderkey", d="o_totalprice", t="Update_timestamp_utc")
add("upsert_latest", f"SELECT * FROM ({NEWEST}) WHERE NOT gone", VERSIONS_SQL, **VERSION_KINDS)
add("stream_upsert", """
    SELECT * FROM (SELECT *, o_orderstatus = 'P' AS removed, CAST(o_custkey AS VARCHAR) AS Id, o_orderdate AS Update_timestamp_utc FROM orders)
    QUALIFY ROW_NUMBER() OVER (PARTITION BY Id ORDER BY Update_timestamp_utc DESC, removed DESC, o_orderkey DESC) = 1 AND NOT removed""", "",
    **VERSION_KINDS)

# --- scaling and metrics ------------------------------------------------------------------------

add("robust_scale", "SELECT Id, \"Default\", {}, {} FROM test, fit".format(
    ", ".join(f"({c} - {c}_q[2]) / CASE WHEN {c}_q[3] = {c}_q[1] THEN 1 ELSE {c}_q[3] - {c}_q[1] END AS {c}"
              for c in ROBUST), ", ".join(CATEGORIES)),
    f"""{CREDIT_SQL}, fit AS (SELECT {", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS {c}_q" for c in ROBUST)}
        FROM train)""", s="Id", i=["Default", *CATEGORIES], d=ROBUST)


def area(label: str, score: str, source: str, name: str) -> str:
    """Rank-sum form with average ranks of ties."""
    return f"""
    SELECT '{name}' AS score, SUM(pos) AS positives, SUM(neg) AS negatives,
           SUM(pos * (below + neg / 2)) / NULLIF(CAST(SUM(pos) AS DOUBLE) * SUM(neg), 0) AS auc
    FROM (SELECT *, SUM(neg) OVER (ORDER BY s) - neg AS below FROM (
      SELECT {score} AS s, COUNT(*) FILTER ({label} = 1) AS pos, COUNT(*) FILTER ({label} <> 1) AS neg
      FROM {source} GROUP BY ALL))"""


AUC_KINDS = dict(s="score", i="positives negatives", d="auc")
FLAGGED = "(SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, * FROM lineitem)"
add("auc_exact", " UNION ALL ".join(
    area("y", c, FLAGGED, c) for c in ["l_extendedprice", "l_quantity", "l_discount"]), "", **AUC_KINDS)
add("auc_documents", area("quality", "n_chars", "documents JOIN labels USING (doc_id)", "n_chars"), "", **AUC_KINDS)
JUDGED_SQL = f"""{CREDIT_SQL},
scored AS (SELECT Id, "Default", ROUND((Pay_0 * 8 + Pay_2 * 2 + Age / 10.0::DOUBLE) / 100.0::DOUBLE, 4) AS new,
                  ROUND((Pay_3 * 6 + Pay_0 * 3) / 100.0::DOUBLE, 4) AS old FROM test),
judged AS (SELECT *, CASE WHEN new > 0.4 THEN 1.0 ELSE 0.0 END AS prediction FROM scored)"""
add("auc_hard_labels", area('"Default"', "prediction", "judged", "prediction"), JUDGED_SQL, **AUC_KINDS)
add("confusion_matrix", 'SELECT "Default" AS label, prediction, COUNT(*) AS "rows" FROM judged GROUP BY ALL',
    JUDGED_SQL, d="label prediction", i="rows")
add("classification_report", """
    SELECT class, "precision", recall, f1, support FROM per_class
    UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT SUM(hits) / SUM(support) AS a, SUM(support) AS n FROM per_class)
    UNION ALL SELECT 'macro avg', AVG("precision"), AVG(recall), AVG(f1), SUM(support) FROM per_class
    UNION ALL SELECT 'weighted avg', SUM("precision" * support) / SUM(support), SUM(recall * support) / SUM(support),
                     SUM(f1 * support) / SUM(support), SUM(support) FROM per_class""",
    f"""{JUDGED_SQL},
per_class AS (
  SELECT class || '.0' AS class, hits, support, COALESCE(hits / NULLIF(predicted, 0), 0) AS "precision",
         COALESCE(hits / NULLIF(support, 0), 0) AS recall, COALESCE(2 * hits / NULLIF(predicted + support, 0), 0) AS f1
  FROM (SELECT c AS class, COUNT(*) FILTER ("Default" = c) AS support, COUNT(*) FILTER (prediction = c) AS predicted,
               COUNT(*) FILTER ("Default" = c AND prediction = c) AS hits
        FROM judged, (VALUES (0), (1)) v(c) GROUP BY ALL))""",
    s="class", d="precision recall f1", i="support")
add("log_loss", """
    SELECT COUNT(*) AS "rows", AVG(-("Default" * LN(p) + (1 - "Default") * LN(1 - p))) AS log_loss
    FROM (SELECT *, LEAST(GREATEST(new, 1e-15), 1 - 1e-15) AS p FROM judged)""", JUDGED_SQL, i="rows", d="log_loss")
add("score_join", 'SELECT Id, "Default", new AS prediction_new, old AS prediction_old FROM judged', JUDGED_SQL,
    s="Id", i="Default", d="prediction_new prediction_old")
add("champion_challenger", f"""
    SELECT n.auc AS auc_new, o.auc AS auc_old, o.auc < n.auc AS promote
    FROM ({area('"Default"', "new", "judged", "n")}) n, ({area('"Default"', "old", "judged", "o")}) o""",
    JUDGED_SQL, d="auc_new auc_old", i="promote")

# --- balancing and synthesis --------------------------------------------------------------------


def squares(columns: list[str]) -> str:
    return " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in columns)


NEIGHBOUR_SQL = """
pairs AS (SELECT a.Id AS Id, b.Id AS neighbour, {squares} AS d2 FROM {rows} a JOIN {rows} b ON a.Id <> b.Id),
ranked AS (SELECT *, SQRT(d2) AS distance, ROW_NUMBER() OVER (PARTITION BY Id ORDER BY d2, neighbour) AS "rank"
           FROM pairs QUALIFY "rank" <= 5)"""
MINORITY_SQL = f"""{CREDIT_SQL},
minority AS (SELECT Id, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)} FROM train WHERE "Default" = 1),
{NEIGHBOUR_SQL.format(squares=squares(FEATURES), rows="minority")}"""
NEAREST_KINDS = dict(s="Id neighbour", i="rank", d="distance")
add("smote_neighbors", "SELECT * FROM ranked", MINORITY_SQL, **NEAREST_KINDS)
DRAWN = projections.weights(FEATURES)


def projected(o: int, i: int) -> str:
    return " + ".join(f"{c} * {w!r}::DOUBLE" for c, w in zip(FEATURES, DRAWN[o, i].tolist(), strict=True))


def spread(o: int, i: int) -> str:
    return "SQRT(" + " + ".join(f"(SELECT VAR_POP({c}) FROM minority) * POW({w!r}::DOUBLE, 2)" for c, w in zip(FEATURES, DRAWN[o, i].tolist(), strict=True)) + ")"


add("smote_lsh", f"""
    SELECT Id, ROW_NUMBER() OVER (PARTITION BY Id ORDER BY d2, neighbour) AS "rank", neighbour, SQRT(d2) AS distance
    FROM (SELECT DISTINCT a.Id, b.Id AS neighbour, {squares(FEATURES)} AS d2 FROM near JOIN minority a ON a.Id = near.x JOIN minority b ON b.Id = near.y)
    QUALIFY "rank" <= 5""",
    f"""{CREDIT_SQL},
minority AS (SELECT Id, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)} FROM train WHERE "Default" = 1),
cells AS ({" UNION ALL ".join(
    f"SELECT {o} AS o, Id, FLOOR(({projected(o, 0)}) / {spread(o, 0)}) AS c1, FLOOR(({projected(o, 1)}) / {spread(o, 1)}) AS c2, {projected(o, 2)} AS p FROM minority"
    for o in range(projections.ORDERS))}),
placed AS (SELECT o, Id, ROW_NUMBER() OVER (PARTITION BY o ORDER BY c1, c2, p, Id) AS place FROM cells),
near AS (SELECT DISTINCT a.Id AS x, b.Id AS y FROM placed a JOIN placed b
         ON a.o = b.o AND b.place BETWEEN a.place - {projections.WINDOW} AND a.place + {projections.WINDOW} AND a.Id <> b.Id)""", **NEAREST_KINDS)
XS = [f"x{i}" for i in range(64)]
add("embedding_neighbors", "SELECT * FROM ranked", """
numbers AS (SELECT CAST(vec_id AS VARCHAR) AS Id, {} FROM embeddings), {}""".format(
    ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(64)),
    NEIGHBOUR_SQL.format(squares=squares(XS), rows="numbers").lstrip()), **NEAREST_KINDS)
add("smote_balance", f"""
    SELECT Id, {", ".join(FEATURES)}, "Default" FROM train
    UNION ALL SELECT CAST((SELECT MAX(CAST(Id AS BIGINT)) FROM train) + 1 + j AS VARCHAR),
                     {", ".join(f"x.{c} + u * (y.{c} - x.{c})" for c in FEATURES)}, 1
    FROM draws JOIN places USING (place) JOIN ranked r ON r.Id = places.Id AND r."rank" = draws."rank"
    JOIN minority x ON x.Id = r.Id JOIN minority y ON y.Id = r.neighbour""",
    f"""{MINORITY_SQL},
sizes AS (SELECT COUNT(*) FILTER ("Default" = 1) AS few, COUNT(*) FILTER ("Default" = 0) AS many FROM train),
places AS (SELECT Id, ROW_NUMBER() OVER (ORDER BY md5(concat(Id, ':42'))) - 1 AS place FROM minority),
draws AS (SELECT j, {below("concat(j, ':base:42')", "few")} AS place,
                 1 + {below("concat(j, ':neighbour:42')", "5")} AS "rank", {unit("concat(j, ':share:42')")} AS u
          FROM sizes, range(many - few) g(j))""", s="Id", i="Default", d=FEATURES)


def drawn(c: str) -> str:
    text = f"concat(j, ':{c}:42')"
    if c == "Update_timestamp_utc":
        gap = f"epoch_us({AS_OF}) - top"
        return f"make_timestamp(CASE WHEN low < top AND top < epoch_us({AS_OF}) " \
               f"THEN top + CAST(FLOOR({unit(text)} * ({gap})) AS BIGINT) ELSE top END) AS {c}"
    if c in CATEGORIES and c != "Age" or c == "Default":
        choices = f'(SELECT list_sort(list(DISTINCT "{c}")) FROM seen)'
        return f'{choices}[1 + {below(text, f"len({choices})")}] AS "{c}"'
    normal = f"SQRT(-2.0 * LN(1.0 - {unit(text)})) * COS(2.0 * PI() * {unit(text, 13)})"
    value = f"((SELECT AVG({c}) FROM seen) + (SELECT STDDEV_SAMP({c}) FROM seen) * {normal})"
    if c.startswith("Pay_amt"):
        return f"CAST(TRUNC(ABS({value})) AS DOUBLE) AS {c}"
    return f"CAST(ROUND_EVEN({value}, 0) AS DOUBLE) AS {c}"


SYNTH_SQL = f"""{CREDIT_SQL},
seen AS (SELECT * FROM train UNION ALL SELECT * FROM test),
made AS (SELECT CAST((SELECT MAX(CAST(Id AS BIGINT)) FROM seen) + 1 + j AS VARCHAR) AS Id,
                {", ".join(drawn(c) for c in [*FEATURES, "Default", "Update_timestamp_utc"])}
         FROM range(1000) g(j), (SELECT epoch_us(MIN(Update_timestamp_utc)) AS low,
                                        epoch_us(MAX(Update_timestamp_utc)) AS top FROM seen))"""
SYNTH_KINDS = dict(s="Id", t="Update_timestamp_utc")
add("synthetic_rows", "SELECT * FROM made", SYNTH_SQL, **SYNTH_KINDS,
    i=[c for c in [*CATEGORIES, "Default"] if c != "Age"], d=[*DOUBLES, "Age"])
add("synthetic_skewed", f"""SELECT * EXCLUDE ({", ".join(DRIFT_COLUMNS)}), {DRIFTED_CREDIT} FROM made""", SYNTH_SQL,
    **SYNTH_KINDS, i=[c for c in [*CATEGORIES, "Default"] if c not in DRIFT_COLUMNS], d=[*DOUBLES, "Age", "Pay_0"])

# --- models and scoring -------------------------------------------------------------------------

add("score_python_model", """
    SELECT Id, "Default", Pay_0 * 0.1::DOUBLE + Age * 0.01::DOUBLE + Limit_bal / 1e4 AS prediction FROM credit""",
    CREDIT_SQL, s="Id", i="Default", d="prediction")
add("ab_route", """
    SELECT Id, CASE WHEN substr(md5(Id), 32, 1) IN ('1', '3', '5', '7', '9', 'b', 'd', 'f') THEN 'A' ELSE 'B' END
      AS route FROM credit""", CREDIT_SQL, s="Id route")
