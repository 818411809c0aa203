"""DuckDB SQL of registered queries."""

from __future__ import annotations

from riskframe.llm import chat, lines, mixing, secrets

WORD = r"[^\x20\x09-\x0D]+"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: RE2 folds more letters than A-Z, so both cases are written out.
KEYWORDS = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|" + _either_case("api") + "_?" + _either_case("key")


def _pattern(rule: secrets.Rule) -> str:
    pattern = rule.pattern.replace("(?i:(password|passwd|secret|token|api_?key))", f"({KEYWORDS})")
    return pattern.replace("'", "''")


def _rule_sql(rank: int, rule: secrets.Rule) -> str:
    p = _pattern(rule)
    return f"""
      SELECT id, {rank} AS rank, '{rule.kind}' AS kind, start, start + own AS stop FROM (
        SELECT id, unnest(list_transform(range(1, len(m) + 1), lambda i:
            CAST(coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
              + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS BIGINT))) AS start,
          unnest(list_transform(m, lambda x: length(x))) AS own, unnest(list_transform(v, lambda x: length(x))) AS tested
        FROM (SELECT id, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {rule.group}) AS v,
          string_split_regex(t, '{p}') AS g FROM d WHERE regexp_matches(t, '{rule.test or p}')))
      WHERE tested >= {rule.least}"""


def secret_scan() -> str:
    rules = secrets.RULES
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in secrets.BASE_RULES)
    span = "kind || ':' || start || ':' || stop"
    order = "ORDER BY start, rank, stop"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
    f AS ({' UNION ALL '.join(_rule_sql(i, r) for i, r in enumerate(rules))}),
    s AS (SELECT id, {counts},
        coalesce(string_agg({span}, ',' {order}) FILTER (rank < {len(secrets.BASE_RULES)}), '') AS base,
        string_agg({span}, ',' {order}) AS spans FROM f GROUP BY id)
    SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in secrets.BASE_RULES)},
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN s USING (id)"""


def source_mixing() -> str:
    weights = "[" + ", ".join(map(str, mixing.WEIGHTS)) + "]"
    return f"""
    WITH RECURSIVE d AS (
      SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '~') || ':' || md5(coalesce(text, '~')) || ':{mixing.SEED}') AS key
      FROM documents),
    t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (SELECT *, CAST({weights}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)}] AS DOUBLE) AS weight,
        {float(mixing.MOST_EPOCHS)} * source_size AS most FROM t),
    -- Rounds of sharing: who is above the limit gets the limit, the rest is shared again.
    rounds AS (
      SELECT 0 AS round, source, source_size, weight, most, false AS capped,
        {mixing.SHARE} * sum(source_size) OVER () AS remains, sum(weight) OVER () AS among FROM w
      UNION ALL
      SELECT round + 1, source, source_size, weight, most, capped_now,
        {mixing.SHARE} * sum(source_size) OVER () - coalesce(sum(most) FILTER (capped_now) OVER (), 0),
        coalesce(sum(weight) FILTER (NOT capped_now) OVER (), 0)
      FROM (SELECT *, capped OR remains * weight > most * among AS capped_now FROM rounds)
      WHERE (SELECT count(*) FROM rounds WHERE NOT capped AND remains * weight > most * among) > 0),
    g AS (SELECT *, CASE WHEN capped THEN most ELSE least(most, remains / among * weight) END AS target
      FROM rounds WHERE round = (SELECT max(round) FROM rounds)),
    b AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target + 1e-9) AS BIGINT) // source_size ELSE 0 END AS epochs,
        CASE WHEN source_size > 0 THEN CAST(floor(target + 1e-9) AS BIGINT) % source_size ELSE 0 END AS rest FROM g),
    k AS (SELECT source, key, CAST(sum(size) AS BIGINT) AS words, count(*) AS ties FROM d GROUP BY source, key),
    o AS (SELECT *, CAST(sum(words) OVER (PARTITION BY source ORDER BY key) AS BIGINT) - words AS before FROM k)
    SELECT doc_id, size, source_size, target, CAST(epochs * size + CASE
        WHEN before + words <= rest AND NOT (before + words = rest AND ties > 1) THEN size
        WHEN before >= rest THEN 0 ELSE least(size, (rest - before) // ties) END AS BIGINT) AS taken
    FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
      JOIN o ON d.source IS NOT DISTINCT FROM o.source AND d.key = o.key"""


def chat_rotation() -> str:
    role = f"CASE WHEN own THEN 'assistant' WHEN speaker = '{chat.SYSTEM}' THEN '{chat.SYSTEM}' ELSE 'user name=' || speaker END"
    return f"""
    WITH t AS (SELECT conv_id, role, coalesce(nullif(role, ''), '{chat.UNKNOWN}') AS speaker, coalesce(text, '') AS body,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos
      FROM conversations),
    p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role NOT IN ('', '{chat.SYSTEM}', '{chat.UNKNOWN}')),
    r AS (SELECT t.conv_id, perspective, pos, pos // {chat.PART_TURNS} AS part, body, speaker, speaker = perspective AS own
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
    h AS (SELECT *, '{chat.BEGIN}' || {role} || chr(10) AS head, body || '{chat.END}' AS said FROM r),
    l AS (SELECT *, sum(length(head) + length(said) + 1) OVER (PARTITION BY conv_id, perspective, part ORDER BY pos)
        - length(said) - 1 AS start FROM h)
    SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, count(*) AS n_turns,
      string_agg(head || said || chr(10), '' ORDER BY pos) AS text,
      coalesce(string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(start + length(said) AS BIGINT) AS VARCHAR), ',' ORDER BY pos)
        FILTER (own), '') AS mask
    FROM l GROUP BY conv_id, perspective, part"""


def exact_topk() -> str:
    return """
    WITH v AS (SELECT row_number() OVER () AS num, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.num, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.num <> c.num WHERE q.vec_id % 50 = 0),
    r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY num ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
    SELECT * FROM r WHERE rank <= 5"""


def hard_negatives() -> str:
    return """
    WITH v AS (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        CAST(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.row AS anchor, a.vec_id AS anchor_id, c.row, c.vec_id, a.label = c.label AS same,
        CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score FROM v a JOIN v c ON a.row <> c.row WHERE a.vec_id % 100 = 0),
    p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) AS place FROM s WHERE same QUALIFY place <= 5),
    n AS (SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
        s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
      FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
    SELECT * FROM n WHERE rank <= 10"""


def line_dedup() -> str:
    key = r"""translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
    return f"""
    WITH d AS (SELECT row_number() OVER () AS id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
    k AS (SELECT *, {key} AS key FROM l),
    f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT id) >= {lines.LEAST}),
    r AS (SELECT id, count(*) AS n_lines, count(f.key) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (f.key IS NULL), '') AS kept FROM k LEFT JOIN f USING (key) GROUP BY id)
    SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN r USING (id)"""


ORACLES: dict[str, str] = {
    "op2_secret_scan": secret_scan(),
    "op6_exact_topk": exact_topk(),
    "op5_chat_rotation": chat_rotation(),
    "op4_source_mixing": source_mixing(),
    "op12_hard_negatives": hard_negatives(),
    "op13_line_dedup": line_dedup(),
}
