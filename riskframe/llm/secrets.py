"""Secret scans over a ledger of text blobs (DataFrame functions only).

Every version of every path is content-addressed by the SHA-256 of its text. The ledger holds what was found in a blob
under a version of the rules, also when nothing was found. Only pairs of blob and rule version that the ledger lacks are
scanned, each once however many paths and versions carry the blob; findings are then joined back to all of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stored


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of a pattern whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    test: str = ""  # if given, a pattern that every text with a long enough match has


BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24, r"[0-9a-f]{24}"),
)
MORE_RULES = (
    # To the END line or, without one, over the lines of the key.
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[^-]*(?:-[^-]+){0,4}-----END [A-Z ]{0,40}PRIVATE KEY-----|(?:[\x20\x09-\x0D]*[A-Za-z0-9+/=]{16,}){0,60})",
         test=r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
)
RULES = BASE_RULES + MORE_RULES
RULE_VERSION = "2"
FINDINGS = "array<struct<start:long,rank:int,end:long,kind:string>>"
LEDGER = f"blob string, rule_version string, findings {FINDINGS}"
#: Replaces a secret in a text.
MARK = "[secret]"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def promising(text: Column, rule: Rule) -> Column:
    """Whether the rule can have a match at all; the cheap test that most texts fail."""
    return text.rlike(rule.test or rule.pattern)


def rule_findings(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule, from the lengths of its matches and of the gaps between them."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(text, rule.pattern, -1)
    lengths = F.arrays_zip(
        F.transform(gaps, F.length).alias("gap"), F.transform(matches, F.length).alias("own"),
        F.transform(tested, F.length).alias("tested"),
    )
    # The last gap has no match behind it.
    pairs = F.filter(lengths, lambda x: x["own"].isNotNull())
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(FINDINGS).alias("found"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + x["own"]).alias("end"), F.lit(rule.kind).alias("kind"))
        found = F.when(x["tested"] >= rule.least, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct((start + x["own"]).alias("at"), found.alias("found"))

    return F.when(promising(text, rule), F.aggregate(pairs, nothing, step, lambda s: s["found"])).otherwise(F.array().cast(FINDINGS))


def findings(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans in order of start, then rule, then end: code points from 0, end exclusive."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*(rule_findings(text, r, i) for i, r in enumerate(rules))))


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def scan_unseen(
    versions: DataFrame, ledger: DataFrame, key: list[str], text: str = "text",
    rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION,
) -> DataFrame:
    """Ledger rows of the blobs in ``versions`` that the ledger lacks for this rule version, stored.

    ``key`` names the columns that tell paths and versions apart. One of the rows that carry a blob is scanned; which
    one is decided on keys and digests alone, so each text moves at most once. Rows that repeat in key and text are
    told apart by nothing and give one ledger row. A null text is an empty blob.
    """
    blob = blob_id(F.col(text))
    place = F.struct(*(F.col(c).cast("string") for c in key))
    seen = ledger.filter(F.col("rule_version") == rule_version).select("blob")
    chosen = (
        versions.select(blob.alias("blob"), place.alias("place")).groupBy("blob").agg(F.min("place").alias("place"))
        .join(seen, "blob", "left_anti")
        .select("blob", F.to_json("place").alias("place"))
    )
    texts = versions.select(blob.alias("blob"), F.to_json(place).alias("place"), F.col(text).alias("text"))
    scanned = (
        texts.join(chosen.hint("shuffle_hash"), ["blob", "place"], "left_semi")
        .select("blob", F.lit(rule_version).alias("rule_version"), findings(F.col("text"), rules).alias("findings"))
        .groupBy("blob", "rule_version").agg(F.first("findings").alias("findings"))
    )
    return stored(scanned, "secret-ledger")


def found_in(versions: DataFrame, ledger: DataFrame, columns: list[str], text: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """``columns`` of every row of ``versions`` with the findings of its blob."""
    rows = versions.select(*columns, blob_id(F.col(text)).alias("blob"))
    known = ledger.filter(F.col("rule_version") == rule_version).select("blob", "findings")
    return rows.join(known, "blob", "left").withColumn("findings", F.coalesce("findings", F.array().cast(FINDINGS)))


def scan(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION) -> tuple[DataFrame, DataFrame]:
    """(doc_id, blob, findings) of every document and the ledger with what was scanned now.

    Null and empty texts have no findings; an empty table gives empty results; other columns are ignored.
    """
    ledger = empty_ledger(docs.sparkSession) if ledger is None else ledger
    ledger = ledger.unionByName(scan_unseen(docs, ledger, ["doc_id"], rules=rules, rule_version=rule_version))
    return found_in(docs, ledger, ["doc_id"], rule_version=rule_version), ledger


def scan_history(deliveries: list[DataFrame], ledger: DataFrame | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(doc_id, blob, findings) of every row of all deliveries, in turn over one ledger, and the ledger after the last.

    A blob that an earlier delivery, or the given ledger, holds for this rule version is not scanned again.
    """
    found = []
    for docs in deliveries:
        rows, ledger = scan(docs, ledger, **options)
        found.append(rows)
    return reduce(DataFrame.unionByName, found), ledger


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digest_columns(found: DataFrame) -> DataFrame:
    """The findings of each document as counts, a digest of the base spans and all spans as text."""
    base = len(BASE_RULES)
    of = lambda rank: F.size(F.filter("findings", lambda s: s["rank"] == rank)).cast("long")
    counts = [of(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)]
    return found.select(
        "doc_id", *counts, F.sha2(joined(F.filter("findings", lambda s: s["rank"] < base)), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by MARK."""
    nothing = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        parts = F.when(fresh, F.concat(state["parts"], F.array(gap, F.lit(MARK)))).otherwise(state["parts"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), parts.alias("parts"))

    rest = lambda s: F.substring(text, (s["at"] + 1).cast("int"), F.lit(2**31 - 1))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(spans, nothing, step, lambda s: F.concat_ws("", s["parts"], rest(s)))
    )


def redact(docs: DataFrame, rule_version: str = RULE_VERSION, **options) -> DataFrame:
    """All rows and columns of ``docs``; secrets in ``text`` are replaced and ``n_chars`` follows changed texts.

    The same columns in the same order, whatever their names; rows without findings stay as they are. Of an older ledger
    only findings of this rule version count.
    """
    _, ledger = scan(docs, rule_version=rule_version, **options)
    hits = ledger.filter((F.col("rule_version") == rule_version) & (F.size("findings") > 0)).select("blob", "findings")
    rows = docs.select(F.struct("*").alias("doc"), blob_id(F.col("text")).alias("blob")).join(hits, "blob", "left")
    changed = F.col("findings").isNotNull()
    clean = rows.select("doc", changed.alias("changed"), F.when(changed, redacted(F.col("doc.text"), F.col("findings"))).otherwise(F.col("doc.text")).alias("clean"))
    out = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("changed"), F.length("clean").cast(kind)).otherwise(F.col("doc.n_chars"))
    return clean.select(*(out.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))
