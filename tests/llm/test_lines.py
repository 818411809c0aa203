"""Line removal against brute force, SQL, and its own reversal."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from riskframe.llm import lines

SCHEMA = "doc_id long, text string, kept string, t string, n_lines long"
COMMON = ["All rights reserved.", "  all RIGHTS reserved.\t", "ALL rights reserved.\r", "Home", "Été  "]


def rows(n=60):
    out = []
    for i in range(n):
        text = [COMMON[i % 3], f"own line {i}", COMMON[3] if i % 4 == 0 else f"x{i}", "", COMMON[4] if i % 5 == 0 else "é", f"pair {i // 2}"]
        out.append((i, "\n".join(text), "clash", "clash", 1))
    out += [out[3]] * 4 + [(100, None, None, None, None), (101, "", None, None, None), (102, "\n\n", None, None, None), (103, " \t\n\x0b\r", None, None, None)]
    out += [(104, "Home", "k", "t", 2), (104, "home \n HOME", "k", "t", 2), (None, "Home\nrare", None, None, None)]
    out += [(105, "\n".join(f"long {i} " + "y" * 300 for i in range(3000)) + "\nHome", None, None, None), (106, "p q\x0cr\x85s", None, None, None)]
    return out


def key(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))


def brute(given, counted=None, least=10):
    counts = Counter(k for r in (counted or given) for k in {key(x) for x in (r[1] or "").split("\n")} - {""})
    out = []
    for r in given:
        split = (r[1] or "").split("\n")
        kept = [x for x in split if counts[key(x)] < least]
        out.append((r[0], len(split), len(split) - len(kept), "\n".join(kept)))
    return Counter(out)


def cleaned(df, ledger, **how):
    return Counter((r["doc"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in lines.clean_lines(df, ledger, **how).collect())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def ledger(spark, docs):
    return lines.insert(lines.empty_ledger(spark), docs)


def test_equals_brute_force(docs, ledger):
    assert cleaned(docs, ledger) == brute(rows())


@pytest.mark.parametrize("shard_keys", [lines.SHARD_KEYS, 200])
def test_routed_equals_broadcast(spark, docs, shard_keys):
    ledger = lines.insert(lines.empty_ledger(spark), docs, shard_keys)
    assert ledger.bits == (0 if shard_keys == lines.SHARD_KEYS else 4)
    assert cleaned(docs, ledger, broadcast_bytes=-1) == cleaned(docs, ledger) == brute(rows())


def test_user_columns_stay(docs, ledger):
    kept = lines.clean_lines(docs, ledger)
    assert kept.select("doc.*").columns == docs.columns
    assert sorted(kept.select("doc.*").collect(), key=str) == sorted(docs.collect(), key=str)


def test_digest_columns(docs, ledger):
    got = Counter(tuple(r) for r in lines.digest_columns(lines.clean_lines(docs, ledger)).collect())
    want = Counter()
    for (i, n, dropped, kept), times in brute(rows()).items():
        want[i, n, dropped, hashlib.sha256(kept.encode()).hexdigest()] += times
    assert got == want


def test_documents_come_and_go(spark, docs):
    """In parts, with a deletion that brings lines back, and another that empties the ledger."""
    all_rows = rows()
    part = lambda xs: spark.createDataFrame(xs, SCHEMA)
    ledger = lines.insert(lines.empty_ledger(spark), part(all_rows[:9]))
    assert cleaned(part(all_rows[:9]), ledger) == brute(all_rows[:9])
    ledger = lines.insert(ledger, part(all_rows[9:]), shard_keys=300)  # more shards now
    assert cleaned(docs, ledger) == brute(all_rows)
    ledger = lines.delete(ledger, part(all_rows[5:]), shard_keys=300)
    assert cleaned(part(all_rows[:5]), ledger) == brute(all_rows[:5])
    back = lines.insert(ledger, part(all_rows[5:]), shard_keys=300)
    assert cleaned(docs, back, broadcast_bytes=-1) == brute(all_rows)
    nothing = lines.delete(ledger, part(all_rows[:5]))
    assert nothing.counts.count() == 0
    with pytest.raises(Exception, match="does not hold"):
        lines.delete(nothing, part(all_rows[:1]))


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    ledger = lines.insert(lines.empty_ledger(spark), none)
    assert lines.clean_lines(none, ledger).collect() == []
    assert cleaned(spark.createDataFrame([(1, "a\nb", "", "", 1)], SCHEMA), ledger) == Counter([(1, 2, 0, "a\nb")])


@pytest.mark.parametrize("n", [0, 1, 3, 5_000])
def test_cuckoo_holds_what_was_put_in(n):
    d = np.random.default_rng(3).integers(0, 2**63, size=(2 * n + 10, 2)).astype(np.uint64)
    c = lines.Cuckoo.sized(n)
    assert c.insert(d[:n]) and c.holds(d[:n]).all()
    assert c.holds(d[n:]).mean() < 0.2
    c.delete(d[: n // 2])
    assert c.holds(d[n // 2 : n]).all() and (c.slots > 0).sum() == n - n // 2
    assert c.insert(d[: n // 2]) and c.holds(d[:n]).all()


def test_full_cuckoo_says_so():
    d = np.random.default_rng(4).integers(0, 2**63, size=(100, 2)).astype(np.uint64)
    assert not lines.Cuckoo.sized(10).insert(d)


def test_false_claims_are_listed(spark):
    """A filter of one bucket, full of fingerprints, wrongly claims some of the rare keys of a large set; answers stay exact."""
    n = 240_000
    text = [("\n".join(f"r{i}" for i in range(j * 20_000, (j + 1) * 20_000)) + "\n" + "\n".join(f"c{i}" for i in range(600))) for j in range(n // 20_000)]
    given = [(j, t, "", "", 1) for j, t in enumerate(text)]
    df = spark.createDataFrame(given, SCHEMA)
    ledger = lines.insert(lines.empty_ledger(spark), df)
    assert sum(len(r["wrong"]) for r in ledger.filters.collect()) > 0
    assert cleaned(df, ledger) == brute(given)
