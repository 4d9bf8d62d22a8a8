"""Periodic runs against a brute force over all periods, the planted input, digests and edge cases."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from tallyfold.llm import periodic
from tallyfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """Every maximal stretch of smallest period q and length at least max(6, 4q), by trying all q."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            seg = w[i : i + length]
            if length >= max(6, 4 * q) and all(any(seg[t] != seg[t + d] for t in range(length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is None or n == 0:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    w = planted(doc_id, text)
    runs = brute(w)
    drop = set()
    for s, ln, q in runs:
        drop.update(range(s + q, s + ln))
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return (
        len(runs), *(best or (None, None, None)), None if best is None else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest(),
    )


def test_runs_equal_brute_force():
    rng = random.Random(1)
    cases = []
    for _ in range(300):
        n = rng.randint(0, 150)
        w = [rng.randint(1, rng.randint(1, 4)) for _ in range(n)]
        if n > 10 and rng.random() < 0.5:
            a = rng.randint(0, n - 1)
            p = rng.randint(1, max(1, (n - a) // 3))
            w = w[:a] + [w[a + i % p] for i in range(n - a)]
        cases.append(w)
    got = periodic.runs_of([np.array(w, dtype=np.int64) for w in cases])
    assert [brute(w) for w in cases] == got


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    assert any(r.n_runs for r in got.values())
    for d in docs:
        r = got[d.doc_id]
        have = (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
        assert have == expected(d.doc_id, d.text)


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a a a a a a a", "x"), (3, "a a a a a a a", "y"), (3, "a a a a a a a", "y"),
            (4, "a b " * 5000, "z"), (5, "é é é é é é", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = periodic.detect(
        df.selectExpr("doc_id", "regexp_extract_all(coalesce(text, ''), '[^\\\\x20\\\\x09-\\\\x0D]+', 0) AS words", "source AS text")
    ).collect()
    assert len(got) == 7
    empty = hashlib.sha256(b"").hexdigest()
    for r in got:
        if r.doc_id in (1, 2):
            assert (r.n_words, r.n_runs, r.start, r.runs_sha256, r.collapsed_sha256) == (0, 0, None, empty, empty)
        if r.doc_id in (3, None):
            assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (1, 0, 7, 1, 7000)
            assert r.collapsed_sha256 == hashlib.sha256(b"a").hexdigest()
        if r.doc_id == 4:
            assert (r.n_runs, r.start, r.length, r.period) == (1, 0, 10000, 2)
    assert periodic.detect(df.selectExpr("doc_id", "array() AS words").where("false")).collect() == []
