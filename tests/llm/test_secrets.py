"""The automaton against ``re``, the query against brute force, and edge cases."""

import hashlib
import re
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tallyfold.llm import secrets
from tallyfold.llm.automaton import compile_rules
from tallyfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCANNER = secrets.Scanner()


def slow_spans(text):
    """Spans of each rule by ``re``, in code points."""
    out = []
    for rule in secrets.RULES:
        flags = re.ASCII | (re.IGNORECASE if rule.ignore_case else 0)
        # Only ASCII letters count in either case.
        hidden = text.replace("ſ", "§").replace("K", "§").replace("İ", "§").replace("ı", "§")
        found = []
        for m in re.finditer(rule.pattern, hidden, flags):
            head = len(re.match(rule.head, m[0], flags)[0]) if rule.head else 0
            if len(m[0]) - head >= rule.least:
                found.append(m.span())
        out.append(found)
    return out


def fast_spans(text):
    points = secrets._code_points(text.encode(), SCANNER.spans(text.encode()))
    return [sorted((s, e) for s, r, e in points if r == k) for k in range(len(secrets.RULES))]


@pytest.mark.parametrize("pattern", ["a(b|cd)*e", "[^a-c]{2,3}x?", "(ab|a)(c|bcd)", r"\d+\.\d{2}", "x.y|[xy]{4}", "(a|ab)+c?"])
def test_automaton_equals_re(pattern):
    rng = np.random.default_rng(3)
    next_, accepts = compile_rules([(pattern, False)])
    for _ in range(400):
        text = "".join(rng.choice(list("abcdexy.1"), rng.integers(0, 9)))
        state = 0
        for c in text.encode():
            state = next_[state, c]
        assert bool(accepts[state]) == bool(re.fullmatch(pattern, text)), text


def test_automaton_is_minimal():
    next_, accepts = compile_rules([("(a|b)*abb", False)])
    assert len(accepts) == 5  # four states and the dead one


words = st.sampled_from([
    "password", "PassWD", "secret", "token", "apikey", "API_key", "AKIA", "akia", "=", ":", " ", '"', "'", "0123456789abcdef",
    "deadbeef", "ABCDEFGH01234567", "\n", "é", "K", "ghp_", "xoxb-", "eyJ", ".", "-----BEGIN PRIVATE KEY-----", "x", "_", "9",
])


@settings(max_examples=300, deadline=None)
@given(st.lists(words, max_size=14).map("".join))
def test_scanner_equals_re(text):
    assert fast_spans(text) == slow_spans(text)


def test_dropped_match_uses_up_its_text():
    assert fast_spans("token=token: abcdefgh")[0] == []
    assert fast_spans("token=tokens: token: abcdefgh")[0] == [(0, 12), (14, 29)]


def test_long_keys_need_little_memory():
    text = b"x " + b"0123456789abcdef" * 40_000 + b" token=" + b"a9_" * 100_000
    SCANNER.spans(b"")
    tracemalloc.start()
    try:
        found = SCANNER.spans(text)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found[0] == [(640_003, len(text))] and found[2] == [(2, 640_002)]
    assert peak < 4 * len(text)


def test_rules_that_match_nothing():
    scanner = secrets.Scanner((secrets.Rule("any", "a*"), secrets.Rule("b", "b")))
    assert scanner.spans(b"aaba")[1] == [(2, 3)]
    assert [s for s in scanner.spans(b"aaba")[0] if s[0] < s[1]] == [(0, 2), (3, 4)]


# sf0.001 holds no secret at all, so the query is compared on sf0.01, beside planted rows.
SF_SECRETS = "/root/testdata/sf0.01"
PLANTED = [
    (10**9 + 1, "config: password = 'hunter2secret' and api_key: \"Zx9_ab.cd\""),
    (10**9 + 2, "keys AKIA" + "B7" * 9 + " and AKIA12 and " + "deadbeef" * 4),
    (10**9 + 3, "TOKEN=abc secret:abcdefgh Secret = " + "q" * 30),
]


def check(got, docs):
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        found = slow_spans(docs[r.doc_id] or "")
        listed = sorted((s, k, e) for k, spans in enumerate(found) for s, e in spans)
        text = ",".join(f"{secrets.RULES[k].kind}:{s}:{e}" for s, k, e in listed)
        base = ",".join(f"{secrets.RULES[k].kind}:{s}:{e}" for s, k, e in listed if k < 3)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(len, found[:3]))
        assert r.spans == text and r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SECRETS}/documents.parquet").collect()}
    got = QUERIES["op1_secret_scans"](spark, SF_SECRETS).collect()
    check(got, docs)
    assert sum(r.n_assign + r.n_access + r.n_hex for r in got) > 0


def test_planted_secrets_equal_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    planted = spark.createDataFrame([(i, t, "en", "planted", len(t)) for i, t in PLANTED], table.schema)
    docs = {r.doc_id: r.text for r in table.collect()} | dict(PLANTED)
    got = secrets.digests(table.unionByName(planted)).collect()
    check(got, docs)
    by = {r.doc_id: r for r in got}
    assert by[10**9 + 1].n_assign == 2 and by[10**9 + 2].n_access == 1 and by[10**9 + 2].n_hex == 1
    assert by[10**9 + 3].n_assign == 2


def test_edge_cases(spark):
    long = "é" * 100_000 + " token = abcdef123 " + "f" * 40_000
    rows = [(1, None), (2, ""), (None, "secret: 123456"), (4, long), (4, long), (5, "AKIA" + "A" * 15), (6, "AKIA" + "A" * 16)]
    d = spark.createDataFrame([(i, t, "s", 7, None) for i, t in rows], "doc_id long, text string, spans string, counts int, n_chars int")
    got = sorted(((r.doc_id or 0, r.spans) for r in secrets.digests(d).collect()))
    deep = "assign:100001:100018,hex:100019:140019"
    assert got == [(0, "assign:0:14"), (1, ""), (2, ""), (4, deep), (4, deep), (5, ""), (6, "access:0:20")]
    masked = secrets.mask(d)
    assert masked.columns == d.columns
    by = {r.doc_id: r for r in masked.collect()}
    assert by[1].text is None and by[2].text == "" and by[None].text == "[SECRET]" and by[None].n_chars == 8
    assert by[4].text == "é" * 100_000 + " [SECRET] [SECRET]" and by[5].text == rows[5][1]
    assert secrets.digests(d.limit(0)).count() == 0 and secrets.mask(d.limit(0)).count() == 0
