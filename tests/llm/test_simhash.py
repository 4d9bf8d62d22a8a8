"""Near-duplicates against brute force, and edge cases."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row

from tallyfold.llm import simhash
from tallyfold.llm.components import components
from tallyfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps, bits=4):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in fps}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    fps = {r.doc_id: slow_fingerprint(r.text) for r in docs}
    want = slow_components(fps)
    got = QUERIES["op3_simhash_near_dedup"](spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{fps[i]:016x}", want[i]) for i in fps}
    assert len(got) == len(docs)


@pytest.mark.parametrize("shard,leaf", [(64, 16), (16, 4)])
def test_tree_loses_no_link(spark, monkeypatch, shard, leaf):
    """Random fingerprints, dense balls and chains, cut into many shards and leaves."""
    monkeypatch.setattr(simhash, "SHARD", shard)
    monkeypatch.setattr(simhash, "LEAF", leaf)
    rng = np.random.default_rng(1)
    points = list(rng.integers(0, 2**64, 600, np.uint64))
    for centre in points[:5]:
        points += [centre ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for a, b in rng.integers(0, 64, (60, 2))]
    chain = points[10]
    for k in range(0, 60, 3):
        chain = chain ^ np.uint64(7 << k)
        points.append(chain)
    points = np.unique(np.array(points, np.uint64))
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    got = {r.node: r.root for r in components(simhash.near_links(df)).collect()}
    signed = {int(p): int(p) & (2**64 - 1) for p in points.view(np.int64)}
    want = slow_components(signed)
    assert {i: got.get(i, i) for i in signed} == want


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (1, 0)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)}


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (None, "one"), (7, "x " * 50_000), (7, "x " * 50_000)]
    docs = spark.createDataFrame([Row(doc_id=i, text=t, fp=1, component_id="a", root=2) for i, t in rows],
                                 "doc_id long, text string, fp int, component_id string, root int")
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    one, many = (f"{slow_fingerprint(t):016x}" for t in ("one", "x " * 50_000))
    zero = "0" * 16
    assert sorted(got, key=str) == sorted([
        (1, zero, 1), (2, zero, 1), (3, zero, 1), (4, one, 4), (5, one, 4), (None, one, 4), (7, many, 7), (7, many, 7)
    ], key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # Each row has its own key: the null id goes with the group of 4, one of the repeated rows of 7 stays.
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [1, 4, 7]


def test_keep_one_by_row(spark):
    docs = spark.createDataFrame([(7, "q r s"), (7, "x y z"), (5, "x y z"), (None, "u v w"), (None, "u v w")],
                                 "doc_id long, text string")
    kept = sorted((r.doc_id or 0, r.text) for r in simhash.keep_one(docs).collect())
    assert kept == [(0, "u v w"), (5, "x y z"), (7, "q r s")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0
