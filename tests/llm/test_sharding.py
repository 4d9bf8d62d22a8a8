"""The law, groups and slots of shards, and edge cases."""

import zlib
from collections import Counter, defaultdict

from tallyfold.llm import sharding
from tallyfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def check(rows, docs, shards):
    """Everything but the balance."""
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, None if t is None else zlib.crc32(t.encode())) for i, t in docs
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert (r.law, r.grown_shard) == ("bytes", None) and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    of_crc = defaultdict(set)
    for r in rows:
        of_crc[r.size, r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in of_crc.values())


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = QUERIES["op5_sharding"](spark, SF).collect()
    check(rows, docs, 40)


def test_balance(spark):
    rows = QUERIES["op5_sharding"](spark, "/root/testdata/sf0.01").collect()
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    assert len(load) == 40 and max(load.values()) <= 1.02 * min(load.values())


def test_schedule_is_longest_first():
    assert sharding.schedule({"a": 5, "b": 4, "c": 3, "d": 3, "e": 3}, 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def test_edge_cases_and_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 7)
    docs = [(1, None), (2, ""), (None, "x"), (3, "x"), (3, "x"), (4, "é" * 100_000), (5, None)] + [(k, f"t{k % 90}") for k in range(10, 300)]
    d = spark.createDataFrame([(i, t, 1, 2, "g") for i, t in docs], "doc_id long, text string, size int, shard int, grp string")
    for shards in (1, 3, 40):
        check(sharding.shard(d, shards=shards).collect(), docs, shards)
    assert sharding.shard(d.limit(0)).count() == 0
