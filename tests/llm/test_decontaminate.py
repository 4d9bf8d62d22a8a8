"""Phrase and proximity matches against brute force, and edge cases."""

import glob
import hashlib
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import decontaminate
from tallyfold.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def slow_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def slow_hits(docs, items, size=10):
    wanted = {}
    for i, t in items:
        w = slow_words(t)
        for k in range(max(1, len(w) - size + 1)):
            if w:
                wanted.setdefault(tuple(w[k:k + size]), set()).add(None if i is None else str(i))
    lengths = {len(x) for x in wanted}
    out = []
    for i, t in docs:
        w, hit, found = slow_words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (got := wanted.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= got
        # Items without id hit like any other, but have no name in the list.
        named = sorted(x for x in found if x is not None)
        sha = hashlib.sha256(",".join(named).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(named), sha, bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r)[:6] for r in df.collect()), key=str)


@pytest.mark.parametrize("block,portion", [(1_000_000, 50_000), (3_000, 400)])
def test_query_equals_brute_force(spark, monkeypatch, block, portion):
    monkeypatch.setattr(decontaminate, "BLOCK_TOKENS", block)
    monkeypatch.setattr(decontaminate, "PORTION", portion)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = rows(QUERIES["op8_benchmark_decontamination"](spark, SF))
    assert got == slow_hits(docs, items)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_edge_cases(spark):
    ten = "a b c d e f g h i j"
    docs = [(1, None), (2, ""), (3, "x " + ten.upper() + " y"), (3, "x " + ten.upper() + " y"), (None, ten), (5, "short one"),
            (6, "a-b:c d e f g h i"), (7, "é! ü, " * 3000 + ten + " j k"), (8, "a b c d e f g h i"), (9, "j a b c d e f g h i j " + ten),
            (10, "a b c d x e f g h i j")]
    items = [(1, ten), (2, "Short ONE"), (3, None), (4, "..."), (None, "é ü"), (5, ten), (6, "the the the"), (6, "é!")]
    d = spark.createDataFrame([(i, t, 0, 0) for i, t in docs], "doc_id long, text string, n_words int, block int")
    b = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, words string")
    found = decontaminate.contamination(d, b)
    assert rows(found) == slow_hits(docs, items)
    # Doc 7 holds the passage of the item without id.
    assert {r.doc_id: r.n_hit for r in found.collect()}[7] > 10
    near = {r.doc_id: r.n_near_items for r in found.collect()}
    assert near[10] == 2 and near[8] == 0
    kept = decontaminate.clean(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 6, 8, 10]


@pytest.mark.parametrize("block", [1_000_000, 40])
def test_proximity_does_not_depend_on_blocks(spark, monkeypatch, block):
    """Random small texts: some start from which every word is within three places."""
    monkeypatch.setattr(decontaminate, "BLOCK_TOKENS", block)
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randrange(40)))) for i in range(60)]
    items = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 9)))) for i in range(12)]

    def near(doc, item):
        at = {}
        for k, w in enumerate(doc.split()):
            at.setdefault(w, []).append(k)
        words = item.split()
        return any(all(any(abs(p - s - k) <= 3 for p in at.get(w, [])) for k, w in enumerate(words)) for s in range(-4, len(doc)))

    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_items, r.n_near_items) for r in decontaminate.contamination(d, b).collect()}
    exact = {r[0]: r[3] for r in slow_hits(docs, items)}
    assert got == {i: (exact[i], sum(near(t, x) for _, x in items)) for i, t in docs}


def test_query_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    result = con.execute(SQL["op8_benchmark_decontamination"])
    df = QUERIES["op8_benchmark_decontamination"](spark, SF)
    assert df.columns == [c[0] for c in result.description]
    assert sorted(map(tuple, df.collect())) == sorted(result.fetchall())


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert rows(decontaminate.contamination(d, b.limit(0)))[0][1:4] == (2, 0, 0)
    assert decontaminate.contamination(d.limit(0), b).count() == 0


def test_registered_query_returns_proximity_matches(spark, tmp_path):
    """An inserted word hides a passage from the exact matches, not from the near ones."""
    passage = "one two three four five six seven eight nine ten"
    spark.createDataFrame([
        (1, passage), (2, passage.replace("five", "five odd")), (3, "one two three"), (4, None),
    ], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("b", passage), ("a", passage + " eleven")], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in QUERIES["op8_benchmark_proximity"](spark, str(tmp_path)).collect()}
    assert {i: (r.contaminated, r.n_near_items, r.near_items) for i, r in got.items()} == {
        1: (True, 2, "a,b"), 2: (False, 2, "a,b"), 3: (False, 0, ""), 4: (False, 0, ""),
    }
    assert all(r.near_items_sha256 == hashlib.sha256(r.near_items.encode()).hexdigest() for r in got.values())


def test_row_groups_of_the_index_stay_small(spark, monkeypatch, tmp_path):
    """Neither a task that makes many blocks nor one that reads them holds them all."""
    monkeypatch.setattr(decontaminate, "BLOCK_TOKENS", 200_000)
    text = " ".join(f"w{i}" for i in range(200_000))
    docs = spark.range(12).coalesce(1).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    index = decontaminate.build_index(docs, f"{tmp_path}/index")
    assert sorted(i for r in index.select("doc_ids").collect() for i in r.doc_ids) == list(range(12))
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{tmp_path}/index/*.parquet")]
    groups = [m.row_group(k) for m in files for k in range(m.num_row_groups)]
    # 200,000 positions and terms of 6 bytes: less than 6 MB a block.
    assert sum(g.num_rows for g in groups) == 12 and max(g.total_byte_size for g in groups) < 6 << 20
    assert not any(g.column(c).is_stats_set for g in groups for c in range(g.num_columns))
