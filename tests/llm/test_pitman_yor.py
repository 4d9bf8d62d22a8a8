"""Scores against brute force, the sampler against enumeration, and edge cases."""

import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyfold.llm import pitman_yor as py
from tallyfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w] + ["\n"]


def slow_base(docs, out):
    counts = Counter(w for i, t in docs if not out(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return sorted(((
        i, out(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
        round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6),
    ) for i, t in docs), key=str)


def held(i):
    return i is None or zlib.crc32(str(i).encode()) % 7 == 2


def plain(rows):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows), key=str)


@pytest.mark.parametrize("block,buckets", [(4_000_000, 64), (2_000, 7)])
def test_query_equals_brute_force(spark, monkeypatch, block, buckets):
    monkeypatch.setattr(py, "BLOCK_TOKENS", block)
    monkeypatch.setattr(py, "MIN_BUCKETS", buckets)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op10_lm_scoring"](spark, SF)
    rows = got.collect()
    assert plain(rows) == slow_base(docs, held)
    ours = {o: 10 ** (-sum(r.score for r in rows if r.held_out == o) / sum(r.n_tokens for r in rows if r.held_out == o)) for o in (True, False)}
    base = {o: 10 ** (-sum(r.base_score for r in rows if r.held_out == o) / sum(r.n_tokens for r in rows if r.held_out == o)) for o in (True, False)}
    assert ours[True] < base[True] and ours[False] < base[False]
    if block > 2_000:
        assert {r.held_out: r.perplexity for r in py.perplexity(spark.createDataFrame(rows)).collect()} == pytest.approx(ours)


def test_tables_follow_their_distribution():
    rng = np.random.default_rng(5)
    for c, weight, d in ((2, 0.3, 0.5), (5, 1.7, 0.8), (12, 4.0, 0.2)):
        logits = py._stirling(d)[c, 1:c + 1] + np.arange(1, c + 1) * math.log(weight)
        p = np.exp(logits - logits.max())
        p /= p.sum()
        drawn = py.sample_tables(np.full(40_000, c), np.full(40_000, weight), d, rng)
        assert np.abs(np.bincount(drawn, minlength=c + 1)[1:] / 40_000 - p).max() < 0.015
    for c, weight, d in ((1_000, 3.0, 0.5), (1_000, 300.0, 0.8), (1_000, 0.01, 0.7), (600, 40.0, 0.3)):
        logits = py._stirling(d, c)[c, 1:c + 1] + np.arange(1, c + 1) * math.log(weight)
        p = np.exp(logits - logits.max())
        mean = (p / p.sum() * np.arange(1, c + 1)).sum()
        drawn = py.sample_tables(np.full(4_000, c), np.full(4_000, weight), d, rng)
        assert drawn.mean() == pytest.approx(mean, rel=0.06)


def test_stirling_numbers_count_seatings():
    # Three customers: one table, two tables in three ways, three tables.
    d = 0.4
    assert np.exp(py._stirling(d)[3, 1:4]) == pytest.approx([(1 - d) * (2 - d), 3 * (1 - d), 1])


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(2)
    hashes = np.sort(rng.integers(0, 2**63, 50).astype(np.uint64))
    codes = np.unique(rng.integers(0, 50 * py._F, 400))
    used = np.unique(codes // py._F)
    codes = np.searchsorted(used, codes // py._F) * py._F + codes % py._F
    b = py.Bucket(hashes[used], codes, rng.integers(1, 400, len(codes)))
    totals = py.Totals.of(b.totals())
    for _ in range(3):
        b.sweep(totals, rng)
        totals = py.Totals.of(b.totals(), totals.discounts)
    asked = np.append(hashes[used], np.uint64(1))
    for context in (0, 5, py.FIRST):
        p, seen = b.predict(asked, np.full(len(asked), context, np.uint8), [(b.tables, totals)])
        assert p.sum() == pytest.approx(1) and (p > 0).all() and seen[-1] == 0
    assert seen.sum() == b.counts.sum()


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "A b a"), (3, "A b a"), (None, "b zz"), (5, "é! x " * 30_000), (9, "a\x0bB\tc")]
    d = spark.createDataFrame([(i, t, "b", 1.0, True) for i, t in docs], "doc_id long, text string, block string, score double, held boolean")
    got = py.by_checksum(d).collect()
    assert plain(got) == slow_base(docs, held)
    assert all(r.score < 0 for r in got)
    assert py.by_checksum(d.limit(0)).count() == 0
    untrained = py.by_checksum(d.where("doc_id is null")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in untrained] == [(3, 0, 0)]
    assert xxhash.xxh64_intdigest(b"\n") != xxhash.xxh64_intdigest(b"")


def test_contexts_are_words(spark):
    """Two words that end alike predict what followed each of them, summed up over buckets."""
    docs = [(k, "at new york here") for k in range(30)] + [(30 + k, "at view point here") for k in range(30)]
    docs += [(k, "at new york here") for k in range(100, 104)] + [(k, "at new point here") for k in range(200, 204)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    by = {r.doc_id: r.score for r in py.score(d, F.col("doc_id") >= 100).collect()}
    assert by[100] - by[200] > 0.5
    contexts = py.contexts_of([b"new", b"view"], np.array([xxhash.xxh64_intdigest(w) for w in (b"new", b"view")], np.uint64))
    assert contexts[0] != contexts[1] and (contexts & 63 == ord("w") - ord("a")).all()
    assert (py._unpack(py._pack(contexts)) == contexts).all()


def test_totals_of_contexts_do_not_depend_on_buckets(spark):
    """Customers and tables of a context are those of its pairs in all buckets."""
    rng = np.random.default_rng(3)
    docs = [(k, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, 60) % 40)) for k in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("held_out", F.col("doc_id") % 5 == 0)
    made = py._blocks(d.select("doc_id", "held_out", "text"), 7).where("bucket >= 0").select("block", "bucket", *py._names(py._PAIRS))
    state, kept = py.train(made, 5)
    customers, tables, told = Counter(), Counter(), {}
    for r in state.collect():
        b = py._load(r)
        sample = py._tables(b, r["kept"][-1])
        for c, n, t in zip(b.codes % py._F, b.counts, sample[0], strict=True):
            customers[int(c)] += int(n)
            tables[int(c)] += int(t)
        for c, n, t in zip(b.contexts, b.leaf, sample[3], strict=True):
            told.setdefault(int(c), set()).add((int(n), int(t)))
    assert len(told) > 30 and told == {c: {(customers[c], tables[c])} for c in told}
    assert sum(customers.values()) == kept[-1].tokens


def test_scores_are_predictions_of_the_trained_state(spark):
    """What is put together block by block is what the buckets predict."""
    rng = np.random.default_rng(4)
    docs = [(k, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 50) % 300)) for k in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("held_out", F.col("doc_id") % 5 == 0)
    n = py.MIN_BUCKETS
    made = py._blocks(d.select("doc_id", "held_out", "text"), n).where("bucket >= 0").select("block", "bucket", *py._names(py._PAIRS))
    state, kept = py.train(made, n)
    loaded = [(r.bucket, py._load(r), r["kept"]) for r in state.collect()]
    every = {}
    for _, b, samples in loaded:
        by_context = [py._tables(b, t)[3] for t in samples]
        every |= {c: v for c, *v in zip(b.contexts.tolist(), b.leaf.tolist(), *(x.tolist() for x in by_context), strict=True)}
    contexts = np.array(sorted(every))
    customers, *tables = np.array([every[c] for c in contexts.tolist()]).T
    buckets = {}
    for bucket, b, samples in loaded:
        own = [(*py._tables(b, t)[:3], x) for t, x in zip(samples, tables, strict=True)]
        b.contexts, b.leaf = contexts, customers
        buckets[bucket] = b, list(zip(own, kept, strict=True))
    assert sum((b.counts > 1).sum() for b, _ in buckets.values()) > 100
    hashed = lambda w: np.array([xxhash.xxh64_intdigest(w)], np.uint64)
    scores = {r.doc_id: r.score for r in py.score(d, F.col("held_out")).collect()}
    for i, text in docs[:12]:
        words, context, expected = [w.encode() for w in tokens(text)], np.array([py.FIRST]), 0.0
        for w in words:
            b, samples = buckets[int(hashed(w)[0] >> np.uint64(32)) % n]
            expected += math.log10(b.predict(hashed(w), context, samples)[0][0])
            context = py.contexts_of([w], hashed(w))
        assert scores[i] == pytest.approx(expected, abs=1e-4)


def test_pairs_seen_once_are_not_moved_by_each_sweep(spark):
    """Files that a run leaves, shuffled and shared, stay near the size of a text of which every pair is new."""
    rng = np.random.default_rng(6)
    docs = [(k, " ".join(f"{int(x):x}" for x in rng.integers(0, 60_000, 10_000))) for k in range(40)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(2).cache()
    size = sum(len(t) for _, t in docs)
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [*(str(f) for f in manager.localDirs()), spark.sparkContext.getCheckpointDir().removeprefix("file:")]

    def left():
        found = [os.path.join(top, f) for folder in folders for top, _, files in os.walk(folder) for f in files]
        return {f: os.path.getsize(f) for f in found if not f.endswith(".crc")}

    before = left()
    assert py.by_checksum(d).count() == 40
    assert sum(v for f, v in left().items() if f not in before) < 8 * size
    d.unpersist()
