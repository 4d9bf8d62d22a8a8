"""Toxicity: held-out rows, scores and edge cases."""

import zlib

import numpy as np

from tallyfold.llm import toxicity
from tallyfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_query(spark):
    rows = QUERIES["op12_toxicity"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    assert sorted(r.doc_id for r in rows) == sorted(d.doc_id for d in docs)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    # Ranking: a held-out toxic row scores above an ordinary one more often than by chance.
    pos = np.array([s for s, y in held if y == 1])
    neg = np.array([s for s, y in held if y == 0])
    auc = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    assert auc > 0.6


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, "you idiot moron", "x"), (2, "a calm text", "x"), (3, None, "x"), (4, "", "x"), (5, "idiot " * 20000, "x"),
         (None, "calm", "x"), (6, "a calm text", "x")],
        "doc_id long, text string, lang string",
    )
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 1), (6, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, docs["doc_id"].isNotNull())
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got.values())
    assert got[3].score == got[4].score
    empty = docs.where("false")
    model = toxicity.train(empty, labels.where("false"), empty["doc_id"].isNotNull())
    assert toxicity.score(docs, model).count() == 7


def test_stems_are_learnt_and_copied_texts_are_not(spark):
    """Toxic words with ever different endings are found; the words of one copied toxic text are no evidence."""
    rng = np.random.default_rng(4)
    plain = [f"{a}{b}" for a in ("mar", "tol", "ben", "sil") for b in ("ando", "ire", "une", "asta", "olo")]
    ends = [f"{a}{b}" for a in "abcdefghik" for b in "lmnoprstuv"]

    def text(more):
        return " ".join(rng.permutation([*rng.choice(plain, 30), *more]))

    copied = text([f"rarity{k}" for k in range(12)])
    rows = []
    for k in range(1200):
        toxic = k % 6 == 0
        words = ["grolk" + e for e in rng.choice(ends, 3)] if toxic else ["zelt" + e for e in rng.choice(ends, 3)] * (k % 6 < 3)
        rows.append((k, copied + f" x{k}" if k % 30 == 0 else text(words), int(toxic)))
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    _, own = toxicity._vocabulary(docs.join(labels.withColumnRenamed("toxic", "label"), "doc_id").where("doc_id % 4 != 2"))
    assert "grolk" in own[1] and not any(w.startswith("rari") for w in own[1])
    model = toxicity.train(docs, labels, docs["doc_id"] % 4 != 2)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    held = [(got[k], y) for k, _, y in rows if k % 4 == 2 and k % 30]
    assert sum(p for p, y in held if y) >= 0.9 * sum(y for _, y in held)
    assert sum(p for p, y in held if not y) <= 0.05 * sum(not y for _, y in held)
