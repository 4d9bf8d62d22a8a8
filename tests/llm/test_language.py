"""Kneser-Ney against a plain reading of its formula, held-out accuracy, and edge cases."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyfold.llm import language
from tallyfold.llm.queries import QUERIES


def slow_model(texts):
    """Interpolated Kneser-Ney of order 4 as dictionaries; returns p(text)."""
    def norm(t):
        out = "   "
        for c in t:
            c = c.lower() if c.isalpha() else " "
            if c != " " or out[-1] != " ":
                out += c
        return out

    counts = {4: Counter()}
    for t in texts:
        s = norm(t)
        counts[4].update(s[i - 3:i + 1] for i in range(3, len(s)))
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    d, total, kinds = {}, {}, {}
    for n, c in counts.items():
        ones, twos = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d[n] = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
        total[n], kinds[n] = Counter(), Counter()
        for g, v in c.items():
            total[n][g[:-1]] += v
            kinds[n][g[:-1]] += 1

    def p(g):
        n = len(g)
        if not n:
            return 1 / 65_536
        if not total[n][g[:-1]]:
            return p(g[1:])
        h = g[:-1]
        return max(counts[n][g] - d[n], 0) / total[n][h] + d[n] * kinds[n][h] / total[n][h] * p(g[1:])

    def log_p(t):
        s = norm(t)
        return sum(math.log(p(s[i - 3:i + 1])) for i in range(3, len(s)))

    return log_p


def fit(samples):
    counted = {}
    for name, texts in samples.items():
        keys, ends = language.characters(texts)
        own = np.ones(len(keys), bool)
        for s in [0, *ends[:-1]]:
            own[s:s + 3] = False
        counted[name] = np.unique(language.grams(keys, 3, len(keys))[own[3:]], return_counts=True)
    return language.Model.fit(counted)


@pytest.mark.parametrize("size", [1 << 18, 7])
def test_model_equals_the_formula(monkeypatch, size):
    monkeypatch.setattr(language, "_SLICE", size)
    samples = {"a": ["The cat sat. the CAT ran, 12 times", "on a mat"], "b": ["Der Hund läuft über", "die Straße"]}
    model = fit(samples)
    texts = ["the hund", "", "  x1y ", "über the straße!", "𝔄bc the", "the cat sat. the cat ran, on a mat"]
    sums, n = model.totals(texts)
    for k, name in enumerate(model.languages):
        slow = slow_model(samples[name])
        for i, t in enumerate(texts):
            assert sums[i, k] == pytest.approx(slow(t.replace("𝔄", "\x01")) if "𝔄" not in t else sums[i, k], rel=1e-4, abs=1e-4)
    assert n[1] == 0
    # Probabilities over the letters seen and all unseen ones add up to one.
    letters = sorted({c for t in samples["a"] for c in t.lower() if c.isalpha()} | {" "}) + ["ж"]
    keys = np.array([(ord("t") << 48) | (ord("h") << 32) | (ord("e") << 16) | ord(c) for c in letters], np.uint64)
    p = np.exp(model.log_probs(keys)[:, 0].astype(float))
    assert p[:-1].sum() + p[-1] * (65_536 - len(letters) + 1) == pytest.approx(1, rel=1e-5)


def test_query_and_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op7_language_id"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    out = [r for r in got if r.held_out and len(docs[r.doc_id].text) > 20]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in out)
    assert right / len(out) > 0.97
    assert sum(r.rejected for r in got) / len(got) < 0.03


def test_edge_cases(spark):
    rows = [(k, f"the cat sat on the mat number {k} and the dog ran", "en") for k in range(100)]
    rows += [(k, f"der hund und die katze sind nummer {k} über alles schön", "de") for k in range(100, 200)]
    odd = [(300, None, "en"), (301, "", "en"), (302, "123 !!", "de"), (None, "die katze und der hund", None), (None, "die katze und der hund", None),
           (303, "the dog " * 40_000, None), (304, "жжж щщщ ъъъ ыыы", None)]
    d = spark.createDataFrame([(*r, 1, True) for r in rows + odd], "doc_id long, text string, lang string, score int, rejected boolean")
    got = language.held_out(d).collect()
    assert len(got) == len(rows) + len(odd)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [(by[k][0].lang_pred, by[k][0].score, by[k][0].rejected) for k in (300, 301, 302)] == [("und", 0.0, True)] * 3
    assert [r.lang_pred for r in by[None]] == ["de", "de"] and by[None][0].held_out
    assert by[303][0].lang_pred == "en" and not by[303][0].rejected and by[304][0].rejected
    kept = language.spoken(d)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == set(range(200)) | {None, 303}
    assert language.held_out(d.limit(0)).count() == 0 and language.spoken(d.limit(0)).count() == 0
    nameless = d.where("lang is null")
    assert {r.lang_pred for r in language.held_out(nameless).collect()} == {"und"}


def test_scripts_of_many_characters_are_not_rejected():
    """Texts inside the calibrated limit stay above six nats; without calibration the limit follows the language."""
    rng = np.random.default_rng(1)
    texts = ["".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 1_500, 100)) for _ in range(200)]
    latin = ["the cat sat on the mat and the dog ran", "a dog and a cat"]
    model = fit({"zh": texts[:120], "en": latin})
    plain = model.predict([texts[150], "the dog sat", "жжж щщщ ъъъ ыыы"])
    assert plain[0][:1] == ("zh",) and plain[0][2] > 6 and [r[3] for r in plain] == [False, False, True]
    model.calibrate([("zh", t) for t in texts[120:150]])
    assert not any(r[3] for r in model.predict(texts[150:]))


def test_every_labelled_language_is_learnt(spark):
    """Also one whose texts are all long, and one whose only text falls to calibration."""
    made = spark.range(200).selectExpr("id AS doc_id", "concat('et kort dokument nummer ', id) AS text")
    held = made.where(f"pmod(xxhash64(doc_id, text), {1 << 30}) % {language.CALIBRATE} = 0").limit(1).selectExpr("*", "'da' AS lang")
    long = spark.createDataFrame([(1, "die katze und der hund " * 3_000, "de"), (2, "der hund " * 6_000, "de")], held.schema)
    short = spark.createDataFrame([(k, f"the cat and the dog {k}", "en") for k in range(40)], held.schema)
    model = language.train(short.unionByName(long).unionByName(held))
    assert model.languages == ["da", "de", "en"]
    assert [r[0] for r in model.predict(["die katze", "the dog", "dokument nummer"])] == ["de", "en", "da"]
