"""N-best segmentations against enumeration, exact round trips, and edge cases."""

import hashlib
import itertools
import sys

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tallyfold.llm import common, pieces
from tallyfold.llm.queries import QUERIES, TOKENIZER

SF = "/root/testdata/sf0.001"
REAL = pieces.Vocabulary.load(TOKENIZER)
TRIE = pieces.Trie(REAL)


def small(scores):
    named = {p: (256 + i, s) for i, (p, s) in enumerate(scores.items())}
    return pieces.Vocabulary(named, list(range(256)), [bytes([b]) for b in range(256)] + [p.encode() for p in scores])


TOY = small({" ": -3.0, "a": -2.0, "b": -2.5, "ab": -3.25, " a": -4.5, "ba": -4.75, "aba": -5.125, " ab": -6.0, "  ": -5.5})


def every(vocabulary, text):
    """Scores of all segmentations, best first."""
    out = []
    for cuts in itertools.product([0, 1], repeat=max(0, len(text) - 1)):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
        parts = [text[a:b] for a, b in zip(at, at[1:])]
        if all(p in vocabulary.pieces or len(p) == 1 for p in parts):
            out.append(sum(vocabulary.pieces[p][1] if p in vocabulary.pieces else vocabulary.unknown for p in parts))
    return sorted(out, reverse=True)


texts = st.text("ab x\né", min_size=1, max_size=11)


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 6))
def test_chunk_search_equals_enumeration(text, n):
    want = every(TOY, text)
    found = TOY.n_best(text, n)
    assert [s for s, _ in found] == want[:n]
    assert len({tuple(ids) for _, ids in found}) == len(found)
    _, score, loss = TOY.viterbi(text)
    assert score == want[0] and (score - loss == want[1] if len(want) > 1 else loss == np.inf)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab x", min_size=1, max_size=20), min_size=1, max_size=6), st.booleans())
def test_search_of_many_chunks_equals_one(chunks, real):
    vocabulary = REAL if real else TOY
    for chunk, found in zip(chunks, pieces.Trie(vocabulary).search(chunks) if not real else TRIE.search(chunks)):
        if found is not None:
            ids, score, loss = vocabulary.viterbi(chunk)
            assert found[1:] == (score, loss)
            spelled = b"".join(vocabulary.spelled[i] for i in np.frombuffer(found[0], "<i4"))
            assert spelled.decode() == chunk


@settings(max_examples=150, deadline=None)
@given(texts, st.integers(1, 5))
def test_text_search_equals_enumeration(text, n):
    found = pieces.Encoder(TOY, n).encode(text)
    assert [s for s, _ in found] == pytest.approx(every(TOY, " " + text)[:n])
    assert len({b for _, b in found}) == len(found)
    for _, b in found:
        assert TOY.decode(np.frombuffer(b, "<i4").tolist()) == text


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_round_trip_with_the_real_model(text):
    for _, b in pieces.Encoder(REAL, 3).encode(text):
        assert REAL.decode(np.frombuffer(b, "<i4").tolist()) == text


def test_real_model_ids_are_its_pieces():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=TOKENIZER)
    ids = np.frombuffer(pieces.Encoder(REAL, 2).encode("The cat sat.")[0][1], "<i4").tolist()
    assert model.decode(ids) == "The cat sat."


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op9_sentencepiece_nbest"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    encoder = pieces.Encoder(REAL, 3)
    for r in got:
        assert r.round_trip and (r.gap is None or r.gap >= 0)
        found = encoder.encode(docs[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(found[0][1]).hexdigest() and r.n_pieces == len(found[0][1]) // 4
        # The whole lattice in one search gives the same scores.
        if len(docs[r.doc_id]) < 400:
            assert [s for s, _ in REAL.n_best(" " + docs[r.doc_id], 3)] == [s for s, _ in found]


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a▁b  ▁"), (4, "a▁b  ▁"), (None, "x"), (5, "ab" * 60_000), (6, "🎉 中文 é\0")]
    d = spark.createDataFrame([(i, t, [1], "d", 5) for i, t in rows], "doc_id long, text string, ids array<int>, decoded string, score int")
    got = pieces.digests(d, TOKENIZER).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    assert sorted(r.n_pieces for r in got)[:2] == [0, 0]
    best = pieces.best(d, TOKENIZER)
    back = pieces.decode(best, TOKENIZER)
    assert best.columns == ["doc_id", "text", "decoded", "score", "ids"]
    assert all(r.decoded == r.text for r in back.collect())
    lists = {r.doc_id: r.segmentations for r in pieces.encode(d, TOKENIZER, n=2).collect()}
    assert lists[1] is None and lists[2][0].ids == [] and len(lists[4]) == 2
    for f in (pieces.digests, pieces.best, pieces.encode):
        assert f(d.limit(0), TOKENIZER).count() == 0


def test_a_worker_keeps_a_bounded_size_of_chunks():
    """Of 400,000 different chunks only so many stay that they fit the limit, tables of the dictionaries included."""
    encoder = pieces.Encoder(REAL, 1)
    for k in range(80):
        encoder.encode_all([" ".join(f"w{1_000_000 + 5_000 * k + i}" for i in range(j, j + 500)) for j in range(0, 5_000, 500)])
    kept = [encoder, getattr(encoder, "older", {})]
    held = sum(sys.getsizeof(d) + sum(sys.getsizeof(c) + sum(map(sys.getsizeof, (e, *e))) for c, e in d.items()) for d in kept)
    assert 20 << 20 < held < 80 << 20


def test_forgotten_chunks_are_found_again(monkeypatch):
    """With room for few chunks, split in portions, segmentations stay the same."""
    texts = [f"{'ab' * 40} a{i % 7}中{i} ab{i % 3} {'x' * (i % 9)}" for i in range(60)]
    want = [pieces.Encoder(REAL, 3).encode(t) for t in texts]
    monkeypatch.setattr(pieces, "CACHE_BYTES", 8_000)
    monkeypatch.setattr(pieces, "PORTION", 200)
    encoder = pieces.Encoder(REAL, 3)
    assert encoder.encode_all(texts) + encoder.encode_all(texts) == want + want


def test_worker_frees_the_cache_of_another_operator(spark):
    class Frame:
        sparkSession = spark

        def mapInArrow(self, task, schema):
            return task

    def work(batches):
        return batches

    encoder = pieces._encoder(TOY, 1)
    encoder.encode("ab aba")
    work.__module__ = pieces.__name__
    assert list(common.map_batches(Frame(), work, "x int")(iter([]))) == []
    assert pieces._encoder(TOY, 1) is encoder
    work.__module__ = "tallyfold.llm.secrets"
    assert list(common.map_batches(Frame(), work, "x int")(iter([]))) == []
    assert pieces._encoder(TOY, 1) is not encoder
