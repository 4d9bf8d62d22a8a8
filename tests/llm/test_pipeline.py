"""The pipeline against its stages done by brute force."""

import corpus_pipeline
from tallyfold.llm import language, pieces
from tallyfold.llm.common import table
from tests.llm.test_decontaminate import slow_hits
from tests.llm.test_secrets import slow_spans
from tests.llm.test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"


def masked(text):
    spans, out, done = sorted(s for x in slow_spans(text) for s in x), "", 0
    for s, e in spans:
        if s >= done:
            out += text[done:s] + "[SECRET]"
        done = max(done, e)
    return out + text[done:]


def test_pipeline_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = docs.collect()
    model = language.train(docs)
    rows = [r for r, v in zip(rows, language.judged([r.text for r in rows], model)) if not v[3]]
    fps = {r.doc_id: slow_fingerprint(r.text) for r in rows}
    root = slow_components(fps)
    rows = [r for r in rows if root[r.doc_id] == r.doc_id]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    bad = {h[0] for h in slow_hits([(r.doc_id, r.text) for r in rows], items) if h[5]}
    want = {r.doc_id: (masked(r.text), r.lang, r.source) for r in rows if r.doc_id not in bad}
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [*docs.columns, "ids"]
    got = got.collect()
    assert len(got) == len(want)
    vocabulary = pieces.Vocabulary.load(corpus_pipeline.TOKENIZER)
    for r in got:
        assert (r.text, r.lang, r.source) == want[r.doc_id] and r.n_chars == len(r.text)
        assert vocabulary.decode(r.ids) == r.text
    assert 0.5 * docs.count() < len(got) < docs.count()


def test_edge_cases(spark):
    rows = [(k, f"the cat sat on mat {k} and so did the dog number {k * k}", "en", "s", 1) for k in range(60)]
    rows += [(100, None, None, None, None), (101, "", "en", "s", 0), (None, "the dog sat on the cat and the mat", "en", None, 5), (103, "123", "en", "s", 3),
             (104, "the dog has a password: hunter2hunter2 and so did the cat on the mat", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        step = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES:
            step = stage(spark, step, SF)
            assert step.columns[:5] == docs.columns, name
        texts = {r.doc_id: r.text for r in step.collect()}
        assert set(texts) <= set(range(60)) | {None, 104} and (empty or None in texts)
        assert empty or texts[104] == "the dog has a [SECRET] and so did the cat on the mat"


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "sentencepiece"
    ]


def test_last_stage_searches_the_n_best(spark):
    rows = [(1, "the dog sat on the mat and so did the cat"), (2, ""), (None, "a▁b  中é\n x"), (4, None), (5, "123 🎉")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert found.columns == ["doc_id", "text", "ids", "segmentations", "round_trip"]
    got = {r.text: r for r in found.collect()}
    assert len(got) == 5 and got[None][2:] == (None, None, None)
    vocabulary = pieces.Vocabulary.load(corpus_pipeline.TOKENIZER)
    assert [(x.score, x.ids) for x in got[""].segmentations] == [(0.0, [])]
    for text in set(got) - {None, ""}:
        r = got[text]
        # The whole lattice in one search gives the same scores.
        assert [x.score for x in r.segmentations] == [s for s, _ in vocabulary.n_best(" " + text, 3)]
        assert r.ids == r.segmentations[0].ids and len({tuple(x.ids) for x in r.segmentations}) == (1 if r.doc_id == 5 else 3)
        assert r.round_trip and all(vocabulary.decode(x.ids) == text for x in r.segmentations)
    assert found.limit(0).count() == 0
