"""Measures against brute force, line rules, and edge cases."""

import re
from collections import Counter

import pytest

from tallyfold.llm import quality
from tallyfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def slow(text):
    split = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    words, seen, dups = split(text), set(), 0
    for line in text.split("\n"):
        dups += line in seen and bool(split(line))
        seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    hit = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(hit)


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op6_quality_rules"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        want = slow(docs[r.doc_id] or "")
        assert tuple(r)[1:6] == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)
    assert 0.5 < sum(r.kept for r in got) / len(got) < 1


@pytest.mark.parametrize("line,fault", [
    ("An ordinary sentence, with seven plain words.", None), ("short title", None), ("home | about | contact | help", "navigation"),
    ("Home About Contact", "navigation"), ("All rights reserved.", "boilerplate"), ("a*** b*** c*** d***", "symbols"),
    ("THIS LINE SHOUTS AT ALL READERS", "capitals"), ("1 2 3 4 5 6 7 8", "letters"), ("word " * 60, "punctuation"),
    ("In 1990, 12 of 30 members (40 %) voted.", None), ("See A | B for details on the matter.", None),
])
def test_line_rules(line, fault):
    assert quality.line_fault(line, quality.words_of(line)) == fault


def test_edge_cases(spark):
    good = "These are ten plain words that make one good sentence."
    rows = [(1, None), (2, ""), (3, "\n \n"), (4, good), (4, good), (None, good), (5, good + "\n" + "a*** " * 30),
            (6, (good + "\n") * 3), (7, "mot un deux " + good), (8, " ".join(f"words{k}," for k in range(60_000)) + ".")]
    d = spark.createDataFrame([(i, t, 1, True) for i, t in rows], "doc_id long, text string, n_words int, kept boolean")
    got = quality.judge(d).collect()
    assert sorted([tuple(r)[:6] for r in got], key=str) == sorted([(i, *slow(t or "")) for i, t in rows], key=str)
    kept = Counter(r.doc_id for r in got if r.kept)
    assert kept == {4: 2, None: 1, 7: 1, 8: 1}
    left = {r.doc_id: r.text for r in quality.cleaned(d).collect()}
    assert left[4] == good and set(left) == {4, None, 7, 8}
    assert quality.judge(d.limit(0)).count() == 0
    assert quality.clean_lines(good + "\nhome | about | news")[0] == good


@pytest.mark.parametrize("line,fault", [
    ("the first of many words, then a cut in the", "punctuation"), ("five words and no mark", "punctuation"), ("only four words here", None),
    ("The council met on Monday, and", "punctuation"), ("word, " * 49, "punctuation"), ("five words and a mark. ", None),
    ("He said: \"these are the words\"", None), ("यह एक छोटा सा वाक्य है।", None), ("هل هذه جملة قصيرة مع علامة؟", None),
    ("这 是 一 个 句子。", None),
])
def test_end_marks(line, fault):
    """A mark inside the line does not excuse it, nor do fewer than fifty words."""
    assert quality.line_fault(line, quality.words_of(line)) == fault
