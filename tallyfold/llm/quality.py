"""Quality rules, line first: bad lines go, then documents that lose too much of their text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import map_batches

# Base rules.
MIN_WORDS = 10
WINDOW = 5
MAX_REPEATED_PERCENT = 20
SYMBOLS = "#*$%&|<>"
# Lines. Shares are of the characters or words of a line; letters are counted
# among the characters in words, capitals among letters.
MAX_SYMBOL_SHARE = 0.1
MAX_BAR_SHARE = 0.2
MIN_LETTER_SHARE = 0.4
MAX_CAPITAL_SHARE = 0.8
# Capitals and letters are only judged in lines of at least so many words.
JUDGED_WORDS = 5
# So is the mark at the end.
END_MARK_WORDS = JUDGED_WORDS
# A document goes if it loses more than this share of its word characters.
MAX_LOST_SHARE = 0.5
# Phrases of page furniture and licence notes; lines of up to
# BOILERPLATE_WORDS words with one of them go.
BOILERPLATE = (
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of use", "terms of service",
    "enable javascript", "click here", "sign up", "log in", "subscribe to our", "share this", "licensed under",
    "released under the", "lorem ipsum",
)
BOILERPLATE_WORDS = 20
NAVIGATION = frozenset("home about contact next previous menu login search help sitemap back top news".split())

_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_SYMBOL = re.compile("[" + re.escape(SYMBOLS) + "]")
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))
# Marks at the end of a line, those of other scripts included.
_END = re.compile(r"[.!?…:;\"'”»)\]‘’“«›‹。．！？：；」』）】》।॥؟۔؛።፧։՜՞។៕၊။༎།]$")
REASONS = ("symbols", "navigation", "boilerplate", "letters", "capitals", "punctuation")


def words_of(text: str) -> list[str]:
    """Words between ASCII blanks; ``str.split`` would also divide at others."""
    return text.encode("utf-8", "surrogatepass").split() if text.isascii() else [w for w in _SPACE.split(text) if w]


def line_fault(line: str, words: list) -> str | None:
    """The first rule that a line with words fails."""
    n = len(line)
    symbols = len(_SYMBOL.findall(line))
    bars = line.count("|")
    lower = line.lower()
    if len(words) <= BOILERPLATE_WORDS and _BOILERPLATE.search(lower):
        return "boilerplate"
    if bars > MAX_BAR_SHARE * len(words) and bars > 1 or len(words) > 1 and all(w in NAVIGATION for w in lower.split()):
        return "navigation"
    if symbols > MAX_SYMBOL_SHARE * n:
        return "symbols"
    if len(words) >= JUDGED_WORDS:
        letters = [c for c in line if c.isalpha()]
        if len(letters) < MIN_LETTER_SHARE * sum(map(len, words)):
            return "letters"
        if sum(map(str.isupper, letters)) > MAX_CAPITAL_SHARE * len(letters):
            return "capitals"
    # Without a mark at its end a line is cut off, an item of a list or debris.
    if len(words) >= END_MARK_WORDS and not _END.search(line.rstrip()):
        return "punctuation"
    return None


def clean_lines(text: str) -> tuple[str, dict[str, int], int]:
    """The text without bad lines, lines removed by reason, and word characters removed."""
    kept, reasons, lost = [], {}, 0
    for line in text.split("\n"):
        words = words_of(line)
        fault = line_fault(line, words) if words else None
        if fault:
            reasons[fault] = reasons.get(fault, 0) + 1
            lost += sum(map(len, words))
        else:
            kept.append(line)
    return "\n".join(kept), reasons, lost


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words in windows of ``window`` words that occur twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict = {}
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    # Windows are numbered exactly: pairs of numbers get a number, again and again.
    at = numbers
    for k in range(1, window):
        at = np.unique(at[:-1] * (len(words) + 1) + numbers[k:], return_inverse=True)[1]
    often = np.bincount(at)[at] > 1
    if not often.any():
        return 0
    steps = np.zeros(len(words) + 1, np.int64)
    steps[:n] += often
    steps[window:] -= often
    return int(np.count_nonzero(np.cumsum(steps[:-1])))


def measure(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    words = words_of(text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dups += bool(words_of(line))
        else:
            seen.add(line)
    return len(words), sum(map(len, words)), len(_SYMBOL.findall(text)), dups, repeated_words(words)


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The measures of every row of ``docs``, its verdict and its cleaned text, in one pass without a shuffle.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_lines_removed, lost_chars. Null and
    empty texts have no words and are not kept. Lines are judged first;
    a document is kept if the base rules hold and at most ``MAX_LOST_SHARE`` of
    its word characters stood in bad lines. Repeated rows each give a row; other
    columns are ignored.
    """
    return _judged(docs, doc_id, text, False).drop("cleaned")


def cleaned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text)`` of the documents kept, without their bad lines."""
    return _judged(docs, doc_id, text, True).where("kept").select("doc_id", F.col("cleaned").alias("text"))


def _judged(docs: DataFrame, doc_id: str, text: str, with_text: bool) -> DataFrame:
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    names = (
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed", "lost_chars", "cleaned",
    )
    kinds = [None, *[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                t = t or ""
                n, chars, symbols, dups, repeated = measure(t)
                failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n
                left, reasons, lost = clean_lines(t)
                kept = not failed and lost <= MAX_LOST_SHARE * chars
                rows.append((n, chars, symbols, dups, repeated, failed, kept, sum(reasons.values()), lost, left if with_text else None))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds[1:]))], list(names)
            )

    return map_batches(chosen, work, (
        f"doc_id {dict(chosen.dtypes)['doc_id']}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, kept boolean, n_lines_removed long, lost_chars long, cleaned string"
    ))
