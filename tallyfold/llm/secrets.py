"""Secret scans: all rules in one minimal automaton, one pass over the bytes of a text.

The pass runs from right to left over an automaton of the reversed rules, so
it tells for every byte which rules match from there on. Only at such bytes a
rule's own forward automaton looks for the longest end. Matches of a rule are
leftmost and do not overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.automaton import compile_rules
from tallyfold.llm.common import map_batches, utf8


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds a secret; a match whose part after ``head`` is shorter than ``least`` bytes is dropped.

    ``head`` is an expression for the beginning of a match that does not count
    (empty: the whole match counts). A dropped match still ends the search up
    to its end.
    """

    kind: str
    pattern: str
    least: int = 0
    head: str = ""
    ignore_case: bool = False


_ASSIGN = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
# The first three rules are the base, the others are formats of
# tokens that their issuers have published. ``{24,}`` equals ``+`` with a least
# length here, since a run that is too short holds no longer one.
RULES = (
    Rule("assign", _ASSIGN + r"[A-Za-z0-9+/_.=-]+", 6, _ASSIGN, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", 24),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = 3


class Scanner:
    """Compiled rules; arrays only, so tasks get it as it is."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.arrays = compile_rules([(r.pattern, r.ignore_case) for r in rules], reverse=True, anywhere=True)
        self.forward = [compile_rules([(r.pattern, r.ignore_case)]) for r in rules]
        self.heads = [compile_rules([(r.head, r.ignore_case)]) if r.head else None for r in rules]
        self.loops = None

    def __getstate__(self):
        return self.__dict__ | {"loops": None}

    def _prepare(self) -> None:
        """The arrays as lists that refer to each other: a step is one list access."""

        def rows(next_: np.ndarray, accepts: np.ndarray) -> list:
            made = [[None] * 256 for _ in accepts]
            for row, to, mark in zip(made, next_.tolist(), accepts.tolist(), strict=True):
                row[:] = [made[t] for t in to]
                # What the state accepts, and whether nothing can follow.
                row += [mark, not mark and all(made[t] is row for t in to)]
            return made[0]

        self.loops = rows(*self.arrays), [rows(*x) for x in self.forward], [x and rows(*x) for x in self.heads]

    def spans(self, text: bytes) -> list[list[tuple[int, int]]]:
        """Byte spans of each rule in ``text``, by start."""
        if self.loops is None:
            self._prepare()
        row, forward, heads = self.loops
        # Where the marks change, from the end of the text on: all bytes of a long key but its last ones have the same.
        changes, before = [], 0
        for i, c in enumerate(text[::-1]):
            row = row[c]
            if row[256] != before:
                before = row[256]
                changes.append((i, before))
        found: list[list[tuple[int, int]]] = [[] for _ in self.rules]
        done = [0] * len(self.rules)
        first = 0
        for i, marks in reversed(changes):
            stop, r = len(text) - i, 0
            while marks:
                if marks & 1:
                    at = max(first, done[r])
                    while at < stop:
                        end = done[r] = _longest(forward[r], text, at)
                        begin = _longest(heads[r], text, at) if heads[r] else at
                        if end - begin >= self.rules[r].least:
                            found[r].append((at, end))
                        at = max(end, at + 1)
                marks >>= 1
                r += 1
            first = stop
        return found


def _longest(row: list, text: bytes, start: int) -> int:
    """End of the longest match that begins at ``start``."""
    end = start
    for at in range(start, len(text)):
        row = row[text[at]]
        if row[257]:
            break
        if row[256]:
            end = at + 1
    return end


def _digest(spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    return ",".join(f"{rules[r].kind}:{s}:{e}" for s, r, e in spans)


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, base: int = BASE
) -> DataFrame:
    """``(doc_id, counts, base_spans, spans)`` for every row of ``docs``, in one pass without a shuffle.

    counts has the matches of each rule in order; spans are ``kind:start:end``
    by start, then rule, comma-joined, in code points, end exclusive; base_spans
    has those of the first ``base`` rules. Null and empty texts have none.
    Repeated rows and null ids each give a row; other columns are ignored.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scanner = Scanner(rules)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base_spans, spans = [], [], []
            for t in utf8(batch.column(1)):
                found = scanner.spans(t)
                points = _code_points(t, found)
                counts.append([len(x) for x in found])
                base_spans.append(_digest([x for x in points if x[1] < base], rules))
                spans.append(_digest(points, rules))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.list_(pa.int64())), pa.array(base_spans, pa.string()),
                 pa.array(spans, pa.string())],
                ["doc_id", "counts", "base_spans", "spans"],
            )

    return map_batches(
        chosen, work, f"doc_id {dict(chosen.dtypes)['doc_id']}, counts array<long>, base_spans string, spans string"
    )


def _code_points(text: bytes, found: list[list[tuple[int, int]]]) -> list[tuple[int, int, int]]:
    """``(start, rule, end)`` in code points, by start, then rule."""
    ends = sorted({x for spans in found for s in spans for x in s})
    place, at, n = {}, 0, 0
    for x in ends:
        n += len(text[at:x].decode(errors="replace"))
        place[x], at = n, x
    return sorted((place[s], r, place[e]) for r, spans in enumerate(found) for s, e in spans)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``scan`` with counts and the digest of the base rules as columns."""
    return scan(docs, doc_id, text).select(
        "doc_id", *(F.col("counts")[i].alias(f"n_{RULES[i].kind}") for i in range(BASE)),
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans",
    )


def mask(docs: DataFrame, text: str = "text", length: str | None = "n_chars", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret replaced by ``[SECRET]``; a column ``length`` follows the text.

    Spans of different rules that overlap are replaced together. Null texts stay null.
    """
    scanner = Scanner(rules)
    columns = docs.columns
    at = columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, known in zip(utf8(batch.column(at)), batch.column(at).is_valid().to_pylist(), strict=True):
                spans = sorted(s for x in scanner.spans(t) for s in x) if known else []
                parts, done = [], 0
                for s, e in spans:
                    if s >= done:
                        parts += [t[done:s], b"[SECRET]"]
                    done = max(done, e)
                out.append((b"".join(parts) + t[done:]).decode(errors="replace") if known else None)
            arrays = list(batch.columns)
            arrays[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, columns)

    made = map_batches(docs, work, docs.schema)
    if length in columns:
        changed = F.when(F.col(text).isNotNull(), F.length(text).cast(docs.schema[length].dataType)).otherwise(F.col(length))
        made = made.withColumn(length, changed)
    return made
