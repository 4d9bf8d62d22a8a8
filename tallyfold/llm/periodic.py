"""Periodic runs of words by block convolution: exact integer NTTs at dyadic scales.

A run of smallest period q and length at least ``4q`` holds, at scale
``s = 2^floor(log2 q)``, a block of s words starting at a multiple of s that
occurs again q words later, with ``s <= q < 2s``. So at each scale every
aligned block is compared with the 2s - 1 words that follow it one scale
on: the sum of squared differences ``sum a^2 + sum b^2 - 2 sum a b`` of word
numbers is zero exactly where the block recurs. Blocks whose first words
recur at no shift cannot recur and are left out of the transform. The cross term of all blocks
of all documents of a batch is one batched number-theoretic transform over
the prime 998244353; the squares come from prefix sums. A zero (modulo the
prime) is checked word by word, so a coincidence of the modulus cannot make
a run, and the distance seeds an extension to the maximal stretch of that
period. A seed inside a stretch already found, of a period dividing its
distance, is that stretch again and is skipped, so each run is extended once.

Spark deals documents to tasks; a document is worked whole in one task, in
memory linear in its words.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import map_batches

# The prime of the transform, 119 * 2^23 + 1, and a generator of its group.
PRIME = 998244353
ROOT = 3
_INVERSE = 1.0 / PRIME
# Fixed values of the contract: a run is at least MIN_LENGTH words and MIN_EXPONENT periods long.
MIN_LENGTH = 6
MIN_EXPONENT = 4
# Words at the head of a block that must recur at a shift before the transform is asked about it.
PREFIX = 4
# Cells of one batched transform (blocks x width); larger scales are cut into several.
CELLS = 1 << 20

_OUT = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)

_twiddles: dict[tuple[int, bool], np.ndarray] = {}
_reversed: dict[int, np.ndarray] = {}


def _roots(length: int, invert: bool) -> np.ndarray:
    key = (length, invert)
    if key not in _twiddles:
        w = pow(ROOT, (PRIME - 1) // length, PRIME)
        if invert:
            w = pow(w, PRIME - 2, PRIME)
        half = length // 2
        out = np.ones(half, dtype=np.int64)
        step, filled = w, 1
        while filled < half:
            take = min(filled, half - filled)
            out[filled : filled + take] = out[:take] * step % PRIME  # once per width, cached
            filled += take
            step = step * step % PRIME
        _twiddles[key] = out
    return _twiddles[key]


def mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a * b mod PRIME`` for entries below the prime, exactly.

    The quotient is estimated in floating point, off by at most one, and the
    remainder is computed in 64-bit integers and corrected; this avoids an
    integer division per entry.
    """
    q = np.floor(a.astype(np.float64) * b * _INVERSE).astype(np.int64)
    r = a * b - q * PRIME
    r += PRIME * (r < 0)
    r -= PRIME * (r >= PRIME)
    return r


def ntt(a: np.ndarray, invert: bool = False) -> np.ndarray:
    """The transform of each row of ``a`` (int64 below the prime; width a power of two), iterative radix 2."""
    rows, n = a.shape
    if n not in _reversed:
        bits = n.bit_length() - 1
        rev = np.zeros(n, dtype=np.int64)
        for b in range(bits):
            rev |= ((np.arange(n) >> b) & 1) << (bits - 1 - b)
        _reversed[n] = rev
    a = a[:, _reversed[n]]
    length = 2
    while length <= n:
        half = length // 2
        w = _roots(length, invert)
        a = a.reshape(rows, n // length, length)
        u = a[:, :, :half]
        v = mulmod(a[:, :, half:], w)
        low = u + v
        low -= PRIME * (low >= PRIME)
        high = u - v
        high += PRIME * (high < 0)
        a = np.concatenate((low, high), axis=2)
        length *= 2
    a = a.reshape(rows, n)
    if invert:
        a = mulmod(a, np.int64(pow(n, PRIME - 2, PRIME)))
    return a


def _agree(w: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from i (going by ``step``, 1 or -1) equal those from j, within the array."""
    n = len(w)
    count, chunk = 0, 8
    while True:
        if step > 0:
            room = n - max(i, j) - count
            if room <= 0:
                return count
            take = min(chunk, room)
            a, b = w[i + count : i + count + take], w[j + count : j + count + take]
        else:
            room = min(i, j) + 1 - count
            if room <= 0:
                return count
            take = min(chunk, room)
            a = w[i - count - take + 1 : i - count + 1][::-1]
            b = w[j - count - take + 1 : j - count + 1][::-1]
        miss = np.flatnonzero(a != b)
        if len(miss):
            return count + int(miss[0])
        count += take
        chunk *= 2


@functools.lru_cache(maxsize=1 << 16)
def _divisors(n: int) -> list[int]:
    small = [d for d in range(1, int(n**0.5) + 1) if n % d == 0]
    return small + [n // d for d in reversed(small) if d * d != n]


def runs_of(words: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Runs ``(start, length, period)`` of each array of word numbers (all at least 1), sorted by start, then period."""
    # Per document and period: starts and stops of the stretches found, in order of start.
    found: list[dict[int, tuple[list[int], list[int]]]] = [dict() for _ in words]
    runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    if not len(words):
        return runs
    flat = np.concatenate([w.astype(np.int64) for w in words] + [np.zeros(1, np.int64)])
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    squares = np.concatenate(([0], np.cumsum(flat[:-1] * flat[:-1] % PRIME)))
    s = 1
    while MIN_EXPONENT * s <= lengths.max(initial=0):
        width = 2 * s
        docs = np.flatnonzero(lengths >= MIN_EXPONENT * s)
        per_doc = (lengths[docs] - s) // s  # blocks b with b + 2s <= n
        doc_of = np.repeat(docs, per_doc)
        block = (np.arange(per_doc.sum()) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)) * s
        for lo in range(0, len(block), max(1, CELLS // width)):
            d_rows, b_rows = doc_of[lo : lo + CELLS // width], block[lo : lo + CELLS // width]
            _scale(words, flat, offsets, squares, lengths, d_rows, b_rows, s, found, runs)
        s *= 2
    for r in runs:
        r.sort(key=lambda x: (x[0], x[2]))
    return runs


def _scale(words, flat, offsets, squares, lengths, d_rows, b_rows, s, found, runs) -> None:
    """Blocks ``b_rows`` of documents ``d_rows`` against shifts s to 2s - 1 after them."""
    width = 2 * s
    base = offsets[d_rows] + b_rows
    ends = offsets[d_rows] + lengths[d_rows]
    # A block can only recur where its first words do: blocks without such a shift are left out of the transform.
    j = np.arange(s)
    maybe = np.ones((len(base), s), dtype=bool)
    for i in range(min(s, PREFIX)):
        at = base[:, None] + s + j[None, :] + i
        maybe &= (at < ends[:, None]) & (flat[np.minimum(at, len(flat) - 1)] == flat[base + i][:, None])
    keep = maybe.any(axis=1)
    if not keep.any():
        return
    d_rows, b_rows, base, ends = d_rows[keep], b_rows[keep], base[keep], ends[keep]
    k = np.arange(width)
    at = base[:, None] + k[None, :]
    a = np.where(k[None, :] < s, flat[np.minimum(at, len(flat) - 1)], 0)
    a = np.where(at < ends[:, None], a, 0)
    a_rev = np.zeros_like(a)
    a_rev[:, :s] = a[:, s - 1 :: -1]
    x_at = base[:, None] + s + k[None, :]
    x = np.where((x_at < ends[:, None]) & (k[None, :] < width - 1), flat[np.minimum(x_at, len(flat) - 1)], 0)
    conv = ntt(mulmod(ntt(a_rev), ntt(x)), invert=True)
    cross = conv[:, s - 1 : 2 * s - 1]  # shift delta = s + j
    a2 = (squares[base + s] - squares[base]) % PRIME
    lo = np.minimum(base[:, None] + s + j[None, :], ends[:, None])
    hi = np.minimum(base[:, None] + 2 * s + j[None, :], ends[:, None])
    b2 = (squares[hi] - squares[lo]) % PRIME
    miss = (a2[:, None] + b2 - 2 * cross) % PRIME
    full = base[:, None] + 2 * s + j[None, :] <= ends[:, None]
    for row, shift in zip(*np.nonzero((miss == 0) & full)):
        doc, b, delta = int(d_rows[row]), int(b_rows[row]), int(s + shift)
        w = words[doc]
        if _covered(found[doc], b, delta, s):
            continue
        if not np.array_equal(w[b : b + s], w[b + delta : b + delta + s]):
            continue
        left = _agree(w, b - 1, b - 1 + delta, -1)
        right = _agree(w, b, b + delta, 1)
        start, stop = b - left, b + right + delta
        starts, stops = found[doc].setdefault(delta, ([], []))
        at = bisect.bisect_right(starts, start)
        starts.insert(at, start)
        stops.insert(at, stop)
        if stop - start >= max(MIN_LENGTH, MIN_EXPONENT * delta):
            runs[doc].append((start, stop - start, delta))


def _covered(stretches: dict, b: int, delta: int, s: int) -> bool:
    """Whether block b and its copy delta later lie in a known stretch of a period dividing delta."""
    for q in _divisors(delta):
        if q not in stretches:
            continue
        starts, stops = stretches[q]
        # Maximal stretches of one period overlap by less than that period, so two at most can hold b.
        at = bisect.bisect_right(starts, b)
        for i in range(max(0, at - 2), at):
            if b + delta + s <= stops[i]:
                return True
    return False


def word_numbers(words: list[str]) -> np.ndarray:
    """Words as numbers from 1, equal words equal numbers."""
    if not words:
        return np.zeros(0, dtype=np.int64)
    _, inverse = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)
    return inverse.astype(np.int64) + 1


def summary(words: list[str], runs: list[tuple[int, int, int]]) -> dict:
    """The digest columns of one document from its words and runs."""
    best = None
    for start, length, period in runs:
        key = (Fraction(length, period), -start, -period)
        if best is None or key > best[0]:
            best = (key, start, length, period)
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    keep = np.cumsum(dropped)[: len(words)] == 0
    text = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    out = {
        "n_words": len(words), "n_runs": len(runs), "start": None, "length": None, "period": None,
        "exponent_milli": None, "runs_sha256": hashlib.sha256(text.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(" ".join(w for w, k in zip(words, keep) if k).encode()).hexdigest(),
    }
    if best:
        _, start, length, period = best
        out |= {"start": start, "length": length, "period": period, "exponent_milli": 1000 * length // period}
    return out


def detect(docs: DataFrame, doc_id: str = "doc_id", words: str = "words") -> DataFrame:
    """``(doc_id, n_words, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)`` per row.

    ``words`` is an array of strings (null: no words; a null entry counts as
    the empty word). A run is a maximal stretch of smallest period q and
    length at least ``max(6, 4q)``; the best one has the greatest
    length/period, then the smallest start, then period; without runs those
    four columns are null. runs_sha256 digests ``start,length,period`` lines
    by start, then period; collapsed_sha256 the words that no run holds after
    its first period, joined by one space (of no words: the digest of the
    empty text). Repeated rows each get a row; other columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [[w or "" for w in (ws or [])] for ws in batch.column(1).to_pylist()]
            found = runs_of([word_numbers(ws) for ws in texts])
            rows = [summary(ws, r) for ws, r in zip(texts, found)]
            cols = {"doc_id": ids} | {k: [r[k] for r in rows] for k in _OUT_NAMES[1:]}
            yield pa.RecordBatch.from_pydict(cols, schema=_SCHEMA)

    return map_batches(docs.select(F.col(doc_id).cast("long"), F.col(words)), work, _OUT)


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()),
    ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
    ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
])
_OUT_NAMES = _SCHEMA.names
