"""Language-model scores by a hierarchical Pitman-Yor model of words.

A restaurant serves the words that follow one word, known by its hash. These
restaurants share the parents of coarser contexts, the class of that word's
last character, and the parents share the root, whose base is uniform over the
training words and one unknown word. Seatings are sampled by Gibbs: the tables
of a word in a restaurant are drawn given all others, from the leaves to the
root. Predictive probabilities are averaged over samples.

All restaurants' seatings of one word stand together. What the sampling of a
bucket of words needs from the others are the totals of parents and root, about
a hundred numbers, and those of the words' own contexts, which are added up by
shards of contexts and sent back to the buckets that asked. Text is divided into
blocks, and tokens are numbered by their distinct (word, context) pairs there.

A partition keeps its share of the blocks, buckets and shards from the first step
to the last: steps read what stays as it is where it was dealt to, and only new
tables, and numbers that another place asked for, are shuffled. A pair seen once
always has one table, so it takes no part in the sweeps. Shuffled files that are
lost are made anew from the text; like any such repair it needs a table that is
read in the same order again, as files are.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import RDD
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import Numbers, map_batches, utf8
from tallyfold.llm.language import remainder

BURN_IN = 2
SAMPLES = 3
SEED = 11
CONCENTRATION = 1.0
BLOCK_TOKENS = 4_000_000
# Rows of a batch that leaves a block: pairs of so many buckets.
ROWS = 16
# Buckets of words: at least so many, and one for so many bytes of text.
MIN_BUCKETS = 64
BUCKET_BYTES = 32 << 20
# Up to so many customers of a word the number of tables is drawn from its exact law.
EXACT = 128
# The end of a text; no word has this spelling.
_END = b"\n"


def _classes() -> np.ndarray:
    """Last byte of a word to its class."""
    found = np.full(256, 29, np.uint8)
    found[ord("a"):ord("z") + 1] = np.arange(26)
    found[ord("0"):ord("9") + 1] = 26
    found[[ord(c) for c in ".!?"]] = 27
    found[[ord(c) for c in ",;:"]] = 28
    found[128:] = 30 + np.arange(128) % 32
    return found


CLASSES = _classes()
# The context of a text's first word, a class of its own.
FIRST = 62
_G = 63
# A context has 40 bits: 34 of the word's hash and its class in the lowest 6.
_F = 1 << 40
_CLASS = 63


def contexts_of(words: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """The context that each word is for the next one."""
    return _context(hashes, _last_classes(words))


def _last_classes(words: list[bytes]) -> np.ndarray:
    return CLASSES[np.fromiter((w[-1] for w in words), np.uint8, len(words))]


def _context(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return ((hashes >> np.uint64(30)) << np.uint64(6)).astype(np.int64) | classes


def _planes(values: np.ndarray) -> bytes:
    """First the lowest bytes of all values, then the next ones: high bytes are mostly zero and cost nothing."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 3)


def _values(packed: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def _pack(numbers: np.ndarray) -> bytes:
    """Long numbers as their steps, which are small where they ascend."""
    return _planes(np.diff(numbers.astype("<i8"), prepend=np.int64(0)))


def _unpack(packed: bytes) -> np.ndarray:
    return np.cumsum(_values(packed, "<i8"))


def _pack_counts(counts: np.ndarray) -> bytes:
    return _planes(np.ascontiguousarray(counts).astype("<u4").ravel())


def _unpack_counts(packed: bytes, rows: int | None = None) -> np.ndarray:
    found = _values(packed, "<u4").astype(np.int64)
    return found if rows is None else found.reshape(rows, -1)


def _place(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``wanted`` stand in sorted ``values``, and which of them do."""
    if not len(values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return at, values[at] == wanted


def _pick(values: np.ndarray, at: np.ndarray, there: np.ndarray) -> np.ndarray:
    """``values[at]``, and 0 for what is not ``there``."""
    out = np.zeros(len(at), np.int64)
    out[there] = values[at[there]]
    return out


def _stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: seatings of c customers at t tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0
    for c in range(1, most):
        t = np.arange(1, c + 1)
        out[c + 1, 1:c + 1] = out[c, 1:c + 1] + np.log(c - t * discount)
        out[c + 1, 2:c + 2] = np.logaddexp(out[c + 1, 2:c + 2], out[c, 1:c + 1])
    return out


def sample_tables(counts: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of words with so many customers, each new table weighing ``weight``.

    Exact up to ``EXACT`` customers. Tables given customers are a compound
    Poisson law held at its total: the sum over tables of the seatings' weights
    has the generating function ``exp(weight * (1 - (1 - x) ** discount) / discount)``.
    Beyond ``EXACT`` the number of tables is one and a Poisson number, its mean
    taken where the expected total is the number of customers.
    """
    log_s, tables = _stirling(discount), np.minimum(counts, 1).astype(np.int64)
    log_weight = np.log(np.maximum(weight, 1e-300))
    seated = np.minimum(counts, EXACT)
    order = np.argsort(seated, kind="stable")
    values, begin = np.unique(seated[order], return_index=True)
    for c, low, high in zip(values.tolist(), begin.tolist(), [*begin.tolist()[1:], len(order)]):
        if c < 2:
            continue
        step = max(1, (1 << 20) // c)
        for k in range(low, high, step):
            who = order[k:min(high, k + step)]
            logits = log_s[c, 1:c + 1] + np.arange(1, c + 1) * log_weight[who, None]
            p = np.cumsum(np.exp(logits - logits.max(axis=1, keepdims=True)), axis=1)
            tables[who] = 1 + (p < rng.random(len(who))[:, None] * p[:, -1:]).sum(axis=1)
    many = np.flatnonzero(counts > EXACT)
    if len(many):
        # Solve weight * z * (1 - z) ** (discount - 1) = customers for u = 1 - z, in logarithms.
        low, high = np.full(len(many), -700.0), np.full(len(many), -1e-12)
        for _ in range(60):
            middle = (low + high) / 2
            over = log_weight[many] + np.log(-np.expm1(middle)) + (discount - 1) * middle > np.log(counts[many])
            low, high = np.where(over, middle, low), np.where(over, high, middle)
        mean = weight[many] * -np.expm1(discount * low) / discount
        tables[many] = np.minimum(counts[many], 1 + rng.poisson(mean))
    return tables


@dataclass
class Totals:
    """Customers and tables of parents and root, discounts by level, and the size of the training text."""

    parent: np.ndarray
    parent_tables: np.ndarray
    root: float
    root_tables: float
    tokens: float
    words: float
    discounts: tuple[float, float, float]

    @classmethod
    def of(cls, x: list[float], discounts: tuple[float, float, float] | None = None) -> Totals:
        x = np.array(x, float)
        at = 2 * _G
        if discounts is None:
            # As in Kneser-Ney smoothing, from the words served once and twice.
            ones = x[at + 4:at + 10]
            discounts = tuple(
                float(np.clip(a / (a + 2 * b), 0.1, 0.95)) if a else 0.5 for a, b in zip(ones[::2], ones[1::2], strict=True)
            )
        return cls(x[:_G], x[_G:at], *x[at:at + 4], discounts)


class Bucket:
    """The training pairs of some words, sorted, with their seating.

    ``contexts`` are those of its pairs and others that will be asked for;
    ``leaf`` and the last array of ``tables`` are their customers and tables,
    of this bucket alone until the sums over all buckets are put there. With
    ``once``, the codes of word and class and how many pairs of each were seen
    once, those pairs are not listed.
    """

    def __init__(
        self, hashes: np.ndarray, codes: np.ndarray, counts: np.ndarray, contexts: np.ndarray | None = None,
        once: tuple[np.ndarray, np.ndarray] | None = None, words: int | None = None,
    ) -> None:
        self.hashes, self.codes, self.counts = hashes, codes, counts
        self.words = len(hashes) if words is None else words
        self.word, context = codes // _F, codes % _F
        self.contexts = np.unique(context) if contexts is None else contexts
        self.at = np.searchsorted(self.contexts, context)
        coarse = self.word * _G + (context & _CLASS)
        self.coarse = np.unique(coarse) if once is None else once[0]
        self.up = np.searchsorted(self.coarse, coarse)
        self.alone = np.zeros(len(self.coarse), np.int64) if once is None else once[1]
        self.coarse_word, self.group = self.coarse // _G, self.coarse % _G
        self.leaf = self.by_context(counts)
        # At first each word has one table in each restaurant that serves it.
        self.tables = (
            np.ones(len(codes), np.int64), np.ones(len(self.coarse), np.int64), np.ones(self.words, np.int64),
            self.by_context(np.ones(len(codes))),
        )

    def moving(self) -> tuple:
        """What the sweeps need, packed: pairs seen once have no table to draw."""
        more = self.counts > 1
        alone = np.bincount(self.up[~more], minlength=len(self.coarse))
        return self.words, _pack(self.codes[more]), _pack_counts(self.counts[more]), _pack(self.coarse), _pack_counts(alone)

    @classmethod
    def of_moving(cls, words: int, codes: bytes, counts: bytes, coarse: bytes, alone: bytes) -> Bucket:
        once = _unpack(coarse), _unpack_counts(alone)
        return cls(np.zeros(0, np.uint64), _unpack(codes), _unpack_counts(counts), once=once, words=words)

    def all_tables(self, leaf: bytes, parent: bytes, root: bytes) -> tuple[np.ndarray, ...]:
        """Tables drawn without the pairs seen once, now with them."""
        tables = np.ones(len(self.codes), np.int64)
        tables[self.counts > 1] = _unpack_counts(leaf)
        return tables, _unpack_counts(parent), _unpack_counts(root)

    @cached_property
    def seen(self) -> np.ndarray:
        return np.bincount(self.word, self.counts, self.words).astype(np.int64)

    def by_context(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, values, len(self.contexts)).astype(np.int64)

    def customers(self, tables) -> tuple[np.ndarray, np.ndarray]:
        """Customers in parents and root: the tables below."""
        return (
            self.alone + np.bincount(self.up, tables[0], len(self.coarse)).astype(np.int64),
            np.bincount(self.coarse_word, tables[1], self.words).astype(np.int64),
        )

    def totals(self) -> list[float]:
        t = self.tables
        parent, root = self.customers(t)
        once = self.alone.sum()
        served = [np.count_nonzero(c == k) for c in (self.counts, parent, root) for k in (1, 2)]
        served[0] += once
        return [float(v) for v in (
            *np.bincount(self.group, parent, _G), *np.bincount(self.group, t[1], _G),
            root.sum(), t[2].sum(), self.counts.sum() + once, self.words, *served,
        )]

    def shared(self, tables, totals: Totals) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each word in the root, and of each word in the parents that serve it."""
        parent, root = self.customers(tables)
        return shared(root, tables[2], parent, tables[1], self.coarse_word, self.group, totals)

    def sweep(self, totals: Totals, rng: np.random.Generator) -> None:
        """Draw all tables anew, from the leaves to the root."""
        d_leaf, d_parent, d_root = totals.discounts
        old, parent, root, by_context = self.tables
        p_root, p_parent = self.shared(self.tables, totals)
        others = np.maximum(by_context[self.at] - old, 0)
        leaf = sample_tables(self.counts, (CONCENTRATION + d_leaf * others) * p_parent[self.up], d_leaf, rng)
        below, _ = self.customers((leaf, parent, root))
        others = np.maximum(totals.parent_tables[self.group] - parent, 0)
        parent = sample_tables(below, (CONCENTRATION + d_parent * others) * p_root[self.coarse_word], d_parent, rng)
        _, below = self.customers((leaf, parent, root))
        others = np.maximum(totals.root_tables - root, 0)
        root = sample_tables(below, (CONCENTRATION + d_root * others) / (totals.words + 1), d_root, rng)
        self.tables = leaf, parent, root, by_context + self.by_context(leaf - old)

    def look_up(
        self, hashes: np.ndarray, word: np.ndarray, context: np.ndarray, samples: list[tuple], customers: list[tuple],
    ) -> Found:
        """What is known of words by their hashes, and of pairs of one of them (by its place) and a context.

        ``customers`` are those of the samples' tables.
        """
        at, known = _place(self.hashes, hashes)
        coarse = np.unique(word * _G + (context & _CLASS))
        of = coarse // _G
        pair, met = _place(self.codes, at[word] * _F + context)
        above, served = _place(self.coarse, at[of] * _G + coarse % _G)
        met, served = met & known[word], served & known[of]
        return Found(
            _pick(self.seen, at, known),
            [(_pick(c[1], at, known), _pick(t[2], at, known)) for t, c in zip(samples, customers, strict=True)],
            [(_pick(c[0], above, served), _pick(t[1], above, served)) for t, c in zip(samples, customers, strict=True)],
            _pick(self.counts, pair, met), [_pick(t[0], pair, met) for t in samples],
        )

    def predict(self, hashes: np.ndarray, context: np.ndarray, samples: list[tuple[tuple, Totals]]) -> tuple[np.ndarray, np.ndarray]:
        """Averaged probability of words in contexts, and their training counts."""
        context, word = context.astype(np.int64), np.arange(len(hashes))
        found = self.look_up(hashes, word, context, [t for t, _ in samples], [self.customers(t) for t, _ in samples])
        here, used = _place(self.contexts, context)
        of_context = [_pick(t[3], here, used) for t, _ in samples]
        return found.probability(word, context, word, _pick(self.leaf, here, used), of_context, [x for _, x in samples]), found.seen


@dataclass
class Found:
    """What training knows of some words in some contexts, 0 where it knows nothing.

    Training counts of the words, for each sample their customers and tables in
    the root and then in the parents (for each word and class that occur, in
    order), training counts of the pairs, and for each sample their tables.
    """

    seen: np.ndarray
    root: list[tuple[np.ndarray, np.ndarray]]
    parent: list[tuple[np.ndarray, np.ndarray]]
    counts: np.ndarray
    tables: list[np.ndarray]

    def packed(self) -> tuple[bytes, ...]:
        tables = [t[self.counts > 1] for t in self.tables]
        return tuple(_pack_counts(np.array(x)) for x in (self.seen, self.root, self.parent, self.counts, tables))

    @classmethod
    def of(cls, samples: int, seen: bytes, root: bytes, parent: bytes, counts: bytes, tables: bytes) -> Found:
        def pairs(packed: bytes) -> list[tuple[np.ndarray, np.ndarray]]:
            found = _unpack_counts(packed, 2 * samples)
            return list(zip(found[::2], found[1::2], strict=True))

        found = _unpack_counts(counts)
        every = [np.minimum(found, 1) for _ in range(samples)]
        for t, drawn in zip(every, _unpack_counts(tables, samples), strict=True):
            t[found > 1] = drawn
        return cls(_unpack_counts(seen), pairs(root), pairs(parent), found, every)

    def probability(
        self, word: np.ndarray, context: np.ndarray, at: np.ndarray, customers: np.ndarray, of_context: list[np.ndarray],
        totals: list[Totals],
    ) -> np.ndarray:
        """Of the pairs, averaged; ``at`` is the place of a pair's context in ``customers`` and tables ``of_context``."""
        coarse, up = np.unique(word * _G + (context & _CLASS), return_inverse=True)
        total = np.zeros(len(word))
        for root, parent, tables, above, x in zip(self.root, self.parent, self.tables, of_context, totals, strict=True):
            _, p = shared(*root, *parent, coarse // _G, coarse % _G, x)
            d_leaf = x.discounts[0]
            p = p[up] * ((CONCENTRATION + d_leaf * above) / (CONCENTRATION + customers))[at]
            p += np.maximum(self.counts - d_leaf * tables, 0) / (CONCENTRATION + customers)[at]
            total += p
        return total / max(1, len(totals))


def shared(
    root: np.ndarray, root_tables: np.ndarray, parent: np.ndarray, parent_tables: np.ndarray, word: np.ndarray, group: np.ndarray,
    totals: Totals,
) -> tuple[np.ndarray, np.ndarray]:
    """Probability of words in the root, and of words (by their place) in parents, from their customers and tables."""
    _, d_parent, d_root = totals.discounts
    unknown = root_share(totals) / (totals.words + 1)
    p_root = np.maximum(root - d_root * root_tables, 0) / (CONCENTRATION + totals.root) + unknown
    p_parent = p_root[word] * parent_share(totals)[group] + np.maximum(parent - d_parent * parent_tables, 0) / (
        CONCENTRATION + totals.parent[group]
    )
    return p_root, p_parent


def parent_share(totals: Totals) -> np.ndarray:
    """What each parent leaves to the root."""
    return (CONCENTRATION + totals.discounts[1] * totals.parent_tables) / (CONCENTRATION + totals.parent)


def root_share(totals: Totals) -> float:
    """What the root leaves to the uniform base."""
    return (CONCENTRATION + totals.discounts[2] * totals.root_tables) / (CONCENTRATION + totals.root)


class _Block:
    def __init__(self) -> None:
        self.numbers, self.ids, self.held, self.lengths, self.tokens, self.size = Numbers(), [], [], [], [], 0
        self.numbers[_END]

    def add(self, doc_id, held_out: bool, text: bytes) -> None:
        words = text.lower().split()
        words.append(_END)
        self.tokens.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.ids.append(doc_id)
        self.held.append(held_out)
        self.lengths.append(len(words))
        self.size += len(words)

    def text(self) -> tuple[bytes, ...]:
        """Lengths of texts, word number of each token, and the words' hashes and last characters' classes."""
        words = list(self.numbers)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        self.numbers.clear()
        return (
            _pack_counts(np.array(self.lengths)), _pack_counts(np.concatenate(self.tokens)), hashes.tobytes(),
            _last_classes(words).tobytes(),
        )


class _Pairs:
    """The distinct (word, context) pairs of a block, by bucket, hash and context; ``numbers`` has the pair of each token."""

    def __init__(self, lengths: bytes, tokens: bytes, hashes: bytes, classes: bytes, buckets: int) -> None:
        self.lengths, words = _unpack_counts(lengths), np.frombuffer(hashes, np.uint64)
        bucket = ((words >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((words, bucket))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.hashes, self.bucket = words[order], bucket[order]
        self.contexts, place = np.unique(np.append(_context(words, np.frombuffer(classes, np.uint8)), FIRST), return_inverse=True)
        self._number(_values(tokens, "<u4"), rank * len(self.contexts), place)

    def _number(self, tokens: np.ndarray, word_codes: np.ndarray, place: np.ndarray) -> None:
        """As ``np.unique`` with the inverse, with half its memory."""
        codes, first = word_codes[tokens], np.cumsum(self.lengths) - self.lengths
        codes[1:] += place.astype(np.int32)[tokens[:-1]]
        codes[first] = word_codes[tokens[first]] + place[-1]
        order = np.argsort(codes)
        codes = codes[order]
        new = np.diff(codes, prepend=-1) > 0
        self.numbers = np.empty(len(codes), np.int32)
        self.numbers[order] = np.cumsum(new, dtype=np.int32) - 1
        codes = codes[new]
        self.word, self.at = codes // len(self.contexts), codes % len(self.contexts)

    def parts(self) -> Iterator[tuple[int, slice, slice]]:
        """Buckets with the places of their words and of their pairs."""
        cut = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        ends = np.append(cut[1:], len(self.bucket))
        for a, b, c, d in zip(cut.tolist(), ends.tolist(), *np.searchsorted(self.word, [cut, ends]).tolist(), strict=True):
            yield int(self.bucket[a]), slice(a, b), slice(c, d)

    def rows(self, held: list[bool]) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """``(bucket, hashes, pairs, counts)``: a pair is its word's place there and its context, a count is of learnt tokens."""
        learnt = np.repeat(~np.array(held, bool), self.lengths)
        counts = np.bincount(self.numbers[learnt], minlength=len(self.word)).astype(np.uint32)
        del learnt
        for bucket, words, pairs in self.parts():
            codes = (self.word[pairs] - words.start) * _F + self.contexts[self.at[pairs]]
            yield bucket, self.hashes[words].tobytes(), _pack(codes), _pack_counts(counts[pairs])


_PAIRS = "hashes binary, pairs binary, counts binary"
_STATE = "bucket int, hashes binary, codes binary, counts binary, contexts binary, leaf binary, tables binary, kept array<binary>"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _blocks(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of blocks: one with the tokens (bucket -1) and one for each bucket with its pairs."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"block string, bucket int, {_PAIRS}, ids array<{kind}>, held array<boolean>, lengths binary, tokens binary, classes binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, block, id_kind = TaskContext.get().partitionId(), 0, _Block(), None

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal made, block
            name, ids, held, packed = f"{part}-{made}", block.ids, block.held, block.text()
            # The dictionary of words goes before the pairs come.
            made, block = made + 1, _Block()
            kinds = [pa.string(), pa.int32(), *[pa.binary()] * 3, pa.list_(id_kind), pa.list_(pa.bool_()), *[pa.binary()] * 3]
            lengths, tokens, hashes, classes = packed
            rows = [(name, -1, hashes, None, None, ids, held, lengths, tokens, classes)]
            for r in _Pairs(*packed, buckets).rows(held):
                rows.append((name, *r, *[None] * 5))
                if len(rows) == ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], _names(schema))
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], _names(schema))

        for batch in batches:
            id_kind = batch.column(0).type
            for i, h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                block.add(i, h, t)
                if block.size >= BLOCK_TOKENS:
                    yield from close()
        if block.ids:
            yield from close()

    return map_batches(docs, work, schema)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _own(key: int | str) -> int:
    """The place of a bucket, a shard (both numbers) or a block, named by its part of the input and its number there."""
    return key if isinstance(key, int) else sum(map(int, key.split("-")))


def _deal(blocks: DataFrame, parts: int) -> RDD:
    """Rows ``(key, (kind, ...))``: ``text`` of a block and ``pairs`` of a bucket."""

    def row(r) -> tuple:
        if r["bucket"] < 0:
            return r["block"], ("text", r["ids"], r["held"], *(bytes(r[c]) for c in ("lengths", "tokens", "hashes", "classes")))
        return r["bucket"], ("pairs", r["block"], *(bytes(r[c]) for c in _names(_PAIRS)))

    return blocks.rdd.map(row).partitionBy(parts, _own)


def _meet(work: Callable, kinds: set[str], *sources: RDD) -> RDD:
    """What ``work(key, rows by kind)`` gives for each key with rows of these kinds.

    Sources have been dealt alike, so a key's rows lie in the same partition of
    each and are read where they are. ``totals`` are added up by task.
    """

    def one(rows: Iterator[tuple]) -> Iterator[tuple]:
        found: dict = defaultdict(lambda: defaultdict(list))
        for key, (kind, *values) in rows:
            if kind in kinds:
                found[key][kind].append(values)
        totals = None
        for key in list(found):
            for to, row in work(key, found.pop(key)):
                if row[0] == "totals":
                    totals = row[1] if totals is None else totals + row[1]
                else:
                    yield to, row
        if totals is not None:
            yield 0, ("totals", totals)

    return sources[0].context.union(list(sources)).mapPartitions(one)


def _totals(dealt: RDD) -> list[float]:
    """The totals of all buckets: a fixed count of numbers."""
    rows = dealt.context.runJob(dealt, lambda rows: [r[1] for _, r in rows if r[0] == "totals"], [0])
    return sum(rows, np.zeros(2 * _G + 10)).tolist()


def _merge(pairs: list[list]) -> Bucket:
    """The training pairs of a bucket from all blocks."""
    words, contexts, counts = [], [], []
    for _, hashes, codes, count in pairs:
        codes, count = _unpack(codes), _unpack_counts(count)
        codes = codes[count > 0]
        words.append(np.frombuffer(hashes, np.uint64)[codes // _F])
        contexts.append(codes % _F)
        counts.append(count[count > 0])
    words, at = np.unique(np.concatenate(words), return_inverse=True)
    if len(words) > np.iinfo(np.int64).max // _F:
        raise ValueError("too many words in a bucket")
    codes, to = np.unique(at * _F + np.concatenate(contexts), return_inverse=True)
    return Bucket(words, codes, np.bincount(to, np.concatenate(counts), len(codes)).astype(np.int64))


def _by_shard(contexts: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """Shards, each a range of contexts, with the places of theirs among ascending ``contexts``."""
    shard = contexts // (_F // shards + 1)
    cut = np.flatnonzero(np.diff(shard, prepend=-1))
    for low, high in zip(cut.tolist(), [*cut.tolist()[1:], len(shard)]):
        yield int(shard[low]), slice(low, high)


def _in_order(parts: list[list], rows: int | None = None) -> np.ndarray:
    """The numbers that shards have sent, in the order of the contexts asked for."""
    found = [_unpack_counts(x, rows) for _, x in sorted(parts)]
    return np.concatenate([np.zeros(0 if rows is None else (rows, 0), np.int64), *found], axis=-1)


@dataclass
class Seating:
    """A trained model where it was dealt to: the tables of each sample kept, and the shards' customers by context."""

    samples: list[RDD]
    shards: RDD
    totals: list[Totals]

    def by_context(self, asked: RDD) -> RDD:
        """Customers of contexts, and their tables in each sample.

        Rows asked are ``(shard, ("asked", key, contexts))``; those given ``(key, ("told", shard, numbers))``.
        """
        kept = range(BURN_IN, BURN_IN + SAMPLES)

        def tell(shard: int, rows: dict) -> Iterator[tuple]:
            known, customers, once, movers = _contexts(rows)
            tables = [_added(once, movers, rows["drawn"], number) for number in kept]
            for key, contexts in rows["asked"]:
                at, there = _place(known, _unpack(contexts))
                yield key, ("told", shard, _pack_counts(np.array([_pick(x, at, there) for x in (customers, *tables)])))

        return _meet(tell, {"contexts", "drawn", "asked"}, self.shards, *self.samples, asked)


def _contexts(rows: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """Of a shard: contexts, their customers, how many of those are pairs seen once, and where each bucket's others are."""
    if not rows["contexts"]:
        return *[np.zeros(0, np.int64)] * 3, []
    contexts, customers, once, movers = rows["contexts"][0]
    return _unpack(contexts), _unpack_counts(customers), _unpack_counts(once), [(b, _unpack(at)) for b, at in movers]


def _added(once: np.ndarray, movers: list, drawn: list, number: int) -> np.ndarray:
    """Tables by context after a sweep, over all buckets."""
    values = {bucket: v for n, bucket, v in drawn if n == number}
    sums = once.copy()
    for bucket, at in movers:
        sums[at] += _unpack_counts(values[bucket])
    return sums


def _seat(dealt: RDD, shards: int, parts: int) -> Seating:
    """Sample the seating of dealt pairs. Each step reads the rows that stay from where they lie."""

    def begin(bucket: int, rows: dict) -> Iterator[tuple]:
        b = _merge(rows["pairs"])
        yield bucket, ("moving", *b.moving())
        one = b.counts == 1
        by_context = [b.leaf, b.by_context(one), b.by_context(~one)]
        for shard, at in _by_shard(b.contexts, shards):
            yield shard, ("first", bucket, _pack(b.contexts[at]), *(_pack_counts(v[at]) for v in by_context))
        yield None, ("totals", np.array(b.totals()))

    def index(shard: int, rows: dict) -> Iterator[tuple]:
        each = [(bucket, _unpack(c), *map(_unpack_counts, values)) for bucket, c, *values in rows["first"]]
        contexts, at = np.unique(np.concatenate([x[1] for x in each]), return_inverse=True)
        customers, once, tables = (
            np.bincount(at, np.concatenate([x[k] for x in each]), len(contexts)).astype(np.int64) for k in (2, 3, 4)
        )
        movers, begin = [], 0
        for bucket, c, _, _, more in each:
            place, begin = at[begin:begin + len(c)], begin + len(c)
            if more.any():
                movers.append((bucket, _pack(place[more > 0])))
                yield bucket, ("told", shard, _pack_counts((once + tables)[place[more > 0]]))
        yield shard, ("contexts", _pack(contexts), _pack_counts(customers), _pack_counts(once), movers)

    def sweep_of(number: int, totals: Totals) -> Callable:
        def sweep(bucket: int, rows: dict) -> Iterator[tuple]:
            b = Bucket.of_moving(*rows["moving"][0])
            for n, *tables in rows["tables"]:
                if n == number - 1:
                    b.tables = *map(_unpack_counts, tables), None
            b.tables = *b.tables[:3], _in_order(rows["told"])
            b.sweep(totals, np.random.default_rng([SEED, number, bucket]))
            yield bucket, ("tables", number, *map(_pack_counts, b.tables[:3]))
            drawn = b.by_context(b.tables[0])
            for shard, at in _by_shard(b.contexts, shards):
                yield shard, ("drawn", number, bucket, _pack_counts(drawn[at]))
            yield None, ("totals", np.array(b.totals()))

        return sweep

    def add_of(number: int) -> Callable:
        def add(shard: int, rows: dict) -> Iterator[tuple]:
            _, _, once, movers = _contexts(rows)
            sums = _added(once, movers, rows["drawn"], number)
            for bucket, at in movers:
                yield bucket, ("told", shard, _pack_counts(sums[at]))

        return add

    def deal(rows: RDD) -> RDD:
        return rows.partitionBy(parts, _own)

    start = deal(_meet(begin, {"pairs"}, dealt))
    index_of = told = deal(_meet(index, {"first"}, start))
    totals = Totals.of(_totals(start))
    seated, drawn = [], []
    for number in range(BURN_IN + SAMPLES):
        drawn.append(deal(_meet(sweep_of(number, totals), {"moving", "told", "tables"}, start, told, *drawn[-1:])))
        totals = Totals.of(_totals(drawn[-1]), totals.discounts)
        seated.append(totals)
        told = deal(_meet(add_of(number), {"contexts", "drawn"}, index_of, drawn[-1]))
    return Seating(drawn[BURN_IN:], index_of, seated[BURN_IN:])


def _drawn(b: Bucket, rows: dict) -> list[tuple[np.ndarray, ...]]:
    """The tables of each sample kept, in order."""
    return [b.all_tables(*tables) for _, *tables in sorted(rows["tables"])]


def _load(row) -> Bucket:
    b = Bucket(
        np.frombuffer(row["hashes"], np.uint64), _unpack(row["codes"]), _unpack_counts(row["counts"]), _unpack(row["contexts"]),
    )
    b.leaf = _unpack_counts(row["leaf"])
    b.tables = _tables(b, row["tables"])
    return b


def _tables(b: Bucket, packed: bytes) -> tuple[np.ndarray, ...]:
    return tuple(np.split(_unpack_counts(packed), np.cumsum([len(b.codes), len(b.coarse), b.words])))


def train(pairs: DataFrame, shards: int = MIN_BUCKETS) -> tuple[DataFrame, list[Totals]]:
    """The sampled state of every bucket as a table, and the totals of each sample kept.

    In the state each sample also has the tables of the bucket's contexts.
    """
    parts = min(shards, _partitions(pairs))
    dealt = _deal(pairs, parts)
    seating = _seat(dealt, shards, parts)

    def ask(bucket: int, rows: dict) -> Iterator[tuple]:
        contexts = _merge(rows["pairs"]).contexts
        for shard, at in _by_shard(contexts, shards):
            yield shard, ("asked", bucket, _pack(contexts[at]))

    def row(bucket: int, rows: dict) -> Iterator[tuple]:
        b = _merge(rows["pairs"])
        customers, *by_context = _in_order(rows["told"], 1 + SAMPLES)
        kept = [_pack_counts(np.concatenate([*t, c])) for t, c in zip(_drawn(b, rows), by_context, strict=True)]
        values = b.hashes.tobytes(), _pack(b.codes), _pack_counts(b.counts), _pack(b.contexts), _pack_counts(customers)
        yield bucket, ("state", *values, kept[-1], kept)

    asked = _meet(ask, {"pairs"}, dealt).partitionBy(parts, _own)
    told = seating.by_context(asked).partitionBy(parts, _own)
    rows = _meet(row, {"pairs", "tables", "told"}, dealt, *seating.samples, told)
    state = rows.map(lambda r: (r[0], *map(bytearray, r[1][1:-1]), list(map(bytearray, r[1][-1]))))
    return pairs.sparkSession.createDataFrame(state, _STATE, verifySchema=False), seating.totals


def score(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of every row of ``docs`` under a model of those that are not ``held_out`` (a Boolean column).

    ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``;
    scores are log10 probabilities of whole texts, tokens being lower-case words
    and one end. A null text is empty. Repeated rows each give a row and each
    count in training; other columns are ignored; an empty table gives no rows.
    Without training rows every word is the unknown one.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), F.col(text).alias("text"))
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(MIN_BUCKETS, math.ceil(size / BUCKET_BYTES))
    parts = min(buckets, max(_partitions(docs), math.ceil(size / BUCKET_BYTES)))
    dealt = _deal(_blocks(chosen, buckets), parts)
    seating = _seat(dealt, buckets, parts)
    totals = seating.totals
    tokens, words = totals[-1].tokens, totals[-1].words

    def answer(bucket: int, rows: dict) -> Iterator[tuple]:
        b = _merge(rows["pairs"])
        samples = _drawn(b, rows)
        customers = [b.customers(t) for t in samples]
        for block, hashes, pairs, _ in rows["pairs"]:
            codes = _unpack(pairs)
            found = b.look_up(np.frombuffer(hashes, np.uint64), codes // _F, codes % _F, samples, customers)
            yield block, ("answer", bucket, *found.packed())

    def ask(block: str, rows: dict) -> Iterator[tuple]:
        _, _, _, _, hashes, classes = rows["text"][0]
        contexts = np.unique(np.append(_context(np.frombuffer(hashes, np.uint64), np.frombuffer(classes, np.uint8)), FIRST))
        for shard, at in _by_shard(contexts, buckets):
            yield shard, ("asked", block, _pack(contexts[at]))

    def add_up(block: str, rows: dict) -> Iterator[tuple]:
        ids, held, *packed = rows["text"][0]
        pairs = _Pairs(*packed, buckets)
        customers, *of_context = _in_order(rows["told"], 1 + SAMPLES)
        found = {bucket: Found.of(SAMPLES, *values) for bucket, *values in rows["answer"]}
        log_p, seen = np.empty(len(pairs.word), np.float32), np.empty(len(pairs.word), np.int64)
        for bucket, w, p in pairs.parts():
            known, word, at = found.pop(bucket), pairs.word[p] - w.start, pairs.at[p]
            log_p[p] = np.log10(known.probability(word, pairs.contexts[at], at, customers, of_context, totals))
            seen[p] = known.seen[word]
        lengths, numbers = pairs.lengths, pairs.numbers
        begin = np.cumsum(lengths) - lengths
        base = np.add.reduceat(np.log10(seen + 1.0)[numbers], begin) - lengths * math.log10(tokens + words + 1)
        n_known = np.add.reduceat((seen > 0).astype(np.int64)[numbers], begin)
        whole = np.add.reduceat(log_p.astype(np.float64)[numbers], begin)
        for row in zip(ids, held, lengths.tolist(), n_known.tolist(), base.tolist(), whole.tolist(), strict=True):
            yield block, ("scored", *row)

    answers = _meet(answer, {"pairs", "tables"}, dealt, *seating.samples).partitionBy(parts, _own)
    asked = _meet(ask, {"text"}, dealt).partitionBy(parts, _own)
    told = seating.by_context(asked).partitionBy(parts, _own)
    scored = _meet(add_up, {"text", "answer", "told"}, dealt, answers, told)
    kind = dict(chosen.dtypes)["doc_id"]
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    rows = scored.map(lambda r: (*r[1][1:5], int(tokens), *r[1][5:]))
    return spark.createDataFrame(rows, schema, verifySchema=False)


def by_checksum(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``score`` with the rows held out whose id's checksum is 2 modulo 7; a row without id is held out."""
    return score(docs, F.coalesce(remainder(doc_id, 7) == 2, F.lit(True)), doc_id, text)


def perplexity(scores: DataFrame) -> DataFrame:
    """``(held_out, perplexity)`` of scored texts: per token, over all texts of either kind."""
    return scores.groupBy("held_out").agg(F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))
