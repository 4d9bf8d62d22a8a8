"""Language identification by interpolated Kneser-Ney character models in sorted arrays.

A model has, for each order up to four, the sorted keys of all n-grams that any
language has seen and their smoothed log-probability in every language. A key
packs the n-gram's characters, 16 bits each, so equal keys are equal n-grams. A
text gets the language of least cross-entropy per character; it is rejected
where even that is far above what texts of the language have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyfold.llm.common import map_batches

ORDER = 4
# Bound of the sample a model is fitted on: texts of each language, and characters of such a text.
SAMPLE_DOCS = 1_500
SAMPLE_CHARS = 50_000
# One in so many sample texts is not counted but calibrates the rejection.
CALIBRATE = 5
# Share of calibration texts that lie within the limit, and how far beyond it a text must be to be rejected.
QUANTILE = 0.999
MARGIN = 1.5
# Nats per character that any text may lie above its language's mean, however long it is.
LEEWAY = 0.7
# Divides log-likelihoods before they are compared as probabilities, since neighbouring n-grams are not independent.
TEMPERATURE = 4.0
UNKNOWN = "und"
# Where a language has no calibration, a text is rejected that costs as much as if more than this share of its
# characters were letters the language has never had, and the others came at its unigram entropy.
MOST_UNSEEN = 0.5
_SPACE, _ASTRAL = 32, 1
# Below single characters all keys are equally likely.
_KEYS = 65_536
_SLICE = 1 << 18


def _table() -> np.ndarray:
    """Code point to character key: letters in lower case, all others as a blank; beyond 16 bits one common letter."""
    keys = np.full(65_537, _SPACE, np.uint16)
    for c in range(65_536):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            low = chr(c).lower()
            keys[c] = ord(low) if len(low) == 1 and ord(low) < 65_536 else c
    keys[65_536] = _ASTRAL
    return keys


TABLE = _table()
_PAD = ORDER - 1


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character keys of all texts, each after ``ORDER - 1`` blanks, and where each text's own characters end.

    Runs of characters that are no letters count as one blank.
    """
    points = np.frombuffer("".join("\0" * _PAD + t for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    keys = TABLE[np.minimum(points, 65_536)]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + _PAD
    ends = np.cumsum(lengths)
    keep = keys != _SPACE
    keep[1:] |= keys[:-1] != _SPACE
    pads = (ends - lengths)[:, None] + np.arange(_PAD)
    keep[pads.ravel()] = True
    return keys[keep], np.cumsum(keep)[ends - 1]


def grams(keys: np.ndarray, start: int, end: int) -> np.ndarray:
    """The n-grams that end at the places start to end; start is at least ``ORDER - 1``."""
    out = keys[start - _PAD:end - _PAD].astype(np.uint64)
    for k in range(_PAD - 1, -1, -1):
        out = (out << np.uint64(16)) | keys[start - k:end - k]
    return out


def _suffix(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & np.uint64((1 << 16 * order) - 1)


def _find(where: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(where):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(where, keys), len(where) - 1)
    return at, where[at] == keys


def _unigram_entropy(keys: np.ndarray, counts: np.ndarray) -> float:
    """Nats per character of n-grams' last characters, with Miller and Madow's correction for few of them."""
    _, at = np.unique(_suffix(keys, 1), return_inverse=True)
    n = np.bincount(at, counts)
    if not len(n):
        return float(np.log(_KEYS))
    share = n / n.sum()
    return float(-(share * np.log(share)).sum() + (len(n) - 1) / (2 * n.sum()))


class _Language:
    """Kneser-Ney probabilities of one language, by order."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.p, self.context, self.back = {}, {}, {}, {}
        self.entropy = _unigram_entropy(keys, counts)
        found = {ORDER: (keys, counts)}
        for n in range(ORDER - 1, 0, -1):
            # Below the highest order an n-gram counts once for each character seen before it.
            found[n] = np.unique(_suffix(found[n + 1][0], n), return_counts=True)
        for n in range(1, ORDER + 1):
            keys, counts = found[n]
            ones, twos = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
            discount = min(0.95, max(0.1, ones / (ones + 2 * twos))) if ones else 0.5
            context, at = np.unique(keys >> np.uint64(16), return_inverse=True)
            total = np.bincount(at, counts)
            back = discount * np.bincount(at) / total
            self.keys[n], self.context[n], self.back[n] = keys, context, back
            lower = self.prob(n - 1, _suffix(keys, n - 1))
            self.p[n] = (counts - discount) / total[at] + back[at] * lower

    def prob(self, n: int, keys: np.ndarray) -> np.ndarray:
        if n == 0:
            return np.full(len(keys), 1 / _KEYS)
        at, known = _find(self.keys[n], keys)
        out = np.empty(len(keys))
        out[known] = self.p[n][at[known]]
        rest = keys[~known]
        if len(rest):
            out[~known] = self.weight(n, rest >> np.uint64(16)) * self.prob(n - 1, _suffix(rest, n - 1))
        return out

    def weight(self, n: int, context: np.ndarray) -> np.ndarray:
        """What an n-gram that was not seen after ``context`` keeps of its shorter one's probability."""
        at, known = _find(self.context[n], context)
        return np.where(known, self.back[n][at], 1.0)


@dataclass
class Model:
    languages: list[str]
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    log_p: dict[int, np.ndarray] = field(default_factory=dict)
    context: dict[int, np.ndarray] = field(default_factory=dict)
    log_back: dict[int, np.ndarray] = field(default_factory=dict)
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    uncalibrated: np.ndarray | None = None

    @classmethod
    def fit(cls, counted: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
        """Model of languages given as sorted n-gram keys with counts."""
        names = sorted(counted)
        parts = [_Language(*counted[x]) for x in names]
        model = cls(names)
        for n in range(1, ORDER + 1) if parts else ():
            model.keys[n] = np.unique(np.concatenate([p.keys[n] for p in parts]))
            model.context[n] = np.unique(np.concatenate([p.context[n] for p in parts]))
            model.log_p[n] = np.log(np.stack([p.prob(n, model.keys[n]) for p in parts], axis=1)).astype(np.float32)
            model.log_back[n] = np.log(np.stack([p.weight(n, model.context[n]) for p in parts], axis=1)).astype(np.float32)
        if parts:
            model.mean, model.spread = np.zeros(len(parts)), np.full(len(parts), np.inf)
            own = np.array([min(p.entropy, np.log(_KEYS)) for p in parts])
            model.uncalibrated = own + MOST_UNSEEN * (np.log(_KEYS) - own)
        return model

    def log_probs(self, keys: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Log-probability of each n-gram's last character after the others, a column for each language."""
        if n == 0:
            return np.full((len(keys), len(self.languages)), -np.log(_KEYS), np.float32)
        at, known = _find(self.keys[n], keys)
        out = self.log_p[n][at]
        missing = np.flatnonzero(~known)
        if len(missing):
            rest = keys[missing]
            at, seen = _find(self.context[n], rest >> np.uint64(16))
            out[missing] = np.where(seen[:, None], self.log_back[n][at], 0) + self.log_probs(_suffix(rest, n - 1), n - 1)
        return out

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihoods of texts by language, and how many characters were scored."""
        keys, ends = characters(texts)
        starts = np.concatenate(([0], ends[:-1])) + _PAD
        sums = np.zeros((len(texts), len(self.languages)))
        first = 0
        for low in range(_PAD, len(keys), _SLICE):
            high = min(len(keys), low + _SLICE)
            added = np.cumsum(self.log_probs(grams(keys, low, high)), axis=0, dtype=np.float64)
            added = np.concatenate([np.zeros((1, added.shape[1])), added])
            while first < len(texts) and ends[first] <= low:
                first += 1
            last = int(np.searchsorted(starts, high))
            which = slice(first, last)
            a, b = np.clip(starts[which], low, high) - low, np.clip(ends[which], low, high) - low
            sums[which] += added[b] - added[np.minimum(a, b)]
        return sums, ends - starts

    def calibrate(self, rows: list[tuple[str, str]]) -> None:
        """Take mean cross-entropy and its spread by length from ``(language, text)`` rows that were not counted."""
        if not rows or not self.languages:
            return
        sums, n = self.totals([t for _, t in rows])
        place = {x: i for i, x in enumerate(self.languages)}
        own = np.array([place.get(x, -1) for x, _ in rows])
        for k in range(len(self.languages)):
            mine = (own == k) & (n > 0)
            if np.count_nonzero(mine) < 20:
                continue
            entropy = -sums[mine, k] / n[mine]
            self.mean[k] = np.average(entropy, weights=n[mine])
            # A text's mean varies with one over the root of its length.
            self.spread[k] = max(0.1, np.quantile((entropy - self.mean[k]) * np.sqrt(n[mine]), QUANTILE))

    def predict(self, texts: list[str]) -> list[tuple[str, float, float | None, bool]]:
        """Language, probability, cross-entropy in nats per character and rejection of each text."""
        if not self.languages or not texts:
            return [(UNKNOWN, 0.0, None, True) for _ in texts]
        sums, n = self.totals(texts)
        best = sums.argmax(axis=1)
        weights = np.exp((sums - sums.max(axis=1, keepdims=True)) / TEMPERATURE)
        score = 1 / weights.sum(axis=1)
        entropy = -sums.max(axis=1) / np.maximum(n, 1)
        limit = self.mean[best] + MARGIN * np.maximum(self.spread[best] / np.sqrt(np.maximum(n, 1)), LEEWAY)
        limit = np.where(np.isfinite(self.spread[best]), limit, self.uncalibrated[best])
        return [
            (self.languages[b], float(s), float(e), bool(e > x))
            for b, s, e, x in zip(best.tolist(), score, entropy, limit, strict=True)
        ]


def remainder(doc_id: str, of: int) -> Column:
    """CRC-32 of the id as text, modulo ``of``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(of))


def train(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from ``labelled`` rows with text and language.

    About ``SAMPLE_DOCS`` texts of each language are taken by hash, from rows of
    at most ``SAMPLE_CHARS`` characters, or the beginnings of longer ones where
    a language has no other; twice that number is a hard bound. A language whose
    sample would all go to calibration is counted from it instead. Only n-gram
    counts and the calibration texts come to the driver.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    short = F.length(text) <= SAMPLE_CHARS
    wanted = rows.groupBy(F.col(lang).alias("lang")).agg(F.count_if(short).alias("short"), F.count("*").alias("all")).select(
        "lang", (F.col("short") == 0).alias("cut"),
        (SAMPLE_DOCS / F.when(F.col("short") > 0, F.col("short")).otherwise(F.col("all"))).alias("share"),
    )
    mark = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(1 << 30))
    taken = (
        rows.select(F.col(lang).alias("lang"), F.substring(text, 1, SAMPLE_CHARS).alias("text"), mark.alias("mark"), short.alias("short"))
        # One row for each language, of which the model keeps a column: few enough to broadcast.
        .join(F.broadcast(wanted), "lang").where((F.col("short") | F.col("cut")) & (F.col("mark") < F.col("share") * (1 << 30)))
        .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("mark", "text")))
        .where(F.col("n") <= 2 * SAMPLE_DOCS).drop("share", "n", "short", "cut")
        .withColumn("some", F.max(F.col("mark") % CALIBRATE != 0).over(Window.partitionBy("lang")))
        .withColumn("counted", (F.col("mark") % CALIBRATE != 0) | ~F.col("some")).drop("some")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = np.array(batch.column(1).to_pylist(), object)
            for x in sorted(set(langs)):
                keys, ends = characters(list(texts[langs == x]))
                own = np.ones(len(keys), bool)
                starts = np.concatenate(([0], ends[:-1]))
                own[(starts[:, None] + np.arange(_PAD)).ravel()] = False
                found, n = np.unique(grams(keys, _PAD, len(keys))[own[_PAD:]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n)], ["lang", "gram", "n"]
                )

    taken = taken.persist()
    counted = (
        map_batches(taken.where("counted"), count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    )
    held = taken.where("not counted").select("lang", "text").orderBy("lang", "mark").toPandas()
    taken.unpersist()
    tables = {}
    for name, part in counted.groupby("lang"):
        keys = part["gram"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        tables[name] = keys[order], part["n"].to_numpy(np.int64)[order]
    model = Model.fit(tables)
    model.calibrate(list(held.itertuples(index=False, name=None)))
    return model


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, entropy, rejected)`` for every row of ``docs``, in one pass over whole texts.

    A null text, or one without a letter, is ``und`` with score 0 and rejected;
    so is every text under a model without languages. Equal scores go to the
    language first by name. Repeated rows each give a row; other columns are ignored.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judged(batch.column(1).to_pylist(), model)
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in found], k) for i, k in enumerate(kinds))],
                ["doc_id", "lang_pred", "score", "entropy", "rejected"],
            )

    return map_batches(
        chosen, work, f"doc_id {dict(chosen.dtypes)['doc_id']}, lang_pred string, score double, entropy double, rejected boolean"
    )


def judged(texts: list[str | None], model: Model) -> list[tuple[str, float, float | None, bool]]:
    """``predict`` for texts that may be null or without letters."""
    spoken = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    found = dict(zip(spoken, model.predict([texts[i] for i in spoken]), strict=True))
    return [found.get(i, (UNKNOWN, 0.0, None, True)) for i in range(len(texts))]


def held_out(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Predictions for all ``docs`` of a model that learns from those whose id's checksum is not 2 modulo 4.

    A row without id is counted as held out.
    """
    out = F.coalesce(remainder(doc_id, 4) == 2, F.lit(True))
    model = train(docs.where(~out), doc_id, text, lang)
    found = identify(docs, model, doc_id, text)
    return found.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(True)).alias("held_out"), "lang_pred", "score", "rejected")


def spoken(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, by a model of their own labels."""
    model = train(docs, doc_id, text, lang)
    columns = docs.columns
    at = columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [not r[3] for r in judged(batch.column(at).to_pylist(), model)]
            yield pa.RecordBatch.from_arrays(list(batch.columns), columns).filter(pa.array(kept, pa.bool_()))

    return map_batches(docs, work, docs.schema)
