"""Toxicity by compression distance: a zstandard dictionary of toxic text, one of ordinary text.

Labelled rows that may be learnt from are split by a hash of their id into a
dictionary part and a calibration part. On the dictionary part Spark counts
in how many documents of each class every word and every beginning of a word
occurs; each dictionary is raw zstandard content: the pieces significantly
more frequent in its own class, then the words most documents share. Trained on whole texts, both
dictionaries would be made of what the classes share, and their difference
would be noise. Every document is cut into windows of ``WINDOW_WORDS``
words; each window is compressed with both dictionaries in Arrow batches,
and the bytes the toxic one saves speak for toxicity. A logistic law of the
label on four features of those savings is fitted on the calibration part
(at most ``CALIBRATION_ROWS`` rows, by hash); its probability is the score,
and the contract's threshold 0.3 predicts. Documents are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.llm.common import map_batches, prepare, settle
from tallyfold.session import join_small

# Bytes of a dictionary at most.
DICT_BYTES = 16 << 10
# Every place of a dictionary is searched (the fast strategies of low levels index only some, and so miss words).
STRATEGY = zstandard.STRATEGY_LAZY2
MIN_MATCH = 4
# Words count with their beginnings of these lengths, so that a stem counts whatever its endings.
STEMS = (4, 5, 6, 7)
# A piece belongs to a class's dictionary if it is at least ``LIFT`` times as frequent in its class as in the other, and
# its G^2 is beyond what any of so many pieces reaches by chance with ``CHANCE``. Only pieces are tested that are in at
# least ``MIN_SPREAD`` of 64 groups of documents, by the smallest hash of three words in a row: near copies mostly fall
# into one group, so the words of one text that was copied often are no evidence.
MIN_SPREAD = 8
LIFT = 2.0
CHANCE = 0.05
# Bytes of the shared words at the end of each dictionary.
SHARED_BYTES = 4 << 10
# Words of one window, and the saving in bytes that marks a window.
WINDOW_WORDS = 16
MARKED = 3
FEATURES = ("f_max", "f_mean", "f_marked", "f_count")
# Labelled rows at most that fit the calibration.
CALIBRATION_ROWS = 200_000
# Fixed value of the contract: a score of at least this is predicted toxic.
THRESHOLD = 0.3

_BITS = [1 << k if k < 63 else -(1 << 63) for k in range(64)]
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def windows(text: str | None) -> list[bytes]:
    """Windows of ``WINDOW_WORDS`` words, space-joined, UTF-8; none for an empty or null text."""
    words = _WORD.findall((text or "").lower())
    return [" ".join(words[i : i + WINDOW_WORDS]).encode() for i in range(0, len(words), WINDOW_WORDS)]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        strategy=STRATEGY, min_match=MIN_MATCH, window_log=16, hash_log=15, chain_log=15, search_log=6, target_length=32,
        write_checksum=False, write_content_size=False, write_dict_id=False,
    )
    return zstandard.ZstdCompressor(
        compression_params=params, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    )


class Model:
    """Two dictionaries and a logistic calibration of the features."""

    def __init__(self, toxic: bytes, ordinary: bytes, weights: np.ndarray | None = None):
        self.toxic, self.ordinary = toxic, ordinary
        self.weights = np.zeros(len(FEATURES) + 1) if weights is None else weights

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Per text: largest and mean saving of the toxic dictionary over its windows, share and log count of marked windows.

        A text without windows has all four zero.
        """
        tox, ordi = _compressor(self.toxic), _compressor(self.ordinary)
        out = np.zeros((len(texts), len(FEATURES)))
        for i, text in enumerate(texts):
            parts = windows(text)
            if not parts:
                continue
            saving = np.array([len(ordi.compress(p)) - len(tox.compress(p)) for p in parts], dtype=np.float64)
            marked = (saving >= MARKED).sum()
            out[i] = saving.max(), saving.mean(), marked / len(parts), np.log1p(marked)
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(features @ self.weights[:-1] + self.weights[-1])))


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> np.ndarray:
    """Weights and bias of a logistic law by Newton steps, with a small ridge so that separable data stay finite."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a @ w)))
        grad = a.T @ (p - y) + ridge * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    return w


def _features_of(model: Model, rows: DataFrame) -> DataFrame:
    """``(key, label, h, f_*)`` for ``(key, text, label, h)`` rows, in Arrow batches; the text is not kept."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = model.features(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict(
                {"key": batch.column(0), "label": batch.column(2), "h": batch.column(3)}
                | {k: f[:, i] for i, k in enumerate(FEATURES)}
            )

    key_type = dict(rows.dtypes)[rows.columns[0]]
    return map_batches(
        rows, work, f"key {key_type}, label int, h long, " + ", ".join(f"{k} double" for k in FEATURES)
    )


def _beginnings(words: str, length: int) -> Column:
    return F.transform(F.filter(words, lambda x: F.length(x) > length), lambda x: F.substring(x, 1, length))


def _vocabulary(rows: DataFrame) -> tuple[list[str], dict[int, list[str]]]:
    """Shared words (most documents first, none of a class) and, per label, pieces significantly more frequent in it (G^2, by strength).

    A piece is a word and the space after it, or a longer word's beginning. Document frequencies are counted
    by Spark over all given rows, with a map-side part; only the top pieces
    within ``DICT_BYTES`` reach the driver.
    """
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[^\x20\x09-\x0D]+"), 0)
    triples = F.transform("w", lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)))
    group = F.pmod(F.coalesce(F.array_min(triples), F.lit(0)), F.lit(64))
    # The group is computed before the pieces are, once for a document.
    held = rows.select("label", words.alias("w")).select(
        "label", F.array_distinct("w").alias("w"), F.element_at(F.lit(_BITS), (group + 1).cast("int")).alias("g")
    ).select("label", "g", F.explode(F.array_distinct(F.concat(
        F.transform("w", lambda x: F.concat(x, F.lit(" "))), *(_beginnings("w", n) for n in STEMS)))).alias("piece"))
    docs = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = docs.get(1, 0), docs.get(0, 0)
    # Counted once and settled: the selections below read the counts four times.
    counts = settle(held.groupBy("piece").agg(
        F.sum((F.col("label") == 1).cast("long")).alias("a"), F.sum((F.col("label") == 0).cast("long")).alias("c"),
        F.bit_count(F.bit_or(F.when(F.col("label") == 1, F.col("g")).otherwise(0))).alias("a_spread"),
        F.bit_count(F.bit_or(F.when(F.col("label") == 0, F.col("g")).otherwise(0))).alias("c_spread"),
    ))
    total = n1 + n0
    tested = counts.where(F.greatest("a_spread", "c_spread") >= MIN_SPREAD)
    # The tail of G^2 beyond t is below exp(-t / 2).
    least = 2 * np.log(max(1, tested.count()) / CHANCE)
    out: dict[int, list[str]] = {}
    for label, (x, y, nx, ny) in {1: ("a", "c", n1, n0), 0: ("c", "a", n0, n1)}.items():
        if not nx or not ny:
            out[label] = []
            continue
        cells = []
        for o, row, col in ((F.col(x), nx, F.col(x) + F.col(y)), (nx - F.col(x), nx, total - F.col(x) - F.col(y)),
                            (F.col(y), ny, F.col(x) + F.col(y)), (ny - F.col(y), ny, total - F.col(x) - F.col(y))):
            cells.append(F.when(o > 0, 2 * o * F.log(o * total / (row * col))).otherwise(0.0))
        g2 = sum(cells[1:], cells[0])
        strong = tested.where((F.col(f"{x}_spread") >= MIN_SPREAD) & (F.col(x) / nx >= LIFT * F.col(y) / ny) & (g2 > least)).orderBy(
            F.desc(g2), F.desc(F.length("piece")), "piece"
        )
        out[label] = [r["piece"] for r in strong.select("piece").limit(DICT_BYTES // 2).collect()]
    # Shared words are those most documents hold, leaving out those that a piece of either class begins.
    own = set(out[0]) | set(out[1])
    top = counts.where(F.col("piece").endswith(" ")).orderBy(F.desc(F.col("a") + F.col("c")), "piece").limit(SHARED_BYTES + len(own))
    shared = [w for w in (r["piece"] for r in top.select("piece").collect()) if own.isdisjoint([w, *(w[:n] for n in STEMS)])]
    return shared, out


def _content(pieces: list[str], limit: int) -> bytes:
    """The first pieces that fit, each after a space; one that begins an earlier piece is there already."""
    out, used, begun = [], 0, set()
    for w in pieces:
        if w in begun:
            continue
        b = w.strip(" ").encode()
        if used + len(b) + 1 > limit:
            break
        out.append(b)
        used += len(b) + 1
        begun.update(w[:n] for n in STEMS)
    return b" ".join(out)


def train(docs: DataFrame, labels: DataFrame, learn: F.Column, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Dictionaries and calibration from the labelled rows for which ``learn`` (over ``docs``' columns) holds.

    A row's label is the largest ``toxic`` given for its id (null labels are
    ignored); rows with null text count as empty. Each dictionary is raw
    content: the words and word beginnings significantly more frequent in its
    class, then the words most documents share, counted on the rows whose id hash is even.
    The calibration is fitted on the others. With one class only, the score
    is a constant near that class.
    """
    prepare(docs.sparkSession)
    marks = labels.where(F.col("toxic").isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("label")
    ).select("_id", "label", F.pmod(F.xxhash64("_id"), F.lit(1 << 30)).alias("h"))
    # Texts are not shuffled or written: the labels are measured and broadcast where small.
    rows = join_small(docs.where(learn).select(F.col(doc_id).alias("_id"), F.col(text).alias("text")), marks, "_id", "inner")
    shared, own = _vocabulary(rows.where(F.col("h") % 2 == 0))
    base = _content(shared, SHARED_BYTES)
    # Class words go first: the shared words keep the same distance from the end, so a window without class
    # words is compressed alike by both dictionaries.
    # Both dictionaries have one size, since zstandard picks its parameters by it; NUL bytes pad the shorter class part.
    parts = {label: _content(own[label], DICT_BYTES - len(base) - 1) for label in (1, 0)}
    width = max(len(p) for p in parts.values())
    model = Model(*(parts[label].ljust(width, b"\0") + b" " + base for label in (1, 0)))
    # Features of every calibration row where it lies; only the small feature rows are sampled by hash.
    calib = rows.where(F.col("h") % 2 == 1).select(F.col("_id").alias("key"), "text", "label", "h")
    feats = _features_of(model, calib).orderBy("h", "key").limit(CALIBRATION_ROWS).collect()
    if feats and len({r["label"] for r in feats}) == 2:
        x = np.array([[r[f] for f in FEATURES] for r in feats])
        y = np.array([r["label"] for r in feats], dtype=np.float64)
        model.weights = fit_logistic(x, y)
    elif feats:
        model.weights = np.array([0.0] * len(FEATURES) + [8.0 if feats[0]["label"] else -8.0])
    return model


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score, predicted, f_*)`` for every row; a null or empty text has no windows and scores as such."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = model.features(batch.column(1).to_pylist())
            p = model.score(f)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "score": p, "predicted": (p >= THRESHOLD).astype(np.int32),
            } | {k: f[:, i] for i, k in enumerate(FEATURES)})

    return map_batches(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), work,
        "doc_id long, score double, predicted int, " + ", ".join(f"{k} double" for k in FEATURES),
    )
