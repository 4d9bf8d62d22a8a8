"""SimHash near-duplicates, found exactly through a distributed vantage-point tree.

A bounded sample of fingerprints gives the upper tree, whose leaves are the
shards. Every distinct fingerprint goes to one home shard; near a border it
also visits the shards in which the triangle inequality allows a partner. A
shard goes on with its own vantage points and compares what is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import map_batches, settle, utf8
from tallyfold.llm.components import components
from tallyfold.session import join_small

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Fingerprints the upper tree is built from, at most (8 bytes each, on the driver).
SAMPLE = 65_536
# Fingerprints a shard should be home to, and the shards there may be.
SHARD = 65_536
MAX_SHARDS = 2_048
# A shard's own tree ends at this many fingerprints.
LEAF = 1_024
# Pairs compared at once in a leaf.
_CELLS = 1 << 21
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash over hashed word shingles of UTF-8 text; 0 for a text without words."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > words:
        starts, ends = starts[: 1 - words] if words > 1 else starts, ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    n = len(starts)
    pieces = map(joined.__getitem__, map(slice, starts.tolist(), ends.tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), "<u8", n)
    octets = hashes.view(np.uint8).reshape(n, 8)
    out = 0
    for k in range(8):
        set_bits = np.bincount(octets[:, k], minlength=256) @ _BITS
        out |= int(np.packbits(2 * set_bits > n, bitorder="little")[0]) << (8 * k)
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)`` for every row; fp holds the 64 bits as a signed number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, words) for t in utf8(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(chosen, work, f"doc_id {dict(chosen.dtypes)['doc_id']}, fp long")


def _split(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point among ``points`` and the distance that halves them best, or None if nothing does."""
    best = None
    for v in points[np.linspace(0, len(points) - 1, 5).astype(int)]:
        d = np.bitwise_count(points ^ v)
        for mu in {int(np.median(d)), max(0, int(np.median(d)) - 1)}:
            near = int(np.count_nonzero(d <= mu))
            edge = int(np.count_nonzero((d > mu - MAX_BITS) & (d <= mu)))
            if 0 < near < len(points):
                cost = abs(2 * near - len(points)) + edge
                if best is None or cost < best[0]:
                    best = cost, v, mu
    return best and best[1:]


def build(sample: np.ndarray, leaf: int) -> list[tuple]:
    """Nodes ``(vantage, mu, near, far)`` or ``(None, shard, 0, 0)``, the first being the top."""
    nodes: list[tuple] = [()]
    todo, shards = [(0, sample)], 0
    while todo:
        at, points = todo.pop()
        cut = _split(points) if len(points) > leaf else None
        if cut is None:
            nodes[at] = (None, shards, 0, 0)
            shards += 1
            continue
        v, mu = cut
        near = np.bitwise_count(points ^ v) <= mu
        nodes[at] = (int(v), mu, len(nodes), len(nodes) + 1)
        todo += [(len(nodes), points[near]), (len(nodes) + 1, points[~near])]
        nodes += [(), ()]
    return nodes


def _branches(d: np.ndarray, home: np.ndarray, mu: int, bits: int):
    """Who goes to the near and to the far side, and who of them is at home there.

    A pair divided here is found by its near one visiting the far side, so only
    visitors may go both ways.
    """
    near = np.where(home, d <= mu, d.astype(np.int64) <= mu + bits)
    far = d.astype(np.int64) > mu - bits
    return near, far, home & (d <= mu), home & (d > mu)


def route(nodes: list[tuple], points: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(shard, points, home)`` for all shards the points have to go to."""
    todo = [(0, points, np.ones(len(points), bool))]
    while todo:
        at, some, home = todo.pop()
        if not len(some):
            continue
        v, mu, a, b = nodes[at]
        if v is None:
            yield mu, some, home
            continue
        d = np.bitwise_count(some ^ np.uint64(v))
        near, far, home_near, home_far = _branches(d, home, mu, bits)
        todo += [(a, some[near], home_near[near]), (b, some[far], home_far[far])]


def _roots(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``labels`` after joining the sets of a and b; a label is the smallest index of its set."""
    while True:
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return labels
        pairs = np.unique(np.stack([np.maximum(la, lb)[differ], np.minimum(la, lb)[differ]]), axis=1)
        np.minimum.at(labels, pairs[0], pairs[1])
        while not np.array_equal(up := labels[labels], labels):
            labels = up
        a, b = a[differ], b[differ]


def link(points: np.ndarray, home: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of links among the points of a shard: each linked point with the smallest of its set there."""
    out_a, out_b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    todo = [(points, home)]
    while todo:
        some, own = todo.pop()
        cut = _split(some[own]) if np.count_nonzero(own) > LEAF else None
        if cut:
            v, mu = cut
            d = np.bitwise_count(some ^ v)
            near, far, home_near, home_far = _branches(d, own, mu, bits)
            if max(np.count_nonzero(near), np.count_nonzero(far)) < len(some):
                todo += [(some[near], home_near[near]), (some[far], home_far[far])]
                continue
        order = np.argsort(some)
        some, own = some[order], own[order]
        at, labels = np.flatnonzero(own), np.arange(len(some))
        step = max(1, _CELLS // max(1, len(some)))
        for k in range(0, len(at), step):
            rows = at[k:k + step]
            i, j = np.nonzero(np.bitwise_count(some[rows, None] ^ some[None, :]) <= bits)
            labels = _roots(labels, rows[i], j)
        linked = np.flatnonzero(labels != np.arange(len(some)))
        out_a.append(some[labels[linked]])
        out_b.append(some[linked])
    return np.concatenate(out_a), np.concatenate(out_b)


def near_links(fps: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)`` links that connect all of the distinct fingerprints ``fp`` within ``bits`` of each other.

    Exact: two fingerprints are connected through the result if and only if a
    chain of steps of at most ``bits`` joins them. Pairs within a dense group
    are not listed; each member is linked to one of its shard's part.
    """
    n = fps.count()
    share = min(1.0, 1.2 * SAMPLE / max(n, 1))
    # The hash order makes the sample the same for any partitioning.
    sample = fps.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(SAMPLE).toPandas()
    points = np.sort(sample["fp"].to_numpy(np.int64)).view(np.uint64)
    shards = min(MAX_SHARDS, max(1, n // SHARD))
    nodes = build(points, max(8, len(points) // shards))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for shard, got, home in route(nodes, some, bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(got), shard, np.int32)), pa.array(got.view(np.int64)), pa.array(home)],
                    ["shard", "fp", "home"],
                )

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = link(pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["home"].to_numpy(bool), bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    # Wider batches than for texts: a row is one number.
    fps.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100000")
    return fps.select("fp").mapInArrow(spread, "shard int, fp long, home boolean").groupBy("shard").applyInPandas(
        search, "a long, b long"
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, bits: int = MAX_BITS
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    component_id is the smallest id of all documents reachable over links of at
    most ``bits`` differing bits. Null and empty texts have fingerprint zero and
    are linked like any other. Repeated rows each give a row; a null id is
    never a component id unless the whole component has none. Other columns are
    ignored; an empty table gives an empty result.

    Equal fingerprints are merged first, with a map-side part, so a group of
    copies counts once in the search.
    """
    found = settle(fingerprints(docs, doc_id, text, words))
    return found.join(_component_of(found, bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _component_of(found: DataFrame, bits: int) -> DataFrame:
    """``(fp, component_id)``: the smallest ``doc_id`` of each fingerprint's component (ids may be structs)."""
    reps = settle(found.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    roots = components(settle(near_links(reps.select("fp"), bits)))
    linked = roots.select(F.col("node").alias("fp"), "root").unionByName(
        roots.select(F.col("root").alias("fp"), "root").distinct()
    )
    smallest = linked.join(reps, "fp").groupBy("root").agg(F.min("rep").alias("component"))
    return reps.join(linked.join(smallest, "root"), "fp", "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest id, null ids last, then the first row written.

    Every row has its own key, so repeated rows and rows of one id with
    other texts are told apart: of a group of equal rows one stays, and an id
    whose two texts fall in two groups can stay in each.
    """
    rows = settle(docs.withColumn("_row", F.monotonically_increasing_id()))
    order = F.struct(F.col(doc_id).isNull().alias("null_id"), F.col(doc_id).alias("id"), F.col("_row").alias("row"))
    found = settle(fingerprints(rows.select(order.alias("key"), F.col(text)), "key", text))
    kept = found.join(_component_of(found, bits), "fp").where(F.col("doc_id") == F.col("component_id"))
    return join_small(rows, kept.select(F.col("doc_id.row").alias("_kept")), F.col("_row") == F.col("_kept"), "left_semi").drop("_row")
