"""Benchmark decontamination through a positional inverted index of the training text.

The index is divided by document: a row holds a block of some documents with
its sorted terms and, for each term, the sorted positions at which it occurs.
Benchmark windows are put to every block in bounded portions; within a block
the lists of a window are intersected from its rarest term on, each moved by
the term's offset in the window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import map_batches, new_folder, settle, utf8
from tallyfold.session import join_small

WINDOW = 10
# How far a term may be from its place in a proximity match.
SLOP = 3
# Tokens after which a block is closed; a document is never divided.
BLOCK_TOKENS = 1_000_000
# Free positions between documents, so that no match crosses a border.
GAP = 64
# Windows put to the blocks in one portion: 8 bytes for each word, a few megabytes in all.
PORTION = 50_000

# All bytes that are no part of a word become blanks, and A-Z becomes a-z.
_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

_INDEX = (
    "block string, doc_ids array<{id}>, starts binary, lengths binary, term_hashes binary, term_ends binary, "
    "terms binary, list_ends binary, positions binary"
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class _Block:
    """Documents whose tokens are gathered until the block is full."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.docs: list = []
        self.lengths: list[int] = []
        self.tokens: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id, words: list[bytes]) -> None:
        ids = self.ids
        # A new word gets the next number: the length of the dictionary.
        self.tokens.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int32, len(words)))
        self.docs.append(doc_id)
        self.lengths.append(len(words))
        self.size += len(words)

    def row(self, name: str) -> list:
        lengths = np.array(self.lengths, np.int32)
        starts = (np.cumsum(lengths + GAP) - lengths - GAP).astype(np.int32)
        tokens = np.concatenate(self.tokens)
        places = np.arange(len(tokens), dtype=np.int32) + np.repeat(np.arange(len(lengths), dtype=np.int32) * GAP, lengths)
        terms = list(self.ids)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in terms), np.uint64, len(terms))
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        ranked = rank[tokens]
        positions = places[np.argsort(ranked, kind="stable")]
        ends = np.cumsum(np.bincount(ranked, minlength=len(terms))).astype(np.int32)
        # Each list as its first position and the steps from there.
        steps = np.diff(positions, prepend=np.int32(0))
        begins = np.concatenate(([0], ends[:-1]))[: len(terms)]
        steps[begins] = positions[begins]
        in_order = [terms[i] for i in order.tolist()]
        term_ends = np.cumsum(np.fromiter(map(len, in_order), np.int32, len(in_order)), dtype=np.int32)
        return [
            name, self.docs, starts.tobytes(), lengths.tobytes(), hashes[order].tobytes(), term_ends.tobytes(),
            b"".join(in_order), ends.tobytes(), steps.tobytes(),
        ]


def build_index(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the index of ``docs`` to ``folder``, one row per block, and read it.

    Only attempts that Spark commits leave blocks, so a lost executor neither
    loses nor doubles a document.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = _INDEX.format(id=dict(chosen.dtypes)["doc_id"])
    arrow = [pa.string(), None, *[pa.binary()] * 7]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, block, kind = TaskContext.get().partitionId(), 0, _Block(), None

        def close() -> pa.RecordBatch:
            row = block.row(f"{part}-{made}")
            kinds = [arrow[0], pa.list_(kind), *arrow[2:]]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], [x.split()[0] for x in schema.split(", ")]
            )

        for batch in batches:
            kind = batch.column(0).type
            for i, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                block.add(i, words_of(t))
                if block.size + GAP * len(block.docs) >= BLOCK_TOKENS:
                    yield close()
                    made, block = made + 1, _Block()
        if block.docs:
            yield close()

    # Writers and readers hold a row group at once. A writer measures it only after a hundred rows, which here may be all
    # blocks of a task, so a block is a row group by itself. Least and largest values would be whole blocks, held to the end.
    written = map_batches(chosen, work, schema).write.options(
        **{"parquet.block.row.count.limit": 1, "parquet.column.statistics.enabled": False, "compression": "zstd"}
    )
    written.parquet(folder)
    return docs.sparkSession.read.schema(schema).parquet(folder)


# The name of items whose id is null; no id cast to text is a single NUL character.
NULL_ITEM = "\x00"


def windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """``(item_id, words)``: each run of ``size`` words of an item, once; a shorter item is one window."""
    words = f"array_remove(split(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
            "'[\\\\x00-\\\\x2F\\\\x3A-\\\\x60\\\\x7B-\\\\x7F]+'), '')"
    return (
        items.selectExpr(f"cast({item_id} as string) AS item_id", f"{words} AS w").where("size(w) > 0")
        .selectExpr(
            "item_id",
            f"explode(transform(sequence(1, greatest(1, size(w) - {size} + 1)), i -> slice(w, i, {size}))) AS words",
        )
        .distinct()
    )


class _Portion:
    """Some windows as arrays: which of the distinct terms stands at which place."""

    def __init__(self, item_ids: list[str], word_lists: list[list[str]], size: int) -> None:
        self.items = sorted(set(item_ids))
        number = {x: i for i, x in enumerate(self.items)}
        self.item = np.array([number[x] for x in item_ids], np.int32)
        encoded = [[w.encode() for w in ws] for ws in word_lists]
        hashes = {w: xxhash.xxh64_intdigest(w) for w in {w for ws in encoded for w in ws}}
        self.terms = sorted(hashes, key=hashes.get)
        self.hashes = np.array([hashes[w] for w in self.terms], np.uint64)
        place = {w: i for i, w in enumerate(self.terms)}
        self.words = np.full((len(encoded), size), -1, np.int32)
        for i, ws in enumerate(encoded):
            self.words[i, : len(ws)] = [place[w] for w in ws]
        self.lengths = np.array([len(ws) for ws in encoded], np.int32)


def _within(places: np.ndarray, wanted: np.ndarray, slop: int) -> np.ndarray:
    """Which of ``wanted`` have one of the sorted ``places`` at most ``slop`` away."""
    at = np.searchsorted(places, wanted - slop)
    return (at < len(places)) & (places[np.minimum(at, len(places) - 1)] <= wanted + slop)


def _search(row: dict, portion: _Portion, slop: int) -> dict[int, tuple[list, set, set]]:
    """Document number in the block to exact spans, items and items matched by proximity."""
    hashes = np.frombuffer(row["term_hashes"], np.uint64)
    if not len(hashes):
        return {}
    term_ends = np.frombuffer(row["term_ends"], np.int32)
    list_ends = np.frombuffer(row["list_ends"], np.int32)
    steps = np.frombuffer(row["positions"], np.int32)
    starts = np.frombuffer(row["starts"], np.int32)
    at = np.minimum(np.searchsorted(hashes, portion.hashes), len(hashes) - 1)
    present = hashes[at] == portion.hashes
    for k in np.flatnonzero(present).tolist():
        i = int(at[k])
        # Equal hashes are not enough: the term itself is compared.
        present[k] = row["terms"][int(term_ends[i - 1]) if i else 0:int(term_ends[i])] == portion.terms[k]
    begin = np.where(at > 0, list_ends[at - 1], 0)
    count = np.where(present, list_ends[at] - begin, 0)
    padded = portion.words < 0
    alive = np.flatnonzero((present[portion.words] | padded).all(axis=1))
    often = np.where(padded, np.iinfo(np.int32).max, count[portion.words])
    lists: dict[int, np.ndarray] = {}

    def places(term: int) -> np.ndarray:
        if term not in lists:
            lists[term] = np.cumsum(steps[begin[term]:begin[term] + count[term]])
        return lists[term]

    found: dict[int, tuple[list, set, set]] = {}
    for w in alive.tolist():
        length, terms = int(portion.lengths[w]), portion.words[w]
        order = np.argsort(often[w, :length], kind="stable").tolist()
        exact = places(int(terms[order[0]])) - order[0]
        # A start from which every term is within the slop of its place need not be that of the rarest.
        near = np.unique(exact[:, None] + np.arange(-slop, slop + 1, dtype=exact.dtype))
        for offset in order[1:]:
            listed = places(int(terms[offset]))
            near = near[_within(listed, near + offset, slop)]
            if not len(near):
                break
            exact = exact[_within(listed, exact + offset, 0)]
        if not len(near):
            continue
        item = portion.items[portion.item[w]]
        for p in near.tolist():
            # A proximity match may begin before its document, but only by the slop.
            doc = int(np.searchsorted(starts, p + slop, side="right")) - 1
            found.setdefault(doc, ([], set(), set()))[2].add(item)
        for p in exact.tolist():
            doc = int(np.searchsorted(starts, p, side="right")) - 1
            spans, items, _ = found[doc]
            spans.append((p - int(starts[doc]), p - int(starts[doc]) + length))
            items.add(item)
    return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def matches(index: DataFrame, wanted: DataFrame, size: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """``(block, doc, starts, ends, items, near_items)`` for documents of the index in which windows occur.

    starts and ends are the words covered by exact phrase matches; near_items
    also has items of which a window's words all stand within ``slop`` of their
    places, counted from some start. ``wanted`` may have any size: it is put to the index in portions of
    ``PORTION`` windows, each sent to the tasks as a small array.
    """
    schema = "block string, doc int, starts array<int>, ends array<int>, items array<string>, near_items array<string>"
    columns = ("block", "starts", "term_hashes", "term_ends", "terms", "list_ends", "positions")
    # A row is a block of several megabytes, so each goes to the worker by itself.
    index.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    found = None

    def put(portion: _Portion) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    for doc, (spans, items, near) in _search(row, portion, slop).items():
                        merged = _merged(spans)
                        out.append((row["block"], doc, [s for s, _ in merged], [e for _, e in merged], sorted(items), sorted(near)))
                kinds = [pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.string())]
                names = ["block", "doc", "starts", "ends", "items", "near_items"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names
                )

        return index.select(*columns).mapInArrow(work, schema)

    ids: list[str] = []
    lists: list[list[str]] = []

    for r in wanted.toLocalIterator():
        ids.append(r["item_id"])
        lists.append(r["words"])
        if len(ids) == PORTION:
            one = settle(put(_Portion(ids, lists, size)))
            found = one if found is None else found.unionByName(one)
            ids, lists = [], []
    if ids or found is None:
        one = put(_Portion(ids, lists, size))
        found = one if found is None else found.unionByName(one)
    return found


def _united(pdf: pd.DataFrame) -> pd.DataFrame:
    """The portions' matches of one document as one row."""
    spans = _merged([s for a, b in zip(pdf["starts"], pdf["ends"], strict=True) for s in zip(a.tolist(), b.tolist(), strict=True)])
    items = sorted({x for xs in pdf["items"] for x in xs} - {NULL_ITEM})
    near = sorted({x for xs in pdf["near_items"] for x in xs} - {NULL_ITEM})
    return pd.DataFrame({
        "block": [pdf["block"].iloc[0]], "doc": [pdf["doc"].iloc[0]], "n_hit": [sum(e - s for s, e in spans)],
        "n_items": [len(items)], "items": [",".join(items)], "n_near_items": [len(near)],
        "near_items": [",".join(near)],
    })


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", size: int = WINDOW, slop: int = SLOP, folder: str | None = None,
) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items, near_items, near_items_sha256)``
    for every row of ``docs``.

    n_hit counts the words inside any exact occurrence of a benchmark window;
    the near items are those matched by proximity, exact matches included.
    Null texts have no words, items without words no window; the windows of an
    item with null id count in n_hit and contaminated, but the item is left out
    of the item lists and counts, as it has no name. Repeated rows each give a
    row; other columns are ignored; empty tables give no rows or no hits.
    """
    if size + 2 * slop >= GAP:
        raise ValueError(f"a window and its slop must stay below {GAP} words")
    index = build_index(docs, folder or new_folder(docs.sparkSession, "postings"), doc_id, text)
    # An item without id still has windows; it is named by a sentinel that the item lists leave out.
    named = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit(NULL_ITEM)).alias("_item"), F.col(item_text).alias("_text")
    )
    wanted = windows(named, "_item", "_text", size)
    hits = (
        matches(index, wanted, size, slop).groupBy("block", "doc")
        .applyInPandas(_united, "block string, doc int, n_hit long, n_items long, items string, n_near_items long, near_items string")
    )

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column(1)[k].values
                n = np.frombuffer(batch.column(2)[k].as_py(), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[k].as_py()] * len(n), pa.string()), pa.array(np.arange(len(n), dtype=np.int32)),
                     ids, pa.array(n.astype(np.int64))],
                    ["block", "doc", "doc_id", "n_words"],
                )

    kind = docs.select(F.col(doc_id).alias("i")).dtypes[0][1]
    every = index.select("block", "doc_ids", "lengths").mapInArrow(listed, f"block string, doc int, doc_id {kind}, n_words long")
    none = hashlib.sha256(b"").hexdigest()
    return every.join(hits, ["block", "doc"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce(F.sha2(F.col("items").cast("binary"), 256), F.lit(none)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_near_items", F.lit(0).cast("long")).alias("n_near_items"),
        F.coalesce("near_items", F.lit("")).alias("near_items"),
        F.coalesce(F.sha2(F.col("near_items").cast("binary"), 256), F.lit(none)).alias("near_items_sha256"),
    )


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no benchmark window.

    Rows are told apart by id and text, so a null id does not spread a verdict
    to other rows without id.
    """
    key = F.concat_ws("|", F.col(doc_id).cast("string"), F.hex(F.xxhash64(text)))
    keyed = docs.select(key.alias("_key"), F.col(text).alias("_text"))
    bad = contamination(keyed, items, "_key", "_text").where("contaminated").select(F.col("doc_id").alias("_bad"))
    return join_small(docs, bad, key == F.col("_bad"), "left_anti")
