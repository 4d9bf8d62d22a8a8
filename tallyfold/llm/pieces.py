"""SentencePiece encoding by n-best search over the piece lattice, and decoding.

Forward Viterbi scores of the lattice are exact heuristics for an A-star search
backwards from the end, which so gives segmentations from the best on. The
scores are those of the model file. A text is searched chunk by chunk, cut only
where no piece can lie across; the n best of the text are put together exactly
from the n best of its chunks.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import kept, map_batches

N_BEST = 3
# Below the least score of a piece, for a character that is no piece and is spelled in bytes.
UNKNOWN_PENALTY = 10.0
# Bytes of chunks and segmentations that a worker keeps, in two generations; an entry has so many besides its text and ids.
# The search for n best gains most from it. The smaller one is for the best alone, and for the n best as a stage among
# others, whose executors need the room.
CACHE_BYTES = 224 << 20
BEST_CACHE_BYTES = 64 << 20
ENTRY_BYTES = 320
# Longer chunks are searched one by one; shorter ones together, so many characters at once.
LONG = 64
TOGETHER = 50_000
# Texts are split together up to so many characters, as their new chunks are all held at once.
PORTION = 2_000_000


class Vocabulary:
    """Pieces with a blank for the model's blank mark, their scores, and a piece for each byte.

    At most a few hundred thousand pieces, as the model file has them.
    """

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], spelled: list[bytes]) -> None:
        self.pieces, self.byte_ids, self.spelled = pieces, byte_ids, spelled
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_PENALTY
        # Chunks are words with the blanks before them, and line ends, if no piece lies across.
        crossing = any("\n" in p or re.search("[^ ] ", p) for p in pieces)
        self.chunks = re.compile(r"(?s).+" if crossing else r"\n| *[^ \n]+| +")

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, byte_ids, spelled = {}, [-1] * 256, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
                spelled.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                spelled.append(b"")
            else:
                plain = piece.replace("▁", " ")
                pieces[plain] = i, model.get_score(i)
                spelled.append(plain.encode())
        if -1 in byte_ids:
            raise ValueError("the model has no piece for some bytes, so a text may be lost")
        return cls(pieces, byte_ids, spelled)

    def lattice(self, text: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For each place, the pieces that end there: start, score, ids."""
        n, get = len(text), self.pieces.get
        ends: list[list] = [[] for _ in range(n + 1)]
        for i in range(n):
            one = get(text[i])
            if one is None:
                spelled = tuple(self.byte_ids[b] for b in text[i].encode("utf-8", "surrogatepass"))
                ends[i + 1].append((i, self.unknown, spelled))
            else:
                ends[i + 1].append((i, one[1], one[:1]))
            for j in range(i + 2, min(n, i + self.longest) + 1):
                found = get(text[i:j])
                if found is not None:
                    ends[j].append((i, found[1], found[:1]))
        return ends

    def viterbi(self, text: str) -> tuple[list[int], float, float]:
        """The best segmentation, its score, and how much the second best loses (infinite without one).

        The second best has a piece that is not in the best one, so its score is
        the highest of a path through any such piece.
        """
        n, get, longest = len(text), self.pieces.get, self.longest
        ahead, come = [0.0] + [-np.inf] * n, [None] * (n + 1)
        edges = []
        for i in range(n):
            here = ahead[i]
            for j in range(i + 1, min(n, i + longest) + 1):
                found = get(text[i:j])
                if found is None:
                    if j > i + 1:
                        continue
                    spelled = [self.byte_ids[b] for b in text[i].encode("utf-8", "surrogatepass")]
                    edge = (i, j, self.unknown, spelled)
                else:
                    edge = (i, j, found[1], found[:1])
                edges.append(edge)
                if here + edge[2] > ahead[j]:
                    ahead[j], come[j] = here + edge[2], edge
        ids, at = [], n
        while at:
            ids.append(come[at][3])
            at = come[at][0]
        behind, second = [-np.inf] * n + [0.0], -np.inf
        for edge in reversed(edges):
            i, j, score, _ = edge
            total = score + behind[j]
            if total > behind[i]:
                behind[i] = total
            if total + ahead[i] > second and come[j] is not edge:
                second = total + ahead[i]
        # Pieces that come best to a place off the best path are not in it either.
        on_path, at = set(), n
        while at:
            on_path.add(id(come[at]))
            at = come[at][0]
        for edge in come[1:]:
            if id(edge) not in on_path:
                second = max(second, ahead[edge[0]] + edge[2] + behind[edge[1]])
        return [x for part in reversed(ids) for x in part], ahead[n], max(0.0, ahead[n] - second)

    def n_best(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """Up to ``n`` segmentations with the highest scores, best first."""
        ends = self.lattice(text)
        best = [0.0] * len(ends)
        for i in range(1, len(ends)):
            best[i] = max([best[start] + score for start, score, _ in ends[i]])
        # Entries: negated score of the whole, order of entry, place, score behind it, pieces behind it.
        agenda, made, out = [(-best[-1], 0, len(text), 0.0, None)], 1, []
        while agenda:
            _, _, place, behind, path = heapq.heappop(agenda)
            if not place:
                ids: list[int] = []
                while path is not None:
                    ids.extend(path[0])
                    path = path[1]
                out.append((behind, ids))
                if len(out) == n:
                    break
                continue
            for start, score, ids in ends[place]:
                total = behind + score
                heapq.heappush(agenda, (-(best[start] + total), made, start, total, (ids, path)))
                made += 1
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of pieces; the blank that encoding puts first is taken off."""
        return b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "surrogatepass")[1:]


class Trie:
    """The pieces of a vocabulary as sorted arrays of steps ``node << 21 | character``."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        steps: dict[int, int] = {}
        ids, scores = [-1], [-np.inf]
        for piece, (i, score) in vocabulary.pieces.items():
            node = 0
            for c in piece:
                key = node << 21 | ord(c)
                if key not in steps:
                    steps[key] = len(ids)
                    ids.append(-1)
                    scores.append(-np.inf)
                node = steps[key]
            ids[node], scores[node] = i, score
        self.steps = np.array(sorted(steps), np.int64)
        self.child = np.array([steps[k] for k in self.steps.tolist()], np.int32)
        self.ids, self.scores = np.array(ids, np.int32), np.array(scores)
        self.longest, self.unknown = vocabulary.longest, vocabulary.unknown

    def edges(self, points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the pieces that begin at each place, a column for each length.

        ``ends`` has the end of each place's chunk. An id of -1 with a finite
        score is a character that has to be spelled in bytes.
        """
        scores = np.full((len(points), self.longest), -np.inf)
        ids = np.full((len(points), self.longest), -1, np.int32)
        at, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        for k in range(self.longest):
            keys = node << 21 | points[at + k]
            found = np.minimum(np.searchsorted(self.steps, keys), len(self.steps) - 1)
            there = self.steps[found] == keys
            at, node = at[there], self.child[found[there]].astype(np.int64)
            scores[at, k], ids[at, k] = self.scores[node], self.ids[node]
            if k == 0:
                scores[ids[:, 0] < 0, 0] = self.unknown
            more = at + k + 1 < ends[at]
            at, node = at[more], node[more]
            if not len(at):
                break
        return scores, ids

    def search(self, chunks: list[str]) -> list[tuple[bytes, float, float] | None]:
        """``Vocabulary.viterbi`` of many short chunks; None for one that has to be spelled in bytes."""
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(-lengths, kind="stable")
        points = np.frombuffer("".join([chunks[i] for i in order.tolist()]).encode("utf-32-le"), np.uint32).astype(np.int64)
        lengths = lengths[order]
        begin = np.cumsum(lengths) - lengths
        scores, ids = self.edges(points, np.repeat(begin + lengths, lengths))
        # A chunk has a node before each character and one at its end; chunks
        # that reach a given length come first.
        first = begin + np.arange(len(chunks))
        nodes = len(points) + len(chunks)
        ahead, come = np.full(nodes, -np.inf), np.zeros(nodes, np.int64)
        ahead[first] = 0
        top, wide = int(lengths[0]), self.longest
        reach = [int(np.searchsorted(-lengths, -j, side="right")) for j in range(top + 1)]
        for j in range(1, top + 1):
            m, back = reach[j], np.arange(1, min(j, wide) + 1)
            start = begin[:m, None] + (j - back)
            total = ahead[first[:m, None] + (j - back)] + scores[start, back - 1]
            best = total.argmax(axis=1)
            ahead[first[:m] + j], come[first[:m] + j] = total[np.arange(m), best], best + 1
        behind = np.full(nodes, -np.inf)
        behind[first + lengths] = 0
        for j in range(top - 1, -1, -1):
            m = reach[j + 1]
            step = np.minimum(np.arange(1, wide + 1), (lengths[:m] - j)[:, None])
            # Pieces are never longer than what is left, so a clipped step has no score to add.
            behind[first[:m] + j] = (scores[begin[:m] + j] + behind[first[:m, None] + j + step]).max(axis=1)
        node = np.arange(len(points)) + np.repeat(np.arange(len(chunks)), lengths)
        after = np.minimum(node[:, None] + np.arange(1, wide + 1), nodes - 1)
        through = scores + ahead[node][:, None] + behind[after]
        at, alive, steps = lengths.copy(), np.arange(len(chunks)), []
        spelled = np.zeros(len(chunks), bool)
        while len(alive):
            length = come[first[alive] + at[alive]]
            start = begin[alive] + at[alive] - length
            got = ids[start, length - 1]
            spelled[alive[got < 0]] = True
            steps.append((alive, got))
            through[start, length - 1] = -np.inf
            at[alive] -= length
            alive = alive[at[alive] > 0]
        second = np.maximum.reduceat(through.max(axis=1), begin)
        count = np.bincount(np.concatenate([a for a, _ in steps]), minlength=len(chunks))
        place = np.cumsum(count)
        flat = np.empty(int(place[-1]), "<i4")
        left = place.copy()
        for some, got in steps:
            left[some] -= 1
            flat[left[some]] = got
        packed, ends = flat.tobytes(), (place * 4).tolist()
        score = ahead[first + lengths]
        loss = np.maximum(0, score - second)
        out: list = [None] * len(chunks)
        start = 0
        for k, end, s, d, odd in zip(order.tolist(), ends, score.tolist(), loss.tolist(), spelled.tolist(), strict=True):
            if not odd:
                out[k] = packed[start:end], s, d
            start = end
        return out


class Encoder(dict):
    """Chunk to ``(ids as bytes, score, loss of the second best)``, computed when first asked for.

    Entries grow old together: when half of the room is used, the younger half
    becomes the older one, from which those asked for again come back.
    """

    def __init__(self, vocabulary: Vocabulary, n: int, room: int | None = None) -> None:
        super().__init__()
        self.vocabulary, self.n, self.trie = vocabulary, n, Trie(vocabulary)
        self.older: dict[str, tuple[bytes, float, float]] = {}
        self.room, self.weight = room or (CACHE_BYTES if n > 1 else BEST_CACHE_BYTES), 0

    def split(self, texts: list[str]) -> list[list[str]]:
        """The chunks of texts; those not seen before are searched together."""
        found = [self.vocabulary.chunks.findall(" " + t) if t else [] for t in texts]
        if self.weight > self.room // 2:
            self.older = dict(self) if self.weight <= self.room else {}
            self.clear()
            self.weight = 0
        new = {c for chunks in found for c in chunks if c not in self}
        again = new & self.older.keys()
        self._keep({c: self.older.pop(c) for c in again})
        new -= again
        portion, size = [], 0
        for c in sorted(new):
            if len(c) > LONG:
                continue
            portion.append(c)
            size += len(c)
            if size >= TOGETHER:
                self._fill(portion)
                portion, size = [], 0
        if portion:
            self._fill(portion)
        return found

    def _fill(self, chunks: list[str]) -> None:
        self._keep({c: entry for c, entry in zip(chunks, self.trie.search(chunks), strict=True) if entry is not None})

    def _keep(self, entries: dict[str, tuple[bytes, float, float]]) -> None:
        self.update(entries)
        self.weight += ENTRY_BYTES * len(entries) + 4 * sum(map(len, entries)) + sum([len(e[0]) for e in entries.values()])

    def __missing__(self, chunk: str):
        ids, score, loss = self.vocabulary.viterbi(chunk)
        entry = np.array(ids, "<i4").tobytes(), score, loss
        self._keep({chunk: entry})
        return entry

    def alternatives(self, chunk: str) -> list[tuple[float, bytes]]:
        """The n best of a chunk as ``(loss, ids as bytes)``, the cached one first among equals."""
        own, score, _ = self[chunk]
        found = [(max(0.0, score - s), np.array(ids, "<i4").tobytes()) for s, ids in self.vocabulary.n_best(chunk, self.n)]
        return ([(0.0, own)] + [x for x in found if x[1] != own])[: self.n]

    def encode(self, text: str) -> list[tuple[float, bytes]]:
        """Up to n segmentations of a text as ``(score, ids as bytes)``, best first."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[tuple[float, bytes]]]:
        out, low, size = [], 0, 0
        for high, text in enumerate(texts, 1):
            size += len(text)
            if size >= PORTION or high == len(texts):
                out += [self._joined(chunks) for chunks in self.split(texts[low:high])]
                low, size = high, 0
        return out

    def _joined(self, chunks: list[str]) -> list[tuple[float, bytes]]:
        if not chunks:
            return [(0.0, b"")]
        entries = list(map(self.__getitem__, chunks))
        parts = [e[0] for e in entries]
        score = sum([e[1] for e in entries])
        if self.n == 1:
            return [(score, b"".join(parts))]
        # A text among the n best departs from the best one only in chunks
        # whose second best loses least: n - 1 of them are enough.
        loss = np.array([e[2] for e in entries])
        least = np.argpartition(loss, self.n - 2)[: self.n - 1] if len(loss) >= self.n else np.arange(len(loss))
        found: list[tuple[float, dict[int, bytes]]] = [(0.0, {})]
        for k in np.sort(least).tolist():
            if np.isfinite(loss[k]):
                others = self.alternatives(chunks[k])
                found = heapq.nsmallest(
                    self.n, ((lost + d, change | {k: ids}) for lost, change in found for d, ids in others), key=lambda x: x[0]
                )
        out = []
        for lost, change in found:
            own = list(parts)
            for k, ids in change.items():
                own[k] = ids
            out.append((score - lost, b"".join(own)))
        return out


def _encoder(vocabulary: Vocabulary, n: int, room: int | None = None) -> Encoder:
    """The encoder of this process for a vocabulary, so that tasks of one worker share what they have found."""
    key = len(vocabulary.spelled), n, room, hashlib.sha1(b"\0".join(vocabulary.spelled)).digest()
    encoders = kept.setdefault(__name__, {})
    if key not in encoders:
        encoders.clear()
        encoders[key] = Encoder(vocabulary, n, room)
    return encoders[key]


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", n: int = N_BEST) -> DataFrame:
    """``(doc_id, segmentations)`` for every row: up to ``n`` structs of score and ids, best first.

    A null text gives null, an empty one a single segmentation without pieces.
    ``path`` names the model file, read on the driver. Repeated rows each give a
    row; other columns are ignored.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    vocabulary = Vocabulary.load(path)
    kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, n)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            out = [
                None if t is None else [{"score": s, "ids": np.frombuffer(b, "<i4")} for s, b in found]
                for t, found in zip(texts, encoder.encode_all([t or "" for t in texts]), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "segmentations"])

    return map_batches(
        chosen, work, f"doc_id {dict(chosen.dtypes)['doc_id']}, segmentations array<struct<score: double, ids: array<int>>>"
    )


def _lists(found: list[bytes | None]) -> pa.ListArray:
    """Ids as bytes made lists of numbers, None a null."""
    ends = np.cumsum([0] + [len(b or b"") // 4 for b in found]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(b or b"" for b in found), "<i4"))
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=pa.array([b is None for b in found], pa.bool_()))


def best(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with the best segmentation of ``text`` in a column ``ids`` (null for a null text); an older ``ids`` is replaced."""
    vocabulary = Vocabulary.load(path)
    docs = docs.drop("ids")
    columns = docs.columns
    at = columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, 1)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            every = encoder.encode_all([t or "" for t in texts])
            ids = _lists([None if t is None else x[0][1] for t, x in zip(texts, every, strict=True)])
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*columns, "ids"])

    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    schema = StructType([*docs.schema.fields, StructField("ids", ArrayType(IntegerType(), True), True)])
    return map_batches(docs, work, schema)


def n_best(docs: DataFrame, path: str, text: str = "text", n: int = N_BEST, room: int | None = None) -> DataFrame:
    """``docs`` with ``(ids, segmentations, round_trip)`` of ``text``, null for a null text; older columns of these names are replaced.

    segmentations has up to ``n`` structs of score and ids, best first, and ids
    those of the first. round_trip tells whether decoding each of them gives
    the text back. ``room`` is the size of what a worker keeps.
    """
    vocabulary = Vocabulary.load(path)
    docs = docs.drop("ids", "segmentations", "round_trip")
    columns = docs.columns
    at = columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, n, room)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            every = encoder.encode_all([t or "" for t in texts])
            every = [None if t is None else x for t, x in zip(texts, every, strict=True)]
            flat = [x for found in every for x in found or []]
            each = pa.StructArray.from_arrays([pa.array([s for s, _ in flat], pa.float64()), _lists([b for _, b in flat])], ["score", "ids"])
            ends = pa.array(np.cumsum([0] + [len(x or []) for x in every]).astype(np.int32))
            segmentations = pa.ListArray.from_arrays(ends, each, mask=pa.array([x is None for x in every], pa.bool_()))
            back = [
                None if x is None else all(vocabulary.decode(np.frombuffer(b, "<i4").tolist()) == t for _, b in x)
                for t, x in zip(texts, every, strict=True)
            ]
            ids = _lists([None if x is None else x[0][1] for x in every])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, ids, segmentations, pa.array(back, pa.bool_())], [*columns, "ids", "segmentations", "round_trip"]
            )

    from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructField, StructType

    ids = ArrayType(IntegerType(), True)
    one = StructType([StructField("score", DoubleType(), True), StructField("ids", ids, True)])
    return map_batches(docs, work, StructType([
        *docs.schema.fields, StructField("ids", ids, True), StructField("segmentations", ArrayType(one, True), True),
        StructField("round_trip", BooleanType(), True),
    ]))


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of each row's ``ids`` (null for null)."""
    vocabulary = Vocabulary.load(path)
    chosen = encoded.drop("decoded")
    columns = chosen.columns
    at = columns.index(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else vocabulary.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*columns, "decoded"])

    from pyspark.sql.types import StringType, StructField, StructType

    return map_batches(chosen, work, StructType([*chosen.schema.fields, StructField("decoded", StringType(), True)]))


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", n: int = N_BEST) -> DataFrame:
    """``(doc_id, n_pieces, score, n_best, gap, ids_sha256, best_sha256, round_trip)`` for every row.

    Of the best segmentation: pieces, score, and the digest of its ids as 4-byte
    little-endian numbers; best_sha256 covers the ids of all ``n``. gap is how
    much the second best loses, null without one. round_trip tells whether
    decoding gives the text back. A null text counts as empty.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    vocabulary = Vocabulary.load(path)
    names = ["doc_id", "n_pieces", "score", "n_best", "gap", "ids_sha256", "best_sha256", "round_trip"]
    kinds = [None, pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.string(), pa.string(), pa.bool_()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, n)
        for batch in batches:
            rows = []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for t, found in zip(texts, encoder.encode_all(texts), strict=True):
                score, ids = found[0]
                every = hashlib.sha256()
                for _, b in found:
                    every.update(b)
                rows.append((
                    len(ids) // 4, score, len(found), score - found[1][0] if len(found) > 1 else None,
                    hashlib.sha256(ids).hexdigest(), every.hexdigest(), encoder.vocabulary.decode(np.frombuffer(ids, "<i4").tolist()) == t,
                ))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds[1:]))], names
            )

    return map_batches(chosen, work, (
        f"doc_id {dict(chosen.dtypes)['doc_id']}, n_pieces long, score double, n_best long, gap double, "
        "ids_sha256 string, best_sha256 string, round_trip boolean"
    ))
