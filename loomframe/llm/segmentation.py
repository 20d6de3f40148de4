"""Encoding with a SentencePiece model by its n best segmentations, and decoding.

A text with a space before it is a lattice: an edge for every piece of the model that
matches, and the bytes of a character where none does. Forward Viterbi scores give the
best way from the start to every place. They are the exact heuristic of an A* search
that walks backward from the end, so that it meets segmentations in the order of their
scores and extends little else.

No piece leads over the beginning of a space or over a line feed, so the lattice falls
into units. Forward scores, the best way and the score of the second best are computed
for all new units of many texts at once. The n best segmentations of a text differ from
the best in at most ``n - 1`` units, those that lose least by their second best. The
search runs on the lattices of these and their ways are combined in the order of scores.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import chunks, prefix_sums, sliced, span_hash

MARK = "▁"
#: Units up to this number of characters are searched together with others.
SHORT = 48
#: Units that a task remembers.
REMEMBERED = 200_000
#: Bytes of text that are encoded at once.
PART = 1 << 19
TABLE = 20

Edge = tuple[int, float, tuple[int, ...]]


@dataclass
class Pieces:
    """The pieces of a model: text, number and score of those that stand for text, and the numbers of bytes."""

    texts: list[str]
    ids: list[int]
    scores: list[float]
    bytes_: list[int]
    longest: int = 0
    known: dict[str, tuple[int, float]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.texts))
        self.known = dict(zip(self.texts, zip(self.ids, self.scores, strict=True), strict=True))
        #: Below every piece, so that bytes are used only where there is no other way.
        self.byte_score = min(self.scores) - 10
        if any("\n" in t or MARK in t.lstrip(MARK) for t in self.texts):
            raise ValueError("pieces that lead over a space or a line feed are not supported")

    @staticmethod
    def load(path: str) -> Pieces:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = [model.get_score(i) for i in plain]
        # Some models score pieces that are there for completeness by a huge penalty; they count as below all others.
        least = min(s for s in scores if s > -1e6) - 10
        return Pieces(
            [model.id_to_piece(i) for i in plain],
            plain,
            [max(s, least) for s in scores],
            [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
        )

    def decoder(self) -> list[bytes]:
        """Bytes of every piece by its number; control pieces have none."""
        out = [b""] * (max([*self.ids, *self.bytes_]) + 1)
        for b, i in enumerate(self.bytes_):
            out[i] = bytes([b])
        for text, i in zip(self.texts, self.ids, strict=True):
            out[i] = text.replace(MARK, " ").encode()
        return out


def edges(unit: str, pieces: Pieces) -> list[list[Edge]]:
    """For every place of a unit the edges that end there: start, score and pieces."""
    out: list[list[Edge]] = [[] for _ in range(len(unit) + 1)]
    text = unit.replace(MARK, "\0").replace(" ", MARK)
    for start in range(len(text)):
        one = pieces.known.get(text[start])
        if one is None or unit[start] == MARK:
            spelt = tuple(pieces.bytes_[b] for b in unit[start].encode())
            out[start + 1].append((start, pieces.byte_score * len(spelt), spelt))
            continue
        for end in range(start + 1, min(start + pieces.longest, len(text)) + 1):
            found = pieces.known.get(text[start:end])
            if found is not None:
                out[end].append((start, found[1], found[:1]))
    return out


def forward(ending: list[list[Edge]]) -> list[float]:
    """Score of the best way from the start to every place."""
    best = [0.0] + [-np.inf] * (len(ending) - 1)
    for end in range(1, len(ending)):
        best[end] = max([best[start] + score for start, score, _ in ending[end]], default=-np.inf)
    return best


def best_ways(ending: list[list[Edge]], n: int) -> list[tuple[float, list[Edge]]]:
    """The ``n`` best ways through a lattice in order, by A* from its end."""
    reach = forward(ending)
    turn = count(1)  # of equal scores the latest goes on, or ties would all be followed at once
    queue = [(-reach[-1], next(turn), len(ending) - 1, 0.0, None)]
    found = []
    while queue and len(found) < n:
        _, _, place, gone, way = heapq.heappop(queue)
        if place == 0:
            out = []
            while way is not None:
                edge, way = way
                out.append(edge)
            found.append((gone, out))
            continue
        for edge in ending[place]:
            start, score, _ = edge
            if reach[start] > -np.inf:
                heapq.heappush(queue, (-(gone + score + reach[start]), -next(turn), start, gone + score, (edge, way)))
    return found


class Encoder:
    """Encodes texts one batch after the other and remembers the units it has met."""

    def __init__(self, pieces: Pieces, n: int) -> None:
        self.pieces, self.n = pieces, n
        self.split = re.compile(f" *[^ \n{MARK}]+|\n+|{MARK}+| +").findall
        self.scores_by_id = np.full(max(pieces.ids) + 1, -np.inf)
        self.scores_by_id[pieces.ids] = pieces.scores
        points = np.frombuffer("".join(pieces.texts).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) for t in pieces.texts])
        self.hashes = span_hash(prefix_sums(points), np.concatenate(([0], ends[:-1])), ends)
        # Two tables by different bits of the hash; what both places of a piece refuse goes to a dictionary.
        self.tables = np.full((2, 1 << TABLE), -1, np.int32)
        self.rest: dict[int, int] = {}
        for at, h in enumerate(self.hashes.tolist()):
            for t, place in enumerate((h >> (64 - TABLE), h & ((1 << TABLE) - 1))):
                if self.tables[t, place] < 0:
                    self.tables[t, place] = at
                    break
            else:
                self.rest[h] = at
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ways: dict[str, list[tuple[float, list[int]]]] = {}
        self.score, self.loss, self.length = [np.zeros(0)], [np.zeros(0)], [np.zeros(0, np.int64)]
        self.ids = [np.zeros(0, np.int32)]

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Place of the piece with each hash, -1 if none."""
        first = self.tables[0][h >> np.uint64(64 - TABLE)]
        second = self.tables[1][h & np.uint64((1 << TABLE) - 1)]
        out = np.where(self.hashes[first] == h, first, np.where(self.hashes[second] == h, second, -1))
        out[(first < 0) & (self.hashes[second] != h)] = -1
        if self.rest:
            late = np.flatnonzero(np.isin(h, np.fromiter(self.rest, np.uint64, len(self.rest))))
            out[late] = [self.rest[x] for x in h[late].tolist()]
        return out

    def learn(self, units: list[str]) -> None:
        """Best way, its score and the loss of the second best for new units."""
        together = [u for u in units if len(u) <= SHORT and MARK not in u and "\n" not in u]
        alone = [u for u in units if len(u) > SHORT or MARK in u or "\n" in u]
        for lo in range(0, len(together), 50_000):
            alone += self._learn_together(together[lo : lo + 50_000])
        for unit in alone:
            ways = best_ways(edges(unit, self.pieces), 2)
            ids = np.array([i for edge in ways[0][1] for i in edge[2]], np.int32)
            loss = ways[0][0] - ways[1][0] if len(ways) > 1 else np.inf
            self._store([unit], np.array([ways[0][0]]), np.array([loss]), np.array([len(ids)]), ids)

    def _store(self, units: list[str], score: np.ndarray, loss: np.ndarray, length: np.ndarray, ids: np.ndarray) -> None:
        at = len(self.index)
        self.index.update(zip(units, range(at, at + len(units)), strict=True))
        for held, more in ((self.score, score), (self.loss, loss), (self.length, length), (self.ids, ids)):
            held.append(more)

    def _learn_together(self, units: list[str]) -> list[str]:
        """Learns short units; returns those with characters that no piece has."""
        units = sorted(units, key=len, reverse=True)
        points = np.frombuffer("".join(units).replace(" ", MARK).encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        starts = np.cumsum(sizes) - sizes
        left = np.repeat(sizes + starts, sizes) - np.arange(len(points))
        sums = prefix_sums(points)
        longest = min(self.pieces.longest, int(sizes[0]))
        piece = np.full((longest + 1, len(points)), -1, np.int32)
        for n in range(1, longest + 1):
            at = np.flatnonzero(left >= n)
            piece[n, at] = self.lookup(span_hash(sums, at, at + n))
        strange = np.unique(np.repeat(np.arange(len(units)), sizes)[piece[1] < 0])
        if len(strange):
            out = [units[i] for i in strange]
            drop = set(strange.tolist())
            self_units = [u for i, u in enumerate(units) if i not in drop]
            if self_units:
                self._learn_together(self_units)
            return out
        value = np.append(np.array(self.pieces.scores), -np.inf)  # -1 is the last
        # Places of the ways: one more than characters in each unit.
        base = starts + np.arange(len(units))
        first = np.full(len(points) + len(units), -np.inf)
        second = first.copy()
        step = np.zeros(len(first), np.int64)
        first[base] = 0.0
        for end in range(1, int(sizes[0]) + 1):
            n_open = int(np.searchsorted(-sizes, -end, side="right"))
            at, here = starts[:n_open], base[:n_open]
            top = np.full(n_open, -np.inf)
            next_ = top.copy()
            size = np.zeros(n_open, np.int64)
            for n in range(1, min(end, longest) + 1):
                score = value[piece[n, at + end - n]]
                one, two = first[here + end - n] + score, second[here + end - n] + score
                next_ = np.maximum(np.minimum(top, one), np.maximum(next_, two))
                size[one > top] = n
                top = np.maximum(top, one)
            first[here + end], second[here + end], step[here + end] = top, next_, size
        place, row = sizes.copy(), np.arange(len(units))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(row):
            n = step[base[row] + place[row]]
            place[row] -= n
            found.append((row, piece[n, starts[row] + place[row]]))
            row = row[place[row] > 0]
        owner = np.concatenate([r for r, _ in found][::-1])
        order = np.argsort(owner, kind="stable")
        ids = np.array(self.pieces.ids, np.int32)[np.concatenate([p for _, p in found][::-1])[order]]
        end = base + sizes
        self._store(units, first[end], first[end] - second[end], np.bincount(owner, minlength=len(units)), ids)
        return []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[list[dict]]]:
        """Numbers of the pieces of all texts, how many each text has, and the n best segmentations of each."""
        if len(self.index) > REMEMBERED:
            self.forget()
        units = [self.split(" " + t) if t else [] for t in texts]
        new = list({u for text in units for u in text if u not in self.index})
        if new:
            self.learn(new)
        for held in (self.score, self.loss, self.length, self.ids):
            held[:] = [np.concatenate(held)]
        score, loss, length, ids = self.score[0], self.loss[0], self.length[0], self.ids[0]
        self.begin = begin = np.cumsum(length) - length
        get = self.index.__getitem__
        sizes, parts, ranked = [], [], []
        for text in units:
            at = np.fromiter(map(get, text), np.int64, len(text))
            n = length[at]
            sizes.append(int(n.sum()))
            parts.append(np.repeat(begin[at] - (np.cumsum(n) - n), n) + np.arange(sizes[-1]))
            total = float(score[at].sum())
            ranked.append([{"score": total, "n_pieces": sizes[-1], "swaps": []}, *self._others(text, at, total, sizes[-1], loss[at])])
        flat = ids[np.concatenate(parts)] if parts else ids[:0]
        return flat, np.array(sizes, np.int64), ranked

    def _others(self, text: list[str], at: np.ndarray, total: float, size: int, loss: np.ndarray) -> list[dict]:
        """The second to n-th best segmentation of a text as changes of the best."""
        if self.n < 2 or not len(at):
            return []
        close = np.arange(len(loss))
        if len(loss) > self.n:
            close = np.flatnonzero(loss <= np.partition(loss, self.n - 2)[self.n - 2])
        least = close[np.argsort(loss[close], kind="stable")[: self.n - 1]]
        chosen = sorted(i for i in least.tolist() if loss[i] < np.inf)
        # Losses of the ways through the chosen units, the best first: each unit adds one of its n best.
        combined: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
        found = [self._ways(text[i]) for i in chosen]
        for ways in found:
            combined = sorted((lost + ways[0][0] - score, (*way, k)) for lost, way in combined for k, (score, _) in enumerate(ways))[: self.n]
        out = []
        for lost, way in combined[1:]:
            swaps = [{"unit": i, "ids": ways[k][1]} for i, ways, k in zip(chosen, found, way, strict=True) if k]
            grown = sum(len(ways[k][1]) - len(ways[0][1]) for ways, k in zip(found, way, strict=True))
            out.append({"score": total - lost, "n_pieces": size + grown, "swaps": swaps})
        return out

    def _ways(self, unit: str) -> list[tuple[float, list[int]]]:
        """The n best ways through a unit, the one that stands for it first."""
        known = self.ways.get(unit)
        if known is None:
            at = self.index[unit]
            best = self.ids[0][self.begin[at] : self.begin[at] + self.length[0][at]].tolist()
            ways = [(score, [i for edge in way for i in edge[2]]) for score, way in best_ways(edges(unit, self.pieces), self.n)]
            # Of ways with equal scores the search may meet another first.
            rest = [w for w in ways if w[1] != best]
            known = self.ways[unit] = [(ways[0][0], best), *rest[: len(ways) - 1]]
        return known


def decode(ids: Iterable[int], pieces: list[bytes]) -> str:
    """The text that numbers of pieces stand for: exactly what was encoded."""
    return b"".join([pieces[i] for i in ids]).decode("utf-8", "replace")[1:]


SEGMENTED = "ids array<int>, score double, nbest array<struct<score: double, n_pieces: int, swaps: array<struct<unit: int, ids: array<int>>>>>"
_NBEST = pa.list_(pa.struct([("score", pa.float64()), ("n_pieces", pa.int32()), ("swaps", pa.list_(pa.struct([("unit", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))


def _encode(pieces: Pieces, n: int, decoded: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces, n)
        spelt = pa.array(pieces.decoder(), pa.binary())
        for batch in sliced(batches):
            lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            for lo, hi in chunks(lengths, PART):
                part = batch.slice(lo, hi - lo)
                flat, sizes, ranked = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(flat))
                made = [ids, pa.array([r[0]["score"] for r in ranked], pa.float64()), pa.array(ranked, _NBEST)]
                names = ["ids", "score", "nbest"]
                if decoded:
                    made.append(_texts(ids, spelt))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *names])

    return run


def encode_texts(docs: DataFrame, model_file: str, n: int = 3, decoded: bool = False) -> DataFrame:
    """The columns of ``docs`` with ``ids``, ``score`` and ``nbest`` of ``text``, and with ``decoded`` what ``ids`` give back.

    ``ids`` are the pieces of the best segmentation, ``nbest`` the ``n`` best with their
    scores; each lists the units in which it differs from the best. A text with fewer
    segmentations has fewer. The model is read once, on the driver, and goes to the tasks.

    Null and empty texts have no pieces and one segmentation of score 0. Columns of
    the same names are replaced, others stay; repeated rows get equal results.
    """
    given = docs.drop("ids", "score", "nbest", *["decoded"] * decoded).withColumn("text", F.col("text").cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema)
    schema = f"{schema}, {SEGMENTED}" + ", decoded string" * decoded
    return given.mapInArrow(_encode(Pieces.load(model_file), n, decoded), schema)


def _texts(ids: pa.ListArray, spelt: pa.Array) -> pa.Array:
    """Texts of lists of pieces: the bytes of all pieces in a row, cut at the ends of the lists."""
    bounds = ids.offsets.to_numpy()
    inside = spelt.take(ids.values.slice(bounds[0], bounds[-1] - bounds[0]))
    ends = np.frombuffer(inside.buffers()[1], np.int32)[bounds - bounds[0]]
    joined = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends.tobytes()), inside.buffers()[2]])
    return pa.array([t.decode("utf-8", "replace")[1:] for t in joined.to_pylist()], pa.string())


def _decode(pieces: list[bytes]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelt = pa.array(pieces, pa.binary())
        for batch in sliced(batches):
            texts = _texts(batch.column("ids").fill_null([]), spelt)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    return run


def decode_ids(df: DataFrame, model_file: str) -> DataFrame:
    """The columns of ``df`` with ``decoded``, the text of ``ids``; null ids give an empty text."""
    given = df.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema)
    return given.mapInArrow(_decode(Pieces.load(model_file).decoder()), f"{schema}, decoded string")
