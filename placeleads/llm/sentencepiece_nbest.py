"""SentencePiece encoding and decoding with the N best segmentations.

The pieces of a vocabulary span a lattice over a text; a segmentation is a path and its score
the sum of the scores of its pieces. A forward Viterbi pass gives every place of the lattice
the best score from the start (and the next best score, which tells what leaving the best path
costs at least). These scores are exact heuristics for an A-star search that runs backward
from the end: the first paths that it completes are the best ones, in order.

If no piece holds a space mark behind another character, the lattice falls apart in front of
every space mark into words; paths of the text are combinations of paths of its words, so
the same search runs over words: the score lost by leaving a word's best path is known, the
rest of the text costs nothing more. The forward pass runs over all different words of a
batch at once, words of one length together; words that are very long or have characters
without a piece are passed one by one.

The vocabulary file is an input that is only read. As in SentencePiece, a space becomes the
space mark, one is put in front of the text, and a character without a piece costs the lowest
score less ten and is written as its bytes. Scores are whole numbers in the vocabulary at
hand, so sums are exact. Equal scores have a fixed order.

Defined results: a null text has null pieces, an empty text has none (nothing is put in front
of it) and one segmentation of score 0. A text has as many alternatives as there are paths if
there are fewer than asked for. Rows are encoded one by one; further columns are kept, columns
named as the operator's are replaced. Decoding ignores control pieces.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeleads.llm.common import add_columns, free_name

SPACE_MARK = "▁"
UNKNOWN_COST = 10.0  # fixed value: what an unknown character costs beyond the lowest score
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SHARD_CHARS = 2 << 20
LONGEST = 48  # characters of words that are segmented together
KEPT_PATHS = 20_000  # words whose paths a worker remembers
_FACTOR = 0x9E3779B97F4A7C15


def read_vocabulary(path: str) -> dict:
    """Pieces, their scores and kinds, as plain values that can be shipped to tasks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    numbers = range(model.get_piece_size())
    special = {
        i for i in numbers if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)
    }
    return {
        "pieces": [model.id_to_piece(i) for i in numbers],
        "scores": [model.get_score(i) for i in numbers],
        "special": special,
        "bytes": {int(model.id_to_piece(i)[3:5], 16): i for i in numbers if model.is_byte(i)},
        "unknown": model.unk_id(),
    }


class Lattice:
    """Segments texts; one per Python worker."""

    def __init__(self, vocabulary: dict, n: int):
        self.n = n
        usable = [
            (p, i) for i, p in enumerate(vocabulary["pieces"]) if i not in vocabulary["special"]
        ]
        scores = vocabulary["scores"]
        self.ids = {p: (scores[i], i) for p, i in usable if p}
        self.starts: dict[str, tuple] = {}  # all beginnings of pieces; the pieces have values
        for piece in self.ids:
            for end in range(1, len(piece)):
                self.starts.setdefault(piece[:end], ())
        self.starts.update(self.ids)
        self.unknown_score = min((s for s, _ in self.ids.values()), default=0.0) - UNKNOWN_COST
        self.byte_ids = vocabulary["bytes"]
        self.unknown = vocabulary["unknown"]
        self.paths: dict[str, list] = {}
        self._index_starts()
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in self.ids):
            self._word = re.compile(r"(?s).+")
        else:
            line = "" if any("\n" in p for p in self.ids) else r"\n"  # no piece: a word alone
            self._word = re.compile(rf"(?s){line}{'|' * bool(line)}{SPACE_MARK}*[^{SPACE_MARK}{line}]+|{SPACE_MARK}+")

    def _index_starts(self) -> None:
        """Beginnings of pieces by hash, sorted, with a directory by the top bits."""
        found = sorted((self._hash(t), v[1] if v else -2) for t, v in self.starts.items())
        keys = np.array([h for h, _ in found], np.uint64)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two beginnings of pieces have the same hash")
        self.slots = np.searchsorted(keys >> np.uint64(44), np.arange((1 << 20) + 1, dtype=np.uint64))
        self.deepest = int(np.diff(self.slots).max(initial=0))
        pad = np.zeros(self.deepest + 1, np.uint64)
        self.keys = np.concatenate([keys, pad])
        self.values = np.array([v for _, v in found] + [-1] * len(pad), np.int64)
        self.gains = np.full(max((i for _, i in self.ids.values()), default=0) + 1, -np.inf)
        for score, piece in self.ids.values():
            self.gains[piece] = score

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = ((h ^ ord(c)) + 1) * _FACTOR & (2**64 - 1)
            h ^= h >> 29
        return h

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the piece, -2 for a mere beginning of pieces, -1 for neither."""
        at = self.slots[(hashes >> np.uint64(44)).astype(np.int64)]
        out = np.full(len(hashes), -1, np.int64)
        for _ in range(self.deepest):
            out = np.where(self.keys[at] == hashes, self.values[at], out)
            at = at + 1
        return out

    def _forward_all(self, words: list[str], size: int):
        """The forward pass over words of one length: per word best and next best score, the
        pieces of the best path (from the last to the first, -1 after them), and whether a
        character has no piece."""
        chars = np.array(words, f"<U{size}").view(np.uint32).reshape(len(words), size).astype(np.uint64)
        best = np.full((size + 1, len(words)), -np.inf)
        second = best.copy()
        back = np.zeros((size + 1, len(words)), np.int64)
        last = np.full((size + 1, len(words)), -1, np.int64)
        best[0] = 0.0
        strange = np.zeros(len(words), bool)
        for start in range(size):
            rows = np.arange(len(words))
            h = np.zeros(len(words), np.uint64)
            for end in range(start + 1, size + 1):
                h = ((h ^ chars[rows, end - 1]) + np.uint64(1)) * np.uint64(_FACTOR)
                h ^= h >> np.uint64(29)
                piece = self._find(h)
                if end == start + 1:
                    strange |= piece < 0
                more = piece != -1
                if not more.all():
                    rows, h, piece = rows[more], h[more], piece[more]
                if not len(rows):
                    break
                hit = piece >= 0
                at, number = rows[hit], piece[hit]
                gain = self.gains[number]
                value, next_value = best[start, at] + gain, second[start, at] + gain
                old = best[end, at]
                better = value > old
                second[end, at] = np.where(
                    better, np.maximum(old, next_value), np.maximum(second[end, at], value)
                )
                best[end, at] = np.where(better, value, old)
                back[end, at[better]] = start
                last[end, at[better]] = number[better]
        strange |= ~np.isfinite(best[size])
        path = np.full((len(words), size), -1, np.int64)
        place, every = np.full(len(words), size), np.arange(len(words))
        for step in range(size):
            path[:, step] = np.where(place > 0, last[place, every], -1)
            place = np.where(place > 0, back[place, every], 0)
        return best[size], second[size], path, strange

    def _edges(self, text: str, start: int) -> Iterator[tuple[int, float, int]]:
        """Pieces that start here: end, score and number."""
        known = False
        for end in range(start + 1, len(text) + 1):
            got = self.starts.get(text[start:end])
            if got is None:
                break
            if got:
                known = known or end == start + 1
                yield end, got[0], got[1]
        if not known:
            yield start + 1, self.unknown_score, self.unknown

    def forward(self, text: str):
        """Per place: best score from the start, the next best, and the last piece of the
        best path (its start and number). The inner loop is ``_edges``, written out."""
        size, low = len(text), float("-inf")
        best, second = [low] * (size + 1), [low] * (size + 1)
        back: list = [None] * (size + 1)
        best[0] = 0.0
        get = self.starts.get
        for start in range(size):
            before, before2 = best[start], second[start]
            end, known = start + 1, False
            while end <= size:
                got = get(text[start:end])
                if got is None:
                    break
                if got:
                    known = known or end == start + 1
                    value = before + got[0]
                    if value > best[end]:
                        second[end] = max(best[end], before2 + got[0])
                        best[end], back[end] = value, (start, got[1])
                    elif value > second[end]:
                        second[end] = value
                end += 1
            if not known:
                value, end = before + self.unknown_score, start + 1
                if value > best[end]:
                    second[end] = max(best[end], before2 + self.unknown_score)
                    best[end], back[end] = value, (start, self.unknown)
                elif value > second[end]:
                    second[end] = value
        return best, second, back

    def n_best(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """The best paths of a unit, by A-star search from its end. A state holds a place and
        the pieces after it; its priority is exact: what is after plus the best before."""
        best = self.forward(text)[0]
        into: list[list] = [[] for _ in range(len(text) + 1)]
        for start in range(len(text)):
            for end, gain, piece in self._edges(text, start):
                into[end].append((start, gain, piece))
        # Of equal states the one nearest to the start goes first, so ties cost no detours; no
        # place is on more than the first n of the paths that pass it.
        queue = [(-best[-1], len(text), 0, (), 0.0)]
        visits, number = [0] * (len(text) + 1), 0
        found: list[tuple[float, list[int]]] = []
        while queue and len(found) < n:
            total, place, _, after, score = heapq.heappop(queue)
            if not place:
                found.append((-total, self._written(text, after)))
                continue
            visits[place] += 1
            if visits[place] > n:
                continue
            for start, gain, piece in into[place]:
                rest, number = score + gain, number + 1
                node = (piece, place - start, after)
                heapq.heappush(queue, (-(rest + best[start]), start, number, node, rest))
        return found

    def _written(self, text: str, path: tuple) -> list[int]:
        """Piece numbers of a path; an unknown character as its bytes."""
        out, at = [], 0
        while path:
            piece, width, path = path
            if piece == self.unknown and self.byte_ids:
                raw = text[at : at + width].encode("utf-8", "surrogatepass")
                out.extend(self.byte_ids[b] for b in raw)
            else:
                out.append(piece)
            at += width
        return out

    def _word_alone(self, text: str) -> tuple[float, float, list[int]]:
        """Best and next best score and the pieces of the best path of one word."""
        best, second, back = self.forward(text)
        path, at = (), len(text)
        while at:
            start, piece = back[at]
            path, at = (piece, at - start, path), start
        return best[-1], second[-1], self._written(text, path)

    def segment(self, words: list[str]):
        """Best scores, losses of the next best path, and the pieces of all words in one row
        with the place of each word's first and their number."""
        best, loss = np.zeros(len(words)), np.zeros(len(words))
        first, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        row: list = [np.zeros(0, np.int64)]
        filled = 0
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        alone = np.flatnonzero(sizes > LONGEST).tolist()
        order = np.argsort(sizes, kind="stable")
        ends = np.searchsorted(sizes[order], np.arange(LONGEST + 2))
        for size in range(1, LONGEST + 1):
            group = order[ends[size] : ends[size + 1]]
            for at in range(0, len(group), 1 << 14):
                part = group[at : at + (1 << 14)]
                top, other, path, strange = self._forward_all([words[i] for i in part.tolist()], size)
                alone += part[strange].tolist()
                best[part], loss[part] = top, np.where(strange, 0.0, top) - other
                path = path[:, ::-1]
                used = path >= 0
                count[part] = used.sum(axis=1)
                first[part] = filled + np.cumsum(count[part]) - count[part]
                row.append(path[used])
                filled += len(row[-1])
        for i in alone:
            top, other, ids = self._word_alone(words[i])
            best[i], loss[i], first[i], count[i] = top, top - other, filled, len(ids)
            row.append(np.array(ids, np.int64))
            filled += len(ids)
        return best, loss, np.concatenate(row), first, count

    def encode(self, texts: list[str | None]):
        """Per text: pieces (one row for all, and where each text's begin), score, and the
        next best segmentations as changes of the best: each replaces the pieces from
        ``start`` to ``stop`` of the best by ``ids``."""
        every: list[str] = []
        counts = [0]
        for text in texts:
            found = self._word.findall(SPACE_MARK + text.replace(" ", SPACE_MARK)) if text else []
            every += found
            counts.append(len(found))
        words = list(dict.fromkeys(every))
        number = dict(zip(words, range(len(words)), strict=True))
        at = np.fromiter(map(number.__getitem__, every), np.int64, len(every))
        bounds = np.cumsum(counts)
        best, loss, row, first, count = self.segment(words)
        size = count[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        ids = row[np.repeat(first[at] - ends[:-1], size) + np.arange(ends[-1])]
        sums = np.concatenate([[0.0], np.cumsum(best[at])])
        scores = (sums[bounds[1:]] - sums[bounds[:-1]]).tolist()
        others = []
        for text, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            low = np.argsort(loss[at[a:b]], kind="stable")[: self.n - 1]
            low = np.sort(low[np.isfinite(loss[at[a:b][low]])])
            chosen = [
                (int(ends[a + i] - ends[a]), int(size[a + i]), words[at[a + i]], row, first[at[a + i]])
                for i in low.tolist()
            ]
            others.append(self._alternatives(scores[text], chosen))
        return ids, ends[bounds], scores, others

    def _paths(self, word: str, own: list[int]) -> list[tuple[float, list[int]]]:
        """What each path of a word loses, and its pieces; the best path first."""
        got = self.paths.get(word)
        if got is None:
            found = self.n_best(word, self.n)
            got = [(0.0, own)]
            got += [(found[0][0] - s, ids) for s, ids in found if ids != own][: self.n - 1]
            if len(self.paths) >= KEPT_PATHS:
                self.paths.clear()
            self.paths[word] = got
        return got

    def _alternatives(self, score: float, chosen: list[tuple]) -> list[dict]:
        """Best combinations in which at least one word leaves its best path. Only the n - 1
        words that lose least can be in one of them."""
        combos: list[tuple[float, tuple]] = [(0.0, ())]
        for start, size, word, row, first in chosen:
            paths = self._paths(word, row[first : first + size].tolist())
            combos = heapq.nsmallest(
                self.n,
                (
                    (loss + more, edits + ((start, start + size, tuple(ids)),) if k else edits)
                    for loss, edits in combos
                    for k, (more, ids) in enumerate(paths)
                ),
            )
        return [
            {
                "score": score - loss,
                "edits": [{"start": a, "stop": b, "ids": list(ids)} for a, b, ids in edits],
            }
            for loss, edits in combos
            if edits
        ][: self.n - 1]


ADDED = (
    "ids array<int>;score double;"
    "alternatives array<struct<score:double,edits:array<struct<start:int,stop:int,ids:array<int>>>>>"
)


def encode(
    df: DataFrame, text: str = "text", model: str = MODEL, n: int = 4, decoded: bool = False
) -> DataFrame:
    """The rows with ``ids`` and ``score`` of the best segmentation, and ``alternatives``, the
    next best ones as changes of the best (``applied`` gives their pieces). With ``decoded``
    also what ``decode`` gives for the ids, worked out in the same Python worker: a second
    one per task would hold its memory as long."""
    # A Python worker keeps what was broadcast, and so the table, from task to task.
    vocabulary = read_vocabulary(model)
    context = df.sparkSession.sparkContext
    shared = context.broadcast(Lattice(vocabulary, n))
    back = context.broadcast(Decoder(vocabulary)) if decoded else None
    names = ("ids", "score", "alternatives", "decoded")[: 3 + decoded]
    column, rows = text, df
    if text.lower() in names:
        column = free_name(df, "text")
        rows = df.withColumnRenamed(text, column)
    edit = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("ids", pa.list_(pa.int32()))])
    other = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(edit))]))

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = batch.column(column).to_pylist()
        none = np.array([t is None for t in texts], bool)
        ids, bounds, scores, others = shared.value.encode(texts)
        at = pa.array(bounds, pa.int32())
        others = [None if t is None else o for t, o in zip(texts, others, strict=True)]
        more = {"decoded": _decoded(back.value, ids, bounds, none)} if decoded else {}
        return more | {
            "ids": pa.ListArray.from_arrays(at, pa.array(ids, pa.int32()), mask=pa.array(none)),
            "score": pa.array(scores, pa.float64(), mask=none),
            "alternatives": pa.array(others, other),
        }

    def weigh(batch: pa.RecordBatch) -> list[int]:
        return [n or 0 for n in pc.binary_length(batch.column(column)).to_pylist()]

    added = f"{ADDED};decoded string" if decoded else ADDED
    return add_columns(rows, add, added, weigh, SHARD_CHARS)


def _decoded(decoder: Decoder, ids: np.ndarray, bounds: np.ndarray, none: np.ndarray) -> pa.Array:
    """The texts of rows of pieces; null where there is none."""
    texts = [
        None if skip else decoder.decode(ids[a:b].tolist())
        for skip, a, b in zip(none.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    ]
    return pa.array(texts, pa.string())


def applied(ids: list[int], edits: list[dict]) -> list[int]:
    """The pieces of an alternative."""
    out, at = [], 0
    for e in edits:
        out += ids[at : e["start"]]
        out += e["ids"]
        at = e["stop"]
    return out + ids[at:]


class Decoder:
    """Turns piece numbers into the text."""

    def __init__(self, vocabulary: dict):
        self.byte_of = {i: bytes([b]) for b, i in vocabulary["bytes"].items()}
        self.raw = {
            i: p.replace(SPACE_MARK, " ").encode("utf-8", "surrogatepass")
            for i, p in enumerate(vocabulary["pieces"])
            if i not in vocabulary["special"]
        }
        self.raw.update(self.byte_of)

    def decode(self, ids: list[int]) -> str:
        whole = b"".join([self.raw.get(i, b"") for i in ids])
        return whole.decode("utf-8", "replace").removeprefix(" ")


def decode(df: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """The rows with ``decoded``, the text of the pieces; null for null pieces."""
    shared = df.sparkSession.sparkContext.broadcast(Decoder(read_vocabulary(model)))

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        turn, column = shared.value.decode, batch.column(ids)
        texts = [
            turn(p.values.to_numpy(zero_copy_only=False).tolist()) if p.is_valid else None
            for p in column
        ]
        return {"decoded": pa.array(texts, pa.string())}

    def weigh(batch: pa.RecordBatch) -> list[int]:
        return [n or 0 for n in pc.list_value_length(batch.column(ids)).to_pylist()]

    return add_columns(df, add, "decoded string", weigh, SHARD_CHARS // 4)
