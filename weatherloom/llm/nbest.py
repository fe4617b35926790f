"""SentencePiece encoding with the N best segmentations, and decoding."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm import ngrams
from weatherloom.llm.common import tidy_map

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
NBEST = 3
_SPACE = "▁"
#: Stands for a space mark that is a character of the text; no text decoded from UTF-8 has it.
_LITERAL = "\ud800"
#: Pieces with a lower score are placeholders that no segmentation uses, but for those of nothing but spaces.
_LEAST_SCORE = -1e8
#: A character that no piece covers is spelled in bytes at this much below the lowest score.
_BYTE_PENALTY = 10.0
#: Bytes of text encoded at once, and table cells at once.
_STEP_BYTES = 1 << 21
_CELLS = 1 << 21
#: Longer stretches without a cut go through the search alone, one by one.
_LONGEST_TABLE = 48
_REMEMBERED = 20_000
#: Different stretches a worker remembers, about 50 bytes each; then it starts afresh.
_KNOWN = 300_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_EDIT = "struct<at:int,drop:int,put:array<int>>"
ENCODED = f"ids array<int>, n_tokens long, nbest array<struct<score:double,n_tokens:long,edits:array<{_EDIT}>>>"


class Vocabulary:
    """Pieces of a model, their scores, and which characters stand next to each other inside one."""

    def __init__(self, model: bytes):
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids: dict[str, tuple[int, float]] = {}
        self.byte_ids: dict[int, int] = {}
        texts: list[bytes] = []
        for i in range(processor.get_piece_size()):
            piece, score, text = processor.id_to_piece(i), processor.get_score(i), b""
            if processor.is_byte(i):
                text = bytes([int(piece[3:5], 16)])
                self.byte_ids[text[0]] = i
            elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)) and (score > _LEAST_SCORE or not piece.strip(_SPACE)):
                self.ids[piece] = (i, score)
                text = piece.replace(_SPACE, " ").encode()
            texts.append(text)
        self.longest = max(map(len, self.ids))
        self.unknown = min(score for _, score in self.ids.values() if score > _LEAST_SCORE) - _BYTE_PENALTY
        for piece, (i, score) in self.ids.items():  # one or many spaces are placeholders in some models, but text all the same
            self.ids[piece] = (i, max(score, self.unknown))
        self.sizes = np.array([len(t) for t in texts])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self._neighbours()
        self._tables()

    def _neighbours(self) -> None:
        several = [p for p in self.ids if len(p) > 1]
        chars = sorted({c for p in several for c in p})
        self.char_class = np.zeros(0x110000, np.int32)
        self.char_class[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.inside = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        pairs = np.array([(self.char_class[ord(a)], self.char_class[ord(b)]) for p in several for a, b in zip(p, p[1:])])
        self.inside[pairs[:, 0], pairs[:, 1]] = True

    def _tables(self) -> None:
        """Two open tables that find a piece by the hash of its characters."""
        powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(self.longest, _BASE))))
        self.powers = powers
        entries = list(self.ids.items())
        keys = np.zeros(len(entries), np.uint64)
        for n in range(1, self.longest + 1):
            own = [i for i, (p, _) in enumerate(entries) if len(p) == n]
            points = np.array([[ord(c) for c in entries[i][0]] for i in own], np.uint64).reshape(len(own), n)
            keys[own] = ((points + np.uint64(1)) * powers[:n]).sum(axis=1, dtype=np.uint64) + self.size_key(n)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces with one hash")
        self.table_keys = keys
        self.table_ids = np.array([i for _, (i, _) in entries], np.int32)
        self.table_scores = np.array([s for _, (_, s) in entries])
        left = np.arange(len(keys))
        self.tables = []
        shift = np.uint64(44)
        while len(left):
            slots = ngrams.mix(keys[left] + self.size_key(len(self.tables))) >> shift
            table = np.full(1 << 20, -1, np.int32)
            table[slots[::-1]] = left[::-1]
            self.tables.append(table)
            left = left[table[slots] != left]

    @staticmethod
    def size_key(n: int) -> np.uint64:
        """What the number of characters adds to a key."""
        return np.uint64(n * 0xD1B54A32D192ED03 & (1 << 64) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key, -1 if it is no piece."""
        out = np.full(keys.shape, -1, np.int32)
        for k, table in enumerate(self.tables):
            at = table[ngrams.mix(keys + self.size_key(k)) >> np.uint64(44)]
            hit = (at >= 0) & (self.table_keys[at] == keys)
            out[hit] = at[hit]
        return out

    def spelled(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in (_SPACE if char == _LITERAL else char).encode()]


def segmentations(vocabulary: Vocabulary, part: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` best (score, ids) of a stretch of text, best first.

    Forward: the best score up to every place (Viterbi). Backward: A-star from the end, each open path
    ranked by its own score plus the forward score of its place. That is exactly what the path can
    still reach, so paths come out in order of score. Ties go to the path nearer the start, then
    to the one found first.
    """
    size, pieces, longest = len(part), vocabulary.ids, vocabulary.longest
    best = [0.0] + [-np.inf] * size

    def ending(place: int) -> Iterator[tuple[int, tuple[int, ...], float]]:
        for a in range(max(place - longest, 0), place):
            found = pieces.get(part[a:place])
            if found is not None:
                yield a, (found[0],), found[1]
            elif a == place - 1:
                yield a, tuple(vocabulary.spelled(part[a])), vocabulary.unknown

    for b in range(1, size + 1):
        best[b] = max(best[a] + score for a, _, score in ending(b))
    open_paths: list[tuple] = [(-best[size], size, 0, 0.0, None)]
    count, out = 1, []
    while open_paths and len(out) < n:
        _, place, _, own, path = heapq.heappop(open_paths)
        if place == 0:
            ids: list[int] = []
            while path is not None:
                ids += path[0]
                path = path[1]
            out.append((own, tuple(ids)))
            continue
        for a, ids, score in ending(place):
            heapq.heappush(open_paths, (-(best[a] + own + score), a, count, own + score, (ids, path)))
            count += 1
    return out


def combined(choices: list[list[tuple[float, tuple[int, ...]]]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` best ways to take one of each; (score, index taken of each). Ties go to lower indices."""
    total = [(0.0, ())]
    for options in choices:
        both = [(-(s + o[0]), (*taken, i)) for s, taken in total for i, o in enumerate(options)]
        total = [(-s, taken) for s, taken in heapq.nsmallest(n, both)]
    return total


def best_paths(vocabulary: Vocabulary, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(best score, its loss to the second best, entries of the best path padded in front) of stretches of one length.

    ``points``: character x stretch, as are the entries. An entry below -1 is a character without a
    piece, as -2 - code point; padding is -1. Viterbi over all stretches at once, forward and
    backward: the second best path uses an edge off the best one, and the best path over an edge is
    known from both ways.
    """
    size, rows = points.shape
    reach = min(size, vocabulary.longest)
    found, scores = [], []
    letters = points.astype(np.uint64) + np.uint64(1)
    keys = np.zeros((size, rows), np.uint64)
    for n in range(1, reach + 1):
        keys = keys[: size - n + 1] + letters[n - 1 :] * vocabulary.powers[n - 1]
        at = vocabulary.find(keys + vocabulary.size_key(n))
        score = vocabulary.table_scores[at]
        if n == 1:
            score = np.where(at >= 0, score, vocabulary.unknown)
            at = np.where(at >= 0, at, -2 - points.astype(np.int32))
        else:
            score[at < 0] = -np.inf
        found.append(at)
        scores.append(score)
    ahead = np.full((size + 1, rows), -np.inf)
    ahead[0] = 0
    last = np.zeros((size + 1, rows), np.int8)
    for j in range(1, size + 1):
        for n in range(1, min(j, reach) + 1):
            score = ahead[j - n] + scores[n - 1][j - n]
            better = score >= ahead[j]  # ties go to the longer piece
            np.copyto(ahead[j], score, where=better)
            np.copyto(last[j], n, where=better)
    behind = np.full((size + 1, rows), -np.inf)
    behind[size] = 0
    for i in range(size - 1, -1, -1):
        for n in range(1, min(size - i, reach) + 1):
            np.maximum(behind[i], scores[n - 1][i] + behind[i + n], out=behind[i])
    best = ahead[size].copy()
    paths = np.full((size, rows), -1, np.int32)
    place, every, used = np.full(rows, size), np.arange(rows), size
    while (place > 0).any():
        used -= 1
        n = last[place, every].astype(np.int64)
        for k in np.unique(n[n > 0]):
            own = every[(n == k) & (place > 0)]
            paths[used, own] = found[k - 1][place[own] - k, own]
            scores[k - 1][place[own] - k, own] = -np.inf  # leaves the edges off the path
        place = np.where(place > 0, place - n, 0)
    second = np.full(rows, -np.inf)
    for n in range(1, reach + 1):
        over = ahead[: size - n + 1] + scores[n - 1] + behind[n:]
        np.maximum(second, over.max(axis=0), out=second)
    return best, best - second, paths


class Encoder:
    """Encodes texts stretch by stretch: no piece reaches over a place whose two characters meet in no piece."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._options: dict[tuple[str, int], list[tuple[float, tuple[int, ...]]]] = {}
        self.forget()

    def forget(self) -> None:
        self._options.clear()
        self._keys = np.zeros(0, np.uint64)  # in order, with the place of each in the arrays below
        self._place = np.zeros(0, np.int64)
        self._score, self._loss, self._size = np.zeros(0), np.zeros(0), np.zeros(0, np.int64)
        self._entries = np.zeros(0, np.int32)

    def _learn(self, points: np.ndarray, keys: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The places of the stretches with these different keys, which are remembered up to a fixed number."""
        if len(self._keys) > _KNOWN:
            self.forget()
        at = np.searchsorted(self._keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self._keys)
        known[inside] = self._keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            score, loss, entries, sizes = self._different(points, begin[new], length[new])
            place = len(self._score) + np.arange(len(new))
            self._score, self._loss = np.append(self._score, score), np.append(self._loss, loss)
            self._size, self._entries = np.append(self._size, sizes), np.append(self._entries, entries)
            order = np.argsort(np.append(self._keys, keys[new]), kind="stable")
            self._keys, self._place = np.append(self._keys, keys[new])[order], np.append(self._place, place)[order]
        return self._place[np.searchsorted(self._keys, keys)]

    def options(self, part: str, n: int, first: tuple[int, ...]) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best of ``part``; of equal ones ``first`` comes first."""
        if (part, n) not in self._options:
            if len(self._options) >= _REMEMBERED:
                self._options.clear()
            found = segmentations(self.vocabulary, part, n)
            rest = [x for x in found if x[1] != first]
            self._options[part, n] = [(found[0][0], first), *rest][:n]
        return self._options[part, n]

    def encode(self, data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, list[list[dict]]]:
        """(ids of the best segmentations, offsets of the rows in them, ``n`` best of each row)."""
        rows = len(offsets) - 1
        full = np.flatnonzero(np.diff(offsets))
        if not len(full):
            return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64), [[] for _ in range(rows)]
        points, starts = ngrams.code_points(data[offsets[0] : offsets[-1]], offsets[full] - offsets[0])
        space, literal = ord(_SPACE), ord(_LITERAL)
        points = np.where(points == space, literal, np.where(points == 32, space, points)).astype(np.uint32)
        points = np.insert(points, starts, space)
        starts = starts + np.arange(len(starts))
        known = self.vocabulary.char_class[points]
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.vocabulary.inside[known[:-1], known[1:]]
        cut[starts] = True
        begin = np.flatnonzero(cut)
        length = np.diff(np.append(begin, len(points)))
        up, down = ngrams.power_tables(len(points) + 1)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=sums[1:])
        keys = ngrams.mix((sums[begin + length] - sums[begin]) * down[begin]) + length.astype(np.uint64) * _BASE
        different, index, inverse = np.unique(keys, return_index=True, return_inverse=True)
        stretch = self._learn(points, different, begin[index], length[index])[inverse]
        at = np.cumsum(self._size) - self._size
        n_tokens = self._size[stretch]
        to = np.cumsum(n_tokens) - n_tokens
        ids = self._entries[np.repeat(at[stretch] - to, n_tokens) + np.arange(int(n_tokens.sum()))]
        first = np.append(np.searchsorted(begin, starts), len(begin))
        ends = np.append(to, len(ids))[first]
        out_offsets = np.zeros(rows + 1, np.int64)
        out_offsets[full + 1] = np.diff(ends)
        out_offsets = np.cumsum(out_offsets)
        totals = ngrams.segment_sums(self._score[stretch], np.diff(first))
        losses = self._loss[stretch]
        ranked: list[list[dict]] = [[] for _ in range(rows)]
        for k, row in enumerate(full.tolist()):
            a, b = int(first[k]), int(first[k + 1])
            # Where n - 1 other stretches lose less by changing, a change of this one is not among the n best.
            part = losses[a:b]
            if n > 1 and b - a > n - 1:
                bound = np.partition(part, n - 2)[n - 2]
                near = np.flatnonzero(part < bound)
                near = np.sort(np.append(near, np.flatnonzero(part == bound)[: n - 1 - len(near)]))
            else:
                near = np.arange(b - a) if n > 1 else np.zeros(0, np.int64)
            near = [a + int(i) for i in near if np.isfinite(part[i])]
            choices = []
            for i in near:
                text = "".join(map(chr, points[begin[i] : begin[i] + length[i]].tolist()))
                choices.append(self.options(text, n, tuple(ids[to[i] : to[i] + n_tokens[i]].tolist())))
            base = float(totals[k]) - sum(c[0][0] for c in choices)
            whole = int(ends[k + 1] - ends[k])
            for total, taken in combined(choices, n):
                edits, changed = [], whole
                for i, choice, which in zip(near, choices, taken):
                    if which:
                        edits.append({"at": int(to[i] - ends[k]), "drop": int(n_tokens[i]), "put": list(choice[which][1])})
                        changed += len(choice[which][1]) - int(n_tokens[i])
                ranked[row].append({"score": base + total, "n_tokens": changed, "edits": edits})
        return ids, out_offsets, ranked

    def _different(self, points: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(score, loss to the second best, ids one after another, ids of each) of different stretches."""
        v = self.vocabulary
        score, loss = np.zeros(len(begin)), np.zeros(len(begin))
        where, what, place = [], [], []
        for size in np.unique(length).tolist():
            own = np.flatnonzero(length == size)
            if size > _LONGEST_TABLE:
                for i in own.tolist():
                    found = segmentations(v, "".join(map(chr, points[begin[i] : begin[i] + size].tolist())), 2)
                    score[i], loss[i] = found[0][0], found[0][0] - found[1][0] if len(found) > 1 else np.inf
                    where.append(np.full(len(found[0][1]), i))
                    place.append(np.arange(len(found[0][1])))
                    what.append(np.array(found[0][1], np.int32))
                continue
            step = max(1, _CELLS // (size * min(size, v.longest)))
            for k in range(0, len(own), step):
                some = own[k : k + step]
                score[some], loss[some], paths = best_paths(v, points[begin[some][None, :] + np.arange(size)[:, None]])
                column, row = np.nonzero(paths != -1)
                entry = paths[column, row]
                ids, repeats = v.table_ids[np.maximum(entry, 0)], np.ones(len(entry), np.int64)
                for e in np.unique(entry[entry < -1]).tolist():
                    repeats[entry == e] = len(v.spelled(chr(-2 - e)))
                within = np.arange(int(repeats.sum())) - np.repeat(np.cumsum(repeats) - repeats, repeats)
                ids, spread = np.repeat(ids, repeats), np.repeat(entry, repeats)
                for e in np.unique(entry[entry < -1]).tolist():
                    chosen = spread == e
                    ids[chosen] = np.array(v.spelled(chr(-2 - e)), np.int32)[within[chosen]]
                where.append(np.repeat(some[row], repeats))
                place.append(np.repeat(column, repeats) * 4 + within)
                what.append(ids)
        where, place, what = np.concatenate(where), np.concatenate(place), np.concatenate(what)
        order = np.lexsort((place, where))
        return score, loss, what[order].astype(np.int32), np.bincount(where, minlength=len(begin))

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ``ids`` in UTF-8: piece bytes gathered at once, without the space before the first word."""
        v = self.vocabulary
        sizes = v.sizes[ids]
        within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        text = v.bytes[np.repeat(v.starts[ids], sizes) + within].tobytes()
        return text[1:] if text.startswith(b" ") else text


@lru_cache(maxsize=2)
def _encoder(model: bytes) -> Encoder:
    return Encoder(Vocabulary(model))


def read_model(path: str = MODEL_PATH) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NBEST, model_path: str = MODEL_PATH) -> DataFrame:
    """doc_id, ENCODED and round_trip of every row, whole texts.

    ids: the segmentation with the highest sum of piece scores, which under a BPE model, whose scores are ranks of
    merges, is not what the library's encode gives (README has the figures); characters without a piece, and a
    literal space mark, are spelled in byte pieces, so decoding gives the text back exactly, which
    round_trip says. nbest: up to ``n`` segmentations, best first, each as edits of ids (at, drop, put), in
    order of place. Null and empty texts have no ids and no segmentation; a null text comes back
    as an empty one. Rows repeat as in the input, extra columns are ignored. The model file is read
    by the driver and broadcast.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        step = pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("put", pa.list_(pa.int32()))])
        kind = pa.list_(pa.struct([("score", pa.float64()), ("n_tokens", pa.int64()), ("edits", pa.list_(step))]))
        names = ["doc_id", "ids", "n_tokens", "nbest", "round_trip"]
        for batch in batches:
            data, offsets = ngrams.text_bytes(batch.column(1))
            for rows in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(offsets[:-1] // _STEP_BYTES)) + 1) if len(batch) else []:
                a, b = int(rows[0]), int(rows[-1]) + 1
                ids, ends, ranked = encoder.encode(data, offsets[a : b + 1], n)
                same = [encoder.decode(ids[ends[i] : ends[i + 1]]) == data[offsets[a + i] : offsets[a + i + 1]].tobytes() for i in range(b - a)]
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                arrays = [batch.column(0).slice(a, b - a), lists, pa.array(np.diff(ends)), pa.array(ranked, kind), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(arrays, names)
        encoder.forget()

    return tidy_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id long, {ENCODED}, round_trip boolean")


def decoded(rows: DataFrame, key_col: str = "doc_id", ids_col: str = "ids", model_path: str = MODEL_PATH) -> DataFrame:
    """(key, text) of every row; null or no ids give an empty text."""
    model = rows.sparkSession.sparkContext.broadcast(read_model(model_path))
    field = rows.schema[key_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        for batch in batches:
            texts = [encoder.decode(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key_col, "text"])

    return rows.select(key_col, ids_col).mapInArrow(run, f"`{key_col}` {field.dataType.simpleString()}, text string")
