"""Vectorised hashed n-grams over Arrow text columns: whole texts, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes worked on at once. A longer text is cut after white space, never inside a word; :func:`counted` adds what spans a cut.
PIECE_BYTES = 1 << 20
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_STEPS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
#: Hash of a pair of equal words, whatever the word.
_REPEAT = np.uint64(0x5851F42D4C957F2D)
_powers: tuple[np.ndarray, np.ndarray] | None = None


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; a null row is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), ends


def _cut(data: np.ndarray, start: int, limit: int) -> int:
    """Where to cut a long text that goes on from ``start``: after the last white space within ``limit`` bytes, else after the first."""
    white = np.flatnonzero(WHITE[data[start : start + limit]])
    if len(white):
        return start + int(white[-1]) + 1
    at = start + limit
    while at < len(data):
        white = np.flatnonzero(WHITE[data[at : at + limit]])
        if len(white):
            return at + int(white[0]) + 1
        at += limit
    return len(data)


def _cuts(data: np.ndarray, at: int, end: int, limit: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the pieces of the text data[at:end]."""
    while at < end:
        to = end if end - at <= limit else _cut(data[:end], at, limit)
        yield at, to
        at = to


def pieces(data: np.ndarray, offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, where segments start in them, their rows): whole rows up to ``limit``, longer ones cut. Empty rows do not appear."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        first, last = row, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        last = min(max(last, row + 1), rows)
        if last == row + 1 and offsets[last] - offsets[row] > limit:
            for at, to in _cuts(data, int(offsets[row]), int(offsets[last]), limit):
                yield data[at:to], np.zeros(1, np.int64), np.array([row])
        else:
            own = np.arange(first, last)
            own = own[offsets[first + 1 : last + 1] > offsets[first:last]]
            if len(own):
                yield data[offsets[first] : offsets[last]], offsets[own] - offsets[first], own
        row = last


def crossings(data: np.ndarray, offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, piece before the cut, all of the text behind it) for every cut that :func:`pieces` makes."""
    for row in np.flatnonzero(np.diff(offsets) > limit).tolist():
        end = int(offsets[row + 1])
        for at, to in _cuts(data, int(offsets[row]), end, limit):
            if to < end:
                yield row, data[at:to], data[to:end]


def _next(data: np.ndarray, at: int, white: bool) -> int:
    """The first place from ``at`` on that is white space, or is none; the end if there is no such place."""
    while at < len(data):
        found = np.flatnonzero(WHITE[data[at : at + 4096]] == white)
        if len(found):
            return at + int(found[0])
        at += 4096
    return len(data)


def crossing_words(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The last word before a cut and the first one behind it; empty if one of them is missing."""
    inside = np.flatnonzero(~WHITE[before])
    start = _next(after, 0, False)
    if not len(inside) or start == len(after):
        return before[:0]
    last = before[: inside[-1] + 1]
    gaps = np.flatnonzero(WHITE[last])
    last = last[gaps[-1] + 1 :] if len(gaps) else last
    return np.concatenate([last, np.array([0x20], np.uint8), after[start : _next(after, start, True)]])


def crossing_grams(before: np.ndarray, after: np.ndarray, n: int) -> np.ndarray:
    """Bytes whose n-grams are those that start in the piece before a cut and end behind the cut."""
    tail, head = before[max(len(before) - 4 * (n - 1), 0) :], after[: 4 * (n - 1) + 1]
    first, last = (np.flatnonzero(part & 0xC0 != 0x80) for part in (tail, head))
    if n < 2 or not len(first):
        return before[:0]
    return np.concatenate([tail[first[max(len(first) - n + 1, 0)] :], head[: last[n - 1]] if len(last) >= n else head])


def power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < size:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        up, down = np.full(size, _BASE), np.full(size, inverse)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def words(chunk: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hashes of the words, first byte, byte after the last) of a piece; words end at white space and at segment ends."""
    inside = ~WHITE[chunk]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[starts] = inside[starts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[starts[1:] - 1] = inside[starts[1:] - 1]
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = power_tables(max(len(chunk), PIECE_BYTES) + 1)
    sums = np.zeros(len(chunk) + 1, np.uint64)
    np.cumsum((chunk.astype(np.uint64) + np.uint64(1)) * up[: len(chunk)], out=sums[1:])
    return mix((sums[b] - sums[a]) * down[a]), a, b


def word_counts(first: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Words of each segment."""
    return np.diff(np.searchsorted(first, np.append(starts, size)))


def word_pairs(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of neighbouring words, pairs of each segment). Two equal words have one hash, whatever the word."""
    if len(hashes) < 2:
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    pair = mix(hashes[:-1] * _BASE + hashes[1:])
    pair[hashes[:-1] == hashes[1:]] = _REPEAT
    keep = np.ones(len(pair), bool)
    ends = np.cumsum(counts)
    ends = ends[(ends > 0) & (ends < len(hashes))]
    keep[ends - 1] = False
    return pair[keep], np.maximum(counts - 1, 0)


def code_points(chunk: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a piece and where its segments start in them."""
    lead = np.zeros(len(chunk) + 1, np.int64)
    np.cumsum((chunk & 0xC0) != 0x80, out=lead[1:])
    points = np.frombuffer(chunk.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) != lead[-1]:  # bytes that are no UTF-8
        points = chunk[(chunk & 0xC0) != 0x80].astype(np.uint32)
    return points, lead[starts]


def grams(points: np.ndarray, starts: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every n-gram, n-grams of each segment); ``buckets`` is a power of two."""
    lengths = np.diff(np.append(starts, len(points)))
    counts = np.maximum(lengths - n + 1, 0)
    total = len(points) - n + 1
    if total <= 0:
        return np.zeros(0, np.int64), counts
    h = points[:total] * _STEPS[0]
    for j in range(1, n):
        h = (h ^ (h >> np.uint32(15))) * _STEPS[j] + points[j : j + total] * _STEPS[0]
    h = (h ^ (h >> np.uint32(13))) * _STEPS[3]
    keep = np.ones(total, bool)
    for j in range(1, n):
        crossing = starts[1:] - j
        keep[crossing[(crossing >= 0) & (crossing < total)]] = False
    return (h[keep] >> np.uint32(33 - buckets.bit_length())).astype(np.int64), counts


def bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(65 - buckets.bit_length())).astype(np.int64)


def segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``counts`` values; an empty run sums to zero."""
    ends = np.cumsum(counts)
    sums = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=sums[1:])
    return sums[ends] - sums[ends - counts]


#: The n-gram families of the quality operators.
FAMILIES = ("word", "pair", "gram")


def families(chunk: np.ndarray, starts: np.ndarray, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of FAMILIES: (buckets, n-grams of each segment). Words, pairs of words, three characters."""
    hashes, first, _ = words(chunk, starts)
    counts = word_counts(first, starts, len(chunk))
    pair, pairs = word_pairs(hashes, counts)
    points, at = code_points(chunk, starts)
    return [(bucket(hashes, buckets), counts), (bucket(pair, buckets), pairs), grams(points, at, 3, buckets)]


def counted(data: np.ndarray, offsets: np.ndarray, buckets: int, limit: int = PIECE_BYTES) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """(rows, their FAMILIES) of the pieces, then of what spans their cuts: each n-gram of each whole text once, whatever the limit."""
    for chunk, starts, own in pieces(data, offsets, limit):
        yield own, families(chunk, starts, buckets)
    start, none = np.zeros(1, np.int64), (np.zeros(0, np.int64), np.zeros(1, np.int64))
    for row, before, after in crossings(data, offsets, limit):
        parts = [before[:0], crossing_words(before, after), crossing_grams(before, after, 3)]
        yield np.array([row]), [families(part, start, buckets)[f] if len(part) else none for f, part in enumerate(parts)]


def mean_weights(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, limit: int = PIECE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(mean weight of the row's n-grams, n-grams) by family and row; zero without n-grams. ``weights``: family x bucket."""
    rows = len(offsets) - 1
    sums, counts = np.zeros((len(weights), rows)), np.zeros((len(weights), rows))
    for own, found in counted(data, offsets, weights.shape[1], limit):
        for f, (index, n) in enumerate(found):
            sums[f, own] += segment_sums(weights[f][index], n)
            counts[f, own] += n
    return sums / np.maximum(counts, 1), counts
