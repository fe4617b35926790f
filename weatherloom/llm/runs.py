"""Periodic runs of words: block convolution at dyadic scales finds where blocks come again, distances seed extensions.

A run with smallest period q holds, in its words but the last q, a block of B words on the grid of multiples
of B, for the power of two B with 2 B - 1 <= q <= 4 B - 2. So at each scale B every block is compared with the
windows that follow it, at all those distances at once: the sums of squared differences of block and window are a
convolution, taken exactly in the integers modulo a prime by number-theoretic transforms. A sum of
zero is a seed; the words around it are compared themselves, so a chance zero is no run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm import ngrams
from weatherloom.llm.common import tidy_map

MIN_WORDS = 12
#: Words of a block that are convolved: blocks of longer scales are located by their first words.
BLOCK_WORDS = 64
#: Distances that one transform answers for blocks of BLOCK_WORDS.
_TILE = 3 * BLOCK_WORDS
#: 7 * 2**20 + 1, and 3 generates its units. Sums of 256 products of centred residues stay below 2**53, so that
#: transforms by matrix products of doubles are exact.
PRIME = 7 * (1 << 20) + 1
_GENERATOR = 3
_TEXT_BYTES = 1 << 21
_CHUNK = 2048
_STEPS = 32
_PROBES = 8
_NEVER = np.iinfo(np.int64).max


def _centred(x: np.ndarray) -> np.ndarray:
    return x - PRIME * np.rint(x / PRIME)


@lru_cache
def transforms(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forward, forward of the reversed input, inverse) matrices of the transform modulo PRIME; size is a power of two."""
    root = pow(_GENERATOR, (PRIME - 1) // size, PRIME)
    powers = np.array([pow(root, i, PRIME) for i in range(size)], np.int64)
    at = np.outer(np.arange(size), np.arange(size)) % size
    forward, backward = powers[at], powers[-at % size]
    inverse = backward * pow(size, PRIME - 2, PRIME) % PRIME
    return tuple(_centred(m.astype(float)) for m in (forward, backward, inverse))


def correlations(blocks: np.ndarray, windows: np.ndarray, distances: int) -> np.ndarray:
    """Sums over k of blocks[:, k] * windows[:, k + d] modulo PRIME, centred, for the first ``distances`` shifts d."""
    forward, reversed_, inverse = transforms(windows.shape[1])
    product = _centred(_centred(blocks @ reversed_[: blocks.shape[1]]) * _centred(windows @ forward))
    return _centred(product @ inverse[:, :distances])


def _scale(scale: int) -> tuple[int, int, int]:
    """(words convolved, least distance, distances) of the blocks of ``scale`` words, a power of two from 2 on."""
    least = 1 if scale == 2 else 2 * scale - 1
    return min(scale, BLOCK_WORDS), least, 4 * scale - 1 - least


def seeds(seq: np.ndarray, scale: int, again: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of blocks of one scale that come again at a distance of that scale, by convolution.

    ``again`` is the distance to the next place of the pair of words at each place: a block with a pair that
    does not come again within the scale's distances cannot, and is left out.
    """
    length, least, distances = _scale(scale)
    blocks = len(again) // scale
    nearest = again[: blocks * scale].reshape(blocks, scale)[:, : length - 1].max(axis=1)
    starts = np.flatnonzero(nearest < least + distances) * scale
    none = np.zeros(0, np.int64)
    if not len(starts):
        return none, none
    size = 4 * length
    tile = min(_TILE, distances)
    tiles = -(-distances // tile)
    # words as residues, and numbers that no word has behind the end
    value = np.concatenate((seq, -(1 << 40) - np.arange(least + tiles * tile + size)))
    value = ((value * 0x9E3779B1 & 0xFFFFFFFF) * 0x85EBCA6B >> 7) % PRIME
    square = value * value % PRIME
    value = _centred(value.astype(float))
    sums = np.concatenate(([0], np.cumsum(square)))
    energy = ((sums[length:] - sums[:-length]) % PRIME).astype(float)
    windows = np.lib.stride_tricks.sliding_window_view(value, size)
    energies = np.lib.stride_tricks.sliding_window_view(energy, tile)
    places, found = [], []
    for first in range(0, len(starts), _CHUNK):
        at = starts[first : first + _CHUNK]
        block = value[at[:, None] + np.arange(length)]
        for t in range(tiles):
            begin = at + least + t * tile
            mismatch = energy[at][:, None] + energies[begin] - 2 * correlations(block, windows[begin], tile)
            row, shift = np.nonzero(_centred(mismatch) == 0)
            distance = shift + (least + t * tile)
            inside = distance < least + distances
            places.append(at[row[inside]])
            found.append(distance[inside])
    return np.concatenate(places), np.concatenate(found)


def _next_places(seq: np.ndarray) -> np.ndarray:
    """For each place the distance to the next place where the same two words stand."""
    low = seq.min()
    pairs = (seq[:-1] - low) * (int(seq.max() - low) + 1) + (seq[1:] - low)
    order = np.argsort(pairs, kind="stable")
    same = pairs[order[1:]] == pairs[order[:-1]]
    out = np.full(len(seq), _NEVER)
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def _reach(seq: np.ndarray, at: int, distance: int, step: int) -> int:
    """How many words from ``at`` on, in the direction of ``step``, equal those ``distance`` further on."""
    done, width = 0, 64
    while True:
        if step > 0:
            a = seq[at + done : min(at + done + width, len(seq) - distance)]
            b = seq[at + done + distance : at + done + distance + len(a)]
        else:
            low = max(at - done - width + 1, 0)
            a, b = seq[low : at - done + 1][::-1], seq[low + distance : at - done + 1 + distance][::-1]
        different = np.flatnonzero(a != b)
        if len(different):
            return done + int(different[0])
        done += len(a)
        if len(a) < width:
            return done
        width *= 2


def _extended(seq: np.ndarray, place: np.ndarray, distance: np.ndarray, length: int, min_words: int) -> list[tuple[int, int, int]]:
    """(start, end, distance) of the maximal stretches around seeds that are long enough to be runs."""
    order = np.lexsort((place, distance))
    place, distance = place[order], distance[order]
    low, high = place.copy(), place + length  # compared words: [low, high) equals [low + distance, high + distance)
    sure = np.ones(len(place), bool)
    for k in range(length):
        sure &= seq[place + k] == seq[place + distance + k]
    # a run reaches from the seed over half of what it must compare, to the right or to the left
    half = np.maximum(min_words - distance, distance) // 2
    right, left = sure.copy(), sure
    for k in range(1, _PROBES + 1):
        step = half * k // _PROBES
        right &= place + step + distance < len(seq)
        right[right] = seq[(place + step)[right]] == seq[(place + step + distance)[right]]
        left &= place >= step
        left[left] = seq[(place - step)[left]] == seq[(place - step + distance)[left]]
    sure = left | right
    place, distance, low, high = place[sure], distance[sure], low[sure], high[sure]
    down, up = np.arange(len(place)), np.arange(len(place))
    for _ in range(_STEPS):
        down = down[low[down] > 0]
        down = down[seq[low[down] - 1] == seq[low[down] - 1 + distance[down]]]
        low[down] -= 1
        up = up[high[up] + distance[up] < len(seq)]
        up = up[seq[high[up]] == seq[high[up] + distance[up]]]
        high[up] += 1
    open_ = np.zeros(len(place), bool)
    open_[down] = open_[up] = True
    enough = open_ | (high - low + distance >= np.maximum(min_words, 2 * distance))
    out, last = [], (-1, 0, 0)
    for at, d, a, b, more in zip(*(x[enough].tolist() for x in (place, distance, low, high, open_))):
        if last[0] == d and last[1] <= at < last[2]:
            continue
        if more:
            b += _reach(seq, b, d, 1)
            a -= _reach(seq, a - 1, d, -1) if a else 0
        last = (d, a, b)
        if b - a + d >= max(min_words, 2 * d):
            out.append((a, b + d, d))
    return out


def runs(seq: np.ndarray, longest: int, min_words: int = MIN_WORDS) -> np.ndarray:
    """(start, end, period) rows, sorted by start and period, of all runs of ``seq``; ``longest`` bounds their length.

    A run is a stretch of consecutive numbers with smallest period q and a length of at least
    max(min_words, 2 q), which no neighbour extends. Multiples of a period give the same stretch; the
    least stays. ``min_words`` is at least 12, which the scales rely on.
    """
    if min_words < MIN_WORDS:
        raise ValueError("min_words")
    found: dict[tuple[int, int], int] = {}
    if longest < min_words or len(seq) < min_words:
        return np.zeros((0, 3), np.int64)
    again = _next_places(seq)
    scale = 2
    while _scale(scale)[1] * 2 <= longest:
        place, distance = seeds(seq, scale, again)
        if len(place) and found:  # a multiple of the period of a run that covers the seed finds the same run again
            known = np.array(sorted((a, b, d) for (a, b), d in found.items()), np.int64)
            ends = np.maximum.accumulate(known[:, 1])
            farthest = np.maximum.accumulate(np.where(np.diff(ends, prepend=-1) > 0, np.arange(len(known)), 0))
            at = np.searchsorted(known[:, 0], place, "right") - 1
            by = known[farthest[np.maximum(at, 0)]]
            new = (at < 0) | (by[:, 1] < place + distance + _scale(scale)[0]) | (distance % by[:, 2] != 0)
            place, distance = place[new], distance[new]
        if len(place):
            for a, b, d in _extended(seq, place, distance, _scale(scale)[0], min_words):
                found[a, b] = min(d, found.get((a, b), d))
        scale *= 2
    return np.array(sorted((a, d, b) for (a, b), d in found.items()), np.int64).reshape(-1, 3)[:, [0, 2, 1]]


def planted(n: int, doc_id: int | None) -> np.ndarray | None:
    """Word numbers of the sequence that stands for a text of ``n`` words; None if it stays as it is.

    Of each tenth text, by crc32 of the decimal doc_id, the words from a on repeat with a period p. A null id has none.
    """
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def word_ids(data: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """(words as dictionary array, first byte, byte after the last) of bytes that ``inside`` marks; words end at row starts too."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    first[starts] = inside[starts]
    last[:-1] &= ~inside[1:]
    last[starts[1:] - 1] = inside[starts[1:] - 1]
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    ends = np.zeros(len(a) + 1, np.int64)
    np.cumsum(b - a, out=ends[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(a), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
    return words.dictionary_encode(), a, b


def row_groups(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(first row, row after the last) of whole rows of about ``limit`` bytes together."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        last = min(max(int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1, row + 1), rows)
        yield row, last
        row = last


_COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _judged(ids: list[int | None], data: np.ndarray, offsets: np.ndarray, plant: bool, min_words: int) -> list[tuple]:
    """The columns of _COLUMNS for rows of text."""
    rows = len(offsets) - 1
    base = int(offsets[0])
    chunk = data[base : int(offsets[-1])]
    if len(chunk):
        starts = offsets[:-1][np.diff(offsets) > 0] - base
        words, first, _ = word_ids(chunk, starts, ~ngrams.WHITE[chunk])
        number = words.indices.to_numpy().astype(np.int64)
        bounds = np.searchsorted(first, offsets - base)
    else:
        words, number, bounds = None, np.zeros(0, np.int64), np.zeros(rows + 1, np.int64)
    if plant:
        for r in range(rows):
            if (moved := planted(int(bounds[r + 1] - bounds[r]), ids[r])) is not None:
                own = slice(bounds[r], bounds[r + 1])
                number[own] = number[own][moved]
    counts = np.diff(bounds)
    walls = bounds + np.arange(rows + 1)  # one number of its own before each row and behind the last
    seq = np.empty(len(number) + rows + 1, np.int64)
    seq[walls] = -1 - np.arange(rows + 1)
    spoken = np.ones(len(seq), bool)
    spoken[walls] = False
    seq[spoken] = number
    found = runs(seq, int(counts.max()), min_words)
    depth = np.zeros(len(seq) + 1, np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.add.at(depth, found[:, 1], -1)
    kept = (np.cumsum(depth)[:-1] == 0)[spoken]
    row_of = np.searchsorted(walls, found[:, 0], "right") - 1
    edges = np.searchsorted(row_of, np.arange(rows + 1))
    if words is not None:
        left = words.dictionary.take(pa.array(number[kept]))
        lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(kept)))[bounds]), left)
        texts = pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))
    out = []
    for r in range(rows):
        own = found[edges[r] : edges[r + 1]] - [walls[r] + 1, walls[r] + 1, 0]
        listed = "".join(f"{a},{b - a},{q}\n" for a, b, q in own.tolist())
        best = min(((a - b, a, q) for a, b, q in own.tolist()), default=None)
        top = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        joined = texts[r].as_buffer() if words is not None else b""
        out.append((len(own), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(joined).hexdigest()))
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256.

    Words are what ASCII white space separates, counted from 0. A word is dropped if a run contains it after that
    run's first period; collapsed_sha256 digests the kept words joined by one space, runs_sha256 the lines
    ``start,length,period``. The longest run of equals is that with the smallest start, then period; without runs
    its four columns are null. A null text has no words, like an empty or blank one: no runs, and the digests of
    nothing. ``plant`` puts a repetition into each tenth text, by its id, as ``planted`` says; a null id
    has none. Repeated rows stay repeated, an empty table gives no rows, extra columns are ignored. Each text is
    judged whole and alone, so rows are not shuffled.
    """
    fields = [f.split() for f in _COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = ngrams.text_bytes(batch.column(1))
            for a, b in row_groups(offsets, _TEXT_BYTES):
                columns = zip(*_judged(ids[a:b], data, offsets[a : b + 1], plant, min_words))
                arrays = [pa.array(c, pa.int64() if f[1] == "long" else pa.string()) for c, f in zip(columns, fields)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b], pa.int64()), *arrays], ["doc_id", *(f[0] for f in fields)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return tidy_map(rows, run, f"doc_id long, {_COLUMNS}")
