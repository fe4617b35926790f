"""Phrase collocations: n-grams counted with a bidirectional FM-index per shard, summed across shards, scored by their cuts.

A shard is a bounded stretch of one language's words, with a break between pieces. Its index over word ids holds the
Burrows-Wheeler transforms of the shard and of its reverse; extending the intervals of all phrases by one
word on either side gives the longer phrases with their counts. Depth-limited: suffixes are sorted by the words
that the longest phrase needs, no further.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.llm import ngrams
from weatherloom.llm.common import tidy_map, written
from weatherloom.llm.runs import row_groups, word_ids

MAX_WORDS = 3
MIN_COUNT = 10
TOP = 2000
#: A candidate goes if a longer one around it has at least this percentage of its count.
COVERED_PERCENT = 50
NO_LANG = "und"
SHARD_WORDS = 1 << 20
#: Log2 of the buckets in which hashed shorter phrases are counted to leave out longer ones that cannot be frequent.
SKETCH_BITS = 27
_BITMAP = 1 << 15
_TEXT_BYTES = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)

_BETWEEN, _BREAK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BETWEEN
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


class FMIndex:
    """Bidirectional index over word ids 0 .. size - 1 that ends and breaks with the id ``size``; right for phrases of up to ``depth`` + 1 words."""

    def __init__(self, ids: np.ndarray, size: int, depth: int):
        self.size = size
        self.first = np.concatenate(([0], np.cumsum(np.bincount(ids, minlength=size + 1))))
        self.ids, self.depth = ids, depth
        self.sides: dict[bool, tuple[np.ndarray, np.ndarray]] = {}

    def _side(self, left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(word before each suffix in suffix order, row of the suffix that begins with it); made when first asked for."""
        if left not in self.sides:
            self.sides[left] = self._transform(self.ids if left else self.ids[::-1], self.depth)
        return self.sides[left]

    def _transform(self, ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(ids, kind="stable")
        for _ in range(depth - 1):  # suffixes sorted by d words, each with the word before it, are those by d + 1
            before = order - 1
            before[before < 0] = len(ids) - 1
            order = before[np.argsort(ids[before], kind="stable")]
        before = ids[order - 1]
        to_first = np.empty(len(ids), np.int64)
        to_first[np.argsort(before, kind="stable")] = np.arange(len(ids))
        return before, to_first

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(phrases, starts of their intervals in both orders, counts): one row per word."""
        count = np.diff(self.first)[: self.size]
        ids = np.flatnonzero(count)
        return ids[:, None], self.first[ids], self.first[ids], count[ids]

    def extended(self, phrases: np.ndarray, forward: np.ndarray, reverse: np.ndarray, count: np.ndarray, left: bool) -> tuple[np.ndarray, ...]:
        """All phrases one word longer, on the left or on the right, with intervals and counts as in ``words``."""
        before, to_first = self._side(left)
        own, other = (forward, reverse) if left else (reverse, forward)
        ends = np.cumsum(count)
        row = np.repeat(own - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
        interval = np.repeat(np.arange(len(count)), count)
        word = before[row].astype(np.int64)
        key = interval * (self.size + 1) + word
        order = np.argsort(key, kind="stable")
        key, row = key[order], row[order]
        at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        times = np.diff(np.append(at, len(key)))
        interval, word = key[at] // (self.size + 1), key[at] % (self.size + 1)
        # words smaller than this one in the interval shift the interval of the other order
        shifted = other[interval] + at - (ends - count)[interval]
        stepped = to_first[row[at]]
        keep = word < self.size
        interval, word, times, shifted, stepped = (x[keep] for x in (interval, word, times, shifted, stepped))
        side = [word[:, None], phrases[interval]] if left else [phrases[interval], word[:, None]]
        longer = np.concatenate(side, axis=1)
        return (longer, stepped, shifted, times) if left else (longer, shifted, stepped, times)


class _Sketch:
    """Which buckets of hashed phrases are frequent, for each length so far; phrases in other buckets are not."""

    def __init__(self, bits: int):
        self.bits, self.maps = bits, {}

    def bucket(self, hashes: np.ndarray, lang: int) -> np.ndarray:
        """Bucket of phrases given as rows of word hashes."""
        h = np.full(len(hashes), lang, np.uint64)
        for column in hashes.T:
            h = ngrams.mix((h ^ column) * _BASE + np.uint64(1))
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def frequent(self, hashes: np.ndarray, lang: int) -> np.ndarray:
        bits = self.maps.get(hashes.shape[1])
        if bits is None:
            return np.ones(len(hashes), bool)
        at = self.bucket(hashes, lang)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _shard_phrases(ids: np.ndarray, size: int, hashes: np.ndarray, lang: int, depth: int, sketch: _Sketch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrases, counts) of one shard for each length up to ``depth``; a phrase of which the sketch excludes a part is left out.

    Words are extended to the left first, then to the right and so on.
    """
    good = np.append(sketch.frequent(hashes[:, None], lang), False)
    ids = np.where(good[ids], ids, size)
    index = FMIndex(ids, size, max(depth - 1, 1))
    level = index.words()
    yield level[0], level[3]
    for words in range(2, depth + 1):
        level = index.extended(*level, left=words % 2 == 0)
        fine = sketch.frequent(hashes[level[0]], lang)
        if words > 2:
            fine &= sketch.frequent(hashes[level[0][:, 1:]], lang) & sketch.frequent(hashes[level[0][:, :-1]], lang)
        level = tuple(x[fine] for x in level)
        yield level[0], level[3]


def _word_hashes(dictionary: pa.Array) -> np.ndarray:
    """64-bit hashes of the words; equal hashes of different words only make a bucket fuller."""
    data, offsets = (np.frombuffer(b, k) for b, k in zip(dictionary.buffers()[:0:-1], (np.uint8, np.int64)))
    offsets = offsets[: len(dictionary) + 1]
    out = (offsets[1:] - offsets[:-1]).astype(np.uint64)
    for first in range(0, len(dictionary), 1 << 16):
        ends = offsets[first : first + (1 << 16) + 1]
        part = data[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
        place = np.arange(len(part)) - np.repeat(ends[:-1] - ends[0], np.diff(ends))
        mixed = ngrams.mix((part + place.astype(np.uint64) * np.uint64(256)) * _BASE)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(mixed)))
        out[first : first + (1 << 16)] += sums[ends[1:] - ends[0]] - sums[ends[:-1] - ends[0]]
    return ngrams.mix(out * _BASE + np.uint64(7))


def _lang_mark(lang: str) -> int:
    return int(_word_hashes(pa.array([lang.encode()], pa.large_binary()))[0])


def _shards(batches: Iterator[pa.RecordBatch], shard_words: int) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """(language, words, ids with breaks) of every shard of a task: whole texts of one language, about ``shard_words`` words."""
    held: dict[str, list] = {}
    sizes: dict[str, int] = {}

    def flushed(lang: str) -> tuple[str, pa.Array, np.ndarray]:
        parts = held.pop(lang)
        del sizes[lang]
        words = pa.chunked_array([p[0] for p in parts]).combine_chunks()
        broken = np.concatenate([p[1] for p in parts])
        encoded = words.dictionary_encode()
        ids = np.full(len(words) + int(broken.sum()), len(encoded.dictionary), np.int32)
        ids[np.arange(len(words)) + np.cumsum(broken) - broken] = encoded.indices.to_numpy()
        return lang, encoded.dictionary, ids

    for batch in batches:
        langs = pc.fill_null(batch.column(0), NO_LANG).dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column(1).filter(pc.equal(langs.indices, code))
            data, offsets = ngrams.text_bytes(texts)
            for a, b in row_groups(offsets, _TEXT_BYTES):
                found = _tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                if found is None:
                    continue
                held.setdefault(lang, []).append(found)
                sizes[lang] = sizes.get(lang, 0) + len(found[0])
                if sizes[lang] >= shard_words:
                    yield flushed(lang)
                elif sum(sizes.values()) >= 2 * shard_words:
                    yield flushed(max(sizes, key=sizes.get))
    for lang in list(held):
        yield flushed(lang)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray] | None:
    """(lower-cased words, whether a piece ends after each) of rows of text; None without words."""
    if not len(data):
        return None
    data = _LOWER[data]
    kind = _KIND[data]
    starts = offsets[:-1][np.diff(offsets) > 0]
    words, a, b = word_ids(data, starts, kind == 0)
    if not len(a):
        return None
    walls = np.concatenate(([0], np.cumsum(kind == _BREAK)))
    rows = np.searchsorted(offsets, a, "right")
    broken = np.append((walls[a[1:]] > walls[b[:-1]]) | (rows[1:] != rows[:-1]), True)
    return words.dictionary.take(words.indices), broken


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))


def _sketched(docs: DataFrame, length: int, sketch: _Sketch, min_count: int, shard_words: int) -> np.ndarray:
    """Bitmap of the buckets in which phrases of ``length`` words come ``min_count`` times or more; its size is fixed."""
    sent = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = sent.value
        for lang, dictionary, ids in _shards(batches, shard_words):
            hashes, mark = _word_hashes(dictionary), _lang_mark(lang)
            for phrases, counts in _shard_phrases(ids, len(dictionary), hashes, mark, length, sketch):
                pass
            bucket = sketch.bucket(hashes[phrases], mark)
            order = np.argsort(bucket)
            bucket, counts = bucket[order], np.minimum(counts[order], min_count)
            ranges = bucket // _BITMAP
            at = np.flatnonzero(np.diff(ranges, prepend=-1))
            ends = np.append(at[1:], len(bucket))
            places, times = (bucket % _BITMAP).astype(np.uint16), counts.astype(np.int32)
            for i in range(0, len(at), 1 << 10):
                part = list(zip(at[i : i + (1 << 10)].tolist(), ends[i : i + (1 << 10)].tolist()))
                columns = [pa.array(ranges[at[i : i + (1 << 10)]].astype(np.int32)), pa.array([places[x:y].tobytes() for x, y in part], pa.binary()), pa.array([_packed(times[x:y]) for x, y in part], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["range", "places", "times"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = None, np.zeros(_BITMAP, np.int64)

        def bits() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([own], pa.int32()), pa.array([np.packbits(sums >= min_count, bitorder="little").tobytes()], pa.binary())], ["range", "bits"])

        for batch in batches:
            for range_, places, times in zip(*(c.to_pylist() for c in batch.columns)):
                if range_ != own:
                    if own is not None:
                        yield bits()
                    own, sums = range_, np.zeros(_BITMAP, np.int64)
                np.add.at(sums, np.frombuffer(places, np.uint16), _unpacked(times))
        if own is not None:
            yield bits()

    # a row of a shard holds what falls into one range of buckets, and the rows of a range stream past sorted
    counted = tidy_map(docs, run, "range int, places binary, times binary")
    maps = tidy_map(counted.repartition("range").sortWithinPartitions("range"), summed, "range int, bits binary")
    out = np.zeros((1 << sketch.bits) // 8, np.uint8)
    for range_, bits in maps.collect():  # one row for 2**15 buckets, so 2**(bits - 15) rows of 4 KiB at most
        first = range_ * _BITMAP // 8
        out[first : first + len(bits)] = np.frombuffer(bytes(bits), np.uint8)[: len(out) - first]
    return out


def _packed(counts: np.ndarray) -> bytes:
    """Small whole numbers as bytes; the first byte is their width."""
    width = 1 if counts.max(initial=0) < 256 else 4
    return bytes([width]) + counts.astype(np.uint8 if width == 1 else np.uint32).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if data[0] == 1 else np.uint32, offset=1)


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, shard_words: int = SHARD_WORDS, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """(lang, phrase, words, f) of all phrases of up to ``max_words`` words that come ``min_count`` times or more; a written table.

    One row with words 0 and an empty phrase gives the number of all words of a language. Before phrases of
    k words are enumerated, those of k - 1 words are counted by hash in a sketch of fixed size, and at last those of
    ``max_words`` themselves: a phrase is left out only where it or a part of it is surely rarer than ``min_count``, so no
    count depends on the sketch.
    """
    texts = _texts(docs, text_col, lang_col)
    sketch = _Sketch(sketch_bits)
    for length in range(1, max_words + 1):
        sketch.maps[length] = _sketched(texts, length, sketch, min_count, shard_words)
    sent = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = sent.value
        for lang, dictionary, ids in _shards(batches, shard_words):
            words = int((ids < len(dictionary)).sum())
            yield batch_of(lang, pa.array([""]), np.array([words]))
            for phrases, counts in _shard_phrases(ids, len(dictionary), _word_hashes(dictionary), _lang_mark(lang), max_words, sketch):
                for i in range(0, len(phrases), 1 << 16):
                    part = phrases[i : i + (1 << 16)]
                    joined = pc.binary_join_element_wise(*(dictionary.take(pa.array(c)) for c in part.T), pa.scalar(b" ", pa.large_binary()))
                    yield batch_of(lang, joined.cast(pa.binary()).cast(pa.string()), counts[i : i + (1 << 16)])

    def batch_of(lang: str, texts: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(texts), pa.string()), texts, pa.array(counts.astype(np.int64))], ["lang", "phrase", "f"])

    counted = tidy_map(texts, run, "lang string, phrase string, f long")
    sums = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    words = F.when(F.col("phrase") == "", 0).otherwise(F.length("phrase") - F.length(F.replace("phrase", F.lit(" "))) + 1)
    return written(sums.withColumn("words", words.cast("int")).filter((F.col("f") >= min_count) | (F.col("words") == 0)), "phrases")


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)) of whole columns, exact in decimals of 38 digits."""
    a, left, right = (F.col(c).cast("decimal(15,0)") for c in (a, left, right))
    above = (F.lit(1_000_000).cast("decimal(7,0)") * a * a).cast("decimal(38,0)")
    return F.call_function("div", above, (left * right).cast("decimal(30,0)")).cast("long")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
    top: int = TOP, covered_percent: int = COVERED_PERCENT, shard_words: int = SHARD_WORDS, sketch_bits: int = SKETCH_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to ``max_words`` words of each language.

    A-Z is lowered, pieces end at ``.,;:!?`` and at line ends, words at spaces and tabs; n counts all words of the
    language, a the places of the phrase within pieces, overlaps included. Cut after its first k words a phrase has
    the score floor(1000000 a a / (l r)), with l and r the counts of both parts; the lowest of its cuts counts, then
    the smallest k. Candidates come ``min_count`` times or more. One that stands inside a longer candidate
    with ``covered_percent`` of its count goes, whether or not that one goes. The first ``top`` by score, a (both
    descending) and phrase (by bytes) stay. Products are decimals of 38 digits, exact for counts below 10**15.
    A null lang is ``und``, a null text is empty; repeated rows count as often as they occur; no words, no rows;
    extra columns and ids are ignored.
    """
    if max_words < 2:
        raise ValueError("max_words")
    counts = phrase_counts(docs, text_col, lang_col, max_words, min_count, shard_words, sketch_bits)
    listed = F.split("phrase", " ", -1)
    candidates = counts.filter("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"), listed.alias("w"))
    known = counts.filter("words >= 1").select("lang", "phrase", "f")

    def joined(first, length):
        return F.array_join(F.slice("w", first, length), " ")

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(1, F.col("k")).alias("left"), joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    cuts = cuts.join(known.withColumnsRenamed({"phrase": "left", "f": "l"}), ["lang", "left"]).join(known.withColumnsRenamed({"phrase": "right", "f": "r"}), ["lang", "right"])
    scored = cuts.withColumn("score", score("a", "l", "r"))
    lowest = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("m"))

    parts = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))))
    inside = candidates.filter("words >= 3").select("lang", F.col("a").alias("longer"), F.explode(parts).alias("phrase"))
    around = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = F.coalesce(100 * F.col("longer") >= covered_percent * F.col("a"), F.lit(False))
    lowest = lowest.join(around, ["lang", "phrase"], "left").filter(~covered)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    flat = lowest.select("lang", "phrase", "a", "m.l", "m.r", "m.score")
    # each task passes on no more than the first ``top`` of a language
    first = flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    sizes = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return first.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: For DuckDB, with the contract's lengths, counts and limits.
SQL = f"""
WITH p AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase
), n AS (
  SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT lang, k AS words, phrase, f AS a, string_split(phrase, ' ') AS s FROM f WHERE k > 1 AND f >= {MIN_COUNT}
), x AS (
  SELECT lang, words, phrase, a, j, array_to_string(s[1:j], ' ') AS u, array_to_string(s[j + 1:words], ' ') AS v
  FROM c, (SELECT unnest([1, 2]) AS j) WHERE j < words
), y AS (
  SELECT x.lang, x.phrase, x.a, j, l.f AS l, r.f AS r, (1000000 * x.a::HUGEINT * x.a::HUGEINT // (l.f::HUGEINT * r.f::HUGEINT))::BIGINT AS score
  FROM x JOIN f AS l ON l.lang = x.lang AND l.phrase = u JOIN f AS r ON r.lang = x.lang AND r.phrase = v
), z AS (
  SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), i AS (
  SELECT lang, unnest([array_to_string(s[1:2], ' '), array_to_string(s[2:3], ' ')]) AS phrase, a FROM c WHERE words = 3
), m AS (
  SELECT lang, phrase, max(a) AS longer FROM i GROUP BY lang, phrase
), t AS (
  SELECT z.lang, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, z.a DESC, z.phrase) AS rank, z.phrase, z.a, l, r, score
  FROM z LEFT JOIN m ON m.lang = z.lang AND m.phrase = z.phrase WHERE longer IS NULL OR 100 * longer < {COVERED_PERCENT} * z.a
)
SELECT t.lang, rank, phrase, a, l, r, n, score FROM t JOIN n ON n.lang = t.lang WHERE rank <= {TOP}
"""
