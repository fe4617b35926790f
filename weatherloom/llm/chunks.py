"""Substring dedup: variable chunks between content-defined cuts, found again by digest and extended byte by byte."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.llm import ngrams
from weatherloom.llm.common import BROADCAST_ROWS, small, text_hash, tidy_map, written

#: A cut is the least hash of so many places on either side, so that no chunk between two is short.
REACH = 24
#: Where cuts are further apart than this,
LONG_CHUNK = 80
#: the least hashes of all windows of so many places are cuts as well.
CUT_WINDOW = 64
#: Bytes whose hash is that of a place.
_WINDOW = 16
#: Any so many bytes that two texts share hold a whole chunk of both: two cuts, or one and a long chunk beside it, or a long chunk.
SURE_BYTES = 2 * LONG_CHUNK + 2 * REACH + _WINDOW
#: Bytes on either side of equal chunks that are compared as well.
BORDER = 128
#: What is repeated goes where it holds so many words (white space or ends around them), or
MIN_WORDS = 50
#: so many bytes, for long words and scripts without spaces.
MIN_BYTES = 400
#: Chunks of one text in one row, and in one batch.
_CHUNKS_AT_ONCE = 50_000
#: Digests seen twice that are broadcast to the tasks that look for them, 8 bytes each.
_BROADCAST_DIGESTS = 2_000_000
_STEP = 1 << 20
#: One random number per byte value, for the gear hash.
_GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, 256, np.uint32)
_SPREAD = np.uint32(0x9E3779B1)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash at every byte: each step shifts by one and adds the byte's number; the last 16 bytes count."""
    h = _GEAR[data]
    width = 1
    while width < _WINDOW:
        h[width:] += h[:-width] << np.uint32(width)  # the right side is read before it is changed
        width *= 2
    return h


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring keys."""
    done = 1
    while done < width:
        step = min(done, width - done)
        keys = np.minimum(keys[:-step], keys[step:])
        done += step
    return keys


def cuts(data: np.ndarray) -> np.ndarray:
    """Where the chunks of one text begin, but for the first.

    The hash is of the 16 bytes from a place on, only starts of characters count, and of equal hashes the
    first one is least. A place with the least hash among REACH on either side is a cut, so chunks have
    more than REACH bytes; in what is longer than LONG_CHUNK, as in text that repeats itself, the
    least places of all windows of CUT_WINDOW are cuts too. The bytes around decide alone, whatever the script.
    """
    places, width = len(data) - _WINDOW + 1, 2 * REACH + 1
    peaks, lows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(0, places - width + 1, _STEP):
        stop = min(a + _STEP + CUT_WINDOW - 1, places)
        part = data[a : stop + _WINDOW - 1]
        h = gear_hashes(part)[_WINDOW - 1 :] * _SPREAD
        h ^= h >> np.uint32(15)
        h[part[: len(h)] & 0xC0 == 0x80] = 0xFFFFFFFF
        keys = (h.astype(np.uint64) << np.uint64(32)) + np.arange(len(h), dtype=np.uint64)
        near = _least(keys, width)
        peaks.append(np.flatnonzero(near == keys[REACH : REACH + len(near)]) + REACH + a)
        if len(keys) >= CUT_WINDOW:
            low = (_least(keys, CUT_WINDOW) & np.uint64(0xFFFFFFFF)).astype(np.int64) + a
            lows.append(low[np.diff(low, prepend=-1) > 0])
    peak, low = np.unique(np.concatenate(peaks)), np.unique(np.concatenate(lows))
    edges = np.concatenate([[0], peak, [len(data)]])
    after = np.searchsorted(edges, low)
    wide = np.diff(edges, prepend=0)[np.minimum(after, len(edges) - 1)] > LONG_CHUNK
    return np.union1d(peak, low[wide])


def _digested(text: np.ndarray) -> tuple[list[int], list[bytes]]:
    """(ends, digests) of the chunks of a text, from cut to cut.

    Where a text repeats itself a few bytes may make a chunk; of equal neighbours as many as fit into
    CUT_WINDOW are one, which is the same wherever the repetition begins.
    """
    raw, ends = text.tobytes(), [c for c in cuts(text).tolist() if c] + [len(text)] * (len(text) > 0)
    parts = [raw[a:b] for a, b in zip([0, *ends], ends)]
    if any(x == y for x, y in zip(parts, parts[1:])):
        joined, i = [], 0
        while i < len(parts):
            most, j = max(CUT_WINDOW // len(parts[i]), 1), i + 1
            while j < len(parts) and j - i < most and parts[j] == parts[i]:
                j += 1
            joined.append(j - 1)
            i = j
        ends = [ends[j] for j in joined]
        parts = [raw[a:b] for a, b in zip([0, *ends], ends)]
    return ends, [xxhash.xxh3_128_digest(part) for part in parts]


def chunk_ends(data: np.ndarray) -> list[int]:
    """Where the chunks of one text end; none but the first and the last is longer than LONG_CHUNK."""
    return _digested(data)[0]


_CHUNKS = "doc_id long, text_hash long, chunks array<struct<start:int,size:int>>, d1 array<long>, d2 array<long>"


def chunk_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_size: int = 1) -> DataFrame:
    """(doc_id, text_hash, chunks, d1, d2): the variable chunks of every whole text, d1 and d2 are a 128-bit digest.

    A text has one row for each _CHUNKS_AT_ONCE chunks, one of less than ``min_size`` bytes has none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = ngrams.text_bytes(batch.column(2))
            parts: list[tuple] = []
            held = 0
            for row in range(len(batch)):
                if offsets[row + 1] - offsets[row] < min_size:
                    continue
                ends, digests = _digested(data[offsets[row] : offsets[row + 1]])
                for a in range(0, len(ends), _CHUNKS_AT_ONCE):
                    own = ends[a : a + _CHUNKS_AT_ONCE]
                    parts.append((row, [ends[a - 1] if a else 0, *own[:-1]], own, digests[a : a + _CHUNKS_AT_ONCE]))
                    held += len(own)
                    if held > _CHUNKS_AT_ONCE:
                        yield _chunk_batch(batch, parts)
                        parts, held = [], 0
            yield _chunk_batch(batch, parts)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    return tidy_map(rows, run, _CHUNKS)


def _chunk_batch(batch: pa.RecordBatch, parts: list[tuple]) -> pa.RecordBatch:
    rows = pa.array(np.array([p[0] for p in parts], np.int32))
    starts = np.array([a for p in parts for a in p[1]], np.int32)
    ends = np.array([b for p in parts for b in p[2]], np.int32)
    marks = np.frombuffer(b"".join(d for p in parts for d in p[3]), "<i8").reshape(-1, 2)
    edges = pa.array(np.cumsum([0, *(len(p[1]) for p in parts)]).astype(np.int32))
    spans = pa.StructArray.from_arrays([pa.array(starts), pa.array(ends - starts)], ["start", "size"])
    lists = [pa.ListArray.from_arrays(edges, x) for x in (spans, pa.array(marks[:, 0]), pa.array(marks[:, 1]))]
    return pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *lists], ["doc_id", "text_hash", "chunks", "d1", "d2"])


_RUN = "start int, end int, f_id long, f_hash long, f_start int, f_end int"


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_size: int = 1) -> DataFrame:
    """(doc_id, text_hash, runs): byte ranges that an earlier place has too, with the bytes around that place.

    Places go by (doc_id, text_hash, start), null ids last, so each chunk stays at its first place; only
    rows equal in id and text keep the same chunks. Chunks that follow each other here and there are one
    run. Chunks are made once and written; half of each digest is counted, combined on the map side, and
    only chunks whose half was seen twice move with their places. Texts of less than ``min_size`` bytes are left out. A chunk under a third of all rows is
    one row on one side of each join, and the other side is dealt out anew where it is uneven.
    """
    table = written(chunk_rows(docs, id_col, text_col, min_size), "chunks")
    twice = table.select(F.explode("d1").alias("d1")).groupBy("d1").agg(F.count("*").alias("n")).filter("n > 1").select("d1")
    twice = small(written(twice, "twice"), _BROADCAST_DIGESTS)
    every = table.select("doc_id", "text_hash", F.inline(F.arrays_zip("chunks", "d1", "d2")))
    chunks = written(every.select("doc_id", "text_hash", "chunks.start", "chunks.size", "d1", "d2").join(twice, "d1", "left_semi"), "candidates")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "start")
    firsts = written(chunks.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "repeated")
    again = chunks.join(firsts, ["d1", "d2"]).filter(place > F.col("first"))
    hit = F.struct("start", "size", F.col("first.doc_id").alias("f_id"), F.col("first.text_hash").alias("f_hash"), F.col("first.start").alias("f_start"))
    hits = again.groupBy("doc_id", "text_hash").agg(F.collect_set(hit).alias("hits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [joined_chunks([tuple(x.values()) for x in hits]) for hits in batch.column(2).to_pylist()]
            rows = pa.array(np.repeat(np.arange(len(batch)), [len(f) for f in found]).astype(np.int32))
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            arrays = [pa.array([r[i] for f in found for r in f], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *arrays], ["doc_id", "text_hash", "start", "end", "f_id", "f_hash", "f_start", "f_end"])

    runs = written(hits.mapInArrow(run, f"doc_id long, text_hash long, {_RUN}"), "runs")
    there = ["f_id", "f_hash", "f_start", "f_end"]
    places = written(runs.select(*there).distinct(), "places")
    wanted = places.groupBy("f_id", "f_hash").agg(F.collect_list(F.struct("f_start", "f_end")).alias("places"))
    if places.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).cast("binary").alias("data"))
    theirs = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["f_id"]) & (rows["text_hash"] == wanted["f_hash"]))
    theirs = theirs.select("f_id", "f_hash", "data", F.explode("places").alias("p")).select("f_id", "f_hash", "p.f_start", "p.f_end", "data")
    lead = F.greatest(F.col("f_start") - BORDER, F.lit(0))
    before, after = F.substring("data", lead + 1, F.col("f_start") - lead), F.substring("data", F.col("f_end") + 1, F.lit(BORDER))
    theirs = theirs.select(*there, before.alias("before"), after.alias("after")).dropDuplicates(there).withColumnsRenamed({c: f"{c}_" for c in there})
    same = runs["f_id"].eqNullSafe(theirs["f_id_"])
    for c in there[1:]:
        same &= runs[c] == theirs[f"{c}_"]
    return runs.join(theirs, same).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end", "before", "after")).alias("runs"))


def joined_chunks(hits: list[tuple]) -> list[tuple]:
    """(start, end, f_id, f_hash, f_start, f_end) of chunks (start, size, f_id, f_hash, f_start) that touch here and there."""
    out: list[list] = []
    last: dict[tuple, list] = {}
    for start, size, f_id, f_hash, f_start in sorted(hits, key=lambda hit: hit[0]):
        key = (f_id, f_hash, f_start - start)
        if key in last and start <= last[key][1]:
            last[key][1], last[key][5] = start + size, f_start + size
        else:
            last[key] = [start, start + size, f_id, f_hash, f_start, f_start + size]
            out.append(last[key])
    return [tuple(r) for r in out]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many bytes two arrays of one length have in common from their start."""
    other = np.flatnonzero(a != b)
    return int(other[0]) if len(other) else len(a)


def extended(data: np.ndarray, start: int, end: int, before: bytes, after: bytes) -> tuple[int, int]:
    """(start, end) with the bytes on both sides that are as at the first place, in whole characters."""
    theirs = np.frombuffer(before, np.uint8)
    n = min(start, len(theirs))
    start -= _common(data[start - n : start][::-1], theirs[len(theirs) - n :][::-1])
    theirs = np.frombuffer(after, np.uint8)
    n = min(len(data) - end, len(theirs))
    end += _common(data[end : end + n], theirs[:n])
    while start < end and data[start] & 0xC0 == 0x80:
        start += 1
    while start < end < len(data) and data[end] & 0xC0 == 0x80:
        end -= 1
    return start, end


_RANGES = "array<struct<start:int,end:int>>"


def _cut_out(min_words: int, min_bytes: int, text: Column, runs_col: Column) -> Column:
    """struct<removed, kept> of a text and its runs, null where it loses nothing."""

    @F.arrow_udf(f"struct<removed:{_RANGES},kept:{_RANGES}>")
    def ranges(text: pa.Array, found: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        data, offsets = ngrams.text_bytes(text)
        rows = []
        for row in range(len(text)):
            own = data[offsets[row] : offsets[row + 1]]
            spans = [extended(own, *x.values()) for x in found[row].as_py() or []]
            gone = [(a, b) for a, b in runs(spans) if b - a >= min(min_bytes, len(own)) or words_in(own[a:b]) >= min_words]
            kept = list(zip([0, *(b for _, b in gone)], [*(a for a, _ in gone), (1 << 31) - 1]))
            lists = [[{"start": a, "end": b} for a, b in r] for r in (gone, kept)]
            rows.append(dict(zip(("removed", "kept"), lists)) if gone else None)
        return pa.array(rows, pa.struct([("removed", kind), ("kept", kind)]))

    return ranges(F.when(runs_col.isNotNull(), text), runs_col)


def words_in(data: np.ndarray) -> int:
    """Stretches without white space, cut ones at the ends included."""
    inside = ~ngrams.WHITE[data]
    return int(np.count_nonzero(np.diff(inside.astype(np.int8), prepend=0) > 0))


def runs(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, end) of what spans (start, end) cover that touch or overlap."""
    joined: list[list[int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    return [(a, b) for a, b in joined]


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_bytes: int = MIN_BYTES) -> DataFrame:
    """All columns of ``docs``, the text without its repeated runs, and the new column removed_spans.

    A run goes if it has ``min_words`` words or ``min_bytes`` bytes or is the whole text; texts in which there
    is no room for so much (less than 2 * min_words - 1 bytes) stay. Of stretches in common that are
    shorter than SURE_BYTES some are not found; part of a chunk may stay at a border that only a later
    copy shares, not the first place. removed_spans holds (start, end) in bytes of the UTF-8 text given.
    Null and empty texts stay as they are, with no spans. Rows repeated with id and text keep the same
    text. A text may become empty. A column of ``docs`` named removed_spans is replaced.
    """
    mark = uuid.uuid4().hex
    found = repeated_runs(docs, id_col, text_col, max(min(2 * min_words - 1, min_bytes), 1))
    found = found.select(*(F.col(c).alias(f"{c}{mark}") for c in found.columns))
    same = docs[id_col].cast("long").eqNullSafe(found[f"doc_id{mark}"]) & (text_hash(docs[text_col]) == found[f"text_hash{mark}"])
    joined = docs.join(found, same, "left")
    data, parts = F.col(text_col).cast("binary"), F.col(f"p{mark}")
    joined = joined.withColumn(f"p{mark}", _cut_out(min_words, min_bytes, F.col(text_col), F.col(f"runs{mark}")))
    left = F.array_join(F.transform(parts["kept"], lambda r: F.substring(data, r["start"] + 1, r["end"] - r["start"]).cast("string")), "")
    removed = F.coalesce(parts["removed"], F.array().cast(_RANGES))
    changed = joined.withColumns({f"t{mark}": F.when(parts.isNull(), F.col(text_col)).otherwise(left), f"r{mark}": removed})
    columns = [F.col(f"t{mark}").alias(text_col) if c == text_col else F.col(c) for c in docs.columns if c != "removed_spans"]
    return changed.select(*columns, F.col(f"r{mark}").alias("removed_spans"))
