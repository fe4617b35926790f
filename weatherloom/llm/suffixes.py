"""Suffix-array dedup: bytes covered by long strings that also start elsewhere, found by hash-compared suffix sort.

Sorting every suffix of all text would move every byte many times. Each window of ``match`` bytes
is instead named by its anchor, the smallest of the hashes of its strings of two fifths that length: equal windows
have equal anchors at equal offsets, so only the suffixes at anchors need to be sorted, and only
where an anchor occurs more than once.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.llm import ngrams
from weatherloom.llm.common import small, text_hash, written

MATCH_BYTES = 400
#: Strings that count as shared without being removed; of passages of 51 words, 99.5 % are longer.
SHARED_BYTES = 240
#: Sides of joins are broadcast up to some 64 MB: rows of an anchor or a key, and places in texts. Beyond, both sides are shuffled.
BROADCAST_KEYS = 2_000_000
BROADCAST_PLACES = 1_000_000
#: Different contexts that are sorted together.
GROUP_SIZE = 256
#: Windows of a lane, from one division of a crowded group to the next; the last must be 1.
LANES = (32, 8, 1)
_BLOCK = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE_BITS = np.uint64(24)


def _powers(size: int, base: np.uint64) -> np.ndarray:
    powers = np.full(size, base)
    powers[0] = 1
    return np.cumprod(powers)


_UP = _powers(_BLOCK + MATCH_BYTES + 1, _BASE)
_DOWN = _powers(_BLOCK + MATCH_BYTES + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)))
_FAR = _powers(MATCH_BYTES * 2, _BASE)
_FAR_OTHER = _powers(MATCH_BYTES * 2, _OTHER)


def _digest(data: bytes, *form: int) -> bytes:
    """16 bytes that name ``data`` and up to two numbers; nobody knows two texts with one name."""
    return hashlib.blake2b(data, digest_size=16, salt=struct.pack("<2q", *form, *(0,) * (2 - len(form)))).digest()


def anchored_windows(text: np.ndarray, match: int = MATCH_BYTES) -> tuple[np.ndarray, ...]:
    """(anchor hash, two halves of the context's digest, first window, windows, bytes from the first window to the anchor) of a block.

    One entry per run of neighbouring windows with one anchor; their context is all bytes they cover, named with
    the numbers of windows and leading bytes by a 128-bit BLAKE2b digest. Anchor hashes only bring candidates
    together, so they may collide; contexts of one name are taken for equal.
    """
    width = match * 2 // 5
    size, span = len(text), match - width + 1
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _UP[:size], out=sums[1:])
    total = size - width + 1
    hashes = ngrams.mix((sums[width:] - sums[:-width]) * _DOWN[:total])
    ranked = ((hashes >> _PLACE_BITS) << _PLACE_BITS) | np.arange(total, dtype=np.uint64)
    rows = np.append(ranked, np.full(-total % span + span, np.iinfo(np.uint64).max)).reshape(-1, span)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = size - match + 1
    least = np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows])
    place = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    count = np.diff(np.append(first, windows))
    anchor = place[first]
    lead = anchor - first
    data = text.tobytes()
    names = [_digest(data[a : a + n - 1 + match], n, o) for a, n, o in zip(first.tolist(), count.tolist(), lead.tolist())]
    context = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
    return hashes[anchor], context[:, 0], context[:, 1], first, count, lead


def occurrences(docs: DataFrame, id_col: str, text_col: str, match: int = MATCH_BYTES, within: DataFrame | None = None) -> DataFrame:
    """(doc_id, text_hash, anchor, context, context_2, start, windows, lead) of every run of windows of every text.

    With ``within`` (doc_id, text_hash, removed) only of the windows that lie in the byte ranges ``removed``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_hash", "anchor", "context", "context_2", "start", "windows", "lead"]

        def table(batch: pa.RecordBatch, rows: list, parts: list) -> pa.RecordBatch:
            at = pa.array(np.repeat(np.array(rows, np.int32), [len(p[0]) for p in parts]))
            columns = [np.concatenate(c) for c in zip(*parts)]
            kinds = (np.int64, np.int64, np.int64, np.int32, np.int32, np.int32)
            return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array(c.astype(k)) for c, k in zip(columns, kinds))], names)

        for batch in batches:
            data, offsets = ngrams.text_bytes(batch.column(2))
            rows, parts, held = [], [], 0
            for row, ranges in enumerate(batch.column(3).to_pylist()):
                base = int(offsets[row])
                for r in ranges:
                    for at in range(r["start"], r["end"] - match + 1, _BLOCK):
                        found = anchored_windows(data[base + at : base + min(at + _BLOCK + match - 1, r["end"])], match)
                        found[3][:] += at
                        rows.append(row)
                        parts.append(found)
                        held += len(found[0])
                if held > 100_000:
                    yield table(batch, rows, parts)
                    rows, parts, held = [], [], 0
            if rows:
                yield table(batch, rows, parts)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    rows = rows.filter(F.octet_length("text") >= match)
    if within is None:
        rows = rows.withColumn("ranges", F.array(F.struct(F.lit(0).alias("start"), F.octet_length("text").alias("end"))))
    else:
        long_enough = F.filter("removed", lambda r: r["end"] - r["start"] >= match)
        rows = _with_ranges(rows, within.select("doc_id", "text_hash", long_enough.alias("ranges")).filter(F.size("ranges") > 0), "inner")
    return rows.mapInArrow(run, "doc_id long, text_hash long, anchor long, context long, context_2 long, start int, windows int, lead int")


def _with_ranges(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``rows`` with the columns of ``found`` for their doc_id and text_hash; broadcast if few rows and ranges."""
    lists = [c for c, kind in found.dtypes if kind.startswith("array")]
    found = found.withColumnsRenamed({"doc_id": "i", "text_hash": "h"})
    if (found.agg(F.sum(sum((F.size(c) for c in lists), F.lit(1)))).first()[0] or 0) <= BROADCAST_PLACES:
        found = F.broadcast(found)
    return rows.join(found, rows["doc_id"].eqNullSafe(found["i"]) & (rows["text_hash"] == found["h"]), how).drop("i", "h")


class _Context:
    """The bytes around one anchor, with the hashes of all prefixes from the anchor on and of all suffixes before it."""

    __slots__ = ("data", "lead", "windows", "ahead", "ahead_list", "behind")

    def __init__(self, data: bytes, lead: int, windows: int):
        self.data, self.lead, self.windows = data, lead, windows
        numbers = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        right, left = numbers[lead:], numbers[:lead][::-1]
        self.ahead = np.cumsum(np.append(np.uint64(0), right * _FAR[: len(right)]))
        self.ahead_list = self.ahead.tolist()
        self.behind = np.cumsum(np.append(np.uint64(0), left * _FAR_OTHER[: len(left)]))

    def common(self, other: _Context) -> int:
        """Bytes both have in common from the anchor on: binary search over the prefix hashes, verified byte by byte."""
        mine, theirs = self.ahead_list, other.ahead_list
        low, high = 0, min(len(mine), len(theirs)) - 1
        while low < high:
            middle = (low + high + 1) // 2
            if mine[middle] == theirs[middle]:
                low = middle
            else:
                high = middle - 1
        a, b = self.data[self.lead : self.lead + low], other.data[other.lead : other.lead + low]
        if a == b:
            return low
        return next(i for i in range(low) if a[i] != b[i])  # two strings with one hash

    def compare(self, other: _Context) -> int:
        n = self.common(other)
        a, b = self.data[self.lead + n : self.lead + n + 1], other.data[other.lead + n : other.lead + n + 1]
        return (a > b) - (a < b)


def repeated_windows(group: list[tuple[bytes, int, int]], match: int = MATCH_BYTES) -> list[np.ndarray]:
    """For each context (bytes, lead, windows) of one anchor, which of its windows another one has too.

    The suffixes at the anchors are merge sorted by hash-compared common extensions. A window that
    begins ``o`` bytes before the anchor is another's if both stand in one stretch of suffixes with
    common extensions of match - o at least, and the ``o`` bytes before the anchors are equal.
    """
    contexts = [_Context(*member) for member in group]
    order = sorted(range(len(contexts)), key=cmp_to_key(lambda a, b: contexts[a].compare(contexts[b])))
    ordered = [contexts[i] for i in order]
    common = np.array([a.common(b) for a, b in zip(ordered, ordered[1:])], np.int64)
    widest = max(c.lead for c in ordered)
    narrowest = min(c.lead - c.windows + 1 for c in ordered)
    offsets = np.arange(narrowest, widest + 1)
    stretch = np.zeros((len(offsets), len(ordered)), np.uint64)
    np.cumsum(common[None, :] < (match - offsets)[:, None], axis=1, out=stretch[:, 1:])
    before = np.zeros_like(stretch)
    valid = np.zeros(stretch.shape, bool)
    for i, c in enumerate(ordered):
        own = (offsets <= c.lead) & (offsets > c.lead - c.windows)
        valid[:, i] = own
        before[own, i] = c.behind[offsets[own]]
    where, member = np.nonzero(valid)
    keys = ngrams.mix(before[valid] + stretch[valid] * _BASE) + offsets[where].astype(np.uint64) * _OTHER
    _, index, inverse, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    several = times[inverse] > 1
    partner = member[index][inverse]
    pairs = np.stack([member[several], partner[several], offsets[where[several]]], axis=1)
    if len(pairs):
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        pairs = pairs[np.lexsort((pairs[:, 2], pairs[:, 1], pairs[:, 0]))]
        last = np.append((pairs[1:, :2] != pairs[:-1, :2]).any(axis=1), True)
        for a, b, o in pairs[last].tolist():
            x, y = ordered[a], ordered[b]
            if x.data[x.lead - o : x.lead] != y.data[y.lead - o : y.lead]:
                return _by_bytes(group, match)
    out = [np.zeros(c.windows, bool) for c in contexts]
    for i, o in zip(member[several].tolist(), offsets[where[several]].tolist()):
        c = order[i]
        out[c][contexts[c].lead - o] = True
    return out


def _by_bytes(group: list[tuple[bytes, int, int]], match: int) -> list[np.ndarray]:
    """As repeated_windows, comparing windows as bytes; for two strings with one hash."""
    places: dict[bytes, list[tuple[int, int]]] = {}
    for i, (data, _, windows) in enumerate(group):
        for w in range(windows):
            places.setdefault(data[w : w + match], []).append((i, w))
    out = [np.zeros(windows, bool) for _, _, windows in group]
    for found in places.values():
        for i, w in found if len(found) > 1 else []:
            out[i][w] = True
    return out


def _stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


_SPAN = "doc_id long, text_hash long, start int, end int"


def _sorted_groups(match: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for members in batch.column(0):
                rows = members.as_py()
                for row, flags in zip(rows, repeated_windows([(r["data"], r["lead"], r["windows"]) for r in rows], match)):
                    if row["times"] == 1:
                        out += [(row["doc_id"], row["text_hash"], row["start"] + a, row["start"] + b + match) for a, b in _stretches(flags)]
            yield _span_batch(out)

    return run


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["doc_id", "text_hash", "start", "end"])


_LANE = "doc_id long, text_hash long, times long, start int, windows int, lead int, data binary, k1 long, k2 long, d1 long, d2 long"


def _lanes(width: int, match: int):
    """Each context as pieces of at most ``width`` windows, keyed by a digest of the bytes that all windows of the lane cover.

    Equal windows begin equally far before the anchor, so they are in one lane and have one key. A
    second digest is over all bytes of the piece.
    """
    fields = [f.split() for f in _LANE.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, key, times, start, windows, lead, data in zip(*(c.to_pylist() for c in batch.columns)):
                for lane in range((lead - windows + 1) // width, lead // width + 1):
                    first, last = max(lane * width, lead - windows + 1), min(lane * width + width - 1, lead)
                    common = data[lead - lane * width : lead + match - (lane * width + width) + 1]
                    piece = data[lead - last : lead + match - first]
                    marks = _digest(common, lane) + _digest(piece, lane, last)
                    out.append((doc, key, times, start + lead - last, last - first + 1, last, piece, *np.frombuffer(marks, "<i8").tolist()))
            columns = zip(*out) if out else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kinds[f[1]]) for c, f in zip(columns, fields)], [f[0] for f in fields])

    return run


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_size: int = GROUP_SIZE, match: int = MATCH_BYTES, within: DataFrame | None = None
) -> DataFrame:
    """(doc_id, text_hash, start, end): byte ranges made of windows that also start elsewhere; ranges may overlap.

    Windows have ``match`` bytes, MATCH_BYTES at most; ``within`` as in :func:`occurrences`.

    1. Every run of windows becomes one row, named by anchor and context. 2. Anchors that occur once are
    done. Contexts that occur twice are repeated as a whole, whatever number of rows they hold;
    all these are counts and joins, with partial sums before the shuffle. 3. What is left is one row
    per different context; those of one anchor are sorted together. Anchors with more than
    ``group_size`` different contexts, which no task should hold, are divided by what lanes of some
    neighbouring windows have in common, nearly ``match`` long. Equal pieces are folded, and
    the different ones of a lane sorted together; crowded lanes are divided again, at last into single windows,
    where nothing but equal pieces is left. Rows repeated with id and text are different
    places, so a long text repeated as a row is removed from both.
    """
    found = written(occurrences(docs, id_col, text_col, match, within), "occurrences")
    different = (F.min("context") != F.max("context")) | (F.min("context_2") != F.max("context_2"))
    anchors = written(found.groupBy("anchor").agg(F.count("*").alias("n"), different.alias("mixed")).filter("n > 1").drop("n"), "anchors")
    shared = written(found.join(small(anchors, BROADCAST_KEYS), "anchor"), "shared")
    end = (F.col("start") + F.col("windows") + F.lit(match - 1)).alias("end")
    whole = shared.filter("not mixed").select("doc_id", "text_hash", "start", end)

    mixed = shared.filter("mixed")
    firsts = [F.first(c).alias(c) for c in ("doc_id", "text_hash", "start", "windows", "lead")]
    name = ["anchor", "context", "context_2"]
    folded = written(mixed.groupBy(*name).agg(F.count("*").alias("times"), *firsts), "folded")
    twice_rows = mixed.join(small(folded.filter("times > 1").select(*name)), name).select("doc_id", "text_hash", "start", end)

    mark = uuid.uuid4().hex
    places = F.struct("anchor", "times", "start", "windows", "lead")
    by_doc = folded.groupBy("doc_id", "text_hash").agg(F.collect_list(places).alias("places")).withColumnsRenamed({"doc_id": f"i{mark}", "text_hash": f"h{mark}"})
    if folded.limit(BROADCAST_PLACES + 1).count() <= BROADCAST_PLACES:
        by_doc = F.broadcast(by_doc)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).cast("binary").alias("data"))
    same = rows["doc_id"].eqNullSafe(by_doc[f"i{mark}"]) & (rows["text_hash"] == by_doc[f"h{mark}"])
    cut = F.substring("data", F.col("p.start") + 1, F.col("p.windows") + F.lit(match - 1))
    contexts = rows.join(by_doc, same).select("doc_id", "text_hash", "data", F.explode("places").alias("p")).select("doc_id", "text_hash", "p.*", cut.alias("data"))
    contexts = written(contexts.dropDuplicates(["doc_id", "text_hash", "start"]), "contexts")

    sorted_out, crowded = _by_key(contexts, ["anchor"], group_size, match)
    spans = whole.union(twice_rows).union(sorted_out)
    for width in LANES:
        if crowded is None:
            break
        lanes = written(crowded.mapInArrow(_lanes(width, match), _LANE), "lanes")
        keys = ["k1", "k2", "d1", "d2"]
        firsts = [F.first(c).alias(c) for c in ("doc_id", "text_hash", "start", "windows", "lead", "data")]
        folded = written(lanes.groupBy(*keys).agg(F.count("*").alias("times"), *firsts), "lane-folded")
        equal = lanes.join(small(folded.filter("times > 1").select(*keys)), keys).select("doc_id", "text_hash", "start", end)
        sorted_out, crowded = _by_key(folded, ["k1", "k2"], group_size, match)
        spans = spans.union(equal).union(sorted_out)
    return spans


def _by_key(contexts: DataFrame, keys: list[str], group_size: int, match: int) -> tuple[DataFrame, DataFrame | None]:
    """(spans of the contexts sorted with the others of their key, contexts whose key has too many if there are any)."""
    sizes = written(contexts.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
    sized = contexts.join(small(sizes, BROADCAST_KEYS), keys)
    member = F.struct("doc_id", "text_hash", "times", "start", "windows", "lead", "data")
    groups = sized.filter(F.col("n") <= group_size).groupBy(*keys).agg(F.collect_list(member).alias("members")).select("members")
    crowded = None
    if not sizes.filter(F.col("n") > group_size).isEmpty():
        crowded = sized.filter(F.col("n") > group_size).select("doc_id", "text_hash", "times", "start", "windows", "lead", "data")
    return groups.mapInArrow(_sorted_groups(match), _SPAN), crowded


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of touching or overlapping (start, end)."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def removed_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_size: int = GROUP_SIZE, match: int = MATCH_BYTES, within: DataFrame | None = None
) -> DataFrame:
    """(doc_id, text_hash, removed): the maximal runs (start, end) of repeated bytes, for documents that have any."""
    spans = repeated_spans(docs, id_col, text_col, group_size, match, within)
    lists = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            runs = [merged([(x["start"], x["end"]) for x in row]) for row in batch.column(2).to_pylist()]
            removed = pa.array([[{"start": a, "end": b} for a, b in r] for r in runs], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), removed], ["doc_id", "text_hash", "removed"])

    return written(lists.mapInArrow(run, "doc_id long, text_hash long, removed array<struct<start:int,end:int>>"), "removed")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_size: int = GROUP_SIZE) -> DataFrame:
    """(doc_id, n_bytes, removed, kept, n_shared) of every row: kept are the bytes left, removed the maximal removed runs (start, end).

    A byte goes if a string of MATCH_BYTES bytes covers it that starts anywhere else too, in this text or
    another; every occurrence goes, judged on the input. Null texts are empty, shorter texts stay
    whole, matches never cross rows, null ids keep their rows, extra columns are ignored. n_shared are the
    bytes that a string of SHARED_BYTES covers that starts anywhere else too, whether they go or not.

    All windows of a longer repeated string are repeated, so the runs of shared bytes hold every removed
    one: only these runs are searched for strings of MATCH_BYTES.
    """
    shared = removed_runs(docs, id_col, text_col, group_size, SHARED_BYTES)
    removed = removed_runs(docs, id_col, text_col, group_size, MATCH_BYTES, shared).withColumnsRenamed({"doc_id": "i", "text_hash": "h"})
    n_shared = F.aggregate(shared["removed"], F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"]).alias("n_shared")
    both = shared.join(removed, shared["doc_id"].eqNullSafe(removed["i"]) & (shared["text_hash"] == removed["h"]), "left")
    found = written(both.select("doc_id", "text_hash", F.coalesce(removed["removed"], _no_ranges()).alias("removed"), n_shared), "found")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    joined = _with_ranges(rows, found, "left")
    size = F.octet_length("data")
    runs = F.coalesce("removed", _no_ranges())
    gaps = F.zip_with(F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["end"])), F.concat(F.transform(runs, lambda r: r["start"]), F.array(size)), lambda a, b: F.substring("data", a + 1, b - a))
    kept = F.aggregate(gaps, F.lit("").cast("binary"), lambda a, b: F.concat(a, b))
    return joined.select(
        "doc_id", size.cast("long").alias("n_bytes"), runs.alias("removed"), F.when(F.size(runs) == 0, F.col("data")).otherwise(kept).alias("kept"),
        F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared"),
    )


def _no_ranges() -> Column:
    return F.array().cast("array<struct<start:int,end:int>>")
