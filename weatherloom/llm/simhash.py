"""SimHash fingerprints of documents, and their near duplicates found with BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.common import small, text_hash, tidy_map, without_rows, written
from weatherloom.llm.graph import components

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Fingerprints in one tree.
SHARD_SIZE = 1024
_STEP = 1 << 16
_MASK = (1 << 64) - 1


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of one text, as an unsigned number; 0 without words.

    ASCII upper case is lowered, words are what ASCII white space separates, every shingle
    counts as often as it occurs, fewer words than a shingle make one shingle.
    """
    words = text.lower().split()
    if not words:
        return 0
    width = min(words_per_shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    stops = ends[width - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(starts), _STEP):
        part = zip(starts[i : i + _STEP], stops[i : i + _STEP])
        hashes = np.array([digest(joined[a:b], 42) for a, b in part], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return sum(1 << i for i in np.flatnonzero(counts * 2 > len(starts)).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp is the fingerprint as a signed long. Null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", words_per_shingle) for t in batch.column(2)]
            signed = np.array(marks, np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signed)], ["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    return tidy_map(rows, run, "doc_id long, text_hash long, fp long")


class BKTree:
    """A tree of fingerprints; a child hangs on the edge named by its distance to the parent."""

    def __init__(self, marks: list[int]):
        self.marks = [marks[0]]
        self.children: list[dict[int, int]] = [{}]
        for mark in marks[1:]:
            self._add(mark)

    def _add(self, mark: int) -> None:
        node = 0
        while True:
            distance = (self.marks[node] ^ mark).bit_count()
            if not distance:
                return
            below = self.children[node].get(distance)
            if below is None:
                self.children[node][distance] = len(self.marks)
                self.marks.append(mark)
                self.children.append({})
                return
            node = below

    def within(self, mark: int, radius: int) -> Iterator[int]:
        """Every mark at most ``radius`` bits away: only edges within the radius of the distance are followed."""
        todo = [0]
        marks, children = self.marks, self.children
        while todo:
            node = todo.pop()
            distance = (marks[node] ^ mark).bit_count()
            if distance <= radius:
                yield marks[node]
            for edge, below in children[node].items():
                if distance - radius <= edge <= distance + radius:
                    todo.append(below)


def spanning_links(tree_of: list[int], asked: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join the same fingerprints as all links between the two lists; fewer than there are fingerprints."""
    tree = BKTree(tree_of)
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.get(x, x)) != x:
            above[x] = above.get(y, y)
            x = y
        return x

    found = []
    for mark in asked:
        for other in tree.within(mark, radius):
            a, b = top(mark), top(other)
            if a != b:
                above[a] = b
                found.append((mark, other))
    return found


def block_masks(radius: int) -> list[int]:
    """Masks of two blocks each of radius + 2 blocks: marks within the radius agree under one of them at least."""
    blocks = radius + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [x | y for x, y in combinations(parts, 2)]


def links(marks: DataFrame, radius: int = MAX_BITS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Links (a, b) between the different fingerprints of ``marks`` (fp) whose components are those of all links.

    ``marks`` is a written table of different fingerprints. Fingerprints within ``radius`` bits
    agree in two of radius + 2 blocks, so each pair of blocks deals the fingerprints out into
    shards. A shard of more than ``shard_size`` is divided into cells by hash; the tree of each
    cell is sent to the queries of every cell of that shard, through a shuffle, as no driver
    could hold all trees. So a task holds two cells at most, whatever the group.
    """
    if radius < 0 or radius > 31:
        raise ValueError("radius")
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(radius)]
    table = F.explode(F.array(*(F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed))))
    keyed = marks.select("fp", table.alias("k")).select("fp", "k.block", "k.key")
    sizes = written(keyed.groupBy("block", "key").agg(F.count("*").alias("n")).filter("n > 1"), "shards")
    cells = F.ceil(F.col("n") / shard_size).cast("int")
    placed = (
        keyed.join(sizes, ["block", "key"])
        .withColumn("cell", F.pmod(F.xxhash64("fp"), cells).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), cells - 1)))
    )
    shards = placed.groupBy("block", "key", F.least("cell", "other").alias("i"), F.greatest("cell", "other").alias("j")).agg(
        F.collect_list(F.when(F.col("cell") == F.least("cell", "other"), F.col("fp"))).alias("tree"),
        F.collect_list(F.when(F.col("cell") == F.greatest("cell", "other"), F.col("fp"))).alias("asked"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for tree, asked in zip(batch.column(0), batch.column(1)):
                trees, queries = ([x & _MASK for x in side.as_py()] for side in (tree, asked))
                if trees and queries:
                    found += spanning_links(trees, queries, radius)
            pairs = np.array(found, np.uint64).reshape(-1, 2).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return shards.select("tree", "asked").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = SHINGLE_WORDS, radius: int = MAX_BITS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row; root is one fingerprint of the component.

    component_id is the smallest doc_id that can be reached over links of ``radius`` bits or
    fewer, the row's own included. Null and empty texts and texts without words have fingerprint
    zero and are linked like any other. A null doc_id is never the smallest; a component of null
    ids only has a null component_id. Repeated rows stay repeated. Extra columns are ignored.
    """
    marks = written(fingerprints(docs, id_col, text_col, words_per_shingle), "fingerprints")
    least = written(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "marks")
    roots = components(links(least.select("fp"), radius, shard_size))
    known = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_mark = written(known.join(groups, "root").select("fp", "root", "component_id"), "classes")
    return marks.join(by_mark, "fp")


def first_of_each_group(docs: DataFrame, radius: int = MAX_BITS, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component stays: that with the smallest doc_id, then the smallest text hash. All columns stay."""
    classes = written(near_duplicates(docs, words_per_shingle=words_per_shingle, radius=radius), "near")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    keep = classes.groupBy("root").agg(F.min(order).alias("k"))
    keys = keep.select(F.col("k.doc_id").alias("doc_id"), F.col("k.text_hash").alias("text_hash"))
    every = classes.select("doc_id", "text_hash").distinct()
    gone = written(every.join(keys, every["doc_id"].eqNullSafe(keys["doc_id"]) & (every["text_hash"] == keys["text_hash"]), "left_anti"), "removed")
    left = without_rows(docs, gone)
    repeated = classes.groupBy("doc_id", "text_hash").count().filter("count > 1").drop("count")
    again = written(repeated, "repeated")
    if again.isEmpty():
        return left
    same = left["doc_id"].eqNullSafe(again["doc_id"]) & (text_hash(left["text"]) == again["text_hash"])
    alone = left.join(small(again), same, "left_anti")
    several = left.join(small(again), same, "left_semi")
    return alone.union(several.dropDuplicates(["doc_id", "text"]))
