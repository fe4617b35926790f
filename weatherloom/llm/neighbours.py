"""Near duplicates among vectors by NN-descent: neighbour lists refined through the neighbours of neighbours.

Lists begin with what stands next to a vector in sorted random projections. In each round every node visits some
of its neighbours and is compared with all that these list. A list keeps LIST_SIZE neighbours; one that holds
nothing but links is saturated and is enlarged to all links found. Rounds end when they find no
more links and an audit, a few nodes compared with all vectors, finds next to none that is missing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.common import tidy_map, written
from weatherloom.llm.graph import components

MIN_COSINE = 0.9
LIST_SIZE = 12
#: Sorted projections that the lists begin with, and those added when an audit fails.
TREES, MORE_TREES = 6, 4
#: Nodes on each side in a sorted projection that a node is compared with.
WINDOW = 8
#: Neighbours that a node visits in a round: about so many, and of longer lists no fewer than LEAST_VISITS.
VISITS, LEAST_VISITS = 6, 2
#: Vectors on either side of one comparison in a task.
CELL = 2048
AUDITED = 256
MIN_RECALL = 0.995
MAX_ROUNDS = 40
#: Cosines so close to the limit are taken again in a fixed order of additions.
_NEAR = 1e-9
_SEED = 12


def unit_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vec) of every row; vec holds the doubles of the unit vector, null where there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, out = batch.column(1), []
            for row in column:
                values = None
                if row.is_valid and len(row.values) and not row.values.null_count:
                    values = row.values.to_numpy(zero_copy_only=False).astype(float)
                    top = np.abs(values).max()
                    values = values / top if np.isfinite(values).all() and top > 0 else None
                out.append(None if values is None else (values / np.sqrt(values @ values) + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "vec"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return tidy_map(rows, run, "vec_id long, vec binary")


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(len(column), -1)


def _pair_cosines(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Cosines of all rows of a with all of b; those next to ``limit`` do not depend on how the rows were put together."""
    out = a @ b.T
    i, j = np.nonzero(np.abs(out - limit) < _NEAR)
    if len(i):
        out[i, j] = [float(np.add.accumulate(x * y)[-1]) for x, y in zip(a[i], b[j])]
    return out


def _projected(nodes: DataFrame, trees: range, bits: int) -> DataFrame:
    """(tree, width, sign, line, node, vec): the signs of random projections as a number, and one more projection, by tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = np.array([len(v) for v in batch.column(1).to_pylist()]) // 8
            for w in np.unique(width).tolist():
                own = batch.filter(pa.array(width == w))
                vectors = _matrix(own.column(1))
                for tree in trees:
                    planes = np.random.default_rng([_SEED, tree, w]).standard_normal((w, bits + 1))
                    side = vectors @ planes
                    sign = (side[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    columns = [pa.array(np.full(len(own), x, np.int32)) for x in (tree, w)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(sign.astype(np.int64)), pa.array(side[:, bits]), *own.columns], names)

    names = ["tree", "width", "sign", "line", "node", "vec"]
    return nodes.select("node", "vec").mapInArrow(run, "tree int, width int, sign long, line double, node long, vec binary")


_FOUND = "node long, ids binary, cosines binary"


def _found(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = zip(*((n, i.astype(np.int64).tobytes(), c.astype(float).tobytes()) for n, i, c in rows)) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary()))], ["node", "ids", "cosines"])


def _best(ids: np.ndarray, cosines: np.ndarray, limit: float, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``size`` nearest of different neighbours and every link beyond them, nearest first."""
    order = np.lexsort((ids, -cosines))
    ids, cosines = ids[order], cosines[order]
    _, first = np.unique(ids, return_index=True)
    first.sort()
    keep = first[(np.arange(len(first)) < size) | (cosines[first] >= limit)]
    return ids[keep], cosines[keep]


def _beside(nodes: DataFrame, trees: range, bits: int, limit: float, size: int) -> DataFrame:
    """(node, ids, cosines): what stands within WINDOW rows in each sorted projection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, vectors = np.zeros((0, 2), np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            tree, width = (batch.column(i).to_numpy() for i in (0, 1))
            cuts = np.flatnonzero((np.diff(tree) != 0) | (np.diff(width) != 0)) + 1
            for part in np.split(np.arange(len(batch)), cuts):
                if not len(part):
                    continue
                rows = batch.slice(int(part[0]), len(part))
                key, own = (int(tree[part[0]]), int(width[part[0]])), rows.column(4).to_numpy()
                fresh = _matrix(rows.column(5))
                if vectors is None or keys != key:
                    keys, ids, vectors = key, own, fresh
                    held = 0
                else:  # the rows before the cut are compared with those after it
                    held = min(WINDOW, len(ids))
                    ids, vectors = np.concatenate((ids[-held:], own)), np.concatenate((vectors[-held:], fresh))
                yield _found(_band(ids, vectors, held))

    def _band(ids: np.ndarray, vectors: np.ndarray, held: int) -> list:
        """Neighbours of each row; of two held rows nothing, as that was said before."""
        n = len(ids)
        near = np.full((n, 2 * WINDOW), -2.0)
        at = np.zeros((n, 2 * WINDOW), np.int64)
        for step in range(1, min(WINDOW, n - 1) + 1):
            cosine = np.einsum("ij,ij->i", vectors[:-step], vectors[step:])
            cosine[: max(held - step, 0)] = -2.0
            near[:-step, step - 1], at[:-step, step - 1] = cosine, ids[step:]
            near[step:, WINDOW + step - 1], at[step:, WINDOW + step - 1] = cosine, ids[:-step]
        order = np.argsort(-near, axis=1)[:, :size]
        near, at = np.take_along_axis(near, order, 1), np.take_along_axis(at, order, 1)
        return [(int(i), a[c > -2.0], c[c > -2.0]) for i, a, c in zip(ids, at, near)]

    sorted_ = _projected(nodes, trees, bits).repartitionByRange("tree", "width", "sign", "line").sortWithinPartitions("tree", "width", "sign", "line", "node")
    return sorted_.mapInArrow(run, _FOUND)


def _merged(lists: DataFrame, limit: float, size: int) -> DataFrame:
    """(node, ids, cosines, links, fresh) of every node of ``lists`` (node, ids, cosines, old): one list from all its parts.

    links counts the neighbours at the limit or nearer, fresh tells whether the list has any that the old one had not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, links, fresh = [], [], []
            for node, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(b"".join(p["ids"] for p in parts), np.int64)
                cosines = np.frombuffer(b"".join(p["cosines"] for p in parts), float)
                other = ids != node
                best = _best(ids[other], cosines[other], limit, size)
                before = np.frombuffer(b"".join(p["ids"] for p in parts if p["old"]), np.int64)
                out.append((node, *best))
                links.append(int((best[1] >= limit).sum()))
                fresh.append(not np.isin(best[0], before).all())
            found = _found(out)
            yield pa.RecordBatch.from_arrays([*found.columns, pa.array(links, pa.int64()), pa.array(fresh, pa.bool_())], ["node", "ids", "cosines", "links", "fresh"])

    grouped = lists.groupBy("node").agg(F.collect_list(F.struct("ids", "cosines", "old")).alias("parts"))
    return tidy_map(grouped, run, f"{_FOUND}, links long, fresh boolean")


def _visits(state: DataFrame, round_: int) -> DataFrame:
    """(center, node, fresh): the neighbours that nodes visit this round; fresh tells whether the node's own list is new.

    A node visits a neighbour by the neighbour's hash, so that nodes of one crowd with long lists meet at the same few.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            center, node, fresh = [], [], []
            for own, ids, new in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                listed = np.frombuffer(ids, np.int64)
                share = max(LEAST_VISITS, VISITS * LIST_SIZE / max(len(listed), 1)) / max(len(listed), 1)
                mixed = (listed.astype(np.uint64) + np.uint64(round_ * 0x632BE59B)) * np.uint64(0x9E3779B97F4A7C15)
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                chosen = listed[(mixed >> np.uint64(11)).astype(float) / (1 << 53) < share]
                center.append(chosen)
                node.append(np.full(len(chosen), own))
                fresh.append(np.full(len(chosen), new))
            columns = [pa.array(np.concatenate(c) if c else [], k) for c, k in ((center, pa.int64()), (node, pa.int64()), (fresh, pa.bool_()))]
            yield pa.RecordBatch.from_arrays(columns, ["center", "node", "fresh"])

    return state.select("node", "ids", "fresh").mapInArrow(run, "center long, node long, fresh boolean")


def _listed(state: DataFrame, centers: DataFrame) -> DataFrame:
    """(center, node): the lists of the centers, and the centers themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                listed = np.append(np.frombuffer(ids, np.int64), own)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(listed), own)), pa.array(listed)], ["center", "node"])

    return state.join(centers, state["node"] == centers["center"], "left_semi").select("node", "ids").mapInArrow(run, "center long, node long")


def _round(state: DataFrame, nodes: DataFrame, round_: int, limit: float, size: int, cell: int) -> DataFrame:
    """(node, ids, cosines): what nodes find in the lists of the neighbours they visit; links are told to both ends."""
    visits = written(_visits(state, round_), "visits")
    new = state.filter("fresh").select(F.col("node").alias("center"))
    lively = visits.filter("fresh").select("center").union(visits.join(new, "center", "left_semi").select("center")).distinct()
    centers = written(visits.join(lively, "center", "left_semi").groupBy("center").agg(F.count("*").alias("visitors")), "centers")
    listed = written(_listed(state, centers), "listed")
    sizes = written(centers.join(listed.groupBy("center").agg(F.count("*").alias("listed")), "center"), "sizes")
    asking = F.ceil(F.col("visitors") / cell).cast("int")
    answering = F.ceil(F.col("listed") / cell).cast("int")

    def dealt(rows: DataFrame, own: Column, other: Column, names: list[str], asks: bool) -> DataFrame:
        placed = rows.join(sizes, "center").withColumn(names[0], F.pmod(F.xxhash64("node"), own).cast("int")).withColumn(names[1], F.explode(F.sequence(F.lit(0), other - 1)))
        return placed.select("center", "i", "j", "node", F.lit(asks).alias("asks"))

    asks = dealt(visits.select("center", "node"), asking, answering, ["i", "j"], True)
    answers = dealt(listed, answering, asking, ["j", "i"], False)
    rows = asks.union(answers).join(nodes.select("node", "vec"), "node")
    groups = rows.groupBy("center", "i", "j").agg(
        F.collect_list(F.when(F.col("asks"), F.struct("node", "vec"))).alias("asks"), F.collect_list(F.when(~F.col("asks"), F.struct("node", "vec"))).alias("answers")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for asks, answers in zip(batch.column(0), batch.column(1)):
                a, b = asks.values, answers.values
                if not len(a) or not len(b):
                    continue
                mine, theirs = a.field(0).to_numpy(), b.field(0).to_numpy()
                cosines = _pair_cosines(_matrix(a.field(1)), _matrix(b.field(1)), limit)
                for node, row in zip(mine.tolist(), cosines):
                    near = np.flatnonzero(row >= limit)
                    if len(near) < size:
                        near = np.argpartition(-row, size)[:size] if len(row) > size else np.arange(len(row))
                    out.append((node, theirs[near], row[near]))
                    held += len(near)
                for at in np.flatnonzero((cosines >= limit).any(axis=0) & ~np.isin(theirs, mine)).tolist():
                    near = np.flatnonzero(cosines[:, at] >= limit)
                    out.append((int(theirs[at]), mine[near], cosines[near, at]))
                    held += len(near)
                if held > 500_000:
                    yield _found(out)
                    out, held = [], 0
            yield _found(out)

    return groups.select("asks", "answers").mapInArrow(run, _FOUND)


def audit(state: DataFrame, nodes: DataFrame, limit: float, audited: int = AUDITED) -> tuple[DataFrame, float]:
    """(lists of the audited nodes by comparing them with all vectors, share of their links that their lists have).

    Half of the audited are nodes with links, half any; both by hash. No links, a share of 1.
    """
    order = F.xxhash64("node", F.lit(_SEED))
    linked = state.filter("links > 0").orderBy(order).limit(audited // 2).select("node")
    chosen = linked.union(state.orderBy(order).limit(audited // 2).select("node")).distinct()
    sample = nodes.join(F.broadcast(chosen), "node").select("node", "vec").collect()  # ``audited`` rows at most
    by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for width in {len(r["vec"]) for r in sample}:
        own = [r for r in sample if len(r["vec"]) == width]
        by_width[width] = np.array([r["node"] for r in own]), np.frombuffer(b"".join(bytes(r["vec"]) for r in own), float).reshape(len(own), -1)
    sent = nodes.sparkSession.sparkContext.broadcast(by_width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            ids, vectors = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for width, (own, matrix) in sent.value.items():
                same = np.array([i for i, v in enumerate(vectors) if len(v) == width], np.int64)
                if len(same):
                    cosines = _pair_cosines(matrix, np.frombuffer(b"".join(vectors[i] for i in same), float).reshape(len(same), -1), limit)
                    out += [(int(n), ids[same[row >= limit]], row[row >= limit]) for n, row in zip(own, cosines) if (row >= limit).any()]
            yield _found(out)

    lists = written(_merged(nodes.select("node", "vec").mapInArrow(run, _FOUND).withColumn("old", F.lit(False)), limit, 0), "audit")
    both = lists.select("node", F.col("links").alias("true")).join(state.select("node", "links"), "node", "left")
    true, known = both.agg(F.sum("true"), F.sum(F.least("true", F.coalesce("links", F.lit(0))))).first()
    return lists.select("node", "ids", "cosines"), 1.0 if not true else known / true


def descended(nodes: DataFrame, limit: float = MIN_COSINE, size: int = LIST_SIZE, cell: int = CELL, trees: int = TREES) -> DataFrame:
    """The neighbour lists (node, ids, cosines, links, fresh) of a written table of nodes (node, vec) when no round finds more links."""
    count = nodes.count()
    bits = min(40, max(0, int(np.log2(max(count, 1) / WINDOW))) if count > WINDOW else 0)

    def merged(*parts: DataFrame, state: DataFrame | None = None) -> DataFrame:
        rows = nodes.select("node", F.lit(b"").alias("ids"), F.lit(b"").alias("cosines"), F.lit(True).alias("old"))
        if state is not None:
            rows = state.select("node", "ids", "cosines", F.lit(True).alias("old"))
        for part in parts:
            rows = rows.union(part.withColumn("old", F.lit(False)))
        return written(_merged(rows, limit, size), "lists")

    state = merged(_beside(nodes, range(trees), bits, limit, size))
    links, planted = -1, trees
    for round_ in range(MAX_ROUNDS):
        found = state.agg(F.sum("links")).first()[0] or 0
        if found == links:
            lists, recall = audit(state, nodes, limit)
            if recall >= MIN_RECALL:
                break
            state = merged(lists, _beside(nodes, range(planted, planted + MORE_TREES), bits, limit, size), state=state)
            planted += MORE_TREES
        links = found
        state = merged(_round(state, nodes, round_, limit, size, cell), state=state)
    return state


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", limit: float = MIN_COSINE, size: int = LIST_SIZE, cell: int = CELL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: links are other rows with a cosine of ``limit`` or more.

    Equal unit vectors are folded first, so copies cost nothing. component_id is the smallest vec_id that links reach,
    the row's own included; kept tells whether it is the row's own. Vectors that are null, empty or
    zero or have null or non-finite components link with nothing, nor do vectors of different lengths. A null
    vec_id is never the smallest; a component of null ids has a null component_id, and its rows are kept. Repeated rows are rows
    of their own, linked with each other. No rows, no result; extra columns are ignored. No pair below the limit is
    ever a link; pairs above it may be missed, of which the audit admits one in 200.
    """
    units = written(unit_vectors(vectors, id_col, vector_col), "units")
    folded = units.filter("vec is not null").groupBy("vec").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    nodes = written(folded.withColumn("node", F.monotonically_increasing_id()), "nodes")
    state = descended(nodes.select("node", "vec"), limit, size, cell)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, ids, cosines in zip(*(c.to_pylist() for c in batch.columns)):
                other = np.frombuffer(ids, np.int64)[np.frombuffer(cosines, float) >= limit]
                a, b = np.full(len(other), node), other
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((a, b))), pa.array(np.concatenate((b, a)))], ["a", "b"])

    links = written(state.filter("links > 0").select("node", "ids", "cosines").mapInArrow(linked, "a long, b long").distinct(), "near")
    copies = nodes.select(F.col("node").alias("b"), "copies")
    counts = links.join(copies, "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others"))
    known = nodes.join(components(links.filter("a < b")), "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = written(known.join(groups, "root").join(counts, "node", "left").select("vec", "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    joined = units.join(classes, "vec", "left")
    own = F.when(F.col("vec").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))


#: For DuckDB: every pair, and labels passed on along the links.
SQL = f"""
WITH RECURSIVE e AS (
  SELECT row_number() OVER () AS i, vec_id, embedding::DOUBLE[] AS v FROM embeddings
), v AS MATERIALIZED (
  SELECT i, vec_id, v FROM e
  WHERE v IS NOT NULL AND len(v) > 0 AND NOT list_contains(list_transform(v, lambda x: x IS NULL OR NOT isfinite(x)), true) AND list_sum(list_transform(v, lambda x: abs(x))) > 0
), l AS (
  SELECT a.i AS a, b.i AS b, b.vec_id FROM v AS a JOIN v AS b ON a.i <> b.i AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= {MIN_COSINE}
), r AS (
  SELECT i AS a, i AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
), c AS (
  SELECT r.a AS i, min(v.vec_id) AS component_id FROM r JOIN v ON v.i = r.b GROUP BY r.a
), n AS (
  SELECT a AS i, count(*) AS n FROM l GROUP BY a
)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, CASE WHEN c.i IS NULL THEN e.vec_id ELSE c.component_id END AS component_id,
  e.vec_id IS NOT DISTINCT FROM CASE WHEN c.i IS NULL THEN e.vec_id ELSE c.component_id END AS kept
FROM e LEFT JOIN c USING (i) LEFT JOIN n USING (i)
"""
