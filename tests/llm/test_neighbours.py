"""Near vectors against brute force."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from weatherloom.llm import neighbours

VECTORS = "vec_id long, embedding array<double>, label int"


def brute(rows):
    """n_links, component and kept of every row, all pairs compared."""
    units = []
    for _, v in rows:
        fine = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        units.append(np.array(v) / max(map(abs, v)) if fine else None)
    linked = [[] for _ in rows]
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            if i != j and a is not None and b is not None and len(a) == len(b):
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.9:
                    linked[i].append(j)
    out = []
    for i, (own, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        component = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((own, len(linked[i]), component, own == component))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def planted():
    """Groups of near copies from 2 to 120, a chain, exact copies, scaled copies, and vectors that stand alone."""
    rng = np.random.default_rng(5)
    rows = [rng.standard_normal(24) for _ in range(300)]
    for n in (2, 2, 3, 5, 30, 120):
        base = rng.standard_normal(24)
        rows += [base + 0.1 * rng.standard_normal(24) for _ in range(n)]
    axis, other = np.eye(24)[:2]
    rows += [math.cos(i * 0.4) * axis + math.sin(i * 0.4) * other for i in range(8)]
    rows += [rows[0]] * 40 + [rows[1] * 4, rows[1] * -1]
    order = rng.permutation(len(rows))
    return [(int(1000 - i), rows[j].tolist()) for i, j in enumerate(order)]


def test_groups_chains_and_copies(spark, planted):
    df = spark.createDataFrame([(i, v, 0) for i, v in planted], VECTORS)
    assert found(neighbours.near_vectors(df)) == brute(planted)


def test_small_cells_and_lists_find_the_same(spark, planted):
    df = spark.createDataFrame([(i, v, 0) for i, v in planted], VECTORS)
    assert found(neighbours.near_vectors(df, size=5, cell=16)) == brute(planted)


def test_audit_counts_what_is_missing(spark, planted):
    units = neighbours.unit_vectors(spark.createDataFrame([(i, v, 0) for i, v in planted], VECTORS))
    nodes = neighbours.written(units.groupBy("vec").agg(F.min("vec_id").alias("node")), "nodes")
    nothing = nodes.select("node", F.lit(b"").alias("ids"), F.lit(b"").alias("cosines"), F.lit(0).cast("long").alias("links"))
    _, recall = neighbours.audit(nothing, nodes, 0.9, audited=600)
    assert recall == 0
    _, recall = neighbours.audit(neighbours.descended(nodes), nodes, 0.9, audited=600)
    assert recall == 1


def test_limit_is_met_or_missed(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.9, math.sqrt(1 - 0.81)]), (3, [0.899999, -math.sqrt(1 - 0.899999**2)]), (4, [1e300, 1e290]), (5, [1e-310, 0.0])]
    got = {r[0]: r for r in found(neighbours.near_vectors(spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)))}
    assert got[3][1] == 0
    assert got[1][2] == got[4][2] == got[5][2] == 1


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 2.0]), (None, None),
        (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0, 0.0]), (9, [-0.0, 5.0]), (10, [0.0, 5.0]), (None, [-3.0, 1.0]), (None, [-3.0, 1.0]),
    ]
    df = spark.createDataFrame([(i, v, None) for i, v in rows], VECTORS)
    for name in ("node", "vec", "ids", "root", "copies", "links", "component_id", "kept"):
        df = df.withColumn(name, F.lit(1))
    got = found(neighbours.near_vectors(df))
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding DOUBLE[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    assert got == sorted(con.execute(neighbours.SQL).fetchall(), key=repr)
    assert got == [r if r[0] is not None else (None, *r[1:3], r[2] is None) for r in brute(rows)]
    assert neighbours.near_vectors(df.filter(F.lit(False))).collect() == []
