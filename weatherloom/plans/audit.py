"""What a plan does that a large cluster would suffer from, read off the plan itself."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Finding(NamedTuple):
    """One doubtful node: ``kind`` is one of KINDS, ``node`` its line in the plan."""

    kind: str
    node: str


#: Every pair of rows; a loop over a broadcast side; rows sent to Python; a partitioned table read without a
#: condition on its partitions; a broadcast that nobody asked for, so that only Spark's estimate vouches for its size.
KINDS = ("cross join", "nested loop", "python stage", "all partitions", "estimated broadcast")

_PYTHON = re.compile("Python|ArrowEval|MapInArrow|MapInPandas|InPandas|InArrow|PandasGroup")


def _below(node) -> Iterator:
    """A node of the physical plan and all under it, through adaptive plans, finished stages and reused exchanges."""
    yield node
    name = node.nodeName()
    inner = []
    if name.startswith("AdaptiveSparkPlan"):
        inner = [node.executedPlan()]
    elif "QueryStage" in name:
        inner = [node.plan()]
    elif name.startswith("ReusedExchange"):
        return
    children = node.children()
    for child in inner or [children.apply(i) for i in range(children.size())]:
        yield from _below(child)


def nodes(df: DataFrame) -> list:
    """The nodes of the physical plan of ``df``; nothing is run."""
    return list(_below(df._jdf.queryExecution().executedPlan()))


def findings(df: DataFrame) -> list[Finding]:
    """What KINDS names, in plan order. A broadcast counts as asked for if the optimized plan bears as many hints or more."""
    found = []
    hinted = len(re.findall(r"(?:left|right)Hint=\(strategy=broadcast\)|(?:left|right)Hint=\(strategy=Some\(broadcast\)\)|strategy=broadcast", df._jdf.queryExecution().optimizedPlan().toString()))
    broadcasts = []
    for node in nodes(df):
        name, line = node.nodeName(), node.simpleString(25)
        if name == "CartesianProduct":
            found.append(Finding("cross join", line))
        elif name == "BroadcastNestedLoopJoin":
            found.append(Finding("nested loop", line))
        elif _PYTHON.search(name):
            found.append(Finding("python stage", line))
        elif name.startswith("Scan") and hasattr(node, "relation") and _unpruned(node):
            found.append(Finding("all partitions", line))
        elif name.startswith("BroadcastHashJoin"):
            broadcasts.append(Finding("estimated broadcast", line))
    return found + broadcasts[hinted:]


def _unpruned(scan) -> bool:
    """Whether a file scan has partition columns and no condition on them."""
    if "FileSourceScan" not in scan.getClass().getSimpleName():
        return False
    return scan.relation().partitionSchema().size() > 0 and scan.partitionFilters().isEmpty()


def exchanges(df: DataFrame) -> int:
    """Shuffles of the plan; a reused one counts once."""
    return sum(node.nodeName() == "Exchange" for node in nodes(df))


def scanned_rows(df: DataFrame) -> int:
    """Rows that file scans hand on when the rows of ``df`` are counted: what files and row groups could not be skipped.

    Runs the count; conditions are pushed down as for ``df``.
    """
    counted = df.agg(F.count(F.lit(1)))
    counted.collect()
    scans = [n for n in nodes(counted) if n.nodeName().startswith("Scan")]
    return sum(n.metrics().apply("numOutputRows").value() for n in scans)
