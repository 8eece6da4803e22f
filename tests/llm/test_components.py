"""Components of links: the same by task and by stars, in few tasks when links are few, with no table left that nothing reads."""

from __future__ import annotations

import os
import random

import numpy as np
import pytest

from seriesmill.llm import jaccard
from seriesmill.session import shared_dir


def plain(edges):
    root = {x: x for e in edges if e[0] != e[1] for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return root


def graph(kind: str) -> list[tuple[int, int]]:
    rng = random.Random(kind)
    if kind == "path":
        nodes = rng.sample(range(-500, 500), 200)
        return [*zip(nodes, nodes[1:])]
    if kind == "star":
        return [(7, x) for x in range(-40, 40)]
    return [(rng.randrange(-150, 150), rng.randrange(-150, 150)) for _ in range(120)] * 2


@pytest.mark.parametrize("kind", ["path", "star", "random"])
def test_reachable(kind):
    edges = [e for e in graph(kind) if e[0] != e[1]]
    found = jaccard.reachable(*np.array(edges, dtype=np.int64).T)
    assert dict(zip(*(x.tolist() for x in found))) == plain(edges)


@pytest.mark.parametrize("kind", ["path", "star", "random"])
@pytest.mark.parametrize("held", [4, 60, 1 << 18])
def test_one_task_or_many(spark, monkeypatch, kind, held):
    monkeypatch.setattr(jaccard, "EDGES", held)
    edges = graph(kind)
    rows = spark.createDataFrame(edges, "a long, b long").repartition(6)
    found = [(r.node, r.root) for r in jaccard.smallest_reachable(rows).collect()]
    assert len(found) == len(dict(found)) and dict(found) == plain(edges)


def test_no_links(spark):
    none = spark.createDataFrame([(3, 3), (None, 4)], "a long, b long")
    assert jaccard.smallest_reachable(none).collect() == []


@pytest.fixture
def many_partitions(spark):
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_few_links_take_few_tasks(spark, many_partitions):
    rows = spark.createDataFrame(graph("path"), "a long, b long").coalesce(2)
    spark.sparkContext.setJobGroup("few links", "")
    try:
        jaccard.smallest_reachable(rows)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few links") for s in tracker.getJobInfo(j).stageIds}
    assert stages and sum(tracker.getStageInfo(s).numTasks for s in stages) < 60


def test_tables_that_nothing_reads_go(spark, make, prose):
    def tables():
        top = shared_dir(spark).removeprefix("file:")
        return {d for d in os.listdir(top)} if os.path.isdir(top) else set()

    before = tables()
    texts = [prose(k // 3, 60) + f" {k % 3}" for k in range(30)]
    kept = jaccard.keep_one(make([*enumerate(texts)])).collect()
    left = sorted(d.rpartition("-")[0] for d in tables() - before)
    assert {r.doc_id for r in kept} == {*range(0, 30, 3)}
    assert not {"led", "stars", "links", "edges", "roots", "shared", "pairs", "classes", "components"} & {*left}
