"""The mix of sources against a plain version of its targets, its schedule and its streams."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seriesmill.llm import mixing

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size string, part string, slot string"


@pytest.fixture
def table(spark):
    return lambda rows: spark.createDataFrame([(i, t, "en", s, 0, "x", "y", "z") for i, t, s in rows], COLUMNS)


def plain_targets(sizes: dict) -> dict:
    """Share by weight, stop at three times the size, share again what is left, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    full: set = set()
    while True:
        free = [s for s in names if s not in full]
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        got = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if got[s] > 3 * sizes[s]}
        if not over:
            return {**{s: 3.0 * sizes[s] for s in full}, **got}
        full |= over


def plain_taken(rows) -> Counter:
    """(doc_id, size, taken) of every row."""
    sizes: dict = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    targets, streams, found = plain_targets(sizes), defaultdict(list), Counter()
    for i, text, source in rows:
        streams[source].append((hashlib.md5(str(i).encode()).hexdigest(), i, len((text or "").split())))
    for source, held in streams.items():
        quota, at = int(targets[source] + 0.5), 0
        for _, i, size in sorted(held):
            whole, rest = divmod(quota, sizes[source]) if sizes[source] else (0, 0)
            found[(i, size, size * whole + max(0, min(size, rest - at)))] += 1
            at += size
    return found


def rows(seed: int, sources, n: int):
    rng = random.Random(seed)
    return [(i, "w " * rng.choice([0, 1, 7, 40, 3000]), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize(
    "made",
    [
        rows(1, ["a"] * 30 + ["b", "c", "é", "B", None, "😀", "ﬀ"], 400),
        rows(2, [f"s{i}" for i in range(150)], 300),
        rows(3, ["only"], 20),
        rows(4, [None], 5) + [(7, None, "x"), (7, "a b c", "x"), (7, "a b c", "x"), (8, "", "empty"), (9, " \n", "empty")],
        [(1, "word " * 50_000, "long"), (2, "a", "short"), (3, "b", "tiny")],
    ],
)
def test_taken_against_plain(table, made):
    got = mixing.taken(table(made))
    assert Counter((r.doc_id, r.size, r.taken) for r in got.collect()) == plain_taken(made)
    over = got.where((F.col("taken") > 3 * F.col("size")) | (F.col("target") > 3 * F.col("source_size"))).count()
    assert over == 0


def test_block_size_changes_the_order_only(table):
    made = table(rows(5, ["a", "a", "a", "b", "c"], 120))
    one, other = (sorted(tuple(r) for r in mixing.taken(made, block_words=b).collect()) for b in (1024, 17))
    assert one == other


def test_schedule_and_pieces(spark, table):
    made = rows(6, ["a"] * 5 + ["b", "c", "d"], 300)
    docs = table(made)
    mixed = mixing.mix(docs, block_words=64).collect()
    texts = {i: len((t or "").split()) for i, t, _ in made}
    slots = defaultdict(list)
    for r in mixed:
        assert 0 <= r.first < r.last <= texts[r.doc_id]
        slots[r.slot].append(r)
    for held in slots.values():
        held.sort(key=lambda r: r.place)
        assert len({r.source for r in held}) == 1 and sum(r.last - r.first for r in held) <= 64
        assert all(a.place + a.last - a.first == b.place for a, b in zip(held, held[1:]))
    # in every stretch of the mix each source has about its share
    targets = plain_targets(Counter({s: sum(len(t.split()) for _, t, x in made if x == s) for s in "abcd"}))
    order = [slots[s][0].source for s in sorted(slots)]
    for begin in range(0, len(order) - 500, 500):
        part = Counter(order[begin : begin + 500])
        for source, target in targets.items():
            assert abs(part[source] - 500 * target / sum(targets.values())) < 8
    # every copy of a document is whole unless its source ends there
    again = mixing.mix(docs, block_words=64).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, mixed))


def test_no_words_and_no_rows(table):
    assert mixing.taken(table([])).collect() == []
    assert [(r.taken, r.target) for r in mixing.taken(table([(1, None, "a"), (2, " ", None)])).collect()] == [(0, 0.0)] * 2


def test_main_path_has_no_python(table):
    plan = mixing.taken(table(rows(8, ["a", "b"], 20)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
