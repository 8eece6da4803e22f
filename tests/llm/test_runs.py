"""Periodic runs against a search of every period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from seriesmill.llm import queries, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words: list, least: int = 12) -> list:
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        t = 0
        while t + q < n:
            start = t
            while t + q < n and words[t] == words[t + q]:
                t += 1
            if t + q - start >= max(least, 2 * q):
                best.setdefault((start, t + q), q)
            t += 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def fibonacci(n: int) -> list:
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_of_all_kinds():
    rng = random.Random(1)
    for turn in range(1500):
        n, letters = rng.randint(0, 120), rng.choice([1, 2, 2, 3, 4])
        if turn % 3 == 0:
            words = [rng.randrange(letters) for _ in range(n)]
        elif turn % 3 == 1:
            words = fibonacci(n)
            for _ in range(rng.randint(0, 3)):
                if words:
                    words[rng.randrange(len(words))] = rng.randrange(3)
        else:
            words = []
            while len(words) < n:
                words += [rng.randrange(letters) for _ in range(rng.randint(1, 8))] * rng.randint(1, 6)
        least = rng.choice([2, 3, 12])
        assert [tuple(r) for r in runs.find_runs(np.array(words, dtype=np.int64), least).tolist()] == plain_runs(words, least), words


def test_long_texts_end():
    assert runs.find_runs(np.zeros(300_000, dtype=np.int64)).tolist() == [[0, 300_000, 1]]
    assert len(runs.find_runs(np.array(fibonacci(100_000)))) > 10_000


def changed(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = changed(doc_id, text)
    found = plain_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, digest(lines), digest(collapsed))


ODD = [
    (None, "a b " * 20),
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "  x\x0by z\x1c  " * 9),
    (5, "same " * 5000),
    (5, "same " * 5000),
    (6, "é " * 12),
    (7, "one two three"),
    (8, "a b c d e f " * 3 + "tail"),
]


def test_query_on_odd_and_given_texts(spark, make, tmp_path):
    given = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = ODD + given
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=key) == sorted((expected(*r) for r in rows if len(changed(*r)) < 6000), key=key)
    assert got.where("runs_sha256 IS NULL OR collapsed_sha256 IS NULL").isEmpty()


def test_empty_table(spark, make):
    assert runs.periodic_runs(runs.repeat_some(make([]))).collect() == []


def test_texts_with_many_words_between_batches(spark, make):
    """Batches are cut by size; equal words of two texts never make a run."""
    docs = make([(i, "w " * 11) for i in range(300)])
    assert runs.periodic_runs(docs).agg(F.max(F.size("runs"))).first()[0] == 0
