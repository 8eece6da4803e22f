"""Spelling variants against comparing every pair of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from seriesmill.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def is_near(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain_groups(words: dict) -> list:
    near = {w: [] for w in words}
    # all words one deletion away share a key with a word, or with one of its own deletions
    keys = {}
    for w in words:
        for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            keys.setdefault(k, []).append(w)
    for group in keys.values():
        for a in group:
            near[a] += [b for b in group if is_near(a, b)]
    forms = {}
    for w, found in near.items():
        best = min(set(found), key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * words[w] else None
    rows = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, forms[w], root, n, len(set(near[w])), words[forms[w]] if forms[w] else None))
    return sorted(rows)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_index_against_all_pairs():
    rng = random.Random(3)
    for _ in range(100):
        letters, length = "abcé"[: rng.randint(1, 4)], rng.randint(6, 9)
        held = sorted({"".join(rng.choice(letters) for _ in range(length)) for _ in range(rng.randint(1, 60))})
        asked = sorted({"".join(rng.choice(letters + "z") for _ in range(length + rng.randint(-1, 1))) for _ in range(60)} | set(held[:5]))
        who, what = spelling.Index(held).near(asked, np.array([len(w) // 2 for w in asked]), length)
        want = {(a, b) for a in asked for b in held if is_near(a, b) and a[: len(a) // 2] == b[: len(a) // 2]}
        got = [(asked[i], held[j]) for i, j in zip(who, what)]
        assert len(got) == len(set(got)) and set(got) == want


def crowded(n: int) -> dict:
    """Words of few letters, so that each has many near ones, with one beginning that half of them share."""
    rng = random.Random(7)
    words = {}
    for i in range(n):
        word = ("the" if i % 2 else "") + "".join(rng.choice("abcÿ") for _ in range(rng.randint(3, 6)))
        if len(word) >= 6:
            words[word] = 5 * 6 ** rng.randint(0, 5) + rng.randint(0, 2)
    words |= {"x" * 400: 5, "x" * 399: 50, "x" * 398: 2000}
    return words


@pytest.mark.parametrize("block_words, searches", [(20_000, 100_000), (40, 25)])
def test_groups_of_crowded_words(spark, block_words, searches):
    """Also with many small blocks, and with searches dealt to copies of them."""
    words = crowded(1200)
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = rows_of(spelling.group_variants(table, block_words=block_words, searches=searches))
    assert got == plain_groups(words)


def test_query_on_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    words = plain_words([(r.doc_id, r.text) for r in docs])
    got = rows_of(queries.QUERIES["op11_spelling_variants"](spark, "/root/testdata/sf0.01"))
    assert got == plain_groups(words) and any(r[1] for r in got)


def test_odd_texts(spark, make):
    rows = [(None, "nullids " * 6), (1, None), (2, ""), (3, "ÀÉÎÕÜß÷×ÿ abcdef_ghijkl Ābcdefg " * 5), (3, "LETTERS lettérs LETTÉRS letters " * 9), (4, "w" * 3000 + " "), (4, "short " * 9)]
    rows += [(9, "W" * 3000)] * 4
    words = plain_words(rows)
    assert {"w" * 3000, "letters", "lettérs", "lettÉrs", "nullids"} <= set(words)
    assert rows_of(spelling.group_variants(spelling.words_of(make(rows), drop=199))) == plain_groups(words)


def test_no_words(spark, make):
    assert spelling.group_variants(spelling.words_of(make([]))).collect() == []
    assert spelling.group_variants(spelling.words_of(make([(1, "too few words here")]))).collect() == []
