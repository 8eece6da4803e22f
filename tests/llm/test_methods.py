"""Each operator against a plain version of itself, on small inputs made to be hard."""

from __future__ import annotations

import random
import re
from html import unescape

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from seriesmill.llm import bpe, codec, decontaminate, html_text, jaccard, pii, token_counts, topk, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(bpe.tokenizer_path())


ODD = ["'s", "'ll", "'", "l", " ", "  ", "\n", "a", "B", "é", "1", "²", "Ⅷ", "\x1c", "\x85", "\xa0", "　", "<|endoftext|>", "<|", "漢", "👍", "!", "_", "\x00", "़", "𐐀", "१"]


def odd_texts(n: int):
    rng = random.Random(5)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(1, 14))) for _ in range(n)]


def test_pieces_and_prefixes(tokenizer):
    vocab = bpe.vocabulary(bpe.tokenizer_path())
    counter = token_counts.Counter(vocab)
    for text in odd_texts(3000):
        whole = tokenizer.encode(text, add_special_tokens=False).ids
        assert [i for p in vocab.pieces(text) for i in vocab.encode_piece(p)] == whole
        prefixes = token_counts.Prefixes(text, counter)
        counts = [len(tokenizer.encode(text[:n], add_special_tokens=False).ids) for n in range(len(text) + 1)]
        assert [prefixes.upto(n) for n in range(len(text) + 1)] == counts, repr(text)
        for budget in (0, 1, 3):
            assert prefixes.within(budget) == max(n for n, c in enumerate(counts) if c <= budget), repr(text)


def test_codec(spark, make, tokenizer):
    made = odd_texts(400)
    docs = make(list(enumerate(made)))
    for chunk in (50, codec.CHUNK_CHARS):
        got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in codec.encode(docs, chunk_chars=chunk).collect()}
        assert got == {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in enumerate(made)}
    assert {r.doc_id: r.text for r in codec.decode(codec.encode(docs)).collect()} == dict(enumerate(made))


BASE = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_pii(text: str):
    found = []
    for kind, pattern in zip(pii.BASE, BASE):
        for m in pattern.finditer(text):
            digits = re.sub(r"[^0-9]", "", m.group())
            doubled = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".") if kind == "ip"),
                "card": 14 <= len(digits) <= 19 and doubled % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }
            if good[kind]:
                found.append((m.start(), pii.BASE.index(kind), m.end()))
    return sorted(found)


def test_pii(texts):
    rng = random.Random(1)
    made = [t for _, t in texts] + ["".join(rng.choice("a1.@-2 +()0%9é") for _ in range(rng.randint(1, 30))) for _ in range(20_000)]
    for text in made:
        base = [(s, pii.KINDS.index(k), e) for s, k, e, _ in pii.find(text) if k in pii.BASE]
        assert base == plain_pii(text), repr(text)


def test_iban_and_context():
    spans = pii.find("account GB82WEST12345698765432; not GB82WEST12345698765431")
    assert [(k, s, e) for s, k, e, _ in spans] == [("iban", 8, 30)]
    near = pii.find("call +49 30 1234567")[0][3]
    assert near > pii.find("order +49 30 1234567")[0][3]


def test_html_on_pages():
    for html, in duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet'").fetchall():
        article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", article)]
        assert html_text.main_text(html) == "\n\n".join(b for b in blocks if b)


def test_html_rules():
    long = "This is the text of the article and it has many of the small words that are in all texts. " * 3
    page = (
        f"<body class='has-sidebar'><header>Site name</header><div class='cookie-notice'>{long}</div><h2>Heading</h2><div>{long}</div>"
        f"<p>short one.</p><div>{long}</div><div><a href=x>{long}</a></div><aside>{long}</aside><form>{long}</form>"
        f"<section id=comments><p>{long}</p></section><script>if (a<b) '<p>'</script><footer>{long}</footer><p>Bye."
    )
    want = " ".join(long.split())
    assert html_text.main_text(page).split("\n\n") == ["Heading", want, "short one.", want]
    assert html_text.main_text("<article>a<br>b<br><br>c <!-- <p> -->d</article>") == "a b\n\nc d"


def linked(a: set, b: set) -> bool:
    return bool(a and b) and 100 * len(a & b) >= 80 * len(a | b)


def plain_components(rows):
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if linked(sets[i], sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard(make, prose, monkeypatch):
    """Chains of edits near the threshold, a passage that many texts share, groups over several top nodes."""
    monkeypatch.setattr(jaccard, "TOP", 8)
    monkeypatch.setattr(jaccard, "FAN", 2)
    rng = random.Random(2)
    passage, rows = prose(99, 40), []
    for base in range(12):
        words = prose(base, 60 + 10 * (base % 3)).split()
        for step in range(14):
            text = list(words)
            for _ in range(step % 5):
                text[rng.randrange(len(text))] = f"x{rng.random()}"
            if step % 4 == 3:
                words = text  # a chain: the next ones start here
            rows.append((len(rows), " ".join(text)))
    rows += [(1000 + i, f"{passage} {prose(500 + i, 5 + i % 12)}") for i in range(60)]
    rows += [(2000 + i, prose(i % 3, 3).upper()) for i in range(9)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_join(make(rows)).collect()}
    assert got == plain_components(rows)
    kept = {r.doc_id for r in jaccard.keep_one(make(rows)).collect()}
    assert kept == {c for _, c in got.values()}


def test_trees_lose_no_pair():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 1 << 62, 60, dtype=np.uint64)) for _ in range(30)]
    for k in range(200):
        base = sets[k % 30].copy()
        base[: k % 9] = rng.integers(0, 1 << 62, k % 9, dtype=np.uint64)
        sets.append(np.unique(base))
    sets.sort(key=len)
    signatures = np.stack([jaccard.signature(s).view(np.uint64) for s in sets])
    sizes = np.array([len(s) for s in sets])
    tree = jaccard.Tree(np.arange(len(sets)), jaccard.leaves(sizes, signatures))
    found = {(int(a), int(b)) for i, j in jaccard.traverse(tree, tree, True) for a, b in zip(i, j)}
    plain = [set(s.tolist()) for s in sets]
    assert {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if linked(plain[i], plain[j])} <= found
    assert len(found) < len(sets) ** 2 / 4


def test_prefixes_meet():
    for n in range(1, 200):
        for m in range(n, 200):
            need = -(-80 * (n + m) // 180)
            assert need == jaccard.least_overlap(n, m)
            if need <= n:  # a link is possible: what lies outside a prefix leaves enough of it inside
                assert n - jaccard.prefix_length(n) <= need - jaccard.shared_least(n)
                assert m - jaccard.prefix_length(m) <= need - jaccard.shared_least(m)


def plain_hits(text, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    w, hit, found = words(text), set(), set()
    for item, passage in items:
        p = words(passage)
        n = min(window, len(p))
        pieces = {tuple(p[i : i + n]) for i in range(len(p) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in pieces:
                hit.update(range(i, i + n))
                found.add(item)
    return len(w), len(hit), len(found)


def test_contamination(spark, make, prose):
    items = [(i, prose(i, 8 + i)) for i in range(12)] + [(50, "Éa b"), (51, prose(3, 30))]
    rows = []
    for i in range(40):
        piece = items[i % 14][1].split()
        cut = piece[i % 3 : i % 3 + 10 + i % 5]
        rows.append((i, f"{prose(100 + i, i)}. {', '.join(cut).upper()} {prose(200 + i, 5)}"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(make(rows), benchmark).collect()}
    assert got == {i: plain_hits(t, items) for i, t in rows}


def test_top_k_prunes_and_is_exact(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(10, 16))
    vectors = centres[rng.integers(0, 10, 1500)] + 0.1 * rng.normal(size=(1500, 16))
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    whole = np.floor(256 * vectors).astype(np.int64)
    want = []
    for q in range(0, 1500, 50):
        scores = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(1500), -scores)) if i != q][:5]
        want += [(q, r + 1, int(i), int(scores[i])) for r, i in enumerate(order)]
    got = topk.top_k(frame, block=16, shard=200)
    assert sorted(map(tuple, got.collect())) == want
    met = topk.meetings(topk.build_shards(topk.integers(frame), 5, 50, 16, 200), 5, 16)
    share = met.groupBy("query_id", "asker").max("scored", "blocks").agg({"max(scored)": "sum", "max(blocks)": "sum"}).first()
    assert share["sum(max(scored))"] < 0.7 * share["sum(max(blocks))"]


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where("doc_id % 4 <> 0")
    said = toxicity.score(docs.join(labels.select("doc_id"), "doc_id"), known).select("doc_id", "toxic").withColumnRenamed("toxic", "said")
    rows = said.join(labels, "doc_id").where("doc_id % 4 = 0").select("said", "toxic").collect()
    hit = sum(r.said and r.toxic == 1 for r in rows)
    assert hit >= 0.9 * sum(r.toxic == 1 for r in rows)
    assert sum(r.said and r.toxic == 0 for r in rows) <= 0.02 * len(rows)
