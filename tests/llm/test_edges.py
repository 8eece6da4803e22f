"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

from __future__ import annotations

import hashlib

import pytest

from seriesmill.llm import codec, decontaminate, html_text, jaccard, licences, pii, token_counts, topk, toxicity, warc

LONG = "word another, " * 40_000
ROWS = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (4, "two other words here now"), (None, "no id"), (5, LONG), (6, LONG)]


@pytest.fixture(scope="module")
def docs(make):
    return make(ROWS)


@pytest.fixture(scope="module")
def none(make):
    return make([]).limit(0)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "two other words"), (2, None), (3, ""), (4, "Absent words only"), (None, "no ID")]
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' AS words", "'y' AS piece")


def test_contamination(docs, none, benchmark):
    found = decontaminate.contamination(docs, benchmark).collect()
    assert len(found) == len(ROWS)
    by = {(r.doc_id, r.n_words): r for r in found}
    assert by[4, 5].n_hit == 3 and by[4, 5].n_items == 1 and by[4, 5].items_sha256 == hashlib.sha256(b"1").hexdigest()
    assert not by[4, 1].contaminated and by[1, 0].n_hit == 0 and by[5, 80_000].n_hit == 0
    assert by[None, 2].contaminated and by[None, 2].n_items == 0  # an item without id marks but is not listed
    assert decontaminate.contamination(none, benchmark).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(docs, benchmark.limit(0)).collect())
    kept = decontaminate.remove_documents(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 2
    cut = {r.text for r in decontaminate.remove_spans(docs, benchmark).where("doc_id = 4").collect()}
    assert cut == {"one", " here now"}


def test_pii(docs, none, make):
    assert pii.digest(docs).count() == len(ROWS) and pii.digest(none).count() == 0
    texts = make([(1, "mail a.b@c.de, card 4111 1111 1111 1111, IBAN DE89 3704 0044 0532 0130 00, ip 1.2.3.256"), (1, None)])
    row = pii.digest(texts).where("n_email = 1").first()
    assert row.spans == "email:5:13,card:20:39,iban:46:73" and row.n_card == 1 and row.n_ip == 0
    assert row.base_sha256 == hashlib.sha256(b"email:5:13,card:20:39").hexdigest()
    masked = pii.redact(texts)
    assert masked.columns == texts.columns
    assert {r.text for r in masked.collect()} == {None, "mail <EMAIL>, card <CARD>, IBAN <IBAN>, ip 1.2.3.256"}


def test_licences(docs, none, make):
    assert licences.scan(docs).count() == len(ROWS) and licences.scan(none).count() == 0
    mit = "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + licences._MIT.upper()
    rows = {r.doc_id: r for r in licences.scan(make([(1, mit), (2, "x\nreleased under the MIT-Licence!\ny"), (3, None)])).collect()}
    assert rows[1].license_id == "MIT" and rows[1].notices == ""
    assert rows[2].license_id is None and rows[2].notices == "MIT" and rows[3].digest is None


def test_codec_and_counts(docs, none):
    tokens = {(r.doc_id, r.n_bytes): r for r in token_counts.count_tokens(docs).collect()}
    assert tokens[1, 0].n_tokens == tokens[2, 0].n_tokens == 0 and tokens[5, len(LONG)].over_limit
    assert token_counts.count_tokens(none).count() == 0
    back = codec.decode(codec.encode(docs)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((i or 0, t or "") for i, t in ROWS)
    assert codec.digests(none).count() == 0


def test_jaccard(docs, none):
    found = jaccard.jaccard_join(docs).collect()
    assert sorted((r.doc_id or 0, r.n_shingles) for r in found) == [(0, 1), (1, 0), (2, 0), (3, 0), (4, 1), (4, 1), (4, 1), (5, 2), (6, 2)]
    assert {r.doc_id: r.component_id for r in found if r.doc_id != 4} == {None: None, 1: 1, 2: 2, 3: 3, 5: 5, 6: 5}
    assert jaccard.jaccard_join(none).count() == 0
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.where("text IS NOT NULL").collect()) == sorted(
        [(0, "no id"), (2, ""), (3, " \n\t "), (4, "one"), (4, "two other words here now"), (5, LONG)]
    )


def test_toxicity(docs, none, spark, make):
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r.toxic for r in toxicity.score(docs, labels).collect()} == {False}
    assert toxicity.score(none, labels.limit(0)).count() == 0
    texts = make([(i, ("you fool " if i % 3 == 0 else "") + f"text number {i % 7}") for i in range(300)] + [(900, None), (901, "You FOOL, really")])
    known = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    scored = {r.doc_id: r.toxic for r in toxicity.score(texts, known).collect()}
    assert all(scored[i] == (i % 3 == 0) for i in range(300)) and scored[901] and not scored[900]
    kept = toxicity.reject(texts, known)
    assert kept.columns == texts.columns and kept.count() == 201


def test_html(spark):
    rows = [(1, "u", None), (1, "u", None), (2, None, ""), (None, "u", "plain &amp; simple"), (3, "u", "<p>" * 5000), (4, "u", "<nav>menu</nav><article><p>a\n b&eacute;</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    found = sorted((r.page_id or 0, r.text, r.n_chars) for r in html_text.extract(pages).collect())
    assert found == [(0, "", 0), (1, "", 0), (1, "", 0), (2, "", 0), (3, "", 0), (4, "a bé", 4)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_warc(spark):
    big = "<p>ä</p>" * 40
    rows = [(3, "http://a/ é", big), (1, None, big), (None, "u", big), (2, "u\r\nv", "short"), (5, "u", "short"), (4, "u", None), (1, None, big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS file", "2 AS offset")
    index = warc.write_archives(pages)
    back = warc.read_records(index).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in back)
    assert kinds == [(0, "revisit", 1), (1, "response", None), (1, "response", None), (2, "response", None), (3, "revisit", 1), (4, "response", None), (5, "response", None)]
    assert {r.url for r in back} == {"http://a/ é", None, "u", "u\r\nv"}
    assert all(r.payload_digest == hashlib.sha256(big.encode()).hexdigest() for r in back if r.page_id in (1, 3, None))
    assert all(bytes(r.payload) == big.encode() for r in back if r.page_id == 1)
    one = warc.read_records(index.where("page_id = 2")).first()
    assert bytes(one.payload) == b"short" and one.payload_bytes == 5
    assert warc.read_records(warc.write_archives(pages.limit(0))).count() == 0


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (50, [-1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS v")
    found = topk.top_k(vectors, k=2).collect()
    assert sorted(map(tuple, found)) == [(0, 1, 1, 256 * 256 + 128 * 128), (0, 2, 2, 256 * 256 + 128 * 128), (50, 1, 0, -65536), (50, 2, 0, -65536)]
    assert topk.top_k(vectors.limit(0)).count() == 0
    assert topk.top_k(vectors.where("vec_id = 0"), k=2).count() == 0
