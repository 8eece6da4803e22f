"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import (
    codec,
    decontaminate,
    html_text,
    jaccard,
    licences,
    mixing,
    pii,
    runs,
    spelling,
    token_counts,
    topk,
    toxicity,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS piece
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
spread AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS piece
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hit AS (SELECT s.doc_id, s.i, s.n, x.item_id FROM spread s JOIN windows x USING (n, piece)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op10_decontamination", OP10_SQL)
def op10(spark, sf_dir):
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op9_pii")
def op9(spark, sf_dir):
    return pii.digest(read(spark, sf_dir, "documents"))


@query("op3_html_extraction")
def op3(spark, sf_dir):
    return html_text.extract(read(spark, sf_dir, "pages"))


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM s WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM s LEFT JOIN f USING (payload_digest)
"""


@query("op7_warc", OP7_SQL)
def op7(spark, sf_dir):
    index = warc.write_archives(read(spark, sf_dir, "pages"))
    records = warc.read_records(index, payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _canonical_sql(table: str, key: str) -> str:
    pairs = ", ".join(f"'{a}': '{b}'" for a, b in sorted(licences.EQUIVALENT.items()))
    return f"""
  SELECT {key}, list_transform(string_split(regexp_replace(regexp_replace(lower(text), '{licences.COPYRIGHT_LINE}', '', 'g'),
    '{licences.NOT_WORD}', ' ', 'g'), chr(10)), lambda l: array_to_string(list_transform(string_split(trim(l), ' '),
    lambda w: coalesce(MAP {{{pairs}}}[w], w)), ' ')) AS lines FROM {table}"""


_KNOWN_SQL = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in licences.KNOWN)

OP8_SQL = rf"""
WITH known AS (SELECT * FROM (VALUES {_KNOWN_SQL}) t(license_id, text)),
k AS ({_canonical_sql("known", "license_id")}),
ids AS (SELECT sha256(array_to_string(list_filter(lines, lambda x: x <> ''), ' ')) AS digest, min(license_id) AS license_id FROM k GROUP BY 1),
d AS ({_canonical_sql("documents", "doc_id")}),
whole AS (SELECT doc_id, array_to_string(list_filter(lines, lambda x: x <> ''), ' ') AS form FROM d),
l AS (SELECT DISTINCT doc_id, license_id FROM (SELECT doc_id, unnest(lines) AS line FROM d) JOIN ids ON sha256(line) = digest WHERE line <> ''),
n AS (SELECT doc_id, string_agg(license_id, ',' ORDER BY license_id) AS notices FROM l GROUP BY doc_id),
w AS (SELECT doc_id, CASE WHEN form <> '' THEN sha256(form) END AS digest FROM whole)
SELECT doc_id, digest, license_id, coalesce(notices, '') AS notices FROM w LEFT JOIN ids USING (digest) LEFT JOIN n USING (doc_id)
"""


@query("op8_licence_scan", OP8_SQL)
def op8(spark, sf_dir):
    return licences.scan(read(spark, sf_dir, "documents"))


@query("op6_token_counts")
def op6(spark, sf_dir):
    return token_counts.count_tokens(read(spark, sf_dir, "documents"))


@query("op5_bpe_codec")
def op5(spark, sf_dir):
    return codec.digests(read(spark, sf_dir, "documents"))


OP1_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v::DOUBLE[], d.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op1_exact_top_k", OP1_SQL)
def op1(spark, sf_dir):
    return topk.top_k(read(spark, sf_dir, "embeddings"))


OP4_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * x >= 80 * (na.n + nb.n - x)),
r AS (SELECT doc_id, doc_id AS x FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.x = e.a)
SELECT r.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.x) AS component_id
FROM r LEFT JOIN n ON r.doc_id = n.doc_id GROUP BY r.doc_id
"""


@query("op4_jaccard_join", OP4_SQL)
def op4(spark, sf_dir):
    return jaccard.jaccard_join(read(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2(spark, sf_dir):
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op11_spelling_variants")
def op11(spark, sf_dir):
    return spelling.group_variants(spelling.words_of(read(spark, sf_dir, "documents"), drop=199))


@query("op12_periodic_runs")
def op12(spark, sf_dir):
    found = runs.periodic_runs(runs.repeat_some(read(spark, sf_dir, "documents")))
    best = runs.longest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    made = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines"), "collapsed")
    return made.select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


_SIZES_SQL = r"SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents"

OP13_SQL = rf"""
WITH z AS ({_SIZES_SQL}),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS part FROM z GROUP BY source),
w AS (SELECT *, (1 + part % 3)::DOUBLE AS weight, source_size / (1 + part % 3)::DOUBLE AS ratio, (sum(source_size) OVER ())::BIGINT AS words FROM s),
r AS (SELECT *, sum(weight) OVER () AS total, coalesce(sum(source_size) OVER o, 0)::BIGINT AS size_before, coalesce(sum(weight) OVER o, 0) AS weight_before
  FROM w WINDOW o AS (ORDER BY ratio, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, 3 * size_before + 3 * ratio * (total - weight_before) < words AS is_full FROM r),
l AS (SELECT (max(words) - 3 * coalesce(sum(source_size) FILTER (is_full), 0))::DOUBLE
  / nullif(max(total) - coalesce(sum(weight) FILTER (is_full), 0), 0) AS level FROM f),
t AS (SELECT source, source_size, least(CASE WHEN is_full THEN 3.0::DOUBLE * source_size ELSE weight * level END, 3.0::DOUBLE * source_size) AS target FROM f, l),
q AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM t),
d AS (SELECT z.doc_id, z.size, q.*, coalesce(sum(z.size) OVER (PARTITION BY q.source ORDER BY md5(z.doc_id::VARCHAR), z.doc_id, z.size
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins FROM z JOIN q ON z.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, (CASE WHEN size = 0 THEN 0 ELSE
  (quota // source_size) * size + greatest(0, least(size, quota % source_size - begins)) END)::BIGINT AS taken FROM d
"""


@query("op13_source_mix", OP13_SQL)
def op13(spark, sf_dir):
    return mixing.taken(read(spark, sf_dir, "documents"))
