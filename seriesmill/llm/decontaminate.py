"""Benchmark decontamination with DataFrame functions only.

The n-grams of the benchmark are a broadcast hash set.  A first scan looks up
word blocks at a stride: a window of ``2 m - 1`` words or more holds a whole
block of ``m`` words that starts at a multiple of ``m``, wherever the window lies.  Documents
with such a block are scanned again, window by window, and windows are compared
as texts, so a hit is never a matter of hashes alone.

Edge cases: null and empty texts have no words and no hits.  Repeated rows keep
their number and get equal answers; rows that share a ``doc_id`` are told apart by their text.
Items without words have no windows; an item without an id marks words but is not listed.
An empty benchmark hits nothing.  Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import ascii_lower, broadcast_checked
from seriesmill.session import materialise

# Fixed by the contract: what parts words once A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP, -1), "")


def _pieces(words: Column, size: int, step: int, made) -> Column:
    """``made(slice)`` of ``size`` words at every multiple of ``step``; empty if there are too few."""
    last = F.floor((F.size(words) - F.lit(size)) / F.lit(step)).cast("int")
    return F.when(
        F.size(words) >= size,
        F.transform(F.sequence(F.lit(0), last), lambda i: made(F.slice(words, i * step + 1, size))),
    ).otherwise(F.array().cast("array<bigint>") if made is F.xxhash64 else F.array().cast("array<string>"))


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def benchmark_words(benchmark: DataFrame) -> DataFrame:
    made = benchmark.select("item_id", words_of(F.col("text")).alias("words"))
    return materialise(made.where(F.size("words") > 0), "benchmark")


def benchmark_windows(items: DataFrame, window: int) -> tuple[DataFrame, list[int]]:
    """Distinct windows with the items that hold them, and the window lengths that occur."""
    lengths = [r[0] for r in items.select(F.least(F.size("words"), F.lit(window))).distinct().collect()]
    windows = None
    for n in sorted(lengths):
        part = items.where(F.least(F.size("words"), F.lit(window)) == n).select(
            "item_id", F.explode(_pieces(F.col("words"), n, 1, _joined)).alias("piece")
        )
        windows = part if windows is None else windows.unionByName(part)
    if windows is None:
        return items.select(F.lit("").alias("piece"), F.array("item_id").alias("items")), []
    return windows.groupBy("piece").agg(F.collect_set("item_id").alias("items")), sorted(lengths)


def _row_key() -> Column:
    return F.xxhash64("text")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, _key (of the text), starts (array of position and length), items (array of ids).

    One row per distinct (doc_id, text) with a hit.
    """
    docs = docs.select("doc_id", "text")
    items = benchmark_words(benchmark)
    windows, lengths = benchmark_windows(items, window)
    if not lengths:
        empty = docs.where(F.lit(False))
        return empty.select(
            "doc_id",
            _row_key().alias("_key"),
            F.array().cast("array<struct<pos:int,len:int>>").alias("starts"),
            F.array().cast(f"array<{items.schema['item_id'].dataType.simpleString()}>").alias("items"),
        )
    m = (lengths[0] + 1) // 2
    anchors = items.select(F.explode(_pieces(F.col("words"), m, 1, F.xxhash64)).alias("block")).distinct()
    blocks = docs.select("doc_id", words_of(F.col("text")).alias("words")).select(
        "doc_id", F.explode(_pieces(F.col("words"), m, m, F.xxhash64)).alias("block")
    )
    found = blocks.join(broadcast_checked(anchors, F.lit(8)), "block", "left_semi")
    candidates = materialise(found.select("doc_id").distinct(), "candidates")
    near = docs.join(candidates, docs["doc_id"].eqNullSafe(candidates["doc_id"]), "left_semi")
    split = near.select("doc_id", _row_key().alias("_key"), words_of(F.col("text")).alias("words"))
    spread = None
    for n in lengths:
        part = split.select(
            "doc_id", "_key", F.posexplode(_pieces(F.col("words"), n, 1, _joined)).alias("pos", "piece"), F.lit(n).alias("len")
        )
        spread = part if spread is None else spread.unionByName(part)
    held = broadcast_checked(windows, F.octet_length("piece") + F.size("items") * 16)
    met = spread.join(held, "piece")
    return met.groupBy("doc_id", "_key").agg(
        F.collect_set(F.struct("pos", "len")).alias("starts"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )


def _covered(starts: Column) -> Column:
    return F.array_distinct(
        F.flatten(F.transform(starts, lambda s: F.sequence(s["pos"], s["pos"] + s["len"] - 1)))
    )


def _with_hits(docs: DataFrame, benchmark: DataFrame, window: int, *columns: str) -> DataFrame:
    left = docs.select(*columns, _row_key().alias("_key"))
    right = hits(docs, benchmark, window).select(
        F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), "starts", "items"
    )
    on = left["doc_id"].eqNullSafe(right["_id"]) & (left["_key"] == right["_k"])
    return left.join(right, on, "left").drop("_id", "_k", "_key")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    sized = docs.select("doc_id", "text", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    joined = _with_hits(sized, benchmark, window, "doc_id", "n_words")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce(F.size(_covered(F.col("starts"))), F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(
            F.coalesce(F.array_join(F.array_sort(F.col("items").cast("array<string>")), ","), F.lit("")), 256
        ).alias("items_sha256"),
        F.col("starts").isNotNull().alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit, with all their columns."""
    bad = hits(docs, benchmark, window).select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"))
    on = docs["doc_id"].eqNullSafe(bad["_id"]) & F.xxhash64(docs["text"]).eqNullSafe(bad["_k"])
    return docs.join(bad, on, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and text, hit words cut out together with what parts them from the word before."""
    joined = _with_hits(docs, benchmark, window, "doc_id", "text")
    gap, word = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    # A-Z belong to words here: the text keeps its case
    pieces = F.regexp_extract_all("text", F.lit(f"{gap}*{word}+"), F.lit(0))
    tail = F.regexp_extract("text", f"({gap}*)$", 1)
    cut = joined.select("doc_id", "text", pieces.alias("pieces"), tail.alias("tail"), _covered(F.col("starts")).alias("gone"))
    kept = F.filter("pieces", lambda x, i: ~F.array_contains("gone", i))
    return cut.select(
        "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.concat(F.array_join(kept, ""), "tail")).alias("text")
    )
