"""Mixing the documents of several sources to target weights, by a low-discrepancy schedule.

The mix is a sequence of slots of ``block_words`` words.  Slot t has the point frac(t * golden ratio), and the point falls into
one source's part of the unit interval, parts being the sources' shares of all words; so every stretch of
the sequence has each source about in proportion.  Slots are ranked per source.  The documents of a source, in the order of a
digest of their ids, make one stream of words that is repeated as often as needed and cut into
blocks of equal size; the k-th slot of a source takes its k-th block.  A source's last block ends where its target is
reached; slots beyond it are left out, slots that the points leave owing (a few per source) follow at the end.

Targets: sources in the order of their names (by code point, null last) weigh 1, 2, 3, 1, 2, 3 ... and share the words of
all documents.  No source gives more than ``most`` times its words: what that leaves is shared by weight among the others.

Everything is DataFrame functions.  Running sums are made in two steps, inside ranges of rows and over the ranges, so no source, however
large, is in one task; slots find their sources by an equal cell of the unit interval.

Edge cases: a null or blank text has no words, is taken zero times and stays in the result.  Repeated rows and ids are
documents of their own, in the order of their sizes.  Without any words all targets are 0; an empty table gives an empty
one.  Very long texts are cut by blocks like the stream itself.  Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.operators.slices import attach, bounded
from seriesmill.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 1024
WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3  # times that a document may be taken
# The points of the schedule: multiples of the golden ratio's fraction, as 32-bit fixed-point numbers.
_GOLDEN = 2_654_435_769
_CIRCLE = 1 << 32
_PERIOD = 1 << 31  # multiples are exact in 64 bits below this; then the points repeat
_LEAST_CELLS = 1 << 12


def running(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` and, per entry of ``sums``, the sum over the rows of the same keys that come before in ``order``.

    Rows are dealt by ranges of (keys, order) and written; each range adds up for itself and starts from the sums of those before it.
    Rows equal in all of these are in no order of their own: each still has a sum of its own.
    """
    names = df.columns
    by = [*[F.col(k).asc_nulls_last() for k in keys], *order]
    valued = df.withColumns({f"_v_{n}": c for n, c in sums.items()})
    placed = materialise(valued.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()), "ranges")
    ends = placed.groupBy(*keys, "_range").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in sums])
    past = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(*keys, "_range", *[F.coalesce(F.sum(f"_s_{n}").over(past), F.lit(0)).alias(f"_b_{n}") for n in sums])
    inside = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = attach(placed, bounded(starts), [*keys, "_range"])
    return joined.select(*names, *[(F.col(f"_b_{n}") + F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0))).alias(n) for n in sums])


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and ``size``, the number of words, of every document; written, so that texts are read once."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return materialise(docs.select("doc_id", "source", words.alias("size")), "sizes")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: ``part`` (its number in name order), ``source_size``, ``weight`` and ``target``; a written table.

    With all sources in the order of size for weight, those that reach their most are the first ones: the first
    source that would not, if all behind it took the same for their weight, ends them.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running(sources, [], [F.col("source").asc_nulls_last()], {"part": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("part") % len(weights) + 1).cast("int"))
    ranked = materialise(ranked.withColumns({"weight": weight, "ratio": F.col("source_size") / weight}), "sources")
    whole = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    if not whole["words"]:
        return ranked.select("source", "part", "source_size", "weight", F.lit(0.0).alias("target"))
    words, total = F.lit(whole["words"]), F.lit(whole["weight"])
    before = running(ranked, [], [F.col("ratio").asc(), F.col("part").asc()], {"_size": F.col("source_size"), "_weight": F.col("weight")})
    reached = most * F.col("_size") + most * F.col("ratio") * (total - F.col("_weight")) < words
    placed = materialise(before.withColumn("_full", reached), "shares")
    full = placed.where("_full").agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("weight")).first()
    level = (whole["words"] - most * full["size"]) / (whole["weight"] - full["weight"]) if full["weight"] < whole["weight"] else 0.0
    target = F.when(F.col("_full"), F.col("source_size") * F.lit(float(most))).otherwise(F.col("weight") * F.lit(level))
    # the last digit of a division must not lift a target above its most
    return materialise(placed.select("source", "part", "source_size", "weight", F.least(target, F.col("source_size") * F.lit(float(most))).alias("target")), "targets")


def schedule(goals: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``slot`` (the order of the mix), ``part``, ``block`` (which block of the source's stream) and ``start``, ``end`` in the repeated stream.

    ``goals`` are the rows of ``targets``.
    """
    spark = goals.sparkSession
    quota = F.floor(F.col("target") + 0.5).cast("long")
    wanted = goals.select("part", "target", quota.alias("_quota"), F.ceil(quota / block_words).cast("long").alias("_need")).where("_need > 0")
    shares = materialise(running(wanted, [], [F.col("part").asc()], {"_from": F.col("target")}), "parts")
    found = shares.agg(F.sum("target").alias("words"), F.sum("_need").alias("slots"), F.count(F.lit(1)).alias("parts")).first()
    slots, cells = found["slots"] or 0, _LEAST_CELLS
    while cells < found["parts"]:
        cells *= 2
    width = _CIRCLE // cells
    scale = F.lit(_CIRCLE / found["words"] if slots else 0.0)
    edge = lambda c: F.least(F.floor(c * scale).cast("long"), F.lit(_CIRCLE))
    arcs = shares.withColumns({"_low": edge(F.col("_from")), "_high": edge(F.col("_from") + F.col("target"))}).where("_low < _high")
    # as many cells as sources at least, so a slot meets about two sources
    arcs = arcs.withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_low") / width), F.floor((F.col("_high") - 1) / width))))
    point = ((F.col("id") % _PERIOD) * _GOLDEN) % _CIRCLE
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("_point"), F.floor(point / width).alias("_cell"))
    arcs = bounded(arcs.select("part", "_low", "_high", "_cell", "_quota", "_need"))
    drawn = attach(points, arcs, ["_cell"]).where("_low <= _point AND _point < _high").select("slot", "part", "_quota", "_need")
    ranked = materialise(running(drawn, ["part"], [F.col("slot").asc()], {"block": F.lit(1)}), "drawn")
    kept = ranked.where(F.col("block") < F.col("_need"))
    # slots that a source's points leave owing
    got = kept.groupBy("part").agg(F.count(F.lit(1)).alias("_got"))
    owing = attach(shares.select("part", "_quota", "_need"), got, ["part"], "left").withColumn("_got", F.coalesce("_got", F.lit(0)))
    owed = owing.where("_got < _need").withColumn("block", F.explode(F.sequence("_got", F.col("_need") - 1)))
    late = running(owed.select("part", "_quota", "block"), [], [F.col("block").asc(), F.col("part").asc()], {"slot": F.lit(1)})
    late = late.withColumn("slot", F.col("slot") + slots)
    names = ["slot", "part", "_quota", "block"]
    whole = kept.select(*names).unionByName(late.select(*names))
    start = F.col("block") * block_words
    return whole.select("slot", "part", "block", start.alias("start"), F.least(start + block_words, F.col("_quota")).alias("end"))


def streams(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """Every document with its source's row of ``targets`` and ``offset``, its first word in the source's stream."""
    placed = attach(sizes, bounded(goals), ["source"])
    shuffled = [F.md5(F.col("doc_id").cast("string")).asc_nulls_last(), F.col("doc_id").asc_nulls_last(), F.col("size").asc()]
    return materialise(running(placed, ["part"], shuffled, {"offset": F.col("size")}), "streams")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix: ``slot``, ``doc_id``, ``source``, ``epoch``, and ``first`` to ``last`` (exclusive), the words of the document that it takes there.

    In the order of slots, inside a slot of ``place``.
    """
    sizes = sized(docs)
    goals = targets(sizes, weights, most)
    return _meet(streams(sizes, goals), schedule(goals, block_words), block_words).where("last > first").select(
        "slot", "place", "doc_id", "source", "epoch", "first", "last"
    )


def _meet(documents: DataFrame, slots: DataFrame, block_words: int) -> DataFrame:
    """The parts of documents in the blocks of their streams, as often as targets ask, with the slots that take them.

    Documents without words, or beyond what is taken, come once with no slot.
    """
    quota = F.floor(F.col("target") + 0.5).cast("long")
    begin = F.col("offset") + F.col("epoch") * F.col("source_size")
    end = F.least(begin + F.col("size"), quota)
    # epochs in which the document begins before the quota
    epochs = F.when((F.col("size") > 0) & (F.col("offset") < quota), F.floor((quota - 1 - F.col("offset")) / F.col("source_size")).cast("int"))
    pieces = (
        documents.withColumn("epoch", F.explode_outer(F.sequence(F.lit(0), epochs)))
        .withColumns({"_begin": begin, "_end": end})
        .withColumn("block", F.explode_outer(F.sequence(F.floor(F.col("_begin") / block_words), F.floor((F.col("_end") - 1) / block_words))))
    )
    joined = pieces.join(slots, ["part", "block"], "left")
    first = F.greatest("_begin", "start")
    last = F.least("_end", "end")
    return joined.withColumns({"place": first - F.col("start"), "first": first - F.col("_begin"), "last": last - F.col("_begin")})


def taken(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, size, source_size, target of its source, and ``taken``, the words that the mix takes of it, repeats counted."""
    sizes = sized(docs)
    goals = targets(sizes, weights, most)
    met = _meet(streams(sizes, goals), schedule(goals, block_words), block_words)
    words = F.coalesce(F.greatest(F.col("last") - F.col("first"), F.lit(0)), F.lit(0))
    # part and offset tell documents with words apart, whatever their ids; those without are alike
    alone = F.when(F.col("size") == 0, F.monotonically_increasing_id())
    sums = met.withColumn("_alone", alone).groupBy("part", "offset", "_alone", "doc_id", "size", "source_size", "target").agg(F.sum(words).alias("taken"))
    return sums.select("doc_id", "size", "source_size", "target", "taken")
