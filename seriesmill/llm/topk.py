"""Exact top-k inner products by block-at-a-time pruning.

Vectors become integers, and each dimension becomes two terms, its positive and its negative
side, so that weights are never below zero.  Documents are put into an order that keeps like
vectors together (nearest of a bounded sample of pivots, then id) and cut into ranges, the
blocks.  A block keeps the maximum of each term and a forward index, its integer vectors.  For a query,
the sum of its weights times a block's maxima bounds every score in the block.

The order is dealt by range to partitions, the shards.  Where a shard is cut into blocks, its queries are scored against
their own block; the k-th best score there is a floor under the final one.  Then the queries of
every shard meet every shard: blocks are scored in the order of falling bounds until the bound falls below the floor, which rises
on the way.  Equal scores go to the smaller id, so a bound equal to the floor is still scored.

The pivots shape the blocks and so the amount of pruning, never the result.  What is shuffled for a meeting is the
queries of a shard, never pairs of rows; what comes out of it is at most ``k`` rows per query.

Edge cases: null vectors and vectors with null, NaN or infinite components or of another length than
most take no part, as query or candidate, nor do rows without id.  A query's own id is never a candidate.  Repeated candidate
rows count each for itself; of a repeated query id one vector asks, the first by its bytes.  Fewer than k candidates: all are returned.
An empty table gives no rows.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.session import materialise

BLOCK = 64  # vectors
SHARD = 8192  # vectors, about
STEP = 4  # blocks scored between two looks at the floor
PIVOTS = 256
LARGEST = 1 << 26  # of an integer component, so that sums stay exact as doubles

_RESULT = "query_id long, rank int, vec_id long, score long"


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, v (array<long>) of the vectors that take part."""

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    good = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(F.forall("embedding", finite))
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    m = flat.reshape(len(column), -1)
    if m.size and np.abs(m).max() > LARGEST:
        raise ValueError(f"a component is larger than {LARGEST}")
    return m.astype(np.float64)


def pivots_of(rows: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """Up to ``n`` vectors, those with the smallest hash of their id."""
    found = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(n).collect()
    return np.array([r["v"] for r in found], dtype=np.float64)


def _terms(m: np.ndarray) -> np.ndarray:
    """Weights of the positive and of the negative sides."""
    return np.concatenate([m.clip(0), (-m).clip(0)], axis=1)


def _maxima(m: np.ndarray, block: int) -> np.ndarray:
    """Term maxima of every block."""
    return np.maximum.reduceat(_terms(m), np.arange(0, len(m), block), axis=0)


def _keep_best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best by falling score, then rising id."""
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _floor(own: int, query: np.ndarray, ids: np.ndarray, m: np.ndarray, k: int) -> float:
    scores = (m @ query)[ids != own]
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else float("-inf")


def build_shards(rows: DataFrame, k: int, every: int, block: int = BLOCK, size: int = SHARD) -> DataFrame:
    """The index, a written table: part, ids, forward, maxima, and queries with their floors."""
    pivots = pivots_of(rows)
    norms = (pivots * pivots).sum(axis=1) / 2

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                pivot = (_matrix(batch.column("v")) @ pivots.T - norms).argmax(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot)], names=["vec_id", "v", "pivot"])

    def made(ids: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
        asks = np.flatnonzero(ids % every == 0)
        floors = []
        for i in asks:
            first = i // block * block
            floors.append(_floor(ids[i], m[i], ids[first : first + block], m[first : first + block], k))
        columns = [ids.astype("<i8"), m.astype("<i4"), _maxima(m, block).astype("<i4"), ids[asks].astype("<i8"), m[asks].astype("<i4")]
        arrays = [pa.array([c.tobytes()], pa.binary()) for c in columns]
        arrays.append(pa.array([np.array(floors, "<f8").tobytes()], pa.binary()))
        return pa.RecordBatch.from_arrays(arrays, names=["ids", "forward", "maxima", "q_ids", "q_weights", "q_floors"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids.append(batch.column("vec_id").to_numpy(zero_copy_only=False))
            parts.append(_matrix(batch.column("v")))
            held += len(parts[-1])
            if held >= size:  # a partition may be larger than planned; it becomes several shards
                yield made(np.concatenate(ids), np.concatenate(parts))
                ids, parts, held = [], [], 0
        if held:
            yield made(np.concatenate(ids), np.concatenate(parts))

    n = max(1, rows.count() // size)
    placed = rows.mapInArrow(near, "vec_id long, v array<long>, pivot int")
    ordered = placed.repartitionByRange(n, "pivot", "vec_id").sortWithinPartitions("pivot", "vec_id")
    names = ("ids", "forward", "maxima", "q_ids", "q_weights", "q_floors")
    cut_up = ordered.select("vec_id", "v").mapInArrow(cut, ", ".join(f"{c} binary" for c in names))
    return materialise(cut_up.select(F.spark_partition_id().alias("part"), "*"), "shards")


def _search(k: int, block: int):
    """Queries of one shard against the blocks of another, pruned per query."""

    def one(row: dict) -> Iterator[tuple]:
        ids = np.frombuffer(row["ids"], "<i8")
        m = np.frombuffer(row["forward"], "<i4").reshape(len(ids), -1).astype(np.float64)
        starts = np.arange(0, len(ids), block)
        maxima = np.frombuffer(row["maxima"], "<i4").reshape(len(starts), -1).astype(np.float64)
        q_ids, floors = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["q_floors"], "<f8")
        weights = np.frombuffer(row["q_weights"], "<i4").reshape(len(q_ids), -1).astype(np.float64)
        bounds = _terms(weights) @ maxima.T
        for own, query, floor, bound, copy in zip(q_ids, weights, floors, bounds, range(len(q_ids))):
            best_ids, best = np.empty(0, np.int64), np.empty(0)
            open_blocks = np.flatnonzero(bound >= floor)
            open_blocks = open_blocks[np.argsort(-bound[open_blocks], kind="stable")]
            scored = 0
            for first in range(0, len(open_blocks), STEP):
                if bound[open_blocks[first]] < floor:
                    break
                rows = np.concatenate([np.arange(starts[b], min(starts[b] + block, len(ids))) for b in open_blocks[first : first + STEP]])
                scored += len(open_blocks[first : first + STEP])
                rows = rows[ids[rows] != own]
                scores = m[rows] @ query
                good = scores >= floor
                best_ids, best = _keep_best(np.concatenate([best_ids, ids[rows[good]]]), np.concatenate([best, scores[good]]), k)
                if len(best) == k:
                    floor = max(floor, best[-1])
            asked = weights[copy].astype(">i4").tobytes()
            for vec_id, score in zip(best_ids, best):
                yield int(own), asked, row["asker"], copy, int(vec_id), int(score), scored, len(starts)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = list(one(batch.slice(i, 1).to_pylist()[0]))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.binary(), *[pa.int64()] * 6))],
                        names=["query_id", "asked", "asker", "copy", "vec_id", "score", "scored", "blocks"],
                    )

    return over


def meetings(index: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """The best of every query in every shard, with how many of the shard's blocks were scored."""
    parts = index.agg(F.max("part")).first()[0] + 1
    askers = index.where(F.octet_length("q_ids") > 0).select(
        F.monotonically_increasing_id().alias("asker"), "q_ids", "q_weights", "q_floors"
    )
    sent = askers.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    met = sent.join(index.select("part", "ids", "forward", "maxima"), "part").drop("part")
    schema = "query_id long, asked binary, asker long, copy long, vec_id long, score long, scored long, blocks long"
    return met.mapInArrow(_search(k, block), schema)


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best for every row whose id ``every`` divides."""
    whole = integers(vectors, scale)
    widths = whole.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if widths is None or not widths["n"]:
        return vectors.sparkSession.createDataFrame([], _RESULT)
    rows = materialise(whole.where(F.size("v") == widths["n"]), "vectors")
    found = meetings(build_shards(rows, k, every, block, shard), k, block)
    best_first = Window.partitionBy("query_id", "asked", "asker", "copy").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    # of a repeated query id one copy answers
    copies = Window.partitionBy("query_id").orderBy("asked", "asker", "copy")
    return (
        ranked.withColumn("first", F.dense_rank().over(copies))
        .where("first = 1")
        .select("query_id", "rank", "vec_id", "score")
    )
