"""Periodic runs of the words of a text: stretches that repeat themselves at least twice.

A run is a stretch of words with smallest period q, at least 2 q (and ``least``) long, that no neighbouring word extends.
They are found with a dictionary of basic factors: for every power of two, equal stretches of that many words get one name,
made of the names of their halves.  A run of period q with 2^k <= q < 2^(k+1) repeats the factor of 2^k words at its
start after q words, so it shows among the successors of a factor nearer than twice its length:

* a factor whose next occurrence is more than half its length away has at most three such successors; each is a proposal;
* one whose next occurrence is nearer is itself periodic, its occurrences form an arithmetic progression, and inside it a
  larger period would not be the smallest; only the first occurrence behind the progression is a further proposal.

A proposal is extended both ways, through the factors of falling length, and of equal stretches the smallest period stays.

Whole batches of texts are worked on as one array; names are exact (no hashes).  The memory is four bytes a word and level, and
levels end where no factor occurs twice in one text.  One text is worked on as a whole by one task.

Edge cases: null, empty and blank texts have no words and no runs; very long texts are taken whole.  Rows are independent:
repeated rows and ids are worked on each for itself, a null id is kept.  An empty table gives an empty one.
Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 12  # words of the shortest run that is reported
BATCH_CHARS = 4 << 20  # texts that are worked on together
WORD = r"[^\x20\x09-\x0D]+"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _levels(names: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of 1, 2, 4 ... words from every position on.

    Equal factors have equal names; a factor that occurs once, or that reaches beyond the array, has a name of its own.
    ``names`` differ between texts, so no factor that crosses a border between two texts occurs twice.
    """
    n = len(names)
    kind = np.int32 if 2 * n < 1 << 31 else np.int64
    own = np.arange(n, 2 * n, dtype=kind)
    made, length, active, key = [], 1, np.arange(n), names
    while True:
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        active = active[twice]
        if not len(active):
            return made
        level = own.copy()
        level[active] = inverse[twice]
        made.append(level)
        active = active[active + length < n]
        active = active[level[active + length] < n]
        key = level[active].astype(np.int64) * n + level[active + length]
        length *= 2
        if not len(active):
            return made


def _proposals(level: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and periods, ``length`` <= period < 2 ``length``, that successors of equal factors propose."""
    n = len(level)
    at = np.flatnonzero(level < n)
    at = at[np.argsort(level[at], kind="stable")]
    name = level[at]
    m = len(at)
    gap = np.full(m, 4 * length, dtype=np.int64)  # to the next occurrence; of the last one, out of reach
    gap[:-1] = np.where(name[1:] == name[:-1], at[1:] - at[:-1], 4 * length)
    rows, periods = [], []
    # the next, the second and the third occurrence
    far = np.zeros(m, dtype=np.int64)
    for step in range(3):
        far[: m - step] += gap[step:]
        far[m - step :] = 4 * length
        rows.append(at)
        periods.append(far.copy())
    # behind the progression of a periodic factor: the end of the stretch of equal gaps
    index = np.arange(m)
    ends = np.flatnonzero(np.concatenate((gap[1:] != gap[:-1], [True])))
    last = ends[np.searchsorted(ends, index)] + 1  # the last occurrence of the progression
    inside = (2 * gap <= length) & (last < m)
    here, last = index[inside], last[inside]
    rows.append(at[here])
    periods.append(at[last] + gap[last] - at[here])
    row, period = np.concatenate(rows), np.concatenate(periods)
    good = (period >= length) & (period < 2 * length)
    row, period = row[good], period[good]
    # neighbours with one period lie in one stretch
    order = np.lexsort((row, period))
    row, period = row[order], period[order]
    first = np.ones(len(row), dtype=bool)
    first[1:] = (period[1:] != period[:-1]) | (row[1:] - row[:-1] > 1)
    return row[first], period[first]


def _extend(levels: list[np.ndarray], row: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last word of the stretch around every ``row`` in which words ``period`` apart are equal."""
    n = len(levels[0])
    end, start = row.copy(), row.copy()
    for k in range(len(levels) - 1, -1, -1):
        level, step = levels[k], 1 << k
        # the highest level may be crossed more than once
        live = np.arange(len(row))
        while len(live):
            live = live[end[live] + period[live] < n]
            live = live[level[end[live]] == level[end[live] + period[live]]]
            end[live] += step
            if k < len(levels) - 1:
                break
        live = np.arange(len(row))
        while len(live):
            live = live[start[live] >= step]
            live = live[level[start[live] - step] == level[start[live] - step + period[live]]]
            start[live] -= step
            if k < len(levels) - 1:
                break
    return start, end + period


def find_runs(names: np.ndarray, least: int = LEAST) -> np.ndarray:
    """All runs of a sequence of named words: rows (start, length, period), by start, then period.

    Several texts may follow one another if no two of them share a name.
    """
    levels = _levels(np.asarray(names, dtype=np.int64)) if len(names) else []
    starts, ends, periods = [], [], []
    for k, level in enumerate(levels):
        row, period = _proposals(level, 1 << k)
        start, end = _extend(levels, row, period)
        long = end - start >= np.maximum(least, 2 * period)
        starts.append(start[long])
        ends.append(end[long])
        periods.append(period[long])
    if not levels:
        return np.empty((0, 3), dtype=np.int64)
    start, end, period = np.concatenate(starts), np.concatenate(ends), np.concatenate(periods)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    smallest = np.ones(len(start), dtype=bool)
    smallest[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    found = np.stack((start, end - start, period), axis=1)[smallest]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _batch(texts: pa.Array, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Number of words, runs and collapsed text of every text."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    offsets, words = np.asarray(parts.offsets), parts.values
    some = np.asarray(pc.binary_length(words)) > 0
    upto = np.concatenate(([0], np.cumsum(some)))
    bounds = upto[offsets]  # of each text, in words
    words = words.filter(pa.array(some))
    text_of = np.repeat(np.arange(len(texts)), np.diff(bounds))
    codes = np.asarray(pc.dictionary_encode(words).indices).astype(np.int64) if len(words) else np.empty(0, dtype=np.int64)
    found = find_runs(text_of * (len(words) + 1) + codes, least)
    # words that a run repeats: one step up where they begin, one down where they end
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, found[:, 0] + found[:, 2], 1)
    np.add.at(steps, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(steps[:-1]) == 0
    kept_bounds = np.concatenate(([0], np.cumsum(kept)))[bounds]
    collapsed = pc.binary_join(pa.LargeListArray.from_arrays(kept_bounds, words.filter(pa.array(kept))), pa.scalar(" ", pa.large_string()))
    owner = np.searchsorted(bounds, found[:, 0], side="right") - 1
    run_bounds = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts))))).astype(np.int32)
    runs = pa.StructArray.from_arrays(
        [pa.array(found[:, 0] - bounds[owner]), pa.array(found[:, 1]), pa.array(found[:, 2])], names=["start", "length", "period"]
    )
    return pa.array(np.diff(bounds).astype(np.int64)), pa.ListArray.from_arrays(run_bounds, runs), collapsed.cast(pa.string())


def _chunks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most BATCH_CHARS bytes of text or one row."""
    upto = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + BATCH_CHARS, side="right")))
        yield batch.slice(first, last - first)
        first = last


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length, period; by start, then period) and ``collapsed`` of every document.

    ``collapsed`` is the text without the words that a run repeats (all after its first period), joined by one space.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch, "text"):
                made = _batch(part.column("text"), least)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *made], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(over, schema)


def longest(runs: Column) -> Column:
    """The run with the greatest length; of equals the one that starts first, then the smallest period; null without runs."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less")))
    best = F.array_max(ranked)
    return F.when(best.isNotNull(), F.struct((-best["back"]).alias("start"), best["length"].alias("length"), (-best["less"]).alias("period")))


def repeat_some(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, with repetition put into about a tenth of the documents.

    Let h be the unsigned crc32 of the decimal id and g = h div 10.  Where 10 divides h, the n words from a = g mod n on become
    a cycle of the first p = 1 + (n - a) div (3 + g mod 8) of them.
    """
    made = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("_h"))
    g = F.floor(F.col("_h") / 10)

    def cycled(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, at(i).cast("int"))), " ")).otherwise("")

    # the words are named by a lambda so that they are made once a text
    words = F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    return made.select("doc_id", F.when(F.col("_h") % 10 == 0, F.transform(words, cycled)[0]).otherwise(F.col("text")).alias("text"))
