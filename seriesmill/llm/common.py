"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest table, in bytes as measured before, that is sent to every executor.
BROADCAST_BYTES = 64 << 20
# Texts that one call of a Python operator holds.
PER_CALL = 256


def broadcast_checked(df: DataFrame, size: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast after measuring the table; above ``limit`` it stays a shuffle join."""
    held = df.agg(F.sum(size + F.lit(32)).alias("b")).first()["b"] or 0
    return F.broadcast(df) if held <= limit else df


def give_back() -> None:
    """Return freed memory to the machine: workers live on after a task, with all that they have not given back."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def tidy(over: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``over`` for ``mapInArrow``, freed memory given back after its last batch: an executor keeps several workers, and tasks take them in turn."""

    @wraps(over)
    def run(batches: Iterator) -> Iterator:
        yield from over(batches)
        give_back()

    return run


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all other characters untouched.

    ``lower`` does just that where every character is one byte; other texts are translated.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


# ---- hashes of words and word sequences, on whole byte arrays

_STEP = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x + _STEP
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """One 64-bit hash per word of a text in UTF-8, and where each word starts.

    A-Z are lower-cased and words are parted by space and \\x09-\\x0D.  Each word is read in strides of
    eight bytes over all words at once, so the work is a few array operations whatever the length.
    """
    raw = raw.translate(_FOLD)
    none = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    if not raw:
        return none
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = np.concatenate(([False], ~_GAP[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return none
    padded = np.zeros(len(data) + 8, dtype=np.uint64)
    padded[: len(data)] = data
    # eight bytes from every position on, as one number
    eight = padded[: len(data)].copy()
    for k in range(1, 8):
        eight |= padded[k : len(data) + k] << np.uint64(8 * k)
    lengths = ends - starts
    hashes = mixed(lengths.astype(np.uint64))
    at, left, live = starts.copy(), lengths.copy(), np.arange(len(starts))
    while len(live):
        held = np.minimum(left[live], 8)
        hashes[live] = mixed(hashes[live] ^ (eight[at[live]] & _LOW[held]))
        at[live] += 8
        left[live] -= 8
        live = live[left[live] > 0]
    return hashes, starts


# the lowest n bytes of a number
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of all ``size``-word sequences; of the whole sequence if there are fewer words."""
    if not len(words):
        return words
    size = min(size, len(words))
    made = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        made = mixed(made ^ words[k : len(words) - size + 1 + k])
    return made


def shingle_sets(texts: list, size: int = 5, at_once: int = 1 << 20) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text; texts are hashed together, ``at_once`` bytes or so."""
    held: list[bytes] = []
    total = 0
    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass"))
        total += len(held[-1]) + 1
        if total >= at_once:
            yield from _shingle_sets(held, size)
            held, total = [], 0
    if held:
        yield from _shingle_sets(held, size)


def _shingle_sets(raws: list[bytes], size: int) -> Iterator[np.ndarray]:
    words, starts = word_hashes(b"\n".join(raws))
    ends = np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raws]))
    whole = shingle_hashes(words, size) if len(words) >= size else words
    first = 0
    for end in ends.tolist():
        n = end - first
        if n >= size:
            yield np.unique(whole[first : end - size + 1])
        else:
            yield shingle_hashes(words[first:end], size)
        first = end


def map_texts(df: DataFrame, keep: list[str], column: str, schema: str, made: Callable[[list], dict]) -> DataFrame:
    """Apply ``made`` to the texts of every Arrow batch.

    ``keep`` columns come out as they went in, nulls and types included; ``made`` returns the
    other columns of ``schema`` as lists.  Each row's text is the only one in Python for long:
    batches are cut so that one holds few texts.
    """
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    whole = f"{kinds}, {schema}" if keep else schema
    names = [part.split()[0] for part in schema.split(",")]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, PER_CALL):
                part = batch.slice(first, PER_CALL)
                out = made(part.column(column).to_pylist())
                arrays = [part.column(c) for c in keep] + [pa.array(out[n]) if len(out[n]) else pa.nulls(0) for n in names]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *names])

    return df.select(*keep, *({column} - {*keep})).mapInArrow(tidy(over), whole)
