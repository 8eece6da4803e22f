"""BPE encoding by a table of distinct words, and decoding by a join of ids to pieces.

Documents are cut into pieces ("words" with the space before them) in chunks of whole
documents.  A chunk sends each of its distinct words once to the bucket of that word, packed with the others of that
bucket; there every distinct word is encoded once for all chunks.  The ids go back to the chunk and are joined to its
positions.  What is shuffled is packed word lists and packed word numbers of the positions, no texts and no
row per word; a word that fills a third of all positions arrives once per chunk.

A chunk is known by a hash of its rows, so that both passes over the input name it alike
whatever task they run in; the input must come in a stable order (a written table does).
A chunk whose words do not come back raises an error.

Decoding looks ids up in the table of pieces, which the vocabulary bounds (about 50,000 rows).

Edge cases: null and empty texts have no ids and decode to an empty text.  Repeated rows are encoded
each for itself.  Special strings in a text become their id.  Further columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.bpe import tokenizer_path, vocabulary
from seriesmill.llm.common import give_back, map_texts, tidy
from seriesmill.session import limit_batches

CHUNK_CHARS = 4 << 20
BUCKETS = 256  # of words, at most 256; a task holds the distinct words of one bucket at a time


class _Chunk:
    """Whole documents, as numbers of their distinct words."""

    def __init__(self, vocab):
        self.vocab = vocab
        self.numbers: defaultdict = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.codes: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.ids: list = []
        self.chars = 0
        self.hash = blake2b(digest_size=8)

    def add(self, doc_id, text: str | None) -> None:
        text = text or ""
        pieces = self.vocab.pieces(text)
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, pieces), np.int32, len(pieces)))
        self.sizes.append(len(pieces))
        self.ids.append(doc_id)
        self.chars += len(text)
        self.hash.update(f"{doc_id!r}:{len(text)}:".encode())
        self.hash.update(text.encode())

    @property
    def name(self) -> int:
        return int.from_bytes(self.hash.digest(), "little", signed=True)


def _chunks(batches: Iterator[pa.RecordBatch], path: str, most: int) -> Iterator[_Chunk]:
    vocab = vocabulary(path)
    chunk = _Chunk(vocab)
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            text = text.as_py()
            if chunk.ids and chunk.chars + len(text or "") > most:
                yield chunk
                chunk = _Chunk(vocab)
            chunk.add(doc_id.as_py(), text)
    if chunk.ids:
        yield chunk


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Concatenate the stretches of ``values`` that ``wanted`` names, in its order."""
    n = lengths[wanted]
    total = int(n.sum())
    shift = starts[wanted] - (np.cumsum(n) - n)
    return values[np.repeat(shift, n) + np.arange(total)]


def _pack(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def _pack_numbers(numbers: np.ndarray) -> bytes:
    """32-bit numbers, all low bytes first, so that small ones pack well."""
    return _pack(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack_numbers(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpack(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _pack_lists(rows: list[bytes]) -> bytes:
    lengths = _pack_numbers(np.fromiter(map(len, rows), np.int64, len(rows)))
    return len(lengths).to_bytes(8, "little") + lengths + _pack(b"".join(rows))


def _unpack_lists(packed: bytes) -> tuple[np.ndarray, bytes]:
    cut = 8 + int.from_bytes(packed[:8], "little")
    return _unpack_numbers(packed[8:cut]).astype(np.int64), _unpack(packed[cut:])


def _bucket_of(word: bytes) -> int:
    return crc32(word) % BUCKETS


def encode(docs: DataFrame, path: str | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, ids: the token ids as little-endian unsigned 32-bit numbers."""
    limit_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for id_type, stream in _typed(batches):
            for chunk in _chunks(stream, path or tokenizer_path(), chunk_chars):
                buckets = bytes(_bucket_of(w.encode()) for w in chunk.numbers)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk.name]),
                        pa.array([chunk.ids], pa.list_(id_type)),
                        pa.array([chunk.sizes], pa.list_(pa.int64())),
                        pa.array([_pack_numbers(np.concatenate(chunk.codes))], pa.binary()),
                        pa.array([_pack(buckets)], pa.binary()),
                    ],
                    names=["chunk", "doc_ids", "sizes", "codes", "buckets"],
                )

    def worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, path or tokenizer_path(), chunk_chars):
            lists: defaultdict = defaultdict(list)
            for word in map(str.encode, chunk.numbers):
                lists[_bucket_of(word)].append(word)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(lists), pa.int32()),
                    pa.array([chunk.name] * len(lists), pa.int64()),
                    pa.array(map(_pack_lists, lists.values()), pa.binary()),
                ],
                names=["bucket", "chunk", "words"],
            )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path or tokenizer_path())
        known: dict[bytes, bytes] = {}
        here = None
        for batch in batches:
            for bucket, chunk, packed in zip(*(batch.column(c).to_pylist() for c in ("bucket", "chunk", "words"))):
                if bucket != here:
                    here, known = bucket, {}
                made, at = [], 0
                lengths, joined = _unpack_lists(packed)
                for n in lengths.tolist():
                    word = joined[at : at + n]
                    at += n
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = np.array(vocab.encode_piece(word.decode()), "<u4").tobytes()
                    made.append(ids)
                arrays = [pa.array([chunk], pa.int64()), pa.array([bucket], pa.int32()), pa.array([_pack_ids(made)], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "bucket", "ids"])

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()  # what earlier work of this worker has freed
        if not left.num_rows:
            raise ValueError("words of a chunk that the other pass did not make: the input has no stable order")
        buckets = np.frombuffer(_unpack(left.column("buckets")[0].as_py()), np.uint8)
        lengths = np.zeros(len(buckets), dtype=np.int64)
        starts = np.zeros(len(buckets), dtype=np.int64)
        values, begin, done = [], 0, 0
        once = dict(zip(right.column("bucket").to_pylist(), right.column("ids").to_pylist()))  # equal chunks send equal words
        for bucket, packed in once.items():
            sizes, ids = _unpack_ids(packed)
            at = np.flatnonzero(buckets == bucket)
            if len(at) != len(sizes):
                raise ValueError("a chunk lacks words: the input has no stable order")
            lengths[at] = sizes
            starts[at] = np.cumsum(sizes) - sizes + begin
            values.append(ids)
            begin += len(ids)
            done += len(at)
        if done != len(buckets):
            raise ValueError("a chunk lacks words: the input has no stable order")
        values = np.concatenate([np.empty(0, "<u4"), *values])
        ids, out = [], []
        for doc_ids, sizes, packed in zip(*(left.column(c).to_pylist() for c in ("doc_ids", "sizes", "codes"))):
            codes, at = _unpack_numbers(packed), 0
            for doc_id, n in zip(doc_ids, sizes):
                ids.append(doc_id)
                out.append(_gather(values, starts, lengths, codes[at : at + n]).astype("<u4").tobytes())
                at += n
        return pa.table({"doc_id": pa.array(ids, left.schema.field("doc_ids").type.value_type), "ids": pa.array(out, pa.binary())})

    positions = docs.mapInArrow(tidy(numbered), f"chunk long, doc_ids array<{kind}>, sizes array<long>, codes binary, buckets binary")
    words = docs.mapInArrow(tidy(worded), "bucket int, chunk long, words binary")
    table = words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(encoded), "chunk long, bucket int, ids binary")
    return positions.groupBy("chunk").cogroup(table.groupBy("chunk")).applyInArrow(joined, f"doc_id {kind}, ids binary")


def _pack_ids(rows: list[bytes]) -> bytes:
    sizes = _pack_numbers(np.fromiter((len(r) // 4 for r in rows), np.int64, len(rows)))
    return len(sizes).to_bytes(8, "little") + sizes + _pack_numbers(np.frombuffer(b"".join(rows), "<u4"))


def _unpack_ids(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    cut = 8 + int.from_bytes(packed[:8], "little")
    return _unpack_numbers(packed[8:cut]).astype(np.int64), _unpack_numbers(packed[cut:])


def _typed(batches: Iterator[pa.RecordBatch]):
    """The batches as one stream, with the type of doc_id."""
    first = next(batches, None)
    if first is None:
        return

    def stream():
        yield first
        yield from batches

    yield first.schema.field("doc_id").type, stream()


def as_array(ids: str = "ids"):
    """The binary ids as an array of numbers."""

    def made(packed):
        return packed.map(lambda b: None if b is None else np.frombuffer(b, "<u4").tolist())

    return F.pandas_udf(made, "array<long>")(ids)


SLICE = 1 << 17  # ids that are looked up at once


def decode(encoded: DataFrame, path: str | None = None, keep: tuple = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and the text of rows with column ids."""

    def made(rows: list) -> dict:
        values, starts, lengths = _pieces(path or tokenizer_path())
        texts = []
        for packed in rows:
            ids = np.frombuffer(packed or b"", "<u4")
            parts = [_gather(values, starts, lengths, ids[i : i + SLICE]).tobytes() for i in range(0, len(ids), SLICE)]
            texts.append(b"".join(parts).decode("utf-8", "replace"))
        return {"text": texts}

    return map_texts(encoded, list(keep), "ids", "text string", made)


def _pieces(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The id-to-piece table: all bytes, and where each id's piece starts and how long it is."""
    vocab = vocabulary(path)
    if not hasattr(vocab, "table"):
        rows = [vocab.bytes_of.get(i, b"") for i in range(max(vocab.bytes_of) + 1)]
        lengths = np.array([len(r) for r in rows], dtype=np.int64)
        vocab.table = np.frombuffer(b"".join(rows), np.uint8), np.cumsum(lengths) - lengths, lengths
    return vocab.table


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode and decode every document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = decode(encode(docs, path), path, ("doc_id", "ids"))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
