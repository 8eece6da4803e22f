"""Token counts of every prefix, without encoding any text twice.

A text is cut into pieces.  The dynamic programme of ``bpe`` gives each distinct piece
the tokens of all its prefixes, and sums over pieces give those of the text.  How many tokens
a prefix has, where to cut for a budget and whether a text fits are then look-ups.

A cut inside a piece can change how the text around it falls into pieces (a run of white
space, an apostrophe, a special string); only that small stretch is cut into pieces again.

Edge cases: null and empty texts have no tokens.  Repeated rows are counted each for itself.
Prefixes end between code points.  Further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from seriesmill.llm.bpe import Vocabulary, tokenizer_path, vocabulary
from seriesmill.llm.common import map_texts

REMEMBERED = 1 << 23  # bytes of distinct pieces that a worker keeps the counts of


class Counter:
    """Prefix counts of pieces, remembered."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.totals: dict[str, int] = {}
        self.tables: dict[str, list[int]] = {}
        self.held = 0

    def table(self, piece: str) -> list[int]:
        """Tokens of every byte prefix of a piece."""
        made = self.tables.get(piece)
        if made is None:
            if piece in self.vocab.special:
                made = [0] * len(piece.encode()) + [1]
            else:
                made = self.vocab.prefix_counts(piece.encode("utf-8", "surrogatepass"))
            self.held += len(made)
            if self.held > REMEMBERED:
                self.tables.clear()
                self.totals.clear()
                self.held = len(made)
            self.tables[piece] = made
            self.totals[piece] = made[-1]
        return made

    def total(self, piece: str) -> int:
        made = self.totals.get(piece)
        return self.table(piece)[-1] if made is None else made


class Prefixes:
    """Token counts of all prefixes of one text."""

    def __init__(self, text: str | None, counter: Counter):
        self.counter = counter
        self.pieces = counter.vocab.pieces(text) if text else []
        self.ends = [0, *accumulate(map(len, self.pieces))]
        self.counts = [0, *accumulate(map(counter.total, self.pieces))]
        self.spaces: dict[int, list[int] | None] = {}

    @property
    def total(self) -> int:
        return self.counts[-1]

    def upto(self, n: int) -> int:
        """Tokens of the first ``n`` code points."""
        i = bisect_right(self.ends, n) - 1
        pieces, inside = self.pieces, n - self.ends[i]
        if i == len(pieces) or not (inside or (i > 1 and pieces[i - 1].isspace() and pieces[i - 2].isspace())):
            return self.counts[i]
        begin = i
        special = inside and pieces[i] in self.counter.vocab.special
        while begin and (not pieces[begin - 1][-1].isalnum() if special else pieces[begin - 1].isspace()):
            begin -= 1
        if begin == i and not special and pieces[i][0] != "'" and not pieces[i].isspace():
            return self.counts[i] + self.counter.table(pieces[i])[len(pieces[i][:inside].encode())]
        stretch = "".join(pieces[begin:i]) + (pieces[i][:inside] if inside else "")
        if not special and stretch.isspace():
            table = self._space(begin)
            if table is not None:
                return self.counts[begin] + table[len(stretch.encode())]
        return self.counts[begin] + sum(map(self.counter.total, self.counter.vocab.pieces(stretch)))

    def _space(self, begin: int) -> list[int] | None:
        """Tokens of every prefix of the white space from piece ``begin`` on, made once; None if it is not one piece to the tokenizer."""
        if begin not in self.spaces:
            end = begin
            while end < len(self.pieces) and self.pieces[end].isspace():
                end += 1
            # a space may begin the piece behind
            after = self.pieces[end] if end < len(self.pieces) else ""
            run = "".join(self.pieces[begin:end]) + after[: len(after) - len(after.lstrip())]
            whole = len(self.counter.vocab.pieces(run)) == 1 and run not in self.counter.vocab.special
            self.spaces[begin] = self.counter.vocab.prefix_counts(run.encode()) if whole else None
        return self.spaces[begin]

    def within(self, budget: int) -> int:
        """Code points of the longest prefix of at most ``budget`` tokens."""
        if self.total <= budget:
            return self.ends[-1]
        # each piece adds a token at least, so no prefix beyond this piece fits, unless white space
        # that is several pieces in the text is fewer at the end of a prefix
        i = bisect_right(self.counts, budget) - 1
        end = i + 1
        while end < len(self.pieces) and self.pieces[end - 1].isspace() and self.pieces[end].isspace():
            end += 1
        for n in range(min(self.ends[end] + 1, self.ends[-1]), self.ends[i], -1):
            if self.upto(n) <= budget:
                return n
        return self.ends[i]


def _counter(path: str) -> Counter:
    vocab = vocabulary(path)
    if not hasattr(vocab, "counter"):
        vocab.counter = Counter(vocab)
    return vocab.counter


def count_tokens(docs: DataFrame, limit: int = 1024, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, kept_chars (the longest prefix of at most ``limit`` tokens)."""

    def made(texts: list) -> dict:
        counter = _counter(path or tokenizer_path())
        out: dict = {"n_bytes": [], "n_tokens": [], "over_limit": [], "kept_chars": []}
        for text in texts:
            prefixes = Prefixes(text, counter)
            out["n_bytes"].append(len((text or "").encode()))
            out["n_tokens"].append(prefixes.total)
            out["over_limit"].append(prefixes.total > limit)
            out["kept_chars"].append(prefixes.within(limit))
        return out

    return map_texts(docs, ["doc_id"], "text", "n_bytes long, n_tokens long, over_limit boolean, kept_chars long", made)


def prefix_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, counts: tokens of the first n code points at place n, from 0 to the whole text."""

    def made(texts: list) -> dict:
        counter = _counter(path or tokenizer_path())
        tables = []
        for text in texts:
            prefixes = Prefixes(text, counter)
            tables.append([prefixes.upto(n) for n in range(prefixes.ends[-1] + 1)])
        return {"counts": pa.array(tables, pa.list_(pa.int32()))}

    return map_texts(docs, ["doc_id"], "text", "counts array<int>", made)


def truncate(docs: DataFrame, limit: int, path: str | None = None) -> DataFrame:
    """doc_id and the longest prefix of each text that has at most ``limit`` tokens; null stays null."""

    def made(texts: list) -> dict:
        counter = _counter(path or tokenizer_path())
        return {"text": pa.array([t and t[: Prefixes(t, counter).within(limit)] for t in texts], pa.string())}

    renamed = docs.select("doc_id", docs["text"].alias("_text"))
    return map_texts(renamed, ["doc_id"], "_text", "text string", made)
