"""Grouping of spelling variants: words of a corpus that differ by one character, searched in an FM-index of the vocabulary.

Two words are near if one inserted, deleted or replaced code point turns one into the other.  The error lies in one half of
the searched word, so the other half occurs in the near word unchanged, as its beginning or as its end.  The search scheme has
two searches accordingly: from the delimiter before a word through the left half exactly, then to the right across the other half with one
error; and from the delimiter behind it through the right half, then to the left.  Both walk intervals of suffix ranks over the
delimited vocabulary; the index of either direction is the other's for reversed words.

The index is cut into blocks: words of one direction in the order of (length, spelling), ``block_words`` at most in a task.  A
search goes only to blocks of the three lengths that an error leaves whose words can begin with its exact half, found by an equal join on
direction, length and first characters; where very many searches meet one block, they are dealt to copies of it.  A pair that
both searches find counts once: the second leaves out words that the first has seen.

Edge cases: null and empty texts have no words; very long texts are read whole, and a word of any length is one word.  Repeated rows count
as often as they occur.  A null id counts as an empty one in ``words_of``.  An empty table gives no words.
Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import ascii_lower, broadcast_checked
from seriesmill.session import materialise

LEAST_LENGTH = 6  # code points; halves have three at least
LEAST_COUNT = 5
TIMES = 5  # how much more frequent the usual form is
BLOCK_WORDS = 20_000
SEARCHES = 100_000  # that one task runs against a block
HEAD = 3  # characters that searches and blocks meet by
AT_ONCE = 20_000  # searches walked together
LETTERS = r"a-zÀ-ÿ"
_END, _GAP, _FIRST = 0, 1, 2  # symbols: end of the text, delimiter, first letter


class Index:
    """FM-index of words between delimiters, for patterns that grow to the right.

    The suffixes are those of the reversed text, so that a further character on the right is one step of ranks.
    """

    def __init__(self, words: Sequence[str]):
        joined = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), dtype="<u4")
        self.alphabet = np.unique(joined)[1:]
        symbols = np.where(joined == 0, _GAP, np.searchsorted(self.alphabet, joined) + _FIRST)
        text = np.concatenate((symbols[::-1], [_END])).astype(np.int64)
        n = len(text)
        suffixes = _suffixes(text)
        self.size = len(self.alphabet) + _FIRST
        self.before = text[suffixes - 1]  # the symbol before each suffix, by rank
        self.rows = n
        self.steps = np.sort(self.before * n + np.arange(n))
        # the word whose closing delimiter a suffix begins with
        gaps = np.cumsum(symbols == _GAP)
        place = n - 2 - suffixes
        self.word = np.where(place >= 0, gaps[place] - 2, -1)

    def encode(self, words: Sequence[str], width: int) -> np.ndarray:
        """Symbols of each word, a delimiter behind it; characters that no word of the index has match nothing."""
        raw = "".join(w + "\0" * (width - len(w)) for w in words).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, dtype="<u4").reshape(len(words), width)
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(codes == 0, _GAP, np.where(self.alphabet[at] == codes, at + _FIRST, self.size))

    def start(self) -> tuple[int, int]:
        return self.step(np.array([0]), np.array([self.rows]), np.array([_GAP]))

    def step(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of the pattern with ``symbol`` behind it."""
        base = symbol * self.rows
        return np.searchsorted(self.steps, base + low), np.searchsorted(self.steps, base + high)

    def letters(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every letter that can follow an interval, as (number of the interval, symbol)."""
        sizes = high - low
        letters = self.size - _FIRST
        small = np.flatnonzero(sizes < letters)
        counts = sizes[small]
        owner = np.repeat(small, counts)
        rank = np.repeat(low[small] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        key = np.unique(owner * self.size + self.before[rank])
        large = np.flatnonzero(sizes >= letters)
        key = np.concatenate((key, np.repeat(large, letters) * self.size + np.tile(np.arange(_FIRST, self.size), len(large))))
        owner, symbol = key // self.size, key % self.size
        good = symbol >= _FIRST
        return owner[good], symbol[good]

    def near(self, words: Sequence[str], halves: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of a searched word, number of a word of the index) one error apart, the error behind the exact half.

        All words of the index have ``length`` characters, which says what kind of error each search looks for.
        """
        lengths = np.array([len(w) for w in words])
        grid = self.encode(words, int(lengths.max()) + 1)
        low, high = (np.full(len(words), x[0]) for x in self.start())
        exact = np.arange(len(words))  # searches without an error so far
        none = np.empty(0, dtype=np.int64)
        waiting = (none, none, none)  # searches with their error behind them: word, low, high
        found = []
        for at in range(grid.shape[1]):
            branch = exact[halves[exact] <= at]
            grown = lengths[branch] - length
            here, there = [waiting], []
            skip = branch[(grown == 1) & (lengths[branch] > at)]
            there.append((skip, low[skip], high[skip]))
            other = branch[(grown == -1) | ((grown == 0) & (lengths[branch] > at))]
            owner, symbol = self.letters(low[other], high[other])
            who = other[owner]
            differs = symbol != grid[who, at]
            who, symbol = who[differs], symbol[differs]
            a, b = self.step(low[who], high[who], symbol)
            inserted = lengths[who] < length
            here.append((who[inserted], a[inserted], b[inserted]))
            there.append((who[~inserted], a[~inserted], b[~inserted]))
            who, a, b = (np.concatenate(x) for x in zip(*here))
            a, b = self.step(a, b, grid[who, at])
            live = a < b
            who, a, b = who[live], a[live], b[live]
            done = lengths[who] == at
            found.append((who[done], a[done]))
            there.append((who[~done], a[~done], b[~done]))
            waiting = tuple(np.concatenate(x) for x in zip(*there))
            a, b = self.step(low[exact], high[exact], grid[exact, at])
            low[exact], high[exact] = a, b
            exact = exact[(a < b) & (lengths[exact] > at)]
        who, row = (np.concatenate(x) for x in zip(*found))
        # several places of the error may give one word
        pairs = np.unique(who * self.rows + self.word[row])
        return pairs // self.rows, pairs % self.rows


def _suffixes(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling the length that is compared."""
    n, length = len(text), 1
    rank = text
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[: n - length] = rank[length:] + 1
        _, rank = np.unique(rank * (n + 2) + second, return_inverse=True)
        length *= 2
        if rank.max() == n - 1 or length >= n:
            return np.argsort(rank, kind="stable")


def words_of(docs: DataFrame, drop: int | None = None) -> DataFrame:
    """``word``, ``n``: runs of letters of all texts, A-Z in lower case, LEAST_LENGTH long and LEAST_COUNT times at least.

    With ``drop``, a run loses a character where ``drop`` divides h, the unsigned crc32 of "<doc_id>:<run>": the one at h mod its length.
    """
    found = docs.select("doc_id", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))).alias("word"))
    if drop:
        named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
        found = found.withColumn("_h", F.crc32(named.cast("binary")))
        at = (F.col("_h") % F.char_length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
        found = found.select(F.when(F.col("_h") % drop == 0, cut).otherwise(F.col("word")).alias("word"))
    counts = found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.col("n") >= LEAST_COUNT) & (F.char_length("word") >= LEAST_LENGTH))


def _blocks(words: DataFrame, block_words: int) -> DataFrame:
    """Both directions of all words in ranges of about ``block_words``: ``side``, ``length``, ``key``, ``n``, ``block``; a written table."""
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), k.alias("key")) for s, k in ((0, F.col("word")), (1, F.reverse("word")))]))
    both = words.select("n", sides.alias("_s")).select("_s.*", "n", F.char_length("_s.key").alias("length"))
    parts = max(1, -(-2 * words.count() // block_words))
    return materialise(both.repartitionByRange(parts, "side", "length", "key").withColumn("block", F.spark_partition_id()), "blocks")


def _searches(words: DataFrame, blocks: DataFrame) -> DataFrame:
    """``side``, ``length`` and ``block`` of every block that a word is searched in, with the word in that direction and its exact ``half``; a written table."""
    ranges = blocks.groupBy("side", "length", "block", F.substring("key", 1, HEAD).alias("head")).agg(F.min("key").alias("low"), F.max("key").alias("high"))
    size = F.char_length("word")
    left = F.floor(size / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("word").alias("pattern"), left.alias("half")),
        F.struct(F.lit(1).alias("side"), F.reverse("word").alias("pattern"), (size - left).alias("half")),
    )
    asked = (
        words.select("word", F.explode(sides).alias("_s"))
        .select("_s.*", F.explode(F.sequence(size - 1, size + 1)).alias("length"))
        .where(F.col("length") >= LEAST_LENGTH)
        .withColumns({"head": F.substring("pattern", 1, HEAD), "_exact": F.substring("pattern", F.lit(1), F.col("half"))})
    )
    begin = lambda c: F.substring(c, F.lit(1), F.col("half"))
    met = asked.join(broadcast_checked(ranges, F.octet_length("low") * 2 + 24), ["side", "length", "head"])
    inside = (begin(F.col("low")) <= F.col("_exact")) & (begin(F.col("high")) >= F.col("_exact"))
    return materialise(met.where(inside).select("side", "length", "block", "pattern", "half"), "searches")


_GROUP = ["side", "length", "block", "copy"]


def near_pairs(words: DataFrame, block_words: int = BLOCK_WORDS, searches: int = SEARCHES) -> DataFrame:
    """``word``, ``near``, ``near_n``: every ordered pair of words that differ by one character, once."""
    blocks = _blocks(words, block_words)
    asked = _searches(words, blocks)
    loads = asked.groupBy("side", "length", "block").agg(F.ceil(F.count(F.lit(1)) / searches).cast("int").alias("copies"))
    loads = broadcast_checked(materialise(loads, "loads"), F.lit(16))
    dealt = asked.join(loads, ["side", "length", "block"]).withColumn("copy", F.pmod(F.xxhash64("pattern"), F.col("copies")).cast("int"))
    held = blocks.join(loads, ["side", "length", "block"]).withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))

    def search(index_of: pa.Table, patterns: pa.Table) -> pa.Table:
        keys = index_of.column("key").to_pylist()
        made = {"side": [], "pattern": [], "key": [], "near_n": []}
        if keys and patterns.num_rows:
            index, length = Index(keys), len(keys[0])
            side = patterns.column("side")[0].as_py()
            keys, counts = pa.array(keys), index_of.column("n").combine_chunks()
            for first in range(0, patterns.num_rows, AT_ONCE):
                part = patterns.slice(first, AT_ONCE)
                asked_for = part.column("pattern").combine_chunks()
                who, what = index.near(asked_for.to_pylist(), np.asarray(part.column("half")), length)
                made["side"].append(pa.array(np.full(len(who), side, dtype=np.int32)))
                made["pattern"].append(asked_for.take(pa.array(who)))
                made["key"].append(keys.take(pa.array(what)))
                made["near_n"].append(counts.take(pa.array(what)))
        kinds = {"side": pa.int32(), "pattern": pa.string(), "key": pa.string(), "near_n": pa.int64()}
        return pa.table({c: pa.chunked_array(made[c], kinds[c]) for c in made})

    found = held.select(*_GROUP, "key", "n").groupBy(*_GROUP).cogroup(dealt.select(*_GROUP, "pattern", "half").groupBy(*_GROUP))
    pairs = found.applyInArrow(search, "side int, pattern string, key string, near_n bigint")
    turned = lambda c: F.when(F.col("side") == 1, F.reverse(c)).otherwise(F.col(c))
    named = pairs.select("side", turned("pattern").alias("word"), turned("key").alias("near"), "near_n")
    # words with the same left half are the first search's
    half = lambda c: F.substring(c, F.lit(1), F.floor(F.char_length("word") / 2).cast("int"))
    return named.where((F.col("side") == 0) | (half(F.col("word")) != half(F.col("near")))).drop("side")


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of every row (word, form): the last word when forms are followed.

    Every round doubles how far a word sees; forms are ``TIMES`` as frequent as their words, so there is no circle and few rounds.
    """
    seen = materialise(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = seen.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        if seen.join(onward, "root", "left_semi").isEmpty():
            return seen
        seen = materialise(seen.join(onward, "root", "left").select("word", F.coalesce("_on", "root").alias("root")), "forms")


def group_variants(words: DataFrame, times: int = TIMES, **options) -> DataFrame:
    """Per row (word, n): ``form``, its most frequent near word (of equals the first) if ``times`` as frequent, ``root``, ``n_near``, ``form_n``."""
    words = materialise(words.select("word", "n"), "vocabulary")
    pairs = near_pairs(words, **options)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("_best"))
    usual: Column = -F.col("_best.less") >= times * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(usual, F.col("_best.near")).alias("form"),
        F.when(usual, -F.col("_best.less")).alias("form_n"),
    )
    joined = materialise(joined, "near")
    last = roots(joined.where("form IS NOT NULL"))
    return joined.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
