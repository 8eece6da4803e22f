"""Documents linked by the Jaccard similarity of their word shingles, with signature trees.

Documents with one shingle set form a class; only classes are compared.  Shingles are put into one order for
all documents, common ones last, and a class is known by the first quarter or so of its shingles there: two sets that link
share some of these, the more the larger they are.  The classes of one such shingle are a group.

Leaders: each group has a leader, first the class whose shingles are held by most others, later one drawn by hash.  A class is compared
exactly with the leader it meets in most groups, and linked classes are contracted, so that a thousand near copies no longer
need a million comparisons.  Repeated, this leaves the groups in which several components meet.

Trees: the members of such a group, by size, are the leaves of a tree whose nodes hold the OR of the token bitmaps below and their
range of sizes.  Two nodes are descended into together unless their sizes exclude a link, the overlap that
their bitmaps allow is below what a link needs, or all below belongs to one component already.  The top nodes
are rows, so a large group is spread over tasks by pairs of nodes.  Leaf pairs that survive in as many groups as their size asks for are compared exactly.

Exactness: sets hold 64-bit hashes of shingles, and a class is named by a 64-bit hash of its set; two sets of one name raise an
error.  The order of shingles, the leaders and the bitmaps affect work, never links.

Edge cases: null, empty and blank texts have no shingles and link with nothing.  A text of fewer words than
a shingle is one shingle.  Repeated rows are one class, and rows that share a ``doc_id`` are told apart by their
text.  Further columns are ignored by ``components`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import broadcast_checked, map_texts, mixed, shingle_sets, tidy
from seriesmill.session import forget, limit_batches, materialise

SHINGLE = 5
PERCENT = 80  # links need 100 * intersection >= PERCENT * union
SLOTS = 1 << 18  # of the table that tells common shingles from rare ones
PARTS = 64
BITS = 2048  # of a signature
FAN = 16  # children of a tree node
TOP = 2048  # members below a node that is a row
AT_ONCE = 1 << 15  # node pairs looked at in one array operation
ROUNDS = 5  # of leaders, at most; a round that links few of its pairs is the last
FEW = 0.05
PER_STAR = 256  # texts that one copy of a leader is compared with
EDGES = 1 << 18  # that one task joins to components by itself


def set_name(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that name a set."""
    one = mixed(tokens).sum(dtype=np.uint64) ^ np.uint64(len(tokens))
    two = mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mixed(np.array([one]))[0].astype(np.int64)), int(two.astype(np.int64))


def least_overlap(a, b):
    """Smallest intersection with which sets of these sizes link: x with 100 x >= P (a + b - x)."""
    return -((a + b) * -PERCENT // (100 + PERCENT))


def shared_least(n):
    """First shingles that a set of ``n`` shares with any linked set at least: more for larger sets."""
    return 1 + n // 16


def prefix_length(n: int) -> int:
    """Shingles of a set of ``n`` of which a linked set holds ``shared_least(n)``: all but the least overlap, and those."""
    return n - -(-n * PERCENT // 100) + shared_least(n)


# ---- passes over the texts


def _sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The shingle sets of the texts of a batch."""
    for first in range(0, batch.num_rows, 256):
        yield from shingle_sets(batch.column("text").slice(first, 256).to_pylist(), SHINGLE)


# ---- passes over the texts


def members_of(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), n, class, check, signature of every document; class is null for an empty set."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))

    def made(texts: list) -> dict:
        sizes, names, checks, bits = [], [], [], []
        for tokens in shingle_sets(texts, SHINGLE):
            one, two = set_name(tokens) if len(tokens) else (None, None)
            sizes.append(len(tokens))
            names.append(one)
            checks.append(two)
            bits.append(signature(tokens).tobytes() if len(tokens) else None)
        return {
            "n": sizes,
            "class": pa.array(names, pa.int64()),
            "check": pa.array(checks, pa.int64()),
            "signature": pa.array(bits, pa.binary()),
        }

    return map_texts(keyed, ["doc_id", "key"], "text", "n long, class long, check long, signature binary", made)


def commonness(docs: DataFrame) -> np.ndarray:
    """A level per slot of shingle hashes, zero for slots of usual count, one more per doubling.

    Each task counts the shingles of its documents into a table of fixed size; tables are added up.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            held: list[np.ndarray] = []
            for tokens in _sets(batch):
                held.append((tokens % SLOTS).astype(np.int64))
                if len(held) == 1024:
                    total += np.bincount(np.concatenate(held), minlength=SLOTS)
                    held = []
            if held:
                total += np.bincount(np.concatenate(held), minlength=SLOTS)
        parts = total.reshape(PARTS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(parts.tolist(), pa.list_(pa.int64()))], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            counts = batch.column("counts").flatten().to_numpy().reshape(batch.num_rows, -1)
            for part, row in zip(batch.column("part").to_pylist(), counts):
                sums[part] = sums.get(part, 0) + row
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))], names=["part", "counts"])

    schema = "part int, counts array<long>"
    tables = docs.select("text").mapInArrow(tidy(count), schema).repartition("part").mapInArrow(tidy(add), schema)
    found = {r["part"]: r["counts"] for r in tables.collect()}
    if not found:
        return np.zeros(SLOTS, dtype=np.uint8)
    counts = np.array([x for p in range(PARTS) for x in found[p]], dtype=np.float64)
    usual = max(1.0, float(np.median(counts))) * 1.25 + 8
    return np.floor(np.log2(np.maximum(counts / usual, 0.5)) + 1).astype(np.uint8)


def postings(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """token, class, n: the first shingles of every set, common ones last."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            tokens, names, sizes = [], [], []
            for held in _sets(batch):
                if not len(held):
                    continue
                name = set_name(held)[0]
                if name in seen:  # copies in one task send their shingles once
                    continue
                if len(seen) < 1 << 18:
                    seen.add(name)
                first = held[np.argsort(levels[(held % SLOTS).astype(np.int64)], kind="stable")][: prefix_length(len(held))]
                tokens.append(first)
                names.append(np.full(len(first), name, dtype=np.int64))
                sizes.append(np.full(len(first), len(held), dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(names)), pa.array(np.concatenate(sizes))],
                    names=["token", "class", "n"],
                )

    return docs.select("text").mapInArrow(tidy(over), "token long, class long, n int")


def shared_postings(rows: DataFrame) -> DataFrame:
    """token, class, n of tokens that several classes hold; a written table.

    One shuffle by token; inside a task the rows are sorted, and a token is shared if its first and last classes differ.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, waits = None, None  # the last row, and whether it still waits for a second class
        for batch in batches:
            if not batch.num_rows:
                continue
            part = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("token", "class", "n")])
            if before is not None:
                part = np.concatenate((before, part), axis=1)
            token, name = part[0], part[1]
            near = token[1:] == token[:-1]
            fresh = np.concatenate(([True], ~near | (name[1:] != name[:-1])))
            if before is not None and not waits:
                fresh[0] = False  # it went out with the batch before
            again = near & (name[1:] != name[:-1])
            group = np.concatenate(([0], np.cumsum(~near)))
            several = np.zeros(group[-1] + 1, dtype=bool)
            several[group[1:][again]] = True
            if before is not None and not waits:
                several[0] = True
            out = fresh & several[group]
            waits = not several[group[-1]]
            before = part[:, -1:]
            k = np.flatnonzero(out)
            if len(k):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[0, k]), pa.array(part[1, k]), pa.array(part[2, k].astype(np.int32))], names=["token", "class", "n"]
                )

    ordered = rows.repartition("token").sortWithinPartitions("token", "class")
    return materialise(ordered.mapInArrow(tidy(over), "token long, class long, n int"), "shared")


def signature(tokens: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITS, dtype=np.uint8)
    bits[(tokens >> np.uint64(20)) % np.uint64(BITS)] = 1
    return np.packbits(bits)


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The columns of ``wanted`` but _id and _key, beside the text of that document.

    The wanted documents are sent to the scan if they are few enough in bytes, so that only their texts move on.
    """
    held = broadcast_checked(wanted, F.lit(8 * len(wanted.columns)))
    on = docs["doc_id"].eqNullSafe(held["_id"]) & (F.xxhash64(docs["text"]) == held["_key"])
    rest = [c for c in wanted.columns if c not in ("_id", "_key")]
    return docs.join(held, on).select(*rest, "text")


def allowed(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose sizes and signatures allow a link."""
    one = classes.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("s_a"))
    two = classes.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("s_b"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                every = np.arange(batch.num_rows)
                u = _leaves(batch.column("n_a"), batch.column("s_a"), every)
                v = _leaves(batch.column("n_b"), batch.column("s_b"), -1 - every)  # never one component
                yield batch.select(["a", "b"]).take(pa.array(_may_link(u, v, every, every)))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(tidy(over), "a long, b long")


def links(docs: DataFrame, firsts: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b of the pairs that link, by their whole sets.

    Each ``b`` is a star: its text goes first, then the texts of all its ``a``.  A star of many is cut into
    several, each with its own copy of the centre.
    """
    sizes = pairs.groupBy("b").agg(F.floor(F.count(F.lit(1)) / PER_STAR).cast("int").alias("cuts"))
    dealt = pairs.join(sizes, "b").select("a", "b", F.pmod(F.xxhash64("a", "b"), F.col("cuts") + 1).cast("int").alias("cut"))
    centres = dealt.select("b", "cut").distinct().select(F.col("b").alias("class"), F.col("b").alias("star"), "cut", F.lit(0).alias("role"))
    around = dealt.select(F.col("a").alias("class"), F.col("b").alias("star"), "cut", F.lit(1).alias("role"))
    wanted = materialise(centres.unionByName(around).join(firsts, "class"), "stars")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        star, centre = None, np.empty(0, np.uint64)
        for batch in batches:
            good_a, good_b = [], []
            keys = zip(*(batch.column(c).to_pylist() for c in ("star", "cut", "role", "class")))
            for (b, cut, role, a), held in zip(keys, _sets(batch)):
                if role == 0:
                    star, centre = (b, cut), held
                    continue
                if star != (b, cut):
                    raise ValueError("a star without its centre")
                common = len(np.intersect1d(centre, held, assume_unique=True))
                if 100 * common >= PERCENT * (len(centre) + len(held) - common):
                    good_a.append(a)
                    good_b.append(b)
            if good_a:
                yield pa.RecordBatch.from_arrays([pa.array(good_a, pa.int64()), pa.array(good_b, pa.int64())], names=["a", "b"])

    texts = _texts_of(docs, wanted).repartition("star", "cut").sortWithinPartitions("star", "cut", "role")
    made = materialise(texts.mapInArrow(tidy(compare), "a long, b long"), "links")
    forget(wanted)
    return made


# ---- components


def reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the edges, and the smallest that each can reach."""
    nodes, places = np.unique(np.concatenate((a, b)), return_inverse=True)
    one, two = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while len(one):
        low, high = np.minimum(root[one], root[two]), np.maximum(root[one], root[two])
        apart = low != high
        one, two, low, high = one[apart], two[apart], low[apart], high[apart]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    return nodes, nodes[root]


def _reachable_by_task(edges: DataFrame, rows: int) -> DataFrame:
    """node, root: what the edges (a, b) that one task holds, EDGES or so, make of their nodes; final if ``rows`` are no more."""
    most = EDGES

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined() -> pa.RecordBatch:
            found = reachable(*(np.concatenate(side) for side in zip(*held)))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["node", "root"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        total = 0
        for batch in batches:
            held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
            total += batch.num_rows
            if total > most:
                yield joined()
                held, total = [], 0
        if total:
            yield joined()

    return edges.coalesce(max(1, -(-rows // most))).mapInArrow(tidy(over), "node long, root long")


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """node, root of all nodes of the edges (a, b): the smallest node that each can reach.

    Tasks first join the edges that they hold; EDGES or fewer are done with that, in one task.  Of more, stars are grown and
    flattened in turn (Kiveris et al., 2014) until they no longer change, or so few are left; only
    minima are aggregated, and neighbour lists are never gathered.
    """
    edges = edges.where("a <> b").select("a", "b")
    rows = edges.count()
    joined = materialise(_reachable_by_task(edges, rows), "roots")
    if rows <= EDGES:
        return joined
    now = materialise(joined.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")).distinct(), "edges")
    forget(joined)
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] <= EDGES:
            roots = materialise(_reachable_by_task(now.select(F.col("u").alias("a"), F.col("v").alias("b")), state[0]), "roots")
            break
        if tuple(state) == before:
            least = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
            roots = materialise(least.unionByName(least.select(F.col("root").alias("node"), "root").distinct()), "roots")
            break
        before = tuple(state)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        met = down.join(low, "u")
        small = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(met.select("u", F.col("m").alias("v")))
        last, now = now, materialise(small.where("u <> v").distinct(), "edges")
        forget(last)
    forget(now)
    return roots


def _with_links(roots: DataFrame, found: DataFrame) -> DataFrame:
    """``roots`` after further links (a, b); both tables are deleted, the components hold all that they say."""
    made = smallest_reachable(found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    forget(roots)
    forget(found)
    return made


# ---- trees


def _bits(column: pa.Array) -> np.ndarray:
    """Signatures as a matrix of 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)


def _leaves(sizes: pa.Array, signatures: pa.Array, roots: np.ndarray | None = None) -> dict:
    return leaves(sizes.to_numpy().astype(np.int64), _bits(signatures), roots)


def leaves(sizes: np.ndarray, bits: np.ndarray, roots: np.ndarray | None = None) -> dict:
    """Members as nodes: bitmap, range of sizes, what the bitmap may hide of a set, range of components."""
    roots = np.arange(len(sizes)) if roots is None else roots
    excess = sizes - np.bitwise_count(bits).sum(axis=1)
    return {"bits": bits, "low": sizes, "high": sizes, "over": excess, "first": roots, "last": roots}


class Tree:
    """Levels of nodes over members sorted by size; level 0 are the members."""

    def __init__(self, names: np.ndarray, members: dict):
        self.names = names
        self.levels = [members]
        while len(self.levels[-1]["low"]) > 1:
            below = self.levels[-1]
            at = np.arange(0, len(below["low"]), FAN)
            self.levels.append(
                {
                    "bits": np.bitwise_or.reduceat(below["bits"], at, axis=0),
                    "low": np.minimum.reduceat(below["low"], at),
                    "high": np.maximum.reduceat(below["high"], at),
                    "over": np.maximum.reduceat(below["over"], at),
                    "first": np.minimum.reduceat(below["first"], at),
                    "last": np.maximum.reduceat(below["last"], at),
                }
            )


def _may_link(u: dict, v: dict, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which node pairs could hold a link between two components."""
    low_u, low_v, high_u, high_v = u["low"][i], v["low"][j], u["high"][i], v["high"][j]
    good = 100 * np.minimum(high_u, high_v) >= PERCENT * np.maximum(low_u, low_v)
    one = (u["first"][i] == u["last"][i]) & (v["first"][j] == v["last"][j]) & (u["first"][i] == v["first"][j])
    k = np.flatnonzero(good & ~one)
    i, j = i[k], j[k]
    common = np.bitwise_count(u["bits"][i] & v["bits"][j]).sum(axis=1) + np.minimum(u["over"][i], v["over"][j])
    good = np.minimum(common, np.minimum(high_u[k], high_v[k])) >= least_overlap(low_u[k], low_v[k])
    return k[good]


def traverse(left: Tree, right: Tree, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf pairs that may link, as arrays of member numbers."""
    while len(left.levels) < len(right.levels):
        left.levels.append(left.levels[-1])
    while len(right.levels) < len(left.levels):
        right.levels.append(right.levels[-1])
    depth = len(left.levels) - 1
    zero = np.zeros(1, dtype=np.int64)
    open_pairs = [(depth, zero, zero)]
    while open_pairs:
        level, i, j = open_pairs.pop()
        k = _may_link(left.levels[level], right.levels[level], i, j)
        i, j = i[k], j[k]
        if not len(i):
            continue
        if level == 0:
            if same:
                i, j = i[i < j], j[i < j]
            yield i, j
            continue
        i, j = _children(left, level, i, j, right)
        if same:
            i, j = i[i <= j], j[i <= j]
        for first in range(0, len(i), AT_ONCE):
            open_pairs.append((level - 1, i[first : first + AT_ONCE], j[first : first + AT_ONCE]))


def _children(left: Tree, level: int, i: np.ndarray, j: np.ndarray, right: Tree) -> tuple[np.ndarray, np.ndarray]:
    def below(tree: Tree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(tree.levels[level - 1]["low"])
        if tree.levels[level - 1] is tree.levels[level]:  # a level that only evens out the heights
            return nodes[:, None], np.ones((len(nodes), 1), dtype=bool)
        made = nodes[:, None] * FAN + np.arange(FAN)
        return made, made < n

    a, a_good = below(left, i)
    b, b_good = below(right, j)
    pairs_a = np.repeat(a, b.shape[1], axis=1).ravel()
    pairs_b = np.tile(b, (1, a.shape[1])).ravel()
    good = (np.repeat(a_good, b.shape[1], axis=1) & np.tile(b_good, (1, a.shape[1]))).ravel()
    return pairs_a[good], pairs_b[good]


def group_pairs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of groups (token, class, n, root, signature): class pairs that no bound excludes, and the top nodes of large groups.

    A group of at most TOP members is one tree, gone through where it is read; groups no larger than
    a single node are looked at all together.  A larger group becomes rows of TOP members each.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        node = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            token = whole.column("token").to_numpy()
            changes = np.flatnonzero(token[1:] != token[:-1])
            cut = int(changes[-1]) + 1 if len(changes) else 0
            if cut:  # all but the last group are whole
                yield from _group_rows(whole.slice(0, cut), node)
                node, whole = 0, whole.slice(cut)
            while whole.num_rows > TOP:
                yield _top_row(whole.slice(0, TOP), node)
                node, whole = node + 1, whole.slice(TOP)
            held = whole
        if held is not None and held.num_rows:
            yield from _group_rows(held, node)

    schema = "a long, b long, need long, token long, node int, low long, high long, one long, names binary, sizes binary, roots binary, signatures binary"
    ordered = rows.repartition("token").sortWithinPartitions("token", "n", "class")
    made = materialise(ordered.mapInArrow(tidy(over), schema), "groups")
    return made.where("token IS NULL").select("a", "b", "need"), made.where("token IS NOT NULL").drop("a", "b", "need")


_ROW = pa.schema(
    [("a", pa.int64()), ("b", pa.int64()), ("need", pa.int64()), ("token", pa.int64()), ("node", pa.int32())]
    + [(c, pa.int64()) for c in ("low", "high", "one")]
    + [(c, pa.binary()) for c in ("names", "sizes", "roots", "signatures")]
)


def _pair_columns(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> list[pa.Array]:
    """a, b, and in how many groups the pair must be met."""
    return [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(shared_least(np.minimum(n_a, n_b)))]


def _pair_rows(*columns: np.ndarray) -> pa.RecordBatch:
    made = _pair_columns(*columns)
    return pa.RecordBatch.from_arrays(made + [pa.nulls(len(made[0]), f.type) for f in list(_ROW)[3:]], schema=_ROW)


def _top_row(rows: pa.Table, node: int) -> pa.RecordBatch:
    names, sizes, roots = (rows.column(c).to_numpy().astype("<i8") for c in ("class", "n", "root"))
    made = {
        "token": rows.column("token")[0].as_py(),
        "node": node,
        "low": int(sizes[0]),
        "high": int(sizes[-1]),
        "one": int(roots[0]) if (roots == roots[0]).all() else None,
        "names": names.tobytes(),
        "sizes": sizes.tobytes(),
        "roots": roots.tobytes(),
        "signatures": b"".join(rows.column("signature").to_pylist()),
    }
    return pa.RecordBatch.from_pylist([made], schema=_ROW)


def _group_rows(rows: pa.Table, node: int) -> Iterator[pa.RecordBatch]:
    """Pairs of whole groups; the first is the rest of a large one if ``node`` is not 0."""
    token = rows.column("token").to_numpy()
    starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(token)])))
    if node:
        yield _top_row(rows.slice(0, int(sizes[0])), node)
    names = rows.column("class").to_numpy()
    members = _leaves(rows.column("n"), rows.column("signature").combine_chunks(), rows.column("root").to_numpy())
    small = np.repeat(sizes <= FAN, sizes)
    if node:
        small[: sizes[0]] = False
    group = np.repeat(np.arange(len(starts)), sizes)
    for step in range(1, min(FAN, len(token))):
        i = np.flatnonzero(small[:-step] & (group[:-step] == group[step:]))
        if not len(i):
            break
        for first in range(0, len(i), AT_ONCE):
            u = i[first : first + AT_ONCE]
            u = u[_may_link(members, members, u, u + step)]
            if len(u):
                yield _pair_rows(names[u], names[u + step], members["low"][u], members["low"][u + step])
    for g in np.flatnonzero(sizes > FAN).tolist():
        if g == 0 and node:
            continue
        at = slice(int(starts[g]), int(starts[g] + sizes[g]))
        if sizes[g] > TOP:
            for k, first in enumerate(range(at.start, at.stop, TOP)):
                yield _top_row(rows.slice(first, min(TOP, at.stop - first)), k)
            continue
        tree = Tree(names[at], {k: x[at] for k, x in members.items()})
        for i, j in traverse(tree, tree, True):
            low = tree.levels[0]["low"]
            yield _pair_rows(tree.names[i], tree.names[j], low[i], low[j])


def node_pairs(nodes: DataFrame) -> DataFrame:
    """a, b: class pairs of large groups, from all pairs of their top nodes that sizes and components allow."""

    def tree(row: dict, side: str) -> Tree:
        names, sizes, roots = (np.frombuffer(row[c + side], "<i8") for c in ("names", "sizes", "roots"))
        bits = np.frombuffer(row["signatures" + side], np.uint64).reshape(len(names), -1)
        return Tree(names, leaves(sizes, bits, roots))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                left = tree(row, "")
                same = row["node"] == row["node_b"]
                right = left if same else tree(row, "_b")
                for i, j in traverse(left, right, same):
                    made = _pair_columns(left.names[i], right.names[j], left.levels[0]["low"][i], right.levels[0]["low"][j])
                    yield pa.RecordBatch.from_arrays(made, names=["a", "b", "need"])

    other = nodes.select(*[F.col(c).alias(c if c == "token" else f"{c}_b") for c in nodes.columns])
    met = nodes.join(other, "token").where(
        f"node <= node_b AND 100 * least(high, high_b) >= {PERCENT} * greatest(low, low_b) AND NOT coalesce(one = one_b, false)"
    )
    return met.mapInArrow(tidy(over), "a long, b long, need long")


# ---- the join


def _roots_on(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Column root: the component of the class, itself if it has no link yet."""
    named = roots.select(F.col("node").alias("class"), "root")
    return rows.join(named, "class", "left").withColumn("root", F.coalesce("root", "class"))


def led_pairs(shared: DataFrame, roots: DataFrame, turn: int) -> DataFrame:
    """a, b: each class and the leader it meets in most groups, if they are of different components and fit in size."""
    placed = _roots_on(shared, roots)
    if turn == 0:
        # how many classes hold a shingle of the class, on average over its first shingles: high in the middle of copies
        held = shared.groupBy("token").agg(F.count(F.lit(1)).alias("held"))
        first = F.max("n") - F.ceil(F.max("n") * PERCENT / 100) + 1
        weight = shared.join(held, "token").groupBy("class").agg((F.sum("held") / first).alias("weight"))
        ranked = placed.join(weight, "class")
    else:
        ranked = placed.withColumn("weight", F.xxhash64("class", F.lit(turn)))
    best = ranked.groupBy("token").agg(
        F.max(F.struct("weight", "class", "n", "root")).alias("leader"), F.min("root").alias("x"), F.max("root").alias("y")
    )
    met = placed.join(best.where("x <> y").select("token", "leader"), "token").where(F.col("root") != F.col("leader.root"))
    fits = 100 * F.least("n", "leader.n") >= PERCENT * F.greatest("n", "leader.n")
    tallied = met.where(fits).groupBy("class", F.col("leader.class").alias("b")).agg(F.count(F.lit(1)).alias("times"))
    chosen = tallied.groupBy("class").agg(F.max(F.struct("times", "b")).alias("best"))
    return chosen.select(F.col("class").alias("a"), F.col("best.b").alias("b"))


def class_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """node, root of all classes that have a link; ``classes`` has name, size, signature and a document of each."""
    firsts = classes.select("class", F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key"))
    shared = shared_postings(postings(docs, commonness(docs)))
    roots = docs.sparkSession.createDataFrame([], "node long, root long")
    for turn in range(ROUNDS):
        led = materialise(allowed(led_pairs(shared, roots, turn), classes), "led")
        tried = led.count()
        found = links(docs, firsts, led)
        linked = found.count()
        forget(led)
        if linked:
            roots = _with_links(roots, found)
        else:
            forget(found)
        if linked <= FEW * tried:
            break
    placed = _roots_on(shared, roots)
    several = placed.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("token")
    left = placed.join(several, "token", "left_semi").join(classes.select("class", "signature"), "class")
    near, nodes = group_pairs(left)
    met = near.unionByName(node_pairs(nodes)).groupBy("a", "b", "need").agg(F.count(F.lit(1)).alias("times"))
    pairs = materialise(met.where("times >= need").select("a", "b"), "pairs")
    forget(shared)
    found = links(docs, firsts, pairs)
    forget(pairs)
    return _with_links(roots, found)


def components(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_shingles, component_id (smallest doc_id that links reach), root (a class of the component)."""
    limit_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    members = materialise(members_of(docs), "members")
    classes = materialise(
        members.where("class IS NOT NULL")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("least"),
            F.min(F.struct("doc_id", "key")).alias("first"),
            F.first("n").alias("n"),
            F.first("signature").alias("signature"),
            F.min(F.struct("check", "n")).alias("x"),
            F.max(F.struct("check", "n")).alias("y"),
        ),
        "classes",
    )
    if not classes.where("x <> y").isEmpty():
        raise ValueError("two shingle sets have one name")
    roots = class_links(docs, classes)
    placed = _roots_on(classes.select("class", "least"), roots)
    lowest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = materialise(placed.join(lowest, "root").select("class", "component_id", "root"), "answer")
    forget(roots)
    forget(classes)
    joined = members.drop("signature").join(answer, "class", "left")
    own = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "key", F.col("n").alias("n_shingles"), own.alias("component_id"), "root")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return components(docs).drop("key", "root")


def keep_one(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each component, once, with all its columns.

    Documents without shingles all stay; one without id stays only where no other of its component has one.
    """
    found = materialise(components(docs), "components")
    first: Column = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    firsts = found.where("n_shingles > 0").groupBy("root").agg(first.alias("d"))
    kept = firsts.select(F.col("d.doc_id").alias("_id"), F.col("d.key").alias("_key"))
    blank = found.where("n_shingles = 0").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    chosen = materialise(kept.unionByName(blank).distinct(), "kept")
    on = docs["doc_id"].eqNullSafe(chosen["_id"]) & F.xxhash64(docs["text"]).eqNullSafe(chosen["_key"])
    stay = docs.join(broadcast_checked(chosen, F.lit(16)), on, "left_semi")
    again = found.where("n_shingles > 0").groupBy("doc_id", "key").count().where("count > 1")
    again = materialise(again.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")), "again")
    forget(found)
    if again.isEmpty():
        return stay
    same = stay["doc_id"].eqNullSafe(again["_id"]) & F.xxhash64(stay["text"]).eqNullSafe(again["_key"])
    return stay.join(again, same, "left_anti").unionByName(stay.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))
