"""The rows at given ranks of many groups at once, by digits of their key.

A group's rows are counted by the first digit of their key (65,536 values); the digit that holds a wanted rank is known then,
and only rows that begin with it are counted by the next digit.  Once the rows under a digit are few, they are counted by
their whole key.  All groups and ranks go down together, one pass over the rows a digit; no task sorts more than the counts
of one digit, and the result is exact whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.functions.columns import hash_key
from seriesmill.operators.slices import attach, bounded
from seriesmill.session import materialise

# Rows under a digit that are counted by their whole key.
FEW_ROWS = 1_000_000
DIGIT_BITS = 16
IMAGE_DIGITS = 64 // DIGIT_BITS
DIGEST_DIGITS = 8
# Rows under the digits of a digest that are counted by the whole of it.
FEW_DIGESTS = 50_000

_MANTISSA = 1 << 52


def image(value: Column) -> Column:
    """A 64-bit number per double, in the order of the doubles: exponent and mantissa of its size, with its sign; NaN last."""
    size = F.abs(value)
    # the logarithm may miss the exponent by one next to a power of two
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    power = F.when(F.pow(F.lit(2.0), guess) > size, guess - 1).when(F.pow(F.lit(2.0), F.least(guess + 1, F.lit(1023))) <= size, F.least(guess + 1, F.lit(1023))).otherwise(guess)
    small = size < F.lit(2.0**-1022)
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    normal = (power + 1023) * _MANTISSA + ((size / F.pow(F.lit(2.0), power) - 1.0) * float(_MANTISSA)).cast("long")
    bits = (
        F.when(F.isnan(value), F.lit((1 << 63) - 1))
        .when(size == float("inf"), F.lit(2047 * _MANTISSA))
        .when(size == 0.0, F.lit(0).cast("long"))
        .when(small, tiny)
        .otherwise(normal)
    )
    return F.when(value < 0, -bits).otherwise(bits)


def image_digit(column: str) -> Callable[[int], Column]:
    """The first ``level`` digits of an image."""
    return lambda level: F.shiftright(column, 64 - DIGIT_BITS * level).cast("long") if level else F.lit(0).cast("long")


def digest_digit(column: str) -> Callable[[int], Column]:
    """The first ``level`` digits, of four characters, of a hexadecimal digest."""
    return lambda level: F.substring(column, 1, 4 * level) if level else F.lit("")


def rows_at(
    rows: DataFrame,
    by: Sequence[str],
    wanted: DataFrame,
    key: str,
    digit: Callable[[int], Column],
    digits: int,
    few: int = FEW_ROWS,
    first: DataFrame | None = None,
) -> DataFrame:
    """``by``, ``_rank`` and the key ``_key`` of the row at each wanted rank, with ``_rest``, its rank among the ``_rows`` of that key.

    ``wanted`` has ``by``, ``_rank`` (a name), ``_rest`` (the rank from 0, inside the group) and ``_rows`` of the group.
    ``first`` may bring the counts ``_m`` of the first digit ``_next`` if they are known.
    """
    by = list(by)
    at = wanted.withColumn("_at", digit(0))
    for level in range(digits):
        largest = at.agg(F.max("_rows")).first()[0]
        if largest is None or largest <= few:
            break
        counts = first if level == 0 and first is not None else _inside(rows, by, at, digit, level).groupBy(*by, "_at", digit(level + 1).alias("_next")).agg(F.count(F.lit(1)).alias("_m"))
        at = materialise(_find(counts.withColumn("_at", digit(0)) if level == 0 else counts, by, at, "_next").withColumnRenamed("_next", "_at"), "ranks")
    else:
        level = digits
    counts = _inside(rows, by, at, digit, level).groupBy(*by, "_at", F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_m"))
    return _find(counts, by, at, "_key")


def _inside(rows: DataFrame, by: list[str], at: DataFrame, digit: Callable[[int], Column], level: int) -> DataFrame:
    """The rows that share their first digits with a wanted one."""
    named = rows.withColumn("_at", digit(level))
    if not level:
        return named
    return attach(named, bounded(at.select(*by, "_at").distinct()), [*by, "_at"], "left_semi")


def _find(counts: DataFrame, by: list[str], at: DataFrame, name: str) -> DataFrame:
    """For every wanted rank the entry of ``counts`` that holds it.

    Entries and ranks are put in one falling order of positions, in which a rank's entry is the last one before it.
    """
    group = [*by, "_at"]
    upto = F.sum("_m").over(Window.partitionBy(*group).orderBy(name).rowsBetween(Window.unboundedPreceding, 0))
    kinds = {**dict(at.dtypes), **dict(counts.dtypes)}
    entry = F.struct(F.col(name), "_m", (upto - F.col("_m")).alias("_start"))
    ends = counts.select(*group, (upto - 1).alias("_pos"), F.lit(0).alias("_asks"), F.lit(None).cast(kinds["_rank"]).alias("_rank"), entry.alias("_entry"))
    asks = at.select(*group, F.col("_rest").alias("_pos"), F.lit(1).alias("_asks"), "_rank", F.lit(None).cast(ends.schema["_entry"].dataType).alias("_entry"))
    falling = Window.partitionBy(*group).orderBy(F.col("_pos").desc(), "_asks").rowsBetween(Window.unboundedPreceding, 0)
    met = ends.unionByName(asks).withColumn("_entry", F.last("_entry", ignorenulls=True).over(falling)).where("_asks = 1")
    return met.select(*by, "_rank", F.col(f"_entry.{name}").alias(name), (F.col("_pos") - F.col("_entry._start")).alias("_rest"), F.col("_entry._m").alias("_rows"))


def hash_cuts(df: DataFrame, groups: Sequence[str], wants: Sequence[Column], few: int = FEW_DIGESTS) -> DataFrame:
    """Per group, the digest ``_h`` at which ``wants[i]`` rows of the group are reached.

    ``wants`` are expressions over ``n``, the rows of the group.  Columns: groups, and per want ``_cut_i``, ``_spare_i`` (rows to
    take at the cut) and ``_tied_i`` (rows that share the digest), null where nothing is wanted.
    """
    digit = digest_digit("_h")
    first = materialise(df.groupBy(*groups, digit(1).alias("_next")).agg(F.count(F.lit(1)).alias("_m")), "digests")
    totals = first.groupBy(*groups).agg(F.sum("_m").alias("n"))
    numbered = F.array(*[F.struct(F.lit(i).alias("_rank"), want.cast("bigint").alias("_want")) for i, want in enumerate(wants)])
    asked = totals.select(*groups, F.col("n").alias("_rows"), F.inline(numbered)).where("_want > 0")
    asked = asked.select(*groups, "_rank", (F.least("_want", "_rows") - 1).alias("_rest"), "_rows")
    found = rows_at(df, groups, asked, "_h", digit, DIGEST_DIGITS, few, first)
    values = (("_key", "_cut"), ("_spare", "_spare"), ("_rows", "_tied"))
    return (
        found.withColumn("_spare", F.col("_rest") + 1)
        .groupBy(*groups)
        .agg(*[F.max(F.when(F.col("_rank") == i, F.col(source))).alias(f"{name}_{i}") for i in range(len(wants)) for source, name in values])
    )


def take_hashed(
    df: DataFrame, groups: Sequence[str], key: Sequence[str], seed: int, want: Column
) -> DataFrame:
    """The first ``want`` rows of every group in digest order of ``key``.

    No group is gathered anywhere: counting passes find the digest at the cut,
    a filter takes the rows.  Where several rows share the digest at the cut, only
    as many of them as are wanted are kept.
    """
    names = df.columns
    by = list(groups) or ["_all"]
    tagged = df.withColumn("_h", hash_key(key, seed))
    if not groups:
        tagged = tagged.withColumn("_all", F.lit(0))
    cuts = bounded(hash_cuts(tagged.select(*by, "_h"), by, [want]))
    joined = attach(tagged, cuts, by)
    whole = joined.where(
        (F.col("_h") < F.col("_cut_0"))
        | ((F.col("_h") == F.col("_cut_0")) & (F.col("_spare_0") == F.col("_tied_0")))
    ).select(*names)
    if cuts.where("_spare_0 < _tied_0").isEmpty():
        return whole
    tied = joined.where((F.col("_h") == F.col("_cut_0")) & (F.col("_spare_0") < F.col("_tied_0")))
    merged = tied.groupBy(*dict.fromkeys([*by, *names]), "_spare_0").agg(F.count(F.lit(1)).alias("_copies"))
    upto = Window.partitionBy(*by).orderBy(*names).rowsBetween(Window.unboundedPreceding, 0)
    picked = (
        merged.withColumn("_upto", F.sum("_copies").over(upto))
        .withColumn("_take", F.least("_copies", F.col("_spare_0") - F.col("_upto") + F.col("_copies")))
        .where("_take > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_take").cast("int"))))
    )
    return whole.unionByName(picked.select(*names))
