"""Cut points, hash-ordered samples, splits and exact percentiles."""

from __future__ import annotations

from collections import Counter
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import ranks, sample, selection, split
from seriesmill.operators.quantiles import exact_quantiles
from seriesmill.spec import SeriesSpec

SPEC = SeriesSpec(entity="e", label="c", ts="t", sensors=("x",))


def table(spark, n, entities=3):
    return spark.range(n).selectExpr(
        f"concat('w', cast(hash(id) % {entities} AS string)) AS e",
        "cast(id % 4 AS int) AS c",
        "timestamp_seconds(pmod(hash(id * 7), 100000) * 100000L + id) AS t",
        "double(id) AS x",
    )


@pytest.mark.parametrize("n", [1, 3, 7, 10, 20, 257])
@pytest.mark.parametrize("by_time", [False, True])
def test_split_cuts_are_floors(spark, n, by_time):
    rows = table(spark, n)
    made = (split.time_split if by_time else split.ordinal_split)(rows, SPEC)
    order = ("t", "e") if by_time else ("e", "t")
    got = sorted(made.collect(), key=lambda r: tuple(r[c] for c in order))
    a, b = floor(n * 0.7), floor(n * (0.7 + 0.15))
    assert [r["split"] for r in got] == ["train"] * a + ["val"] * (b - a) + ["test"] * (n - b)


@pytest.mark.parametrize("small", [1, 5, 50])
def test_cuts_without_collecting(spark, monkeypatch, small):
    """With a tiny driver limit every level goes through the distributed search."""
    rows = table(spark, 300, 40)
    want = ranks.keys_at(rows, ["e", "t"], [0.0, 0.7, 0.85, 0.999])
    monkeypatch.setattr(ranks, "SMALL_ROWS", small)
    assert ranks.keys_at(rows, ["e", "t"], [0.0, 0.7, 0.85, 0.999]) == want


@pytest.mark.parametrize("by_time", [False, True])
def test_train_rows_are_pruned_in_the_scan(spark, tmp_path, by_time):
    table(spark, 300, 40).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    names = ["t", "e"] if by_time else ["e", "t"]
    cut = ranks.keys_at(rows, names, [0.7])[0]
    train = rows.where(ranks.rows_before(rows, names, cut))
    assert train.count() == 210
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert f"LessThanOrEqual({'t' if by_time else 'e'}," in plan


def test_missing_times_sort_last(spark):
    rows = spark.createDataFrame([("a", None), ("a", 1), ("a", 2), (None, 1)], "e string, t int")
    made = rows.withColumn("split", split.split_column(rows, ["e", "t"], (0.5, 0.75)))
    assert {(r["e"], r["t"]): r["split"] for r in made.collect()} == {
        ("a", 1): "train",
        ("a", 2): "train",
        ("a", None): "val",
        (None, 1): "test",
    }


def test_stratified_split_sizes(spark):
    rows = table(spark, 400).withColumn("c", F.when(F.col("x") < 1, 9).otherwise(F.col("c")))
    got = Counter((r["c"], r["split"]) for r in split.stratified_split(rows, "c", ["x"]).collect())
    sizes = Counter(r["c"] for r in rows.collect())
    for c, n in sizes.items():
        part = round(n * 0.15)  # both round half to even
        assert got[c, "test"] == part and got[c, "val"] == part
        assert got[c, "train"] == n - 2 * part


def test_sample_sizes_and_determinism(spark, rows_of):
    rows = table(spark, 500)
    got = sample.stratified_sample(rows, "c", ["x"], 50)
    again = sample.stratified_sample(rows.repartition(7), "c", ["x"], 50)
    assert rows_of(got) == rows_of(again)
    assert Counter(r["c"] for r in got.collect()) == {c: round(125 * 0.1) for c in range(4)}
    assert sample.equal_sample(rows, "c", ["x"], 30).count() == 120
    assert sample.equal_sample(rows, "c", ["x"], 1000).count() == 500
    assert sample.sample_cap(rows, ["x"], 33).count() == 33


def test_sample_of_copies_is_exact(spark):
    """A third of the rows are copies of one row; the cut may fall among them."""
    rows = table(spark, 200).unionByName(spark.range(100).selectExpr("'w0' AS e", "1 AS c", "timestamp_seconds(0) AS t", "-1.0D AS x"))
    for n in (1, 50, 120, 299, 300, 400):
        assert sample.sample_cap(rows, ["x"], n).count() == min(n, 300)


def test_missing_classes_and_resplit(spark):
    rows = spark.createDataFrame([(i, "e", i // 50, i) for i in range(100)], "t int, e string, c int, x int")
    made = split.ordinal_split(rows, SPEC)
    lacking = {(r["c"], r["split"]) for r in split.missing_classes(made, "c").collect()}
    assert lacking == {(0, "val"), (0, "test")}
    again = split.resplit_if_needed(made, SPEC, ["x"])
    assert split.missing_classes(again, "c").isEmpty()
    assert again.count() == 100
    no_train = rows.withColumn("split", F.lit("val"))
    assert {r[0] for r in split.resplit_if_needed(no_train, SPEC, ["x"]).select("split").distinct().collect()} == set(split.SPLITS)


def odd_doubles() -> np.ndarray:
    """Doubles of every size, those next to powers of two, the smallest and the largest ones, in both signs."""
    rng = np.random.default_rng(8)
    powers = 2.0 ** np.arange(-1074, 1024, 7)
    sizes = np.concatenate([powers, np.nextafter(powers, np.inf), np.nextafter(powers, 0), rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500), [0.0, 5e-324, 2.0**-1022, 1.7976931348623157e308, np.inf, 1.0, 2.0, 1e5]])
    return np.concatenate([sizes, -sizes])


def test_images_are_the_bits_of_doubles(spark):
    values = odd_doubles()
    rows = spark.createDataFrame([(float(v),) for v in values] + [(float("nan"),)], "v double")
    got = {str(r["v"]): r["i"] for r in rows.select("v", selection.image(F.col("v")).alias("i")).collect()}
    bits = np.abs(values).view(np.int64)
    for v, want in zip(values, np.where(values < 0, -bits, bits)):
        assert got[str(float(v))] == want, v
    assert got["nan"] == (1 << 63) - 1


@pytest.mark.parametrize("few", [0, 10, 200, 1_000_000])
def test_percentiles_equal_numpy(spark, few):
    """One formula, whether groups go down by one digit, by all of them or by none."""
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=2000), np.full(900, 0.25), rng.integers(0, 5, 300), odd_doubles()[np.abs(odd_doubles()) < 1e300]])
    rows = [(int(i % 3), float(v)) for i, v in enumerate(values)] + [(0, None), (None, 4.0), (None, 5.0), (9, -1.5)]
    df = spark.createDataFrame(rows, "g int, value double").repartition(6)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0, "f": 0.5}
    got = exact_quantiles(df, ["g"], probs, few=few).collect()
    for r in got:
        mine = [v for g, v in rows if g == r["g"] and v is not None]
        np.testing.assert_allclose([r[k] for k in probs], np.quantile(mine, list(probs.values())), rtol=1e-12, atol=1e-300)
    assert len(got) == 5
    whole = exact_quantiles(df, [], {"m": 0.5}, few=few).collect()
    assert [r["m"] for r in whole] == pytest.approx([np.quantile([v for _, v in rows if v is not None], 0.5)])
    assert exact_quantiles(df.where("false"), ["g"], probs, few=few).collect() == []


def test_no_task_sorts_more_than_a_digit(spark):
    """The counts that one window sees are those of a digit, or of few rows."""
    df = spark.range(30_000).select(F.lit(0).alias("g"), (F.col("id") / 7).alias("value"))
    deals = []
    plain = selection._find

    def watched(counts, by, at, name):
        deals.append(counts.groupBy(*by, "_at").count().agg(F.max("count")).first()[0])
        return plain(counts, by, at, name)

    selection._find = watched
    try:
        (row,) = exact_quantiles(df, ["g"], {"m": 0.5}, few=100).collect()
    finally:
        selection._find = plain
    assert row["m"] == pytest.approx(29_999 / 14) and len(deals) >= 3 and deals[-1] <= 100


@pytest.mark.parametrize("few", [0, 3, 50_000])
def test_digest_cuts_at_every_depth(spark, few):
    """Also where all digests share their first digits, and where copies share a digest."""
    rng = np.random.default_rng(4)
    rows = [(g, "abcdabcd" * 2 + f"{v:016x}") for g, n in ((0, 500), (1, 7), (None, 40)) for v in rng.integers(0, 300, n)]
    df = spark.createDataFrame(rows, "g int, _h string")
    wants = [F.lit(5), F.col("n"), F.lit(0), F.col("n") * 2]
    for r in selection.hash_cuts(df, ["g"], wants, few).collect():
        mine = sorted(h for g, h in rows if g == r["g"])
        for i, want in enumerate((min(5, len(mine)), len(mine), 0, len(mine))):
            if not want:
                assert r[f"_cut_{i}"] is None
                continue
            cut = mine[want - 1]
            assert (r[f"_cut_{i}"], r[f"_tied_{i}"]) == (cut, mine.count(cut))
            assert r[f"_spare_{i}"] == want - sum(h < cut for h in mine)


def test_downsample_step(spark):
    rows = table(spark, 100, 1)
    kept = sample.downsample(rows, SPEC, 30)
    assert kept.count() == 25  # every 4th of 100
    assert sample.head_per_class(rows, SPEC, 3).count() == 12
