"""What Python workers hold: batches of bounded bytes, and nothing freed after a task's last batch."""

from __future__ import annotations

import pyarrow as pa
import pytest

from seriesmill.llm import codec, common, jaccard
from seriesmill.session import BATCH_LIMIT, limit_batches

KEY, MOST = BATCH_LIMIT[0], 4 << 20


@pytest.fixture
def unset(spark):
    before = spark.conf.get(KEY)
    spark.conf.unset(KEY)
    yield
    spark.conf.set(KEY, before)


def test_given_back_after_the_last_batch(monkeypatch):
    told = []
    monkeypatch.setattr(common, "give_back", lambda: told.append("back"))

    def over(batches):
        for batch in batches:
            told.append(batch)
            yield -batch

    assert list(common.tidy(over)(iter([1, 2]))) == [-1, -2]
    assert told == [1, 2, "back"]


@pytest.mark.parametrize("step", [jaccard.components, codec.encode])
def test_batches_are_bounded(spark, make, prose, unset, step):
    step(make([(1, prose(1, 20)), (2, None)]))
    rows = make([(i, "x" * 40_000) for i in range(400)]).coalesce(1).select("text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([sum(len(t.as_py()) for t in batch.column("text"))], pa.int64())})

    found = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(found) == 400 * 40_000 and max(found) <= MOST + 80_000


def test_another_limit_stays(spark, unset):
    spark.conf.set(KEY, "1m")
    limit_batches(spark)
    assert spark.conf.get(KEY) == "1m"
