from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from seriesmill.session import build_session

    shared = tmp_path_factory.mktemp("shared").as_uri()
    SparkSession.builder.config("spark.checkpoint.dir", shared).config("spark.driver.memory", "6g")
    session = build_session("tests", "local[8]", 4)
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))
    yield session
    session.stop()


@pytest.fixture
def rows_of():
    """Rows as sorted tuples, doubles rounded, for comparison whatever the order."""

    def collect(df, digits: int = 6):
        names = sorted(df.columns)
        made = [
            tuple(round(v, digits) + 0.0 if isinstance(v, float) else v for v in (r[n] for n in names))
            for r in df.collect()
        ]
        return sorted(made, key=lambda t: [(v is None, str(type(v)), v if v is not None else 0) for v in t])

    return collect
