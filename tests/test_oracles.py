"""Queries with a SQL twin agree with it on all values.

Left out unless FULL=1: the wide feature queries and those that fit models, which take long, and queries without a twin,
whose rows are only counted.
"""

from __future__ import annotations

import os

import pytest
from check_oracles import compare, tables

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.01"
SLOW = {n for n in queries() if n.startswith(("features", "gold", "rolling", "quality"))}
FITTED = {"rf_train", "gbt_train", "predict", "score_series", "importance", "learning_curve", "attribution"}
NAMES = sorted(queries()) if os.environ.get("FULL") else sorted(set(oracle_sql()) - SLOW - FITTED)


@pytest.fixture(scope="module")
def duck():
    return tables(SF)


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(spark, duck, name):
    assert compare(spark, duck, name, SF).startswith(("match", "rows only"))


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "l_tax_delta_norm" in df.columns
