"""Every SQL-expressible registered query against DuckDB on the smallest data,
plus the driver contract of ``__spark_entry__``."""

from __future__ import annotations

import importlib.util
import os

import pytest
from pyspark.sql.types import DoubleType

from helpers import ROOT, SF_SMALL
from oracle_check import compare, duck
from tillroll.plans.registry import REGISTRY


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


SQL_QUERIES = [n for n, q in REGISTRY.items() if q.sql is not None]


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_duckdb(spark, con, name):
    q = REGISTRY[name]
    assert compare(spark, con, name, q, SF_SMALL)
    doubles = [f.name for f in q.run(spark, SF_SMALL).schema.fields if isinstance(f.dataType, DoubleType)]
    assert sorted(doubles) == sorted(q.doubles)


def test_entry_contract(spark):
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0 and len(df.columns) == 29
    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert set(REGISTRY) <= set(mod.queries())
