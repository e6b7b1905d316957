"""Paths, rows and small builders that several test modules share."""

from __future__ import annotations

import os

from tillroll.operators import bronze as B
from tillroll.operators import silver as S
from tillroll.sources.schema import RAW_SCHEMA

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
INGESTED = "2011-01-01 00:00:00"


def raw_df(spark, rows):
    """Raw invoice lines from tuples in RAW_SCHEMA order (missing trailing
    fields are NULL)."""
    width = len(RAW_SCHEMA.fields)
    padded = [tuple(r) + (None,) * (width - len(r)) for r in rows]
    return spark.createDataFrame(padded, RAW_SCHEMA)


def clean_of(spark, rows):
    return S.clean_transactions(B.add_lineage(raw_df(spark, rows), ingested_at=INGESTED))


def line(inv="1001", code="A1", desc="thing", qty=1, date="12/1/2010 8:26", price=2.0,
         cust="17850", country="UK"):
    return (inv, code, desc, qty, date, price, cust, country)
