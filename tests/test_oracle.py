"""Every registered query against its DuckDB oracle (the driver's correctness gate) at sf0.001,
plus the properties the job must keep whatever the data."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle_check import compare
from trendlens.plans import catalog
from trendlens.plans.job import Pipeline
from trendlens.streaming import registered

from conftest import SF001, SF01


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["discipline", "publish_year", "word", "count"]


CORE = {**catalog.QUERIES, **registered.QUERIES}       # the queries of tests/llm's subpackage are tested there


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(entry.queries())
    assert set(CORE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_all_queries_match_oracle_sf0001(spark):
    res = compare(spark, SF001, sorted(CORE), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] != "OK"}
    assert not bad, bad


def test_properties_sf001(spark):
    pl = Pipeline(spark, SF01, catalog.P)
    hist = pl.history()
    assert hist.groupBy("discipline", "publish_year").count().agg(F.max("count")).first()[0] <= 12
    r = pl.rules()
    assert r.groupBy("source").count().agg(F.max("count")).first()[0] <= 8
    lo, hi = r.agg(F.min("confidence"), F.max("confidence")).first()
    assert lo >= catalog.P.min_confidence and hi <= 1.0
    fc = pl.trend().filter("is_forecast")
    assert fc.agg(F.min("count")).first()[0] >= 3


def test_result_independent_of_partitions(spark):
    def rows(parts):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            return sorted(map(tuple, Pipeline(spark, SF001, catalog.P).rules().collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert rows(3) == rows(11)
