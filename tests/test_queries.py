"""Every named query against its reference SQL on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = contract.queries(), contract.oracle_sql()


def rows(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return "~"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return str(float(v) + 0.0)
        return str(v.item() if hasattr(v, "item") and not isinstance(v, str) else v) if not hasattr(v, "item") else cell(v.item())

    df = df[sorted(df.columns)]
    return sorted(tuple(cell(v) for v in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{data}/{name}.parquet'")
    return con


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) > 150


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, data, duck, name):
    got = QUERIES[name](spark, data).toPandas()
    want = duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", ["local_spikes", "hex_density", "html_blocks", "plan_slots", "cell_components", "selected_entities", "fan_removal", "mesh_removal"])
def test_runs_without_sql(spark, data, name):
    df = QUERIES[name](spark, data)
    assert df.count() >= 0 and df.columns


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["siteId", "zoneId", "n"] and df.count() > 0


@pytest.mark.parametrize("name", ["long_gaps", "keep_last", "plot_caps", "bucket_pages", "cell_components"])
def test_same_result_for_any_partitioning(spark, data, duck, name):
    want = rows(duck.sql(SQL[name]).df())
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for parts, adaptive in (("1", "false"), ("13", "false")):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            assert rows(QUERIES[name](spark, data).toPandas()) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
