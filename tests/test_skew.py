"""A third of the rows on one customer, day, order and product, and nothing broadcast."""

import duckdb
import pytest
from compare import connect, difference

from tillwise.operators import joins
from tillwise.oracles import oracle_sql
from tillwise.registry import queries

# What is piled up, per table.
SKEW = {
    "orders": """* REPLACE (
        CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 3 = 1 THEN TIMESTAMP '1999-03-03 10:00:00' ELSE o_orderdate END AS o_orderdate)""",
    "lineitem": """* REPLACE (
        CASE WHEN l_linenumber % 3 = 0 THEN 11 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_suppkey % 3 = 0 THEN 50 ELSE l_partkey END AS l_partkey)""",
}

NAMES = (
    "raw_feed", "clean_sales", "clean_report", "dim_customer", "dim_product", "fact_sales", "monthly_revenue",
    "revenue_by_country", "sales_wide", "measures_by", "cohort_retention", "rfm_scores", "sku_concentration",
    "key_stats", "forecast_table",
)


@pytest.fixture(scope="module")
def skewed(small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in ("nation", "customer", "part", "orders", "lineitem"):
        con.execute(
            f"COPY (SELECT {SKEW.get(name, '*')} FROM '{small}/{name}.parquet') TO '{folder}/{name}.parquet'"
        )
    return str(folder)


@pytest.fixture(scope="module")
def con(skewed):
    return connect(skewed, ("nation", "customer", "part", "orders", "lineitem"))


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, skewed, con, settings, monkeypatch, name):
    settings(autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1, shuffle__partitions=16)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    assert difference(queries()[name](spark, skewed), con, oracle_sql()[name]) == ""
