"""How the stand-in feeds are dealt over tasks."""

import datetime as dt

import pytest
from conftest import plan

from testbed.feeds import feed


@pytest.mark.parametrize("name", ["accounts", "contacts", "opportunities"])
def test_a_single_row_group_is_dealt_out_before_a_feed_multiplies_it(spark, tmp_path, name):
    customers = [(i, f"Customer#{i}", i % 25, 1.0 * i, "BUILDING") for i in range(40)]
    kinds = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    suppliers = [(i, f"Supplier#{i}", i % 25, 1.0) for i in range(4)]
    orders = [(i, i % 40, "F", 10.0, dt.datetime(2024, 1, 1), "2-HIGH") for i in range(40)]
    tables = {
        "customer": spark.createDataFrame(customers, kinds),
        "supplier": spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "orders": spark.createDataFrame(
            orders,
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        ),
    }
    for table, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    found = feed(spark, str(tmp_path), name)
    assert "REPARTITION_BY_COL" in plan(found)
    assert found.count() == {"accounts": 2 * 44 + 2, "contacts": 40, "opportunities": 80}[name]
