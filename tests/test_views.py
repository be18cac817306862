"""The views that feed the queries, on tables with repeated and missing keys."""

from workload.views import BRONZE, bronze, run

TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "EUROPE"), (1, "ASIA"), (None, "AFRICA")]),
    "nation": ("n_nationkey int, n_regionkey int", [(0, 0), (1, 1), (1, 0), (2, None)]),
    "customer": ("c_custkey long, c_nationkey int", [(1, 0), (2, 1), (2, 0), (None, 0), (3, None), (4, 2)]),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderdate string",
        [(1, 1, "1998-02-03"), (2, 2, "1997-02-03"), (2, 2, "1997-02-03"), (3, None, "1998-01-01"), (4, 3, None), (5, 4, None), (6, 1, None)],
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string",
        [(k, k, k, n, 3.0, "N", "F") for k in (1, 2, 3, 4, 5, 6, None) for n in (1, 1, 2)],
    ),
}


def test_orders_find_their_region_before_the_line_items_come(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        table = spark.createDataFrame(rows, schema)
        if name == "orders":
            table = table.withColumn("o_orderdate", table["o_orderdate"].cast("date"))
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    found, told = bronze(spark, str(tmp_path)), run(spark, str(tmp_path), BRONZE)
    assert found.columns == told.columns and found.count() == told.count() > 0
    assert found.exceptAll(told).isEmpty() and told.exceptAll(found).isEmpty()
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
    items, = [line.index("Join") for line in joins if "l_orderkey" in line]
    customers, = [line.index("Join") for line in joins if "c_custkey" in line]
    assert customers > items
