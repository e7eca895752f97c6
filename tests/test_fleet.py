"""The landed replies of a cycle."""

from datetime import datetime

from gaugeworks.operators.union import GOOD, OUTCOME
from gaugeworks.plans.fleet import cycle


def test_replies_are_made_once_and_read_by_endpoint(spark, tmp_path):
    at = datetime(2001, 1, 1)
    made = {
        "orders": ([(i, i % 5, "1-URGENT", at) for i in range(60)], "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate timestamp_ntz"),
        "lineitem": ([(1, 3.0)], "l_suppkey long, l_quantity double"),
        "part": ([(1, "t", "b")], "p_partkey long, p_type string, p_brand string"),
        "region": ([(i,) for i in range(5)], "r_regionkey int"),
        "nation": ([(1,)], "n_nationkey int"),
    }
    for name, (rows, ddl) in made.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    got = cycle(spark, str(tmp_path))
    # Only replies have the priority: no job builds them anew from the orders.
    assert "o_orderpriority" not in got._jdf.queryExecution().sparkPlan().toString()
    load = got.where((got["name"] == "host.load.5m") & (got[OUTCOME] == GOOD)).select("value").collect()
    assert sorted(r["value"] for r in load) == list(range(4, 60, 6))
