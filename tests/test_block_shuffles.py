"""Blocks of lines: one exchange of lines, and the same blocks for crowded orders."""

import duckdb
import pytest

from chainlake.plans import views
from chainlake.plans.oracles import ORACLES
from chainlake.plans.registry import QUERIES
from tools.check import rows_of

SF_DIR = "/root/testdata/sf0.001"


def test_lines_are_shuffled_once(spark):
    found = views.blocks(spark, SF_DIR)
    found.write.format("noop").mode("overwrite").save()
    found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("REPARTITION_BY_COL") == 1
    # Besides: counts by bucket, and the orders where they are not broadcast.
    assert sum("Exchange hashpartitioning" in line and "Reused" not in line for line in final.splitlines()) <= 3


@pytest.mark.parametrize("most", [0, 8, 1 << 40])
@pytest.mark.parametrize("name", ["block_source", "flatten_transactions", "archive_replay_state"])
def test_crowded_and_other_orders_make_the_same_blocks(spark, folder, monkeypatch, most, name):
    """All, some or none of the orders are dealt by slices; some lines have no order."""
    sf_dir = folder("lines")
    lines = views.table(spark, "/root/testdata/sf0.001", "lineitem")
    keys = "CASE WHEN l_suppkey % 4 = 0 THEN NULL WHEN l_linenumber = 1 THEN 7 ELSE l_orderkey END"
    lines = lines.selectExpr("*", f"{keys} AS k").drop("l_orderkey").withColumnRenamed("k", "l_orderkey")
    lines.write.parquet(f"{sf_dir}/lineitem.parquet")
    views.table(spark, SF_DIR, "orders").write.parquet(f"{sf_dir}/orders.parquet")
    monkeypatch.setattr(views, "BUCKET_LINES", most)
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    duck = duckdb.connect()
    for table in ("lineitem", "orders"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet/*.parquet'")
    result = duck.execute(ORACLES[name])
    assert got and got == rows_of([column[0] for column in result.description], result.fetchall())
