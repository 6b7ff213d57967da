import __spark_entry__ as driver
from lumengrid.plans.queries import ORACLE, QUERIES


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() == 189 and df.columns[:3] == ["scene", "camera_id", "offset_ms"]
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_plans_prune_and_push(spark):
    """Scans read only the columns that a query needs, and filters reach the files."""
    from tests.conftest import SF

    plan = QUERIES["sync_top_offsets"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "props" not in plan
    plan = QUERIES["roi_common_mask"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "s_name" not in plan and "ReadSchema: struct<s_suppkey:bigint>" in plan
