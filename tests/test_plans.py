"""Physical plan properties: no Python in the plan, pruned scans, partial aggregation, broadcast dims."""

from storeloom.plans import queries as Q
from tests.conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_anywhere(spark):
    loads = ("q_end_to_end_load", "q_reloaded_tables", "q_file_fed_load")  # plans that only read back what they have written
    for name, fn in Q.__dict__.items():
        if name.startswith("q_") and name not in (*loads, "q_text_scan_nulls", "q_feed_arrays"):
            p = plan_of(fn(spark, SF_SMALL))
            assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p, name


def test_kpi_reads_only_needed_columns(spark):
    df = Q.q_kpi_by_year(spark, SF_SMALL)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in p or "FileScan" in p
    # the staged sales snapshot has 38 columns; the KPI needs only a handful
    scan = [line for line in p.splitlines() if "ReadSchema" in line]
    assert scan and all(line.count(":") < 30 for line in scan)


def test_dedup_aggregates_before_the_shuffle(spark):
    df = Q.q_dedup_keep_last(spark, SF_SMALL)
    phys = plan_of(df)
    # WindowGroupLimit runs on each map task before the exchange, then again after it
    assert phys.count("WindowGroupLimit") >= 2


def test_view_joins_without_sort_merge_for_small_dims(spark):
    df = Q.q_sales_weather(spark, SF_SMALL)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p
    assert p.count("fact_marketing_sales") <= 2 and "hashpartitioning(order_id" not in p  # the published fact, read as it is
