"""The whole load: re-run property, gate split, optional feed."""

import uuid

from pyspark.sql import functions as F

from storeloom.operators import quality as V
from storeloom.plans import load as L
from storeloom.plans import queries as Q
from storeloom.session import ensure_checkpoint_dir
from tests.conftest import SF_SMALL


def _root(spark):
    return f"{ensure_checkpoint_dir(spark)}/test-wh-{uuid.uuid4().hex[:8]}"


def test_load_twice_equals_load_once(spark):
    sales = Q.sales_staged(spark, SF_SMALL)
    wh = L.run_load(spark, _root(spark), sales)
    first = wh.read("fact_marketing_sales").drop("created_at")
    n1, c1 = first.count(), first.select(F.sum("revenue")).first()[0]
    stamps = sorted(r[0] for r in wh.read("fact_marketing_sales").select("created_at").distinct().collect())
    wh2 = L.run_load(spark, wh.root, sales)
    again = wh2.read("fact_marketing_sales").drop("created_at")
    assert again.count() == n1 and again.select(F.sum("revenue")).first()[0] == c1
    created = lambda w: sorted(r[0] for r in w.read("fact_marketing_sales").select("created_at").distinct().collect())
    assert created(wh2) == stamps  # the first insert time stays


def test_missing_weather_feed_is_skipped(spark):
    wh = L.run_load(spark, _root(spark), Q.sales_staged(spark, SF_SMALL), Q.ads_staged(spark, SF_SMALL), None)
    assert not wh.exists("fact_weather_daily")
    assert wh.exists("fact_ad_spend") and wh.read("fact_ad_spend").count() > 0


def test_clean_plus_quarantine_is_input(spark):
    flagged = V.flag(Q.sales_staged(spark, SF_SMALL))
    clean, rejected = V.split(flagged)
    assert clean.count() + rejected.count() == flagged.count()


def test_gate_blocks_without_auto_filter(spark):
    to_load, _, rejected = L.gate(Q.sales_staged(spark, SF_SMALL), auto_filter=False)
    assert to_load is None and rejected.count() > 0


def _files(wh, table):
    """The files that hold the rows of each part."""
    rows = wh.spark.read.parquet(wh.path(table)).select("_part", F.input_file_name().alias("file")).distinct().collect()
    return {p: {r["file"] for r in rows if r["_part"] == p} for p in {r["_part"] for r in rows} - {"all"}}


def test_fact_publish_rewrites_only_touched_months(spark):
    from storeloom.plans import clean as C
    sales = Q.sales_staged(spark, SF_SMALL)
    wh = L.run_load(spark, _root(spark), sales)
    m1 = _files(wh, "fact_marketing_sales")
    # a second batch touching a single month
    clean = C.clean_sales(sales)
    one_month = sorted(m1)[0]
    part = clean.where(F.date_format("date", "'m'yyyy-MM") == one_month)
    L.load_sales(wh, part)
    m2 = _files(wh, "fact_marketing_sales")
    assert set(m2) == set(m1)
    changed = {m for m in m2 if m2[m] != m1[m]}
    assert changed == {one_month}
    kept = clean.where(F.size(L.violations_of(*L.SALES_LIMITS)) == 0)
    assert wh.read("fact_marketing_sales").count() == kept.count()


def test_sales_update_moving_a_row_to_another_month(spark):
    import datetime as dt
    from storeloom.plans.load import _merge_fact
    wh = L.Warehouse(spark, _root(spark))
    base = Q.FX.sales_fact(C_clean(spark)).limit(0)
    schema = base.schema
    row = {f.name: None for f in schema.fields}
    from decimal import Decimal
    row["revenue"] = Decimal("1.00")
    a = dict(row, order_id=1, full_date=dt.date(2024, 1, 5))
    b = dict(row, order_id=2, full_date=dt.date(2024, 2, 5))
    _publish_dates(spark, wh, a["full_date"], b["full_date"], dt.date(2024, 3, 1))
    _merge_fact(wh, "fact_marketing_sales", spark.createDataFrame([a, b], schema))
    moved = dict(row, order_id=1, full_date=dt.date(2024, 3, 1))
    _merge_fact(wh, "fact_marketing_sales", spark.createDataFrame([moved], schema))
    got = sorted((r.order_id, str(r.full_date)) for r in wh.read("fact_marketing_sales").collect())
    assert got == [(1, "2024-03-01"), (2, "2024-02-05")]
    parts = {r[0]: r[1] for r in spark.read.parquet(wh.path("fact_marketing_sales")).groupBy("_part").agg(F.count("order_id")).collect()}
    assert parts == {"all": 0, "m2024-01": 0, "m2024-02": 1, "m2024-03": 1}
    back = dict(row, order_id=1, full_date=dt.date(2024, 1, 5))
    _merge_fact(wh, "fact_marketing_sales", spark.createDataFrame([back], schema))
    assert sorted((r.order_id, str(r.full_date)) for r in wh.read("fact_marketing_sales").collect()) == [(1, "2024-01-05"), (2, "2024-02-05")]


def test_second_load_finds_months_without_the_facts_keys(spark):
    wh = L.run_load(spark, _root(spark), Q.sales_staged(spark, SF_SMALL))
    some = wh.read("fact_marketing_sales").agg(F.max("order_id")).first()[0]
    batch = Q.FX.sales_fact(C_clean(spark)).where(F.col("order_id") == some)
    known = L.Homes(wh, "fact_marketing_sales", "order_id").of(batch, L.month_of())
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "_homes" in plan and wh.path("fact_marketing_sales") not in plan  # the staged feed and the homes are read, no fact row
    assert "PartitionFilters: [" in plan and "_span" in plan.split("PartitionFilters: [", 1)[1]
    assert known.count() == batch.count()


def C_clean(spark):
    from storeloom.plans import clean as C
    return C.clean_sales(Q.sales_staged(spark, SF_SMALL))


def test_gate_and_load_quarantines_publishes_and_counts(spark):
    root = _root(spark)
    wh, counts = L.gate_and_load(spark, root, Q.sales_staged(spark, SF_SMALL), auto_filter=True, run_id="t1")
    flagged = V.flag(Q.sales_staged(spark, SF_SMALL))
    bad = flagged.where(F.size("failed_rules") > 0).count()
    assert counts["upload_rows"] == flagged.count()
    assert counts["rejected_rows"] == bad and counts["accepted_rows"] == flagged.count() - bad
    assert spark.read.parquet(f"{root}/quarantine/run=t1").count() == bad
    assert wh.read("upload_sales").count() == flagged.count() - bad
    # a second upload keeps a copy of the first (K9)
    L.gate_and_load(spark, root, Q.sales_staged(spark, SF_SMALL), auto_filter=True, run_id="t2")
    assert spark.read.parquet(f"{root}/backup/upload_sales/run=t2").count() == flagged.count() - bad
    assert wh.backup("nothing_yet", "t3") is None


def test_empty_batch_is_a_no_op(spark):
    from storeloom.operators.upsert import upsert_update
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    empty = spark.createDataFrame([], "k int, v string")
    assert sorted(rows_of(upsert_update(t, empty, ["k"], created_at=None))) == [(1, "a")]


def test_file_summary_and_status(spark):
    from storeloom.sources.text import file_status, read_text_table, summary, write_text_table
    root = _root(spark)
    raw = Q.sales_staged(spark, SF_SMALL).drop("_ordinal")
    write_text_table(raw, f"{root}/upload")
    s = summary(read_text_table(spark, f"{root}/upload")).first()
    assert s.rows == raw.count() and s.columns == 37 and s.header.startswith("OrderID,Date")
    st = file_status(spark, f"{root}/upload").first()
    assert st.rows == raw.count() and st.modified_at is not None and st.amount_m is not None


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_staging_contract_rejects_unknown_header_and_fills_missing(spark):
    import pytest
    from storeloom.sources.text import read_text_table, write_text_table
    root = _root(spark)
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    write_text_table(df, f"{root}/t")
    got = read_text_table(spark, f"{root}/t", contract=["a", "b", "c"]).collect()
    assert [tuple(r) for r in got] == [("1", "x", None)]
    with pytest.raises(ValueError):
        read_text_table(spark, f"{root}/t", contract=["a"])


def test_csv_dialect_round_trip(spark):
    from storeloom.sources.text import read_text_table, write_text_table
    path = f"{_root(spark)}/quoted"
    values = ['a "b", c', "line1\nline2", '"', "x,y", "  padded ", "back\\slash", "tail\\"]
    write_text_table(spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, v string").repartition(3, "id"), path)
    assert sorted(rows_of(read_text_table(spark, path))) == [(str(i), v) for i, v in enumerate(values)]


def _land_files(spark, **files):
    import os
    path = _root(spark)
    os.makedirs(path)
    for name, text in files.items():
        with open(f"{path}/{name}.csv", "w") as f:
            f.write(text)
    return path


def test_reordered_and_surplus_input_raises_and_short_rows_are_filled(spark):
    import pytest
    from storeloom.sources.text import read_text_table
    good = _land_files(spark, a="id,name\n1,x\n", b="id,name\n2,\"q\"\"q\"\n")
    assert sorted(rows_of(read_text_table(spark, good))) == [("1", "x"), ("2", 'q"q')]
    short = _land_files(spark, a="id,name\n1,x\n", b="id,name\n2\n")
    assert sorted(rows_of(read_text_table(spark, short)), key=str) == [("1", "x"), ("2", None)]
    for bad in ("name,id\ny,2\n", "id,name\n2,y,z\n"):
        path = _land_files(spark, a="id,name\n1,x\n", b=bad)
        with pytest.raises(Exception):
            read_text_table(spark, path).collect()


def test_changed_source_data_gives_changed_results(spark):
    from storeloom.sources.staging import source_state, staged
    path = f"{_root(spark)}/src"

    def feed():
        return staged(spark, "changing", lambda: spark.read.parquet(path), source_state(spark, path))
    spark.range(3).write.parquet(path)
    assert feed().count() == 3
    spark.range(5).write.mode("overwrite").parquet(path)
    assert feed().count() == 5


def test_weather_fact_has_no_insert_time(spark):
    wh = L.run_load(spark, _root(spark), Q.sales_staged(spark, SF_SMALL), None, Q.weather_staged(spark, SF_SMALL))
    assert wh.read("fact_weather_daily").columns == ["full_date", "region_name", "temp_mean", "temp_max", "rain_mm"]
    assert "created_at" in wh.read("fact_marketing_sales").columns


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    import pytest
    from storeloom import session

    class Conf:
        def get(self, *a):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def _bad_fact(spark, **change):
    """Two days of a valid sales fact, and a changed copy of its second row."""
    import datetime as dt
    from decimal import Decimal
    fields = Q.FX.sales_fact(C_clean(spark)).limit(0).schema
    row = {f.name: None for f in fields} | {"order_id": 1, "full_date": dt.date(2024, 1, 5), "revenue": Decimal("1.00")}
    return spark.createDataFrame([row, row | {"order_id": 2} | change], fields)


def test_publish_rejects_each_class_of_violation(spark):
    import datetime as dt
    import pytest
    wh = L.Warehouse(spark, _root(spark))
    _publish_dates(spark, wh, dt.date(2024, 1, 5))
    L._merge_fact(wh, "fact_marketing_sales", _bad_fact(spark))
    cases = {"not_null revenue": {"revenue": None}, "max_length_150 product_name": {"product_name": "x" * 151},
             "foreign_key stage_name": {"stage_name": "nowhere"}, "not_null order_id": {"order_id": None}}
    for text, change in cases.items():
        with pytest.raises(ValueError, match=text):
            L._merge_fact(wh, "fact_marketing_sales", _bad_fact(spark, **change))
    with pytest.raises(ValueError, match="primary_key order_id"):
        L._merge_fact(wh, "fact_marketing_sales", _bad_fact(spark, order_id=1))
    assert wh.read("fact_marketing_sales").count() == 2  # each rejected publish leaves the old rows readable


def _publish_dates(spark, wh, *days):
    """All dimensions, empty but for the dates (and the fixed stages)."""
    dates = L.D.dim_date(spark.createDataFrame([(d,) for d in days], "date date"))
    batches = L.dimension_batches(C_clean(spark).limit(0), None, None)
    for table in sorted(batches, key=lambda t: t in L.CHILDREN):
        L._publish_dimension(wh, table, [(dates, True)] if table == "dim_date" else batches[table])


def test_rows_beyond_the_contract_are_quarantined_with_reasons(spark):
    wh = L.run_load(spark, _root(spark), Q.sales_staged(spark, SF_SMALL))
    bad = spark.read.parquet(f"{wh.root}/constraints/sales/quarantine")
    reasons = {r[0] for r in bad.select(F.explode("violations")).distinct().collect()}
    assert {"product longer than 150", "revenue beyond decimal(18,2)"} <= reasons
    assert bad.count() + wh.read("fact_marketing_sales").count() == C_clean(spark).count()


def test_a_fact_publish_joins_whole_rows_with_the_target_alone(spark, monkeypatch):
    plans, publish = [], L.Warehouse.publish

    def noted(wh, table, df, *rest):
        plans.append((table, df._jdf.queryExecution().optimizedPlan().toString()))
        publish(wh, table, df, *rest)
    monkeypatch.setattr(L.Warehouse, "publish", noted)
    wh = L.run_load(spark, _root(spark), Q.sales_staged(spark, SF_SMALL))
    L.run_load(spark, wh.root, Q.second_feeds(spark, SF_SMALL)[0])
    first, second = [plan for table, plan in plans if table == "fact_marketing_sales"]
    assert "Window" not in first + second
    assert first.count("Join ") == 0 and second.count("Join ") == 1


def test_keys_are_rejected_before_anything_is_written(spark):
    import pytest
    wh = L.Warehouse(spark, _root(spark))
    row = _bad_fact(spark).first().asDict()
    _publish_dates(spark, wh, row["full_date"])
    schema = _bad_fact(spark).schema
    for change, why in (({}, "primary_key order_id"), ({"order_id": row["order_id"] + 1, "stage_name": "nowhere"}, "foreign_key stage_name")):
        with pytest.raises(ValueError, match=f"fact_marketing_sales rejected: {why}"):
            L._merge_fact(wh, "fact_marketing_sales", spark.createDataFrame([row, row | change], schema))
        assert not wh.exists("fact_marketing_sales") and not L.path_exists(spark, f"{wh.root}/_homes")
