"""Operators on tiny literal frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from storeloom.operators import constraints as N
from storeloom.operators import dims as D
from storeloom.operators import quality as V
from storeloom.operators.dedup import first_value_by_key, keep_first, keep_last
from storeloom.operators.filters import drop_reason_counts, with_drop_reason
from storeloom.operators.mapping import standardize_columns
from storeloom.operators.upsert import insert_if_absent, upsert_update
from storeloom.plans import clean as C
from storeloom.sources.feed import flatten
from storeloom.sources.ordinal import rows_before
from tests.conftest import rows


def test_keep_last_and_first(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3), (1, "d", 0)], "k int, v string, _ordinal int")
    assert sorted(rows(keep_last(df, ["k"]), "k", "v")) == [(1, "b"), (2, "c")]
    assert sorted(rows(keep_first(df, ["k"]), "k", "v")) == [(1, "d"), (2, "c")]


def test_keep_last_independent_of_partitioning(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), F.col("id").alias("_ordinal"),
                                  (F.col("id") * 3).alias("v"))
    a = sorted(rows(keep_last(df.repartition(3), ["k"])))
    b = sorted(rows(keep_last(df.repartition(11), ["k"])))
    assert a == b and len(a) == 7 and all(r[2] >= 1993 for r in a)


def test_first_value_keeps_null_first(spark):
    df = spark.createDataFrame([("b1", None, 1), ("b1", "R", 2), (None, "X", 0)], "branch string, region string, _ordinal int")
    assert rows(first_value_by_key(df, "branch", "region")) == [("b1", None)]


def test_drop_reason_first_failing_reason(spark):
    df = spark.createDataFrame([(None, None, "c", "s", 1.0), (1, None, None, "s", 1.0), (2, dt.date(2024, 1, 1), "c", None, None)],
                               "order_id int, date date, channel string, stage string, revenue double")
    got = sorted(rows(drop_reason_counts(with_drop_reason(df))))
    assert got == [("date missing/invalid", 1), ("order_id missing/invalid", 1), ("stage missing", 1)]


def test_upsert_update_overwrites_with_nulls_and_keeps_created_at(spark):
    t = spark.createDataFrame([(1, "a", dt.datetime(2020, 1, 1)), (2, "b", dt.datetime(2020, 1, 1))],
                              "k int, v string, created_at timestamp")
    b = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    out = {r.k: r for r in upsert_update(t, b, ["k"]).collect()}
    assert out[1].v == "a" and out[2].v is None and out[3].v == "c"
    assert out[2].created_at == dt.datetime(2020, 1, 1) and out[3].created_at != dt.datetime(2020, 1, 1)


def test_insert_if_absent_existing_wins(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    b = spark.createDataFrame([(1, "z"), (2, "b")], "k int, v string")
    assert sorted(rows(insert_if_absent(t, b, ["k"], created_at=None))) == [(1, "a"), (2, "b")]


def test_upsert_twice_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "x"), (3, "y")], "k int, v string")
    once = upsert_update(t, b, ["k"], created_at=None)
    twice = upsert_update(once, b, ["k"], created_at=None)
    assert sorted(rows(once)) == sorted(rows(twice))


def test_dim_stage_appends_unknown(spark):
    df = spark.createDataFrame([("Click",), ("Returned",), (None,)], "stage string")
    got = sorted(rows(D.dim_stage(df)))
    assert ("Returned", 99, "Other") in got and len(got) == 6


def test_ads_sum_of_all_missing_is_zero(spark):
    raw = spark.createDataFrame([("01/02/2024", "tet_promotion", "1.50", None, "2", "1"),
                                 ("01/02/2024", "TET_PROMOTION ", "2.25", None, "3", None),
                                 ("01/02/2024", "nope", "9", "1", "1", "1")],
                                "date string, campaign string, spend string, impressions string, clicks string, conversions string")
    out = C.clean_ads(raw).collect()
    assert len(out) == 1
    r = out[0]
    assert r.spend == Decimal("3.75") and r.impressions == 0 and r.clicks == 5 and r.conversions == 1


def test_standardize_requires_and_fills(spark):
    df = spark.createDataFrame([("1", "2024-01-01", "TV", "Click", "10")], "OrderID string, NGAY string, Kenh string, Stage string, Doanh_Thu string")
    out = standardize_columns(df)
    assert out.columns[:5] == ["order_id", "date", "channel", "stage", "revenue"] and len(out.columns) == 37
    with pytest.raises(ValueError):
        standardize_columns(df.drop("Stage"))


def test_duplicate_count_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(str(x) if x is not None else None,) for x in [1, None, None, 1]], "OrderID string")
    full = df
    for c in ["Date", "Region", "Product", "Category", "Quantity", "Revenue", "Cost", "Profit"]:
        full = full.withColumn(c, F.lit(None).cast("string"))
    rep = {r.rule: r.n_rows for r in V.report(V.flag(full)).collect()}
    assert rep["duplicate_order_id"] == 2


def test_gate_rules_each_fire(spark):
    cols = ["OrderID", "Date", "Region", "Product", "Category", "Quantity", "Revenue", "Cost", "Profit", "CustomerSegment"]
    good = ["1", "2024-01-05", "Miền Bắc", "p", "Bia", "2", "10", "5", "5", "Bán lẻ"]
    cases = {
        "date_format": {"Date": "05/01/2024"},
        "revenue_not_numeric": {"Revenue": "abc"},
        "revenue_non_positive": {"Revenue": "0"},
        "quantity_non_positive": {"Quantity": "-1"},
        "category_invalid": {"Category": "Toys"},
        "region_invalid": {"Region": "North"},
        "null_Product": {"Product": None},
    }
    data = [tuple(good)]
    for change in cases.values():
        row = dict(zip(cols, good))
        row.update(change)
        data.append(tuple(row[c] for c in cols))
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))
    flagged = {tuple(r.failed_rules) for r in V.flag(df).collect()}
    assert flagged == {()} | {(k,) for k in cases}
    with pytest.raises(V.HardError):
        V.flag(df.drop("Cost"))


def test_positions_are_right_in_a_wide_frame_over_many_partitions(spark):
    order = F.col("id") * 7919 % 5000
    df = spark.range(0, 5000, 1, 8).select(F.struct((order / 100).cast("int").alias("a"), (order % 100).alias("b")).alias("_ordinal"),
                                           F.repeat(F.lit("x"), 50).alias("wide"), order.alias("place"))
    wanted = df.where("place % 97 = 5 or place in (0, 1, 4999)")
    at = {tuple(r[0]): r[1] for r in rows(rows_before(df, wanted.select("_ordinal"), "_ordinal"))}
    assert len(at) == wanted.count() and all(n == a * 100 + b for (a, b), n in at.items())
    assert rows(rows_before(df, df.where("false").select("_ordinal"), "_ordinal")) == []


def test_samples_need_no_range_exchange(spark):
    cols = ["OrderID", "Date", "Region", "Product", "Category", "Quantity", "Revenue", "Cost", "Profit"]
    df = spark.range(2000).repartition(8).selectExpr("id AS _ordinal", *[f"CASE WHEN id % 1999 = 1777 THEN NULL ELSE '5' END AS {c}" for c in cols])
    samples = V.samples(V.flag(df))
    got = {(r.rule, r.sheet_row) for r in samples.where("rule like 'null%'").collect()}
    assert got == {(f"null_{c}", 1779) for c in cols}
    assert "rangepartitioning" not in samples._jdf.queryExecution().toString()


def test_empty_upload_has_a_report(spark):
    cols = ["OrderID", "Date", "Region", "Product", "Category", "Quantity", "Revenue", "Cost", "Profit"]
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in cols))
    got = {r.rule: (r.n_rows, r.pct) for r in V.report(V.flag(empty)).collect()}
    assert got["total_rows"] == (0, None) and got["clean_rows"] == (0, None)


def test_flatten_stops_at_shortest_array(spark):
    docs = spark.createDataFrame(
        [("r", (["2024-01-01", "2024-01-02", "2024-01-03"], [1.0, 2.0], [3.0, 4.0, 5.0], [0.0, 0.1, 0.2]))],
        "region string, daily struct<time: array<string>, temperature_2m_mean: array<double>, "
        "temperature_2m_max: array<double>, precipitation_sum: array<double>>")
    out = rows(flatten(docs))
    assert out == [("2024-01-01", 1.0, 3.0, 0.0, "r"), ("2024-01-02", 2.0, 4.0, 0.1, "r")]


def test_fk_and_key_checks(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None), (3, "a")], "id int, dim string")
    dim = spark.createDataFrame([("a",)], "name string")
    assert rows(N.fk_violations(fact, "dim", dim, "name"), "id") == [(2,)]
    assert rows(N.key_check(fact, "t", ["id"]), "violations") == [(1,)]


def test_blank_weather_region_is_kept_and_reported(spark):
    from storeloom.plans import clean as C
    raw = spark.createDataFrame([("2024-01-01", "  ", "20", "25", "1.5", 1), ("2024-01-01", "North", "20", "25", "0", 2)],
                                "date string, region string, temp_mean string, temp_max string, rain_mm string, _ordinal int")
    cleaned = C.clean_weather(raw)
    assert sorted(r.region for r in cleaned.collect()) == ["", "North"]
    assert rows(N.blank_keys(cleaned, "fact_weather_daily", ["region"]), "violations") == [(1,)]


def test_gate_rules_are_generated_code(spark):
    cols = ["OrderID", "Date", "Region", "Product", "Category", "Quantity", "Revenue", "Cost", "Profit"]
    own = spark.createDataFrame([("1", "2024-02-30", V.VALID_REGIONS[0], "p", None, "0", "x", "1", "1"),
                                 ("2", "2024-2-9", V.VALID_REGIONS[0], "p", V.VALID_CATEGORIES[0], "1", "5", "9", "1")], ", ".join(f"{c} string" for c in cols))
    flagged = V.flag(own)
    assert rows(flagged, "failed_rules", "warnings") == [
        (["date_format", "null_Category", "revenue_not_numeric", "quantity_non_positive"], []), ([], ["revenue_below_cost"])]
    assert not flagged.schema["failed_rules"].dataType.containsNull
    plan = flagged._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan  # a lambda is interpreted, with the whole expression below it


def test_dates_are_cast_not_formatted(spark):
    from storeloom.functions import is_strict_iso_date, parse_date
    texts = ["2024-02-29", "2024-2-30", "29/2/2024", "2.29-2024", "31.04.2024", "2024-1-5 10:00", "2024-1-5T1:22:33.5", "20240229", "0004-02-29", "2024-1-5\n", "1-1-2024x", None]
    own = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").repartition(1).sortWithinPartitions("k")
    got = own.select(parse_date("t").alias("d"), is_strict_iso_date("t").alias("strict"))
    leap, fifth = dt.date(2024, 2, 29), dt.date(2024, 1, 5)
    assert rows(got) == [(leap, True), (None, False), (leap, False), (leap, False), (None, False), (fifth, False), (fifth, False), (leap, False),
                         (dt.date(4, 2, 29), True), (fifth, False), (None, False), (None, False)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp") <= 2  # the compact form alone (its two mentions at most)
