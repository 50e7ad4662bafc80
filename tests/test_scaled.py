"""Steps that must not grow with what a plan doesn't need: landed lines, parses of a record, staged columns."""

import gzip
import os
import tempfile

from storeloom.functions import strip, to_number
from storeloom.plans import queries as Q
from storeloom.session import ensure_checkpoint_dir
from storeloom.sources import staging as G
from storeloom.sources.text import file_status, read_text_table, summary
from tests.conftest import SF_SMALL


def _size(root):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(root) for f in names)


def test_plain_lines_are_not_landed(spark):
    path = tempfile.mkdtemp()
    with open(f"{path}/a.csv", "w") as f:
        f.write("Date,Revenue\n" + "".join(f'{os.urandom(40).hex()},"{i}.5"\r\n' for i in range(20000)))
    root = ensure_checkpoint_dir(spark)
    before = _size(root)
    assert summary(read_text_table(spark, path)).first()["rows"] == 20000
    assert _size(root) - before < _size(path) / 20


def test_compressed_files_and_line_ends_in_values(spark):
    path = tempfile.mkdtemp()
    with gzip.open(f"{path}/a.csv.gz", "wt") as f:
        f.write('Date,Revenue\n1,"2\n3"\n4,5\n')
    with open(f"{path}/b.csv", "w") as f:
        f.write('\n\nDate,Revenue\n"x ""y""",\n')
    got = {(r["Date"], r["Revenue"]) for r in read_text_table(spark, path).collect()}
    assert got == {("1", "2\n3"), ("4", "5"), ('x "y"', None)}


def test_a_record_is_parsed_once(spark):
    path = tempfile.mkdtemp()
    with open(f"{path}/a.csv", "w") as f:
        f.write("Date,Revenue\n1,2.5\n2,\n")
    df = file_status(spark, path).select("rows", "amount_m")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") + plan.count("CsvToStructs(") == 1
    assert df.first()["rows"] == 2


def test_a_narrow_feed_has_all_rows_and_lands_its_columns_only(spark):
    G._LANDED.clear()
    narrow = Q.sales_staged(spark, SF_SMALL, "OrderID", "Revenue")
    landed = [p for key, p in G._LANDED.items() if key[1] == "sales"]
    assert len(landed) == 1 and spark.read.parquet(landed[0]).columns == ["OrderID", "Revenue"]
    whole = Q.sales_staged(spark, SF_SMALL)
    assert narrow.exceptAll(whole.select("OrderID", "Revenue")).count() == 0 and narrow.count() == whole.count()


def test_strip_and_numbers_as_before(spark):
    texts = ["", " ", "a", "~", "\x7f", " a", "a\u3000", "\u2003é", "é", "a b", "\ta\n", "😀 ", " 1.5", "1e5", "5d", "0x1p3", "NaN", "inf", "1\n", "1 2", "-", "+.5", "1e400", None]
    space = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip("t").alias("s"), to_number("t").alias("n")).collect()
    assert [r["s"] for r in rows] == [None if t is None else t.strip(space) for t in texts]
    assert {r["t"]: r["n"] for r in rows if r["n"] is not None} == {" 1.5": 1.5, "1e5": 1e5, "1\n": 1.0, "+.5": 0.5}


def test_landed_sales_files_hold_the_feed_in_order(spark):
    from storeloom.contracts import SALES_RAW_COLUMNS
    path = Q.landed_sales_files(spark, SF_SMALL)
    got = read_text_table(spark, path, SALES_RAW_COLUMNS, ordinal="_at").orderBy("_at").drop("_at").collect()
    want = Q.sales_staged(spark, SF_SMALL).orderBy("_ordinal").drop("_ordinal").collect()
    assert got == want and all(f.endswith(".gz") for f in os.listdir(path) if f.startswith("part-"))


def _widest_window(df):
    """Most columns that a window of the plan has as its input."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return max(plan.apply(i).output().size() for i in range(500) if plan.apply(i) is not None and plan.apply(i).nodeName() == "Window")


def test_tests_of_the_fact_go_through_the_dedup_as_places_of_failed_ones(spark):
    from storeloom.contracts import SALES_FACT_DECIMALS
    from storeloom.operators import constraints as K
    from storeloom.plans import clean as C
    tests = K.row_tests(["order_id", "revenue"], K.length_limits("fact_marketing_sales"), K.overflow_of({d: f"src_{d}" for d in SALES_FACT_DECIMALS}, SALES_FACT_DECIMALS))
    rows, last = Q.tested_sales(spark, SF_SMALL, tests)
    assert rows.columns == ["order_id", "_ordinal", "drop_reason", "failed"] and last.columns == ["order_id", "failed"]
    assert _widest_window(C.last_usable(rows)) < 8
    clean = Q.clean_sales(spark, SF_SMALL)
    assert last.count() == clean.count() and rows.count() == Q.sales_staged(spark, SF_SMALL).count()
    fact = Q.FX.sales_fact(clean, tuple(clean[s].alias(f"src_{d}") for s, d in Q.S_FACT_SOURCES if d in SALES_FACT_DECIMALS))
    want = K._counted(fact, "fact_marketing_sales", tests).collect()
    assert K.failed_checks(last, "fact_marketing_sales", tests, "failed").collect() == want and sum(r["violations"] for r in want) > 0


def test_values_beyond_a_decimal_as_the_cast_says(spark):
    from pyspark.sql import functions as F
    from storeloom.operators.constraints import beyond
    values = [None, 0.0, 499.0, 500.0, -500.0, 999.994, 999.995, 999.996, -999.996, 1000.0, 1e300, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    plain = F.col("v").isNotNull() & F.col("v").try_cast("decimal(5,2)").isNull()
    got = df.select("v", beyond("v", "decimal(5,2)").alias("got"), plain.alias("want")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got] and sum(r["want"] for r in got) >= 5


def test_names_shrink_to_combinations_before_they_are_exploded(spark):
    from storeloom.operators.dims import names_by_dimension
    df = spark.createDataFrame([("x", "a"), ("x", "a"), (None, "a"), ("y", None), (None, None)], "p string, q string")
    names = names_by_dimension(df, {"one": "p", "two": "q", "three": "p"})
    assert sorted(map(tuple, names.collect())) == [("one", "x"), ("one", "y"), ("three", "x"), ("three", "y"), ("two", "a")]
    plan = names._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [p#" in plan.split("Generate", 1)[1]
    G._LANDED.clear()
    Q.q_dim_distinct(spark, SF_SMALL)
    landed = [p for key, p in G._LANDED.items() if key[1] == "sales"]
    assert len(landed) == 1 and len(spark.read.parquet(landed[0]).columns) == 11


def test_scans_of_staged_rows_are_many_small_tasks(spark):
    from storeloom.session import SCAN_BYTES, _bytes, tune
    assert [_bytes(x) for x in ("16m", "134217728b", "134217728", "1g", "64MB")] == [16 << 20, 128 << 20, 128 << 20, 1 << 30, 64 << 20]
    own = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size, want in (("128m", SCAN_BYTES), ("4m", 4 << 20)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert _bytes(tune(spark).conf.get("spark.sql.files.maxPartitionBytes")) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", own)
