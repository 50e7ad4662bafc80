"""What a load leaves on the disks: no shuffle files of plans that have ended, no snapshots that nothing reads any more."""

import os
import tempfile

from pyspark.sql import functions as F

from storeloom import session
from storeloom.contracts import SALES_RAW_COLUMNS
from storeloom.plans import deliveries as P
from storeloom.plans import load as L
from storeloom.plans import queries as Q
from storeloom.plans import warehouse as W
from storeloom.session import _CLEANUP
from storeloom.sources.staging import land


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _sales(spark, ids, revenue="10"):
    own = {"Date": "2024-01-05", "Region": "Miền Nam", "Branch": "B", "Product": "P", "Category": "Snack", "Stage": "Click", "Channel": "TV",
           "Department": "D", "Information": "I", "Machine": "M", "CustomerSegment": "S", "PromotionCampaign": "Flash Sale", "Quantity": "1", "Revenue": revenue}
    rows = spark.createDataFrame([(str(i), k) for k, i in enumerate(ids)], "OrderID string, _ordinal long")
    return rows.select("OrderID", *[F.lit(own.get(c)).cast("string").alias(c) for c in SALES_RAW_COLUMNS if c != "OrderID"], "_ordinal")


def test_a_landed_plan_leaves_no_shuffle_files(spark):
    frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(5, "count")
    setting = spark.conf.get(_CLEANUP)
    path = f"{tempfile.mkdtemp()}/rows"
    assert land(frame, path).count() == 7
    fresh = _shuffle_files(spark)
    land(frame, f"{tempfile.mkdtemp()}/rows")
    assert _shuffle_files(spark) <= fresh and spark.conf.get(_CLEANUP) == setting
    assert all(f.endswith(".zstd.parquet") for f in os.listdir(path) if f.startswith("part-"))
    assert sorted(r["count"] for r in frame.collect()) == [142] + [143] * 6  # the caller's own frame is as it was


def _folders(monkeypatch):
    """The passing folders that are made from here on."""
    made, own = [], session.scratch_folder

    def maker(spark, name):
        made.append(own(spark, name))
        return made[-1]
    monkeypatch.setattr(session, "scratch_folder", maker)
    return made


def test_a_load_leaves_its_warehouse_only(spark, monkeypatch):
    made = _folders(monkeypatch)
    root = tempfile.mkdtemp()
    wh = L.run_load(spark, root, _sales(spark, [1, 2, 2, 3]))
    assert wh.read("fact_marketing_sales").count() == 3
    P.load_delivery(spark, root, {"sales": _sales(spark, [3, 4], "20")})
    assert {r["order_id"]: int(r["revenue"]) for r in wh.read("fact_marketing_sales").collect()} == {1: 10, 2: 10, 3: 20, 4: 20}
    blocked, counts = L.gate_and_load(spark, tempfile.mkdtemp(), _sales(spark, [5, 6]), auto_filter=False)  # they lack a cost
    assert blocked is None and (counts["upload_rows"], counts["rejected_rows"]) == (2, 2)
    names = {os.path.basename(d).rsplit("-", 1)[0] for d in made}
    assert names == {"clean", "merged-fact_marketing_sales", "flagged-upload"} and not any(map(os.path.exists, made))


def _plans(monkeypatch, module, name, place):
    """The optimized plans of the frames that are handed to a writer from here on, each as it is written."""
    seen, own = [], getattr(module, name)

    def writer(*args, **options):
        seen.append((args, args[place]._jdf.queryExecution().optimizedPlan().toString()))
        return own(*args, **options)
    monkeypatch.setattr(module, name, writer)
    return seen


def test_rows_are_dealt_to_months_after_the_join_with_the_target_has_ended(spark, monkeypatch):
    wh = L.run_load(spark, tempfile.mkdtemp(), _sales(spark, [1, 2]))
    seen = _plans(monkeypatch, W, "land", 0)
    L.run_load(spark, wh.root, _sales(spark, [2, 3], "20"))
    assert len(seen) == 1 and "/merged-fact_marketing_sales-" in seen[0][0][1] and "Join" in seen[0][1]  # what is published is read from there
    assert {r["order_id"]: int(r["revenue"]) for r in wh.read("fact_marketing_sales").collect()} == {1: 10, 2: 20, 3: 20}


def test_the_sales_files_are_sorted_after_their_joins_have_ended(spark, monkeypatch):
    from storeloom.sources import text
    sf = tempfile.mkdtemp()
    tables = {
        "lineitem": "SELECT id AS l_orderkey, 7L AS l_partkey, 3L AS l_suppkey, 1 AS l_linenumber, 2.0D AS l_quantity, 5.0D AS l_extendedprice, 0.1D AS l_discount, "
                    "0.1D AS l_tax, 'A' AS l_returnflag, 'F' AS l_linestatus, to_timestamp_ntz('1996-01-0' || (9 - id)) AS l_shipdate FROM range(1, 6)",
        "orders": "SELECT id AS o_orderkey, 4L AS o_custkey, 'O' AS o_orderstatus, 9.0D AS o_totalprice, to_timestamp_ntz('1996-01-01') AS o_orderdate, '5-LOW' AS o_orderpriority FROM range(1, 6)",
        "customer": "SELECT 4L AS c_custkey, 'c' AS c_name, 1 AS c_nationkey, 1.0D AS c_acctbal, 'BUILDING' AS c_mktsegment",
        "part": "SELECT 7L AS p_partkey, 'bolt' AS p_name, 'b' AS p_brand, 't' AS p_type, 1 AS p_size, 3.0D AS p_retailprice",
        "supplier": "SELECT 3L AS s_suppkey, 's' AS s_name, 1 AS s_nationkey, 8.0D AS s_acctbal",
        "nation": "SELECT 1 AS n_nationkey, 'N' AS n_name, 2 AS n_regionkey"}
    for name, sql in tables.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{sf}/{name}.parquet")
    seen, made = _plans(monkeypatch, text, "write_text_table", 0), _folders(monkeypatch)
    path = Q.landed_sales_files(spark, sf)
    assert len(seen) == 1 and "Sort" in seen[0][1] and "Join" not in seen[0][1]
    got = text.read_text_table(spark, path, SALES_RAW_COLUMNS, ordinal="_at").orderBy("_at").drop("_at").collect()
    assert got == Q.sales_staged(spark, sf).orderBy("_ordinal").drop("_ordinal").collect() and len(got) == 5
    assert [d for d in made if "/sales-join-" in d] and not any(os.path.exists(d) for d in made if "/sales-join-" in d)
