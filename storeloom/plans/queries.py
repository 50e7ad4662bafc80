"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the given tables."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom import functions as X
from storeloom.contracts import REQUIRED_COLS, SALES_FACT_DECIMALS, SALES_RAW_COLUMNS
from storeloom.operators import dims as D
from storeloom.operators import facts as FX
from storeloom.operators.dedup import keep_first
from storeloom.operators.filters import drop_reason_counts
from storeloom.operators.mapping import canonical_names, standardize_columns
from storeloom.plans import clean as C
from storeloom.plans import marts as M
from storeloom.sources import standins as S
from storeloom.sources.staging import land, source_state, staged


def _staged(df: DataFrame, keep=("_ordinal",)) -> DataFrame:
    """The reader's missing-value tokens become NULL in every text column."""
    return df.select(*[X.reader_nulls(c).alias(c) if c not in keep else F.col(c) for c in df.columns])


def _version(spark, sf, exprs, *tables):
    """Identity of a staged feed: the state of its source files, feed definition and staging rules."""
    from storeloom.contracts import NA_TOKENS
    return [*(source_state(spark, f"{sf}/{t}.parquet") for t in tables), repr(exprs), repr(NA_TOKENS)]


def sales_staged(spark, sf, *columns):
    """The sales feed as landed in staging (S1 tokens already NULL); only ``columns`` where they are given."""
    return staged(spark, "sales", lambda: _staged(S.sales_raw(spark, sf)),
                  *_version(spark, sf, S.sales_raw_exprs(S.SPARK), "lineitem", "orders", "customer", "part", "supplier", "nation"), columns=columns)


def ads_staged(spark, sf):
    return staged(spark, "ads", lambda: _staged(S.ads_raw(spark, sf)),
                  *_version(spark, sf, S.ads_raw_exprs(S.SPARK), "events"))


def weather_staged(spark, sf):
    return staged(spark, "weather", lambda: _staged(S.weather_raw(spark, sf)),
                  *_version(spark, sf, S.weather_raw_exprs(S.SPARK), "orders", "customer", "nation"))


def clean_sales(spark, sf, *columns):
    """The cleaned sales feed; with ``columns``, these optional ones and the required ones alone are staged and typed."""
    if not columns:
        return C.clean_sales(sales_staged(spark, sf))
    headers = dict(zip(canonical_names(SALES_RAW_COLUMNS), SALES_RAW_COLUMNS, strict=True))
    wanted = [c for c in headers if c in REQUIRED_COLS or c in columns]
    return C.clean_sales(sales_staged(spark, sf, *[headers[c] for c in wanted], "_ordinal"), columns=columns)


def tested_sales(spark, sf, tests):
    """(rows of the feed with the tests of the sales fact that each fails, those of its last usable rows).

    The tests judge a row alone, so they run before the dedup, and its shuffle
    carries the places of failed tests in place of the tested columns. Both are landed.
    """
    from storeloom.operators.constraints import failed_tests
    from storeloom.session import scratch_folder
    typed = C.with_year_and_month(C.typed_sales(sales_staged(spark, sf)))
    sources = [F.col(s_).alias(f"src_{d}") for s_, d in S_FACT_SOURCES if d in SALES_FACT_DECIMALS]
    fact = FX.sales_fact(typed, (F.col("_ordinal"), F.col("drop_reason"), *sources))
    root = scratch_folder(spark, "tested-sales")
    rows = land(fact.select("order_id", "_ordinal", "drop_reason", failed_tests(tests).alias("failed")), f"{root}/rows")
    return rows, land(C.last_usable(rows).select("order_id", "failed"), f"{root}/last")


def sales_fact(spark, sf):
    return FX.sales_fact(clean_sales(spark, sf))


def ads_fact(spark, sf):
    return FX.ads_fact(C.clean_ads(ads_staged(spark, sf)))


def weather_fact(spark, sf):
    return FX.weather_fact(C.clean_weather(weather_staged(spark, sf)))


# ---------------------------------------------------------------------------

def q_kpi_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return M.kpi_by_year(sales_fact(spark, sf))


def q_kpi_total(spark, sf):
    return M.kpi_total(sales_fact(spark, sf))


MESSY_HEADERS = {
    "OrderID": " Order_ID ", "Date": "NGAY", "Channel": "KENH", "Stage": "Funnel Stage",
    "Revenue": "Doanh_Thu", "Product": "San-Pham", "Quantity": "so luong",
    "ROI_Marketing": "roi marketing", "PromotionCampaign": "Campaign", "Region": "Vùng",
}
DROPPED_HEADERS = ["MarketShare", "RegionProfitShare"]


def messy_sales(spark, sf):
    """The sales feed with renamed, dropped and extra headers."""
    raw = sales_staged(spark, sf).drop("_ordinal", *DROPPED_HEADERS)
    renamed = raw.select(*[F.col(f"`{c}`").alias(MESSY_HEADERS.get(c, c)) for c in raw.columns])
    return renamed.withColumn("Ghi chú", F.lit("x"))


def q_standardize_headers(spark, sf):
    return standardize_columns(messy_sales(spark, sf))


def q_clean_numeric(spark, sf):
    raw = sales_staged(spark, sf, "OrderID", "Revenue")
    return raw.select(
        F.col("OrderID").alias("order_id_text"), F.col("Revenue").alias("revenue_text"),
        X.to_id("OrderID").alias("order_id"), X.to_number("Revenue").alias("revenue"),
        X.to_number("Revenue").isNotNull().alias("revenue_valid"),
        X.to_decimal("Revenue", 18, 2).alias("revenue_dec"))


def q_parse_dates(spark, sf):
    raw = sales_staged(spark, sf)
    d = X.parse_date("Date")
    return raw.select(F.col("Date").alias("date_text"), d.alias("date"),
                      F.year(d).alias("year"), F.month(d).alias("month"))


def q_strict_dates(spark, sf):
    raw = sales_staged(spark, sf)
    return raw.select(F.col("Date").alias("date_text"), X.is_strict_iso_date("Date").alias("is_strict"))


def q_drop_reasons(spark, sf):
    return drop_reason_counts(C.typed_sales(sales_staged(spark, sf)))


def q_clean_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    raw_lang = F.expr("CASE doc_id % 7 WHEN 0 THEN concat(' ', chr(9), lang, chr(160)) "
                      "WHEN 1 THEN 'nan' WHEN 2 THEN ' None ' WHEN 3 THEN concat(chr(10), ' ') ELSE lang END")
    raw_source = F.expr("CASE WHEN doc_id % 3 = 0 THEN concat(chr(160), upper(source), '  ') ELSE source END")
    t = docs.select("doc_id", "text", raw_lang.alias("lang_raw"), raw_source.alias("source_raw"))
    return t.select("doc_id", "lang_raw", X.clean_text("lang_raw").alias("lang"),
                    X.strip("source_raw").alias("source"),
                    X.normalize_key("source_raw").alias("source_key"),
                    F.md5(X.clean_text("text").cast("binary")).alias("text_md5"),
                    F.length(X.strip("lang_raw")).alias("lang_len"))


def q_dedup_keep_last(spark, sf):
    return clean_sales(spark, sf).select("order_id", "date", "channel", "stage", "revenue", "year", "month")


def q_dedup_keep_first(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet").select("p_name", "p_type", "p_brand", "p_partkey")
    return keep_first(part, ["p_name"], "p_partkey")


def q_dim_date(spark, sf):
    s = clean_sales(spark, sf).select("date")
    a = C.clean_ads(ads_staged(spark, sf)).select("date")
    w = C.clean_weather(weather_staged(spark, sf)).select("date")
    return D.dim_date(s, a, w)


def q_dim_distinct(spark, sf):
    names = {t: col for t, (col, _) in D.NAME_DIMS.items()}
    return D.names_by_dimension(clean_sales(spark, sf, *names.values()), names)


def q_dim_stage(spark, sf):
    return D.dim_stage(clean_sales(spark, sf))


def q_lookup_default(spark, sf):
    names = D.names_by_dimension(clean_sales(spark, sf, "campaign"), {"channel": "channel", "campaign": "campaign"})
    return names.select("dimension", "name",
                        F.when(F.col("dimension") == "channel", X.channel_type("name"))
                        .otherwise(X.campaign_type("name")).alias("type"))


def q_lookup_drop(spark, sf):
    raw = ads_staged(spark, sf)
    mapped = raw.select(F.col("_ordinal").alias("event_id"), F.col("campaign").alias("slug"),
                        X.campaign_from_slug("campaign").alias("campaign"))
    return mapped.where(F.col("campaign").isNotNull())


def q_dropna_subset(spark, sf):
    return C.typed_ads(ads_staged(spark, sf)).select(
        F.col("_ordinal").alias("event_id"), "date", "campaign", "spend")


def q_ads_daily(spark, sf):
    d = C.clean_ads(ads_staged(spark, sf))
    return d.select("date", "campaign", *[F.col(c).cast("decimal(38,10)").alias(c)
                                          for c in ("spend", "impressions", "clicks", "conversions")])


def q_ads_ratios(spark, sf):
    return ads_fact(spark, sf)


def q_weather_daily(spark, sf):
    return weather_fact(spark, sf)


def q_sales_fact(spark, sf):
    return sales_fact(spark, sf)


_LOADED: dict = {}


def loaded(spark, sf):
    """The warehouse that one load of the three feeds gives; once for an application and state of the sources."""
    from storeloom.plans import load as L
    tables = ("lineitem", "orders", "customer", "part", "supplier", "nation", "events")
    key = (spark.sparkContext.applicationId, *(source_state(spark, f"{sf}/{t}.parquet") for t in tables))
    if key not in _LOADED:
        _LOADED[key] = L.run_load(spark, _scratch(spark, "warehouse"), sales_staged(spark, sf), ads_staged(spark, sf), weather_staged(spark, sf))
    return _LOADED[key]


def q_sales_weather(spark, sf):
    """J4 over the published fact, dimensions and weather."""
    wh = loaded(spark, sf)
    return M.sales_weather(wh.read("fact_marketing_sales").drop("created_at"), wh.read("dim_branch"), wh.read("dim_product"), wh.read("fact_weather_daily"))


def _rows_as_text(wh, tables):
    """(table_name, row) of all rows of the tables: their values in column order."""
    frames = [wh.read(t).drop("created_at") for t in tables]
    texts = [df.select(F.lit(t).alias("table_name"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns]).alias("row"))
             for t, df in zip(tables, frames, strict=True)]
    out = texts[0]
    for t in texts[1:]:
        out = out.unionByName(t)
    return out


def q_loaded_tables(spark, sf):
    """Every row of the 14 tables after one load."""
    from storeloom.plans import load as L
    return _rows_as_text(loaded(spark, sf), L.ALL_TABLES)


def second_feeds(spark, sf):
    """A later delivery that overlaps the first: a tenth of the orders with changed values, some ad days again."""
    sales = sales_staged(spark, sf).where(F.col("OrderID").endswith("1")).withColumns({
        "Revenue": F.lit("777.5"), "Region": F.lit("Miền Nam"), "Machine": F.lit("M-new"), "Stage": F.lit("Return"), "Category": F.lit("Snack")})
    ads = ads_staged(spark, sf).where("_ordinal % 10 = 0").withColumn("spend", F.lit("10"))
    return sales, ads


def q_reloaded_tables(spark, sf):
    """Every row of the 14 tables after a second, overlapping load (updates, first values that stay, new members)."""
    from storeloom.plans import load as L
    root = _scratch(spark, "warehouse")
    L.run_load(spark, root, sales_staged(spark, sf), ads_staged(spark, sf), weather_staged(spark, sf))
    return _rows_as_text(L.run_load(spark, root, *second_feeds(spark, sf)), L.ALL_TABLES)


def q_upload_backup(spark, sf):
    """K9: what the warehouse holds of the accepted upload after a second, smaller one: the new rows and the kept copy."""
    from storeloom.operators import quality as V
    from storeloom.plans import load as L
    wh = L.Warehouse(spark, _scratch(spark, "warehouse"))
    clean, _ = V.split(flagged_sales(spark, sf))
    L.accept_upload(wh, clean, "first")
    L.accept_upload(wh, clean.where(F.col("OrderID").endswith("1")), "second")
    cols = ["OrderID", "Date", "Revenue", "Category", "Region"]
    kept = spark.read.parquet(f"{wh.root}/backup/upload_sales").where("run = 'second'")
    return wh.read("upload_sales").select(F.lit("current").alias("copy"), *cols).unionByName(kept.select(F.lit("backup").alias("copy"), *cols))


# ---------------------------------------------------------------------------
# sources and sinks
# ---------------------------------------------------------------------------

def _scratch(spark, name):
    """A fresh folder under the shared checkpoint folder for a query's files."""
    from storeloom.session import scratch_folder
    return f"{scratch_folder(spark, name)}/files"


def token_rows(spark, sf):
    """customer rows with a note column cycling through NULL tokens and kept look-alikes."""
    from storeloom.contracts import NA_TOKENS
    tokens = list(NA_TOKENS) + ["na", "none", "-", " ", 'a "b", c', '"', "line 1\nline 2", " padded\t", ",", 'x""y', "back\\slash"]
    arms = " ".join("WHEN {} THEN {}".format(i, S._q(t).replace("\\", "\\\\")) for i, t in enumerate(tokens))
    note = f"CASE c_custkey % {len(tokens) + 1} {arms} ELSE c_mktsegment END"
    return (spark.read.parquet(f"{sf}/customer.parquet")
            .selectExpr("CAST(c_custkey AS STRING) AS id", "c_name AS name", f"{note} AS note"))


def q_text_scan_nulls(spark, sf):
    from storeloom.sources.text import read_text_table, write_text_table
    path = _scratch(spark, "customers-csv")
    write_text_table(token_rows(spark, sf).repartition(4, "id"), path)
    return read_text_table(spark, path, contract=["id", "name", "note", "extra"])


_FILES: dict = {}


def landed_sales_files(spark, sf):
    """The raw sales feed as compressed delimited files in feed order; once for an application and state of the sources."""
    from storeloom.session import passing_folder, tune
    from storeloom.sources.text import write_text_table
    key = (spark.sparkContext.applicationId, *(source_state(spark, f"{sf}/{t}.parquet") for t in ("lineitem", "orders", "customer", "part", "supplier", "nation")))
    if key not in _FILES:
        path = _scratch(spark, "sales-csv")
        tune(spark)
        with passing_folder(spark, "sales-join") as root:
            # landed, so that the joins run once (a sort looks at its input twice) and their shuffles are gone when the rows are sorted;
            # keys are sorted, not the feed's texts, which take several times their room
            land(S.read_of_join(S.sales_join(spark, sf)), f"{root}/rows")
            joined = spark.read.parquet(f"{root}/rows")  # dealt by the sort itself
            write_text_table(_staged(S.sales_raw_from(joined.orderBy(*S.SALES_ORDINAL))).drop("_ordinal"), path, compression="gzip")
        _FILES[key] = path
    return _FILES[key]


def q_file_summary(spark, sf):
    """S3: rows, columns and header of the landed sales files."""
    from storeloom.sources.text import read_text_table, summary
    return summary(read_text_table(spark, landed_sales_files(spark, sf)))


def q_file_status(spark, sf):
    """Rows and amount of the landed sales files (their modification time is not repeatable)."""
    from storeloom.sources.text import file_status
    return file_status(spark, landed_sales_files(spark, sf)).select("rows", "amount_m")


def q_file_fed_load(spark, sf):
    """A load from landed files, with the ads feed missing."""
    from storeloom.plans import load as L
    from storeloom.sources.text import write_text_table
    weather = _scratch(spark, "weather-csv")
    write_text_table(weather_staged(spark, sf).orderBy("_ordinal").drop("_ordinal"), weather)
    wh = L.load_files(spark, _scratch(spark, "warehouse"), landed_sales_files(spark, sf), f"{weather}-no-ads-here", weather)
    return L.table_counts(wh, [t for t in L.ALL_TABLES if t != "fact_ad_spend"])


def feed_documents(spark, sf):
    """One document per region x month: parallel arrays of daily order stats, sorted by day.

    Odd months lose the last precipitation value, so their arrays differ in length.
    """
    daily = (S.weather_join(spark, sf)
             .groupBy(F.expr(S.region_name("n_regionkey")).alias("region"),
                      F.to_date("o_orderdate").alias("day"))
             .agg(F.count(F.lit(1)).cast("double").alias("tm"),
                  F.max(F.col("o_custkey") % 40).cast("double").alias("tx"),
                  (F.sum(F.col("o_orderkey") % 100) / 4.0).alias("rain")))
    docs = (daily.groupBy("region", F.date_format("day", "yyyy-MM").alias("month"))
            .agg(F.sort_array(F.collect_list(F.struct("day", "tm", "tx", "rain"))).alias("days")))
    odd = (F.month(F.to_date(F.concat(F.col("month"), F.lit("-01")))) % 2) == 1
    rain = F.transform("days", lambda x: x["rain"])
    return docs.select("region", F.struct(
        F.transform("days", lambda x: F.date_format(x["day"], "yyyy-MM-dd")).alias("time"),
        F.transform("days", lambda x: x["tm"]).alias("temperature_2m_mean"),
        F.transform("days", lambda x: x["tx"]).alias("temperature_2m_max"),
        F.when(odd, F.slice(rain, 1, F.size(rain) - 1)).otherwise(rain).alias("precipitation_sum"),
    ).alias("daily"))


def q_feed_arrays(spark, sf):
    from storeloom.sources.feed import flatten, read_feed
    path = _scratch(spark, "weather-feed")
    feed_documents(spark, sf).write.mode("overwrite").partitionBy("region").json(path)
    return flatten(read_feed(spark, path))


# ---------------------------------------------------------------------------
# upserts
# ---------------------------------------------------------------------------

LOADED_AT = "2020-01-01 00:00:00"


def orders_target(spark, sf):
    """Orders loaded earlier: everything dated before 1999."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total"),
        F.to_date("o_orderdate").alias("order_date"),
        F.lit(LOADED_AT).cast("timestamp").alias("created_at"))


def orders_batch(spark, sf):
    """A re-delivered feed overlapping the last year: changed totals, some NULL statuses."""
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("order_key"),
        F.when(F.col("o_orderkey") % 13 != 0, F.lower("o_orderstatus")).alias("status"),
        (F.col("o_totalprice").cast("decimal(18,2)") + F.lit(1).cast("decimal(18,2)")).cast("decimal(18,2)").alias("total"),
        F.to_date("o_orderdate").alias("order_date"))


def _upsert_view(df):
    return df.select("order_key", "status", "total", "order_date",
                     (F.col("created_at") == F.lit(LOADED_AT).cast("timestamp")).alias("kept_created_at"))


def q_upsert_update(spark, sf):
    from storeloom.operators.upsert import upsert_update
    return _upsert_view(upsert_update(orders_target(spark, sf), orders_batch(spark, sf), ["order_key"]))


def q_upsert_ignore(spark, sf):
    from storeloom.operators.upsert import insert_if_absent
    return _upsert_view(insert_if_absent(orders_target(spark, sf), orders_batch(spark, sf), ["order_key"]))


def q_upsert_idempotent(spark, sf):
    from storeloom.operators.upsert import upsert_update
    batch = orders_batch(spark, sf)
    once = upsert_update(orders_target(spark, sf), batch, ["order_key"])
    return _upsert_view(upsert_update(once, batch, ["order_key"]))


# ---------------------------------------------------------------------------
# constraints
# ---------------------------------------------------------------------------

def q_fk_violations(spark, sf):
    """Line items whose part is missing from a part dimension that lacks the largest sizes."""
    from storeloom.operators.constraints import fk_violations
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey")
    dim = spark.read.parquet(f"{sf}/part.parquet").where(F.col("p_size") <= 45).select("p_partkey")
    return fk_violations(li, "l_partkey", dim, "p_partkey")


def q_constraint_report(spark, sf):
    """N-1, N-2, N-4, N-5 on the sales fact and K6 on the batch before dedup.

    Row checks are tested row by row on the fact's columns and counted over the
    last row of an order (the fact is a row-wise projection of the feed); key
    checks read only the key columns.
    """
    from storeloom.operators.constraints import failed_checks, key_check, length_limits, overflow_of, row_tests, union_all
    overflow = overflow_of({d: f"src_{d}" for d in SALES_FACT_DECIMALS}, SALES_FACT_DECIMALS)
    tests = row_tests(["order_id", "revenue"], length_limits("fact_marketing_sales"), overflow)
    rows, last = tested_sales(spark, sf, tests)
    return union_all([
        failed_checks(last, "fact_marketing_sales", tests, "failed"),
        key_check(last.select("order_id"), "fact_marketing_sales", ["order_id"]),
        key_check(rows.where(F.col("drop_reason").isNull()).select("order_id"), "sales_batch", ["order_id"], check="batch_unique_key"),
    ])


def injected(wh):
    """The published tables with rows that break each kind of constraint."""
    from storeloom.plans import load as L
    t = {name: wh.read(name) for name in L.ALL_TABLES}
    some = lambda n: F.coalesce(F.col("order_id") % 1000 == n, F.lit(False))
    sales = t["fact_marketing_sales"].withColumns({
        "revenue": F.when(~some(1), F.col("revenue")), "stage_name": F.when(some(2), F.lit("No such stage")).otherwise(F.col("stage_name")),
        "product_name": F.when(some(3), F.repeat(F.lit("x"), 151)).otherwise(F.col("product_name"))})
    t["fact_marketing_sales"] = sales.unionByName(sales.where(some(4)))
    t["dim_branch"] = t["dim_branch"].withColumn("region_name", F.when(F.col("branch_name").startswith("B"), F.lit("Nowhere")).otherwise(F.col("region_name")))
    t["dim_date"] = t["dim_date"].withColumn("month", F.when(F.col("year_month") != "1995-02", F.col("month")))
    t["dim_stage"] = t["dim_stage"].withColumn("stage_order", F.when(F.col("stage_name") != "Click", F.col("stage_order")))
    t["fact_ad_spend"] = t["fact_ad_spend"].withColumn("channel_name", F.when(F.dayofmonth("full_date") == 3, F.lit("Radio")).otherwise(F.col("channel_name")))
    t["fact_weather_daily"] = t["fact_weather_daily"].withColumn("region_name", F.when(F.dayofmonth("full_date") != 7, F.col("region_name")))
    return t


def q_warehouse_constraints(spark, sf):
    """N-1..N-5: the contract over all 14 published tables, with injected violations, and the feeds' decimals."""
    from storeloom.contracts import ADS_FACT_DECIMALS, WEATHER_FACT_DECIMALS
    from storeloom.operators.constraints import contract_report, failed_checks, overflow_check, overflow_of, row_tests, union_all
    tests = row_tests(overflow=overflow_of({d: f"src_{d}" for d in SALES_FACT_DECIMALS}, SALES_FACT_DECIMALS))
    feeds = [failed_checks(tested_sales(spark, sf, tests)[1], "fact_marketing_sales", tests, "failed"),
             overflow_check(C.clean_ads(ads_staged(spark, sf)), "fact_ad_spend", {c: c for c in ADS_FACT_DECIMALS}, ADS_FACT_DECIMALS),
             overflow_check(C.clean_weather(weather_staged(spark, sf)), "fact_weather_daily", {c: c for c in WEATHER_FACT_DECIMALS}, WEATHER_FACT_DECIMALS)]
    return union_all([contract_report(injected(loaded(spark, sf))), *feeds])


from storeloom.contracts import SALES_FACT_COLUMNS as S_FACT_SOURCES  # noqa: E402


# ---------------------------------------------------------------------------
# upload gate
# ---------------------------------------------------------------------------

def flagged_sales(spark, sf, *columns):
    from storeloom.operators import quality as V
    return V.flag(sales_staged(spark, sf, *columns))


def judged_sales(spark, sf):
    """The flagged feed with the columns that the gate's rules and reports read."""
    from storeloom.operators import quality as V
    return flagged_sales(spark, sf, *V.JUDGED_COLS, "_ordinal")


def q_quality_report(spark, sf):
    from storeloom.operators import quality as V
    return V.report(flagged_sales(spark, sf))


def q_quality_samples(spark, sf):
    from storeloom.operators import quality as V
    return V.samples(judged_sales(spark, sf))


def q_quality_split(spark, sf):
    from storeloom.operators import quality as V
    clean, rejected = V.split(judged_sales(spark, sf))
    cols = ["OrderID", "Date", "Revenue", "Category", "Region"]
    return (clean.select(*cols, F.lit("clean").alias("status"), F.lit("").alias("failed_rules"))
            .unionByName(rejected.select(*cols, F.lit("rejected").alias("status"),
                                         F.concat_ws(",", "failed_rules").alias("failed_rules"))))


def q_gate_decisions(spark, sf):
    """What the gate does with the upload as it is, with auto-filter, and without a required header."""
    from storeloom.operators import quality as V
    flagged = flagged_sales(spark, sf)
    try:
        V.check_columns(sales_staged(spark, sf).drop("Cost"))
        header = "loads"
    except V.HardError:
        header = "hard_error"
    return V.decision(flagged, False).unionByName(V.decision(flagged, True)).unionByName(
        spark.range(1).select(F.lit("no_cost_column").alias("upload"), F.lit(header).alias("outcome"), F.lit(0).cast("long").alias("rows_to_load")))


def q_preview(spark, sf):
    """L1: the first ten rows of the file and of its clean subset, in file order."""
    from storeloom.operators import quality as V
    flagged = flagged_sales(spark, sf)
    clean, _ = V.split(flagged)
    cols = ["OrderID", "Date", "Region", "Product", "Revenue"]
    raw10 = flagged.orderBy("_ordinal").limit(10).select(F.lit("raw").alias("frame"), *cols)
    clean10 = clean.orderBy("_ordinal").limit(10).select(F.lit("clean").alias("frame"), *cols)
    return raw10.unionByName(clean10)


# ---------------------------------------------------------------------------
# the whole load
# ---------------------------------------------------------------------------

def q_end_to_end_load(spark, sf):
    """R2 then R1 into a fresh warehouse: gate the sales feed (auto-filter), load all three feeds."""
    from storeloom.plans import load as L
    wh, _ = L.gate_and_load(spark, _scratch(spark, "warehouse"), sales_staged(spark, sf),
                            ads_staged(spark, sf), weather_staged(spark, sf), auto_filter=True)
    return L.table_counts(wh, L.ALL_TABLES)


# ---------------------------------------------------------------------------
# deliveries
# ---------------------------------------------------------------------------

def q_stage_counts(spark, sf):
    """Rows of the three feeds at every stage of a load: staged, dropped, merged or deduplicated, quarantined, loaded."""
    from storeloom.plans import deliveries as P
    wh = P.load_delivery(spark, _scratch(spark, "warehouse"), {"sales": sales_staged(spark, sf), "ads": ads_staged(spark, sf), "weather": weather_staged(spark, sf)})
    return P.stage_log(wh).read().select("feed", "stage", "rows")


def q_repeated_deliveries(spark, sf):
    """All tables and the ledger after a load, a second delivery that breaks in its ads phase, and the same one twice more."""
    from storeloom.plans import deliveries as P
    from storeloom.plans import load as L
    root = _scratch(spark, "warehouse")
    P.load_delivery(spark, root, {"sales": sales_staged(spark, sf), "ads": ads_staged(spark, sf), "weather": weather_staged(spark, sf)})
    sales, ads = second_feeds(spark, sf)
    try:
        P.load_delivery(spark, root, {"sales": sales, "ads": ads.drop("campaign")})
    except PySparkException:
        pass  # the phase's failure is what is tried here; the ledger shows it
    P.load_delivery(spark, root, {"sales": sales, "ads": ads})
    wh = P.load_delivery(spark, root, {"sales": sales, "ads": ads})
    entries = P.ledger(wh).read().select(F.lit("ledger").alias("table_name"), F.concat_ws("|", F.col("entry").cast("string"), "phase", "state").alias("row"))
    return _rows_as_text(wh, L.ALL_TABLES).unionByName(entries)


def q_last_good_feed(spark, sf):
    """The weather fact where the newest deliveries of the feed lack a column or can't be read, and the run it came from."""
    from storeloom.contracts import WEATHER_RAW_COLUMNS
    from storeloom.plans import deliveries as P
    wh = P.Warehouse(spark, _scratch(spark, "warehouse"))
    feed = P.Snapshots(wh, "weather", WEATHER_RAW_COLUMNS)
    weather = weather_staged(spark, sf)
    feed.take(lambda: weather, "r1")
    feed.take(lambda: weather.drop("temp_mean"), "r2")
    run = feed.take(lambda: spark.read.parquet(f"{wh.root}/no-feed-here"), "r3")
    P.load_delivery(spark, wh.root, {"weather": feed.read(run)})
    return wh.read("fact_weather_daily").withColumn("source_run", F.lit(run))


def replayed(spark, sf):
    """(warehouse, accepted rows, rows accepted after mending their dates and categories)."""
    from storeloom.contracts import VALID_CATEGORIES
    from storeloom.operators import quality as V
    from storeloom.plans import deliveries as P
    from storeloom.plans import load as L
    wh = P.Warehouse(spark, _scratch(spark, "warehouse"))
    clean, rejected = V.split(flagged_sales(spark, sf))
    L.quarantine(rejected, wh.root, "first")
    fixes = {"Date": F.coalesce(X.parse_date("Date").cast("string"), F.col("Date")),
             "Category": F.when(F.col("Category").isin(*VALID_CATEGORIES), F.col("Category")).otherwise(F.lit(VALID_CATEGORIES[0]))}
    return wh, clean, P.replay(wh, "first", fixes, "second")


def q_quarantine_contents(spark, sf):
    """K8: what the quarantine holds after a gate run and a replay of its mended rows."""
    from storeloom.plans import deliveries as P
    wh, _, _ = replayed(spark, sf)
    cols = ["OrderID", "Date", "Revenue", "Category", "Region"]
    runs = [P.quarantined(wh, run).select(F.lit(run).alias("run"), *cols, F.concat_ws(",", "failed_rules").alias("failed_rules")) for run in ("first", "second")]
    return runs[0].unionByName(runs[1])


def q_quarantine_replay(spark, sf):
    """K8/O3: the orders of the upload with the mended rows back in their first places (the last row of an id counts)."""
    _, clean, passed = replayed(spark, sf)
    return C.clean_sales(clean.unionByName(passed)).select("order_id", "date", "category", "region", "revenue")
