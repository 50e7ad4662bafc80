"""Raw retail feeds derived from the driver's TPC-H-style tables.

The original load reads three landed files (a sales workbook, an ads CSV,
a weather CSV) that are not available. These builders re-aim it onto the
given tables: every raw column is an all-text expression over a join of
``lineitem``/``orders``/``customer``/``part``/``supplier``/``nation`` (sales),
``events`` (ads) and ``orders``/``customer``/``nation`` (weather), with
deterministic dirt injected by key arithmetic. The same expression text is
used by the DuckDB oracle, so both engines start from byte-identical raw
feeds; only the few functions whose names differ are switched per dialect.

The work grows with the tables: every row of lineitem / events / orders
becomes one raw feed row; nothing is sampled or capped.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeloom.sources.tables import read_table
from storeloom.contracts import (
    CAMPAIGN_TYPE_MAP, SALES_RAW_COLUMNS, STAGE_ORDER, VALID_CATEGORIES, VALID_REGIONS,
    VALID_SEGMENTS,
)

SPARK = "spark"
DUCKDB = "duckdb"

# Stand-in vocabularies: TPC-H codes -> retail names. Unknown names are kept
# on purpose so that the "Other" / 99 / warning paths are exercised.
_STAGE_BY_FLAGS = {
    "AF": "Impression", "AO": "Visit website", "NF": "Click",
    "NO": "Add to cart", "RF": "Purchase", "RO": "Returned",
}
_CHANNEL_BY_PRIORITY = {
    "1-URGENT": "Facebook", "2-HIGH": "Ecommerce", "3-MEDIUM": "TV",
    "4-NOT SPECIFIED": "Retail promotion", "5-LOW": "Hotline",
}
_SEGMENT_BY_MKT = {
    "AUTOMOBILE": VALID_SEGMENTS[0], "BUILDING": VALID_SEGMENTS[1],
    "FURNITURE": VALID_SEGMENTS[2], "HOUSEHOLD": VALID_SEGMENTS[3],
    "MACHINERY": "MACHINERY",
}
_CAMPAIGNS = list(CAMPAIGN_TYPE_MAP) + ["Flash Sale"]
_ADS_SLUG_BY_EVENT = {
    "click": "tet_promotion", "purchase": " Summer_Promotion ",
    "signup": "spring_campaign", "view": "back_to_school", "error": "unknown_slug",
}
assert set(_STAGE_BY_FLAGS.values()) - {"Returned"} == set(STAGE_ORDER)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case_map(expr: str, mapping: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"CASE {expr} {arms} ELSE {default} END"


def _case_index(expr: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


_DUCK_FORMATS = {
    "yyyy-MM-dd": "%Y-%m-%d", "yyyy-M-d": "%Y-%-m-%-d",
    "dd/MM/yyyy": "%d/%m/%Y", "MM/dd/yyyy": "%m/%d/%Y",
}


def fmt_date(d: str, spark_fmt: str, dialect: str) -> str:
    if dialect == SPARK:
        return f"date_format({d}, '{spark_fmt}')"
    return f"strftime({d}, '{_DUCK_FORMATS[spark_fmt]}')"


def dec_text(x: str, scale: int = 2) -> str:
    """Text of a number through decimal(18,scale); identical in both engines."""
    return f"CAST(CAST({x} AS DECIMAL(18,{scale})) AS STRING)"


def json_field(doc: str, field: str, dialect: str) -> str:
    if dialect == SPARK:
        return f"get_json_object({doc}, '$.{field}')"
    return f"json_extract_string({doc}, '$.{field}')"


def region_name(regionkey: str) -> str:
    return _case_index(f"{regionkey} % 3", VALID_REGIONS)


def _pad(x: str, key: str) -> str:
    """Surround with space+tab / nbsp on every fifth key, wide spaces on the next (strip test)."""
    return (f"concat(CASE WHEN {key} % 5 = 0 THEN concat(' ', chr(9)) ELSE '' END, {x}, "
            f"CASE WHEN {key} % 5 = 0 THEN chr(160) WHEN {key} % 5 = 1 THEN '\u2003\u3000' ELSE '' END)")


# ---------------------------------------------------------------------------
# sales
# ---------------------------------------------------------------------------

SALES_ORDINAL = ["l_shipdate", "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber"]


def sales_raw_exprs(dialect: str) -> list[tuple[str, str]]:
    """(column, SQL expression) for the 37 raw sales columns, over the sales join."""
    k = "l_orderkey"
    d = "CAST(l_shipdate AS DATE)"
    oid = "(l_orderkey * 10 + l_linenumber)"
    price = "CAST(l_extendedprice AS DECIMAL(18,2))"
    cost = "(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(18,2)))"
    iso = fmt_date(d, "yyyy-MM-dd", dialect)
    exprs = {
        "OrderID": f"CASE WHEN {k} % 101 = 0 THEN NULL "
                   f"WHEN {k} % 101 = 1 THEN concat(CAST({oid} AS STRING), '.7') "
                   # 19 digits that differ in the last ones only, and some beyond the range
                   f"WHEN {k} % 109 = 5 THEN concat('12345678901', CAST(10000000 + {oid} AS STRING)) "
                   f"WHEN {k} % 113 = 7 THEN concat('9223372036854775', CAST(806 + l_linenumber AS STRING)) "
                   f"ELSE CAST({oid} AS STRING) END",
        "Date": f"CASE WHEN {k} % 97 = 0 THEN 'junk' WHEN {k} % 97 = 1 THEN '2024-02-30' "
                f"WHEN {k} % 4 = 1 THEN {fmt_date(d, 'yyyy-M-d', dialect)} "
                f"WHEN {k} % 4 = 2 AND day({d}) > 12 THEN {fmt_date(d, 'dd/MM/yyyy', dialect)} "
                f"WHEN {k} % 4 = 3 AND day({d}) > 12 THEN {fmt_date(d, 'MM/dd/yyyy', dialect)} "
                f"ELSE {iso} END",
        "Year": f"CAST(year({d}) AS STRING)",
        "Month": f"CAST(month({d}) AS STRING)",
        "Region": _pad(f"CASE WHEN {k} % 71 = 1 AND {d} >= DATE '1997-01-01' THEN 'Tây Nguyên' ELSE {region_name('n_regionkey')} END", k),
        "Branch": _pad("n_name", k),
        "Department": f"CASE WHEN {k} % 79 = 0 THEN '' WHEN {k} % 79 = 1 THEN 'nan' "
                      f"WHEN {k} % 79 = 2 THEN 'None' WHEN {k} % 79 = 3 THEN 'NA' "
                      f"WHEN {k} % 79 = 4 THEN 'null' ELSE {_pad("concat('Dept-', o_orderstatus)", k)} END",
        "Product": f"CASE WHEN {k} % 103 = 0 THEN repeat(concat(p_name, ' '), 20) ELSE {_pad('p_name', k)} END",
        "Category": _pad(f"CASE WHEN {k} % 71 = 0 THEN 'Đồ chơi' ELSE {_case_index('p_partkey % 7', VALID_CATEGORIES)} END", k),
        "Stage": f"CASE WHEN {k} % 73 = 1 THEN NULL ELSE "
                 f"{_pad(_case_map('concat(l_returnflag, l_linestatus)', _STAGE_BY_FLAGS), k)} END",
        "Channel": f"CASE WHEN {k} % 73 = 0 THEN NULL ELSE "
                   f"{_pad(_case_map('o_orderpriority', _CHANNEL_BY_PRIORITY), k)} END",
        "Information": "concat('Info ', CAST(l_linenumber AS STRING))",
        "Machine": "p_brand",
        "Quantity": f"CASE WHEN {k} % 83 = 2 THEN '0' ELSE {dec_text('l_quantity')} END",
        "Revenue": f"CASE WHEN {k} % 89 = 0 THEN 'abc' WHEN {k} % 89 = 1 THEN '1,234' "
                   f"WHEN {k} % 89 = 2 THEN '1_000' WHEN {k} % 89 = 3 THEN '5d' "
                   f"WHEN {k} % 89 = 4 THEN 'inf' WHEN {k} % 83 = 0 THEN '0' "
                   f"WHEN {k} % 83 = 1 THEN '-5' WHEN {k} % 107 = 0 THEN '1e17' "
                   f"ELSE CAST({price} AS STRING) END",
        "Cost": dec_text(cost),
        "Profit": dec_text(f"({price} - {cost})"),
        "ProfitMargin": dec_text("l_discount"),
        "InventoryLevel": "CAST(p_size AS STRING)",
        "Calls": "CAST(l_linenumber * 3 AS STRING)",
        "WaitingTime": dec_text("l_tax * 100"),
        "Budget": f"CASE WHEN {k} % 67 = 2 THEN '0' WHEN {k} % 67 = 3 THEN NULL ELSE {dec_text('s_acctbal')} END",
        "Target": f"CASE WHEN {k} % 67 = 0 THEN '0' WHEN {k} % 67 = 1 THEN NULL ELSE {dec_text('o_totalprice')} END",
        "RawMaterialCost": dec_text("p_retailprice"),
        "LaborCost": dec_text("l_tax * 1000"),
        "LogisticsCost": "CAST(l_suppkey % 500 AS STRING)",
        "MarketingCost": dec_text("c_acctbal"),
        "UnitCost": dec_text("p_retailprice", 6),
        "RevenuePerUnit": "CAST(NULL AS STRING)",
        "ROI_Marketing": dec_text("l_discount", 6),
        "ConversionProxy": "CAST(NULL AS STRING)",
        "CostPerMachineUnit": "CAST(NULL AS STRING)",
        "RegionProfitShare": "CAST(NULL AS STRING)",
        "MarketSize": "CAST(o_custkey AS STRING)",
        "MarketShare": "CAST(NULL AS STRING)",
        "CustomerSegment": _pad(f"CASE WHEN {k} % 71 = 2 THEN 'Doanh nghiệp' ELSE "
                                f"{_case_map('c_mktsegment', _SEGMENT_BY_MKT)} END", k),
        "PromotionCampaign": _case_index("o_custkey % 7", _CAMPAIGNS),
    }
    assert list(exprs) == SALES_RAW_COLUMNS
    return list(exprs.items())


def _read(spark: SparkSession, sf_dir: str, name: str, parallel: bool = False) -> DataFrame:
    return read_table(spark, sf_dir, name, parallel=parallel)


def sales_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its order, customer, part, supplier and supplier nation.

    Orders meet their customers first, so that the much longer lineitem isn't shuffled for it.
    """
    t = lambda n: _read(spark, sf_dir, n)
    return (
        _read(spark, sf_dir, "lineitem", parallel=True)
        .join(t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )


def read_of_join(joined: DataFrame) -> DataFrame:
    """The sales join with the columns alone that the feed's expressions read."""
    read = {*re.findall(r"\w+", " ".join(e for _, e in sales_raw_exprs(SPARK))), *SALES_ORDINAL}
    return joined.select(*[c for c in joined.columns if c in read])


def sales_raw(spark: SparkSession, sf_dir: str, ordinal: str = "_ordinal") -> DataFrame:
    """37 all-text sales columns plus ``_ordinal``, the feed's row order."""
    return sales_raw_from(sales_join(spark, sf_dir), ordinal)


def sales_raw_from(joined: DataFrame, ordinal: str = "_ordinal") -> DataFrame:
    """The raw sales columns of rows of the sales join."""
    exprs = [f"{e} AS `{n}`" for n, e in sales_raw_exprs(SPARK)]
    return joined.selectExpr(*exprs, f"struct({', '.join(SALES_ORDINAL)}) AS {ordinal}")


# ---------------------------------------------------------------------------
# ads
# ---------------------------------------------------------------------------

ADS_ORDINAL = ["event_id"]


def ads_raw_exprs(dialect: str) -> list[tuple[str, str]]:
    e = "event_id"
    d = "CAST(ts AS DATE)"
    return [
        ("date", f"CASE WHEN {e} % 53 = 0 THEN 'not a date' ELSE {fmt_date(d, 'dd/MM/yyyy', dialect)} END"),
        ("campaign", _case_map("event_type", _ADS_SLUG_BY_EVENT)),
        ("spend", f"CASE WHEN {e} % 41 = 0 THEN 'n/a' ELSE {dec_text('value')} END"),
        ("impressions", f"CASE WHEN event_type = 'view' AND day(ts) = 1 THEN NULL "
                        f"WHEN {e} % 17 = 0 THEN NULL ELSE {json_field('props', 'k', dialect)} END"),
        ("clicks", f"CAST({e} % 7 AS STRING)"),
        ("conversions", f"CAST({e} % 3 AS STRING)"),
    ]


def ads_raw(spark: SparkSession, sf_dir: str, ordinal: str = "_ordinal") -> DataFrame:
    exprs = [f"{e} AS `{n}`" for n, e in ads_raw_exprs(SPARK)]
    return _read(spark, sf_dir, "events", parallel=True).selectExpr(*exprs, f"event_id AS {ordinal}")


# ---------------------------------------------------------------------------
# weather
# ---------------------------------------------------------------------------

WEATHER_ORDINAL = ["o_orderkey"]


def weather_raw_exprs(dialect: str) -> list[tuple[str, str]]:
    o = "o_orderkey"
    d = "CAST(o_orderdate AS DATE)"
    return [
        ("date", f"CASE WHEN {o} % 61 = 0 THEN '31/02/2020' ELSE {fmt_date(d, 'yyyy-MM-dd', dialect)} END"),
        ("region", f"CASE WHEN {o} % 59 = 0 THEN '  ' WHEN {o} % 5 = 0 "
                   f"THEN concat(' ', {region_name('n_regionkey')}, ' ') ELSE {region_name('n_regionkey')} END"),
        ("temp_mean", f"CASE WHEN {o} % 43 = 0 THEN 'n/a' ELSE CAST(o_custkey % 40 AS STRING) END"),
        ("temp_max", "CAST(o_custkey % 40 + o_orderkey % 10 AS STRING)"),
        ("rain_mm", dec_text(f"({o} % 100) / 4")),
    ]


def weather_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: _read(spark, sf_dir, n)
    return (
        _read(spark, sf_dir, "orders", parallel=True)
        .join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )


def weather_raw(spark: SparkSession, sf_dir: str, ordinal: str = "_ordinal") -> DataFrame:
    exprs = [f"{e} AS `{n}`" for n, e in weather_raw_exprs(SPARK)]
    return weather_join(spark, sf_dir).selectExpr(*exprs, f"o_orderkey AS {ordinal}")
