"""Oracle SQL (DuckDB) for each registered query."""

from __future__ import annotations

from oracle import clean as K
from oracle.feeds import ads_raw_sql, sales_raw_sql, weather_raw_sql
from storeloom.contracts import (
    CAMPAIGN_TYPE_MAP, SALES_FACT_COLUMNS, SALES_FACT_DECIMALS, STAGE_ORDER, VALID_CATEGORIES,
)

_NUMERIC = {"year", "month", "quantity", "revenue", "cost", "profit", "profit_margin",
            "inventory_level", "calls", "waiting_time", "budget", "target", "raw_material_cost",
            "labor_cost", "logistics_cost", "marketing_cost", "unit_cost", "revenue_per_unit",
            "roi_marketing", "conversion_proxy", "cost_per_machine_unit", "region_profit_share",
            "market_size", "market_share"}


def _typed_cols():
    out = []
    for raw, canon in K.SALES_CANON.items():
        x = f'"{raw}"'
        if canon == "order_id":
            e = K.to_id(x)
        elif canon == "date":
            e = K.parse_date(x)
        elif canon in K.TEXT:
            e = K.clean_text(x)
        elif canon in _NUMERIC:
            e = K.to_number(x)
        else:
            e = x
        out.append(f"{e} AS {canon}")
    return ",\n    ".join(out)


def sales_ctes(source: str = "sales_raw", p: str = "sales", with_raw: bool = True) -> str:
    raw = f"sales_raw AS ({sales_raw_sql()}),\n" if with_raw else ""
    return f"""{raw}{p}_typed0 AS (SELECT {_typed_cols()}, o1, o2, o3, o4, o5 FROM {source}),
{p}_typed AS (SELECT *, CASE WHEN order_id IS NULL THEN 'order_id missing/invalid'
    WHEN date IS NULL THEN 'date missing/invalid' WHEN channel IS NULL THEN 'channel missing'
    WHEN stage IS NULL THEN 'stage missing' WHEN revenue IS NULL THEN 'revenue missing' END AS drop_reason
  FROM {p}_typed0),
{p}_clean AS (SELECT * REPLACE (CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month)
  FROM {p}_typed WHERE drop_reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY o1 DESC, o2 DESC, o3 DESC, o4 DESC, o5 DESC) = 1)"""


SALES_CTES = sales_ctes()


def _fact_cols():
    out = []
    for src, dst in SALES_FACT_COLUMNS:
        if dst in SALES_FACT_DECIMALS:
            p, s = SALES_FACT_DECIMALS[dst]
            out.append(f"TRY_CAST({src} AS DECIMAL({p},{s})) AS {dst}")
        else:
            out.append(f"{src} AS {dst}")
    return ", ".join(out)


FACT_CTES = f"""{SALES_CTES},
fact0 AS (SELECT {_fact_cols()} FROM sales_clean),
sales_fact AS (SELECT *,
  CAST(coalesce(revenue, 0) - coalesce(target, 0) AS DECIMAL(18,2)) AS target_gap,
  {K.ratio('revenue', 'target', 2, 2)} AS target_achievement_rate,
  {K.ratio('profit', 'budget', 2, 2)} AS roi_marketing_calc
  FROM fact0)"""

ADS_CTES = f"""ads_raw AS ({ads_raw_sql()}),
ads_typed AS (SELECT {K.parse_date('date')} AS date, {K.campaign_from_slug('campaign')} AS campaign,
  {K.to_decimal('spend', 28, 10)} AS spend, {K.to_decimal('impressions', 28, 10)} AS impressions,
  {K.to_decimal('clicks', 28, 10)} AS clicks, {K.to_decimal('conversions', 28, 10)} AS conversions, o1
  FROM ads_raw),
ads_kept AS (SELECT * FROM ads_typed WHERE date IS NOT NULL AND campaign IS NOT NULL AND spend IS NOT NULL),
ads_daily AS (SELECT date, campaign,
  CAST(coalesce(sum(spend), 0) AS DECIMAL(38,10)) AS spend,
  CAST(coalesce(sum(impressions), 0) AS DECIMAL(38,10)) AS impressions,
  CAST(coalesce(sum(clicks), 0) AS DECIMAL(38,10)) AS clicks,
  CAST(coalesce(sum(conversions), 0) AS DECIMAL(38,10)) AS conversions
  FROM ads_kept GROUP BY date, campaign),
ads_fact0 AS (SELECT date AS full_date, campaign AS campaign_name, 'Facebook' AS channel_name,
  TRY_CAST(spend AS DECIMAL(18,2)) AS spend, TRY_CAST(impressions AS DECIMAL(18,0)) AS impressions,
  TRY_CAST(clicks AS DECIMAL(18,0)) AS clicks, TRY_CAST(conversions AS DECIMAL(18,0)) AS conversions
  FROM ads_daily),
ads_fact AS (SELECT *, {K.ratio('clicks', 'impressions', 0, 0)} AS ctr,
  {K.ratio('spend', 'clicks', 2, 0)} AS cost_per_click FROM ads_fact0)"""

WEATHER_CTES = f"""weather_raw AS ({weather_raw_sql()}),
weather_typed AS (SELECT {K.parse_date('date')} AS date, {K.strip('region')} AS region,
  {K.to_number('temp_mean')} AS temp_mean, {K.to_number('temp_max')} AS temp_max,
  {K.to_number('rain_mm')} AS rain_mm, o1 FROM weather_raw),
weather_clean AS (SELECT * FROM weather_typed
  WHERE date IS NOT NULL AND region IS NOT NULL AND temp_mean IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY date, region ORDER BY o1 DESC) = 1),
weather_fact AS (SELECT date AS full_date, region AS region_name,
  TRY_CAST(temp_mean AS DECIMAL(6,2)) AS temp_mean, TRY_CAST(temp_max AS DECIMAL(6,2)) AS temp_max,
  TRY_CAST(rain_mm AS DECIMAL(8,2)) AS rain_mm FROM weather_clean)"""

DIM_CTES = """dim_branch AS (SELECT branch AS branch_name, arg_min(region, (o1, o2, o3, o4, o5)) AS region_name
  FROM sales_clean WHERE branch IS NOT NULL GROUP BY branch),
dim_product AS (SELECT product AS product_name, arg_min(category, (o1, o2, o3, o4, o5)) AS category_name
  FROM sales_clean WHERE product IS NOT NULL GROUP BY product)"""


def _half_up_div(n_int, d_int):
    return K.half_up_int(n_int, d_int)


KPI_BY_YEAR = f"""WITH {FACT_CTES}
SELECT CAST(year(full_date) AS INTEGER) AS year, count(*) AS orders,
  CAST(CAST({_half_up_div('CAST(sum(revenue) * 100 AS HUGEINT)', 'CAST(10000000 AS HUGEINT)')} AS DECIMAL(38,0)) * 0.1 AS DECIMAL(18,1)) AS revenue_m,
  CAST(CAST({_half_up_div('CAST(sum(profit) * 100 AS HUGEINT) * 1000', 'CAST(sum(revenue) * 100 AS HUGEINT)')} AS DECIMAL(38,0)) * 0.1 AS DECIMAL(18,1)) AS margin_pct
FROM sales_fact GROUP BY 1 ORDER BY 1"""

KPI_TOTAL = f"""WITH {FACT_CTES}
SELECT count(*) AS orders, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue,
  CAST(sum(profit) AS DECIMAL(38,2)) AS profit,
  CAST(CAST({_half_up_div('CAST(sum(profit) * 100 AS HUGEINT) * 1000', 'CAST(sum(revenue) * 100 AS HUGEINT)')} AS DECIMAL(38,0)) * 0.1 AS DECIMAL(18,1)) AS margin_pct
FROM sales_fact"""


def _standardize():
    # messy headers: MarketShare and RegionProfitShare dropped; PromotionCampaign renamed to
    # "Campaign" and Region to "Vùng" (normalises to "vng"), neither of which maps, so
    # campaign and region are NULL; every other column maps back.
    from storeloom.contracts import OPTIONAL_COLS, REQUIRED_COLS
    canon_to_raw = {v: k for k, v in K.SALES_CANON.items()}
    cols = []
    for c in (*REQUIRED_COLS, *OPTIONAL_COLS):
        if c in ("market_share", "region_profit_share", "campaign", "region"):
            cols.append(f"CAST(NULL AS VARCHAR) AS {c}")
        else:
            cols.append(f'"{canon_to_raw[c]}" AS {c}')
    return f"WITH sales_raw AS ({sales_raw_sql()}) SELECT {', '.join(cols)} FROM sales_raw"


CLEAN_NUMERIC = f"""WITH sales_raw AS ({sales_raw_sql()})
SELECT "OrderID" AS order_id_text, "Revenue" AS revenue_text, {K.to_id('"OrderID"')} AS order_id,
  {K.to_number('"Revenue"')} AS revenue, ({K.to_number('"Revenue"')}) IS NOT NULL AS revenue_valid,
  {K.to_decimal('"Revenue"', 18, 2)} AS revenue_dec
FROM sales_raw"""

PARSE_DATES = f"""WITH sales_raw AS ({sales_raw_sql()}), p AS (SELECT "Date" AS date_text, {K.parse_date('"Date"')} AS date FROM sales_raw)
SELECT date_text, date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM p"""

STRICT_DATES = f"""WITH sales_raw AS ({sales_raw_sql()})
SELECT "Date" AS date_text, {K.strict_date('"Date"')} AS is_strict FROM sales_raw"""

DROP_REASONS = f"""WITH {SALES_CTES}
SELECT drop_reason, count(*) AS dropped_rows FROM sales_typed WHERE drop_reason IS NOT NULL GROUP BY drop_reason"""

_LANG_RAW = ("CASE doc_id % 7 WHEN 0 THEN concat(' ', chr(9), lang, chr(160)) WHEN 1 THEN 'nan' "
             "WHEN 2 THEN ' None ' WHEN 3 THEN concat(chr(10), ' ') ELSE lang END")
_SOURCE_RAW = "CASE WHEN doc_id % 3 = 0 THEN concat(chr(160), upper(source), '  ') ELSE source END"
CLEAN_TEXT = f"""WITH t AS (SELECT doc_id, text, {_LANG_RAW} AS lang_raw, {_SOURCE_RAW} AS source_raw FROM documents)
SELECT doc_id, lang_raw, {K.clean_text('lang_raw')} AS lang, {K.strip('source_raw')} AS source,
  lower({K.strip('source_raw')}) AS source_key, md5({K.clean_text('text')}) AS text_md5, CAST(length({K.strip('lang_raw')}) AS INTEGER) AS lang_len FROM t"""

DEDUP_KEEP_LAST = f"""WITH {SALES_CTES}
SELECT order_id, date, channel, stage, revenue, year, month FROM sales_clean"""

DEDUP_KEEP_FIRST = """SELECT p_name, p_type, p_brand, p_partkey FROM part
QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1"""

DIM_DATE = f"""WITH {SALES_CTES}, {ADS_CTES}, {WEATHER_CTES},
d AS (SELECT date FROM sales_clean UNION SELECT date FROM ads_daily UNION SELECT date FROM weather_clean)
SELECT date AS full_date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  monthname(date) AS month_name, CAST(quarter(date) AS INTEGER) AS quarter, strftime(date, '%Y-%m') AS year_month
FROM d WHERE date IS NOT NULL"""

DIM_DISTINCT = f"""WITH {SALES_CTES}
SELECT DISTINCT 'dim_customer_segment' AS dimension, customer_segment AS name FROM sales_clean WHERE customer_segment IS NOT NULL
UNION ALL SELECT DISTINCT 'dim_department', department FROM sales_clean WHERE department IS NOT NULL
UNION ALL SELECT DISTINCT 'dim_machine', machine FROM sales_clean WHERE machine IS NOT NULL
UNION ALL SELECT DISTINCT 'dim_information', information FROM sales_clean WHERE information IS NOT NULL
UNION ALL SELECT DISTINCT 'dim_region', region FROM sales_clean WHERE region IS NOT NULL"""

_SEED = " UNION ALL ".join(f"SELECT {K.q(n)} AS stage_name, {o} AS stage_order, {K.q(g)} AS stage_group"
                           for n, (o, g) in STAGE_ORDER.items())
DIM_STAGE = f"""WITH {SALES_CTES}
SELECT stage_name, CAST(stage_order AS INTEGER) AS stage_order, stage_group FROM ({_SEED}) seed
UNION ALL
SELECT DISTINCT stage, CAST(99 AS INTEGER), 'Other' FROM sales_clean
WHERE stage IS NOT NULL AND stage NOT IN ({', '.join(K.q(s) for s in STAGE_ORDER)})"""

LOOKUP_DEFAULT = f"""WITH {SALES_CTES}
SELECT DISTINCT 'channel' AS dimension, channel AS name, {K.channel_type('channel')} AS type FROM sales_clean WHERE channel IS NOT NULL
UNION ALL
SELECT DISTINCT 'campaign', campaign, {K.campaign_type('campaign')} FROM sales_clean WHERE campaign IS NOT NULL"""

LOOKUP_DROP = f"""WITH ads_raw AS ({ads_raw_sql()}), m AS (SELECT o1 AS event_id, campaign AS slug,
  {K.campaign_from_slug('campaign')} AS campaign FROM ads_raw)
SELECT * FROM m WHERE campaign IS NOT NULL"""

DROPNA_SUBSET = f"""WITH {ADS_CTES}
SELECT o1 AS event_id, date, campaign, spend FROM ads_kept"""

ADS_DAILY = f"""WITH {ADS_CTES} SELECT * FROM ads_daily"""
ADS_RATIOS = f"""WITH {ADS_CTES} SELECT * FROM ads_fact"""
WEATHER_DAILY = f"""WITH {WEATHER_CTES} SELECT * FROM weather_fact"""
SALES_FACT = f"""WITH {FACT_CTES} SELECT * FROM sales_fact"""

SALES_WEATHER = f"""WITH {FACT_CTES}, {DIM_CTES}, {WEATHER_CTES}
SELECT f.*, b.region_name, p.category_name, w.temp_mean, w.temp_max, w.rain_mm
FROM sales_fact f
LEFT JOIN dim_branch b ON b.branch_name = f.branch_name
LEFT JOIN dim_product p ON p.product_name = f.product_name
LEFT JOIN weather_fact w ON w.full_date = f.full_date AND w.region_name = b.region_name"""

ORACLE = {
    "kpi_by_year": KPI_BY_YEAR,
    "kpi_total": KPI_TOTAL,
    "standardize_headers": _standardize(),
    "clean_numeric": CLEAN_NUMERIC,
    "parse_dates": PARSE_DATES,
    "strict_dates": STRICT_DATES,
    "drop_reasons": DROP_REASONS,
    "clean_text": CLEAN_TEXT,
    "dedup_keep_last": DEDUP_KEEP_LAST,
    "dedup_keep_first": DEDUP_KEEP_FIRST,
    "dim_date": DIM_DATE,
    "dim_distinct": DIM_DISTINCT,
    "dim_stage": DIM_STAGE,
    "lookup_default": LOOKUP_DEFAULT,
    "lookup_drop": LOOKUP_DROP,
    "dropna_subset": DROPNA_SUBSET,
    "ads_daily": ADS_DAILY,
    "ads_ratios": ADS_RATIOS,
    "weather_daily": WEATHER_DAILY,
    "sales_fact": SALES_FACT,
    "sales_weather": SALES_WEATHER,
}


# ---------------------------------------------------------------------------
# sources and sinks
# ---------------------------------------------------------------------------

def _na(x):
    from storeloom.contracts import NA_TOKENS
    return f"CASE WHEN {x} IN ({', '.join(K.q(t) for t in NA_TOKENS)}) THEN NULL ELSE {x} END"


def _token_note():
    from storeloom.contracts import NA_TOKENS
    tokens = list(NA_TOKENS) + ["na", "none", "-", " ", 'a "b", c', '"', "line 1\nline 2", " padded\t", ",", 'x""y', "back\\slash"]
    arms = " ".join(f"WHEN {i} THEN {K.q(t)}" for i, t in enumerate(tokens))
    return f"CASE c_custkey % {len(tokens) + 1} {arms} ELSE c_mktsegment END"


TEXT_SCAN_NULLS = f"""WITH t AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, {_token_note()} AS note FROM customer)
SELECT {_na('id')} AS id, {_na('name')} AS name, {_na('note')} AS note, CAST(NULL AS VARCHAR) AS extra FROM t"""

from storeloom.sources.standins import region_name  # noqa: E402

FEED_ARRAYS = f"""WITH j AS (SELECT {region_name('n_regionkey')} AS region, CAST(o_orderdate AS DATE) AS day, o_custkey, o_orderkey
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
daily AS (SELECT region, day, CAST(count(*) AS DOUBLE) AS tm, CAST(max(o_custkey % 40) AS DOUBLE) AS tx,
  CAST(sum(o_orderkey % 100) AS DOUBLE) / 4.0 AS rain FROM j GROUP BY region, day),
ranked AS (SELECT *, row_number() OVER (PARTITION BY region, strftime(day, '%Y-%m') ORDER BY day) AS i,
  count(*) OVER (PARTITION BY region, strftime(day, '%Y-%m')) AS n FROM daily)
SELECT strftime(day, '%Y-%m-%d') AS date, tm AS temp_mean, tx AS temp_max, rain AS rain_mm, region
FROM ranked WHERE i <= CASE WHEN month(day) % 2 = 1 THEN n - 1 ELSE n END"""

# ---------------------------------------------------------------------------
# upserts
# ---------------------------------------------------------------------------

_UPSERT_INPUTS = """t AS (SELECT o_orderkey AS order_key, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
  CAST(o_orderdate AS DATE) AS order_date FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
b AS (SELECT o_orderkey AS order_key, CASE WHEN o_orderkey % 13 <> 0 THEN lower(o_orderstatus) END AS status,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS DECIMAL(18,2)) AS total, CAST(o_orderdate AS DATE) AS order_date
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"""

UPSERT_UPDATE = f"""WITH {_UPSERT_INPUTS}
SELECT b.*, EXISTS (SELECT 1 FROM t WHERE t.order_key = b.order_key) AS kept_created_at FROM b
UNION ALL
SELECT t.*, true FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.order_key = t.order_key)"""

UPSERT_IGNORE = f"""WITH {_UPSERT_INPUTS}
SELECT t.*, true AS kept_created_at FROM t
UNION ALL
SELECT b.*, false FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.order_key = b.order_key)"""

# ---------------------------------------------------------------------------
# constraints
# ---------------------------------------------------------------------------

FK_VIOLATIONS = """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_size <= 45 AND p.p_partkey = l.l_partkey)"""


def _constraint_report():
    from storeloom.contracts import VARCHAR_LIMITS
    src = {d: s for s, d in SALES_FACT_COLUMNS}
    rows = [("not_null", "order_id", "count_if(order_id IS NULL)")]
    for (t, c), n in VARCHAR_LIMITS.items():
        if t == "fact_marketing_sales":
            rows.append((f"max_length_{n}", c, f"count_if(length({src[c]}) > {n})"))
    for d, (p, sc) in SALES_FACT_DECIMALS.items():
        rows.append((f"fits_decimal({p},{sc})", d,
                     f"count_if({src[d]} IS NOT NULL AND TRY_CAST({src[d]} AS DECIMAL({p},{sc})) IS NULL)"))
    body = "\nUNION ALL\n".join(
        f"SELECT {K.q(ch)} AS check_name, 'fact_marketing_sales' AS table_name, {K.q(col)} AS column_name, "
        f"CAST({agg} AS BIGINT) AS violations FROM sales_clean" for ch, col, agg in rows)
    return f"""WITH {FACT_CTES}
{body}
UNION ALL
SELECT 'not_null', 'fact_marketing_sales', 'revenue', CAST(count_if(revenue IS NULL) AS BIGINT) FROM sales_fact
UNION ALL
SELECT 'primary_key', 'fact_marketing_sales', 'order_id', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
  FROM (SELECT order_id, count(*) AS n FROM sales_fact GROUP BY order_id HAVING count(*) > 1) d
UNION ALL
SELECT 'batch_unique_key', 'sales_batch', 'order_id', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
  FROM (SELECT order_id, count(*) AS n FROM sales_typed WHERE drop_reason IS NULL GROUP BY order_id HAVING count(*) > 1) d"""


# ---------------------------------------------------------------------------
# upload gate
# ---------------------------------------------------------------------------

def _gate_flags():
    from storeloom.contracts import GATE_REQUIRED_COLS, VALID_CATEGORIES, VALID_REGIONS, VALID_SEGMENTS
    rev, qty, cost = K.to_number('"Revenue"'), K.to_number('"Quantity"'), K.to_number('"Cost"')
    inlist = lambda vals: ", ".join(K.q(v) for v in vals)
    rules = [("date_format", f'"Date" IS NOT NULL AND NOT {K.strict_date(chr(34) + "Date" + chr(34))}')]
    rules += [(f"null_{c}", f'"{c}" IS NULL') for c in GATE_REQUIRED_COLS]
    rules += [
        ("revenue_not_numeric", f'"Revenue" IS NOT NULL AND ({rev}) IS NULL'),
        ("revenue_non_positive", f"coalesce(({rev}) <= 0, false)"),
        ("quantity_non_positive", f"coalesce(({qty}) <= 0, false)"),
        ("category_invalid", f'"Category" IS NOT NULL AND "Category" NOT IN ({inlist(VALID_CATEGORIES)})'),
        ("region_invalid", f'"Region" IS NOT NULL AND "Region" NOT IN ({inlist(VALID_REGIONS)})'),
    ]
    warns = [
        ("segment_unknown", f'"CustomerSegment" IS NOT NULL AND "CustomerSegment" NOT IN ({inlist(VALID_SEGMENTS)})'),
        ("revenue_below_cost", f"coalesce(({rev}) < ({cost}), false)"),
    ]
    return rules, warns


def gate_ctes(source: str = "sales_raw") -> str:
    rules, warns = _gate_flags()
    cols = ", ".join(f"coalesce({t}, false) AS r_{n}" for n, t in rules)
    wcols = ", ".join(f"coalesce({t}, false) AS w_{n}" for n, t in warns)
    failed = "concat_ws(',', " + ", ".join(f"CASE WHEN r_{n} THEN {K.q(n)} END" for n, _ in rules) + ")"
    return f"""gate0 AS (SELECT *, {cols}, {wcols} FROM {source}),
gate AS (SELECT *, {failed} AS failed_rules,
  row_number() OVER (ORDER BY o1, o2, o3, o4, o5) - 1 AS row_index FROM gate0)"""


def _rule_names():
    rules, warns = _gate_flags()
    return [n for n, _ in rules], [n for n, _ in warns]


def _quality_report():
    rules, warns = _rule_names()
    parts = [f"SELECT {K.q(r)} AS rule, 'row' AS kind, CAST(count_if(r_{r}) AS BIGINT) AS n_rows, "
             f"CAST(NULL AS DOUBLE) AS pct FROM gate" for r in rules]
    pct = lambda n: f"CAST(({n} * 2000 + count(*)) // (2 * count(*)) AS DOUBLE) / CAST(10 AS DOUBLE)"
    parts.append("SELECT 'segment_unknown', 'warning', CAST(count_if(w_segment_unknown) AS BIGINT), CAST(NULL AS DOUBLE) FROM gate")
    parts.append(f"SELECT 'revenue_below_cost', 'warning', CAST(count_if(w_revenue_below_cost) AS BIGINT), "
                 f"{pct('count_if(w_revenue_below_cost)')} FROM gate")
    parts.append("SELECT 'total_rows', 'summary', CAST(count(*) AS BIGINT), CAST(NULL AS DOUBLE) FROM gate")
    parts.append("SELECT 'bad_rows', 'summary', CAST(count_if(failed_rules <> '') AS BIGINT), CAST(NULL AS DOUBLE) FROM gate")
    clean_n = "count_if(failed_rules = '')"
    parts.append(f"SELECT 'clean_rows', 'summary', CAST({clean_n} AS BIGINT), {pct(clean_n)} FROM gate")
    parts.append("""SELECT 'duplicate_order_id', 'warning', CAST(coalesce(sum(n - 1), 0) AS BIGINT), CAST(NULL AS DOUBLE)
  FROM (SELECT "OrderID", count(*) AS n FROM gate GROUP BY "OrderID") d""")
    body = "\nUNION ALL\n".join(parts)
    return f"""WITH sales_raw AS ({sales_raw_sql()}), {gate_ctes()},
report AS ({body})
SELECT * FROM report
UNION ALL
SELECT 'warning_kinds', 'summary', CAST(count(*) AS BIGINT), CAST(NULL AS DOUBLE) FROM report
WHERE kind = 'warning' AND n_rows > 0"""


def _quality_samples():
    rules, _ = _rule_names()
    firsts = "\nUNION ALL\n".join(
        f"""SELECT {K.q(r)} AS rule, CAST(pos AS INTEGER) AS pos, sheet_row, CAST(NULL AS VARCHAR) AS sample FROM (
  SELECT row_number() OVER (ORDER BY row_index) AS pos, row_index + 2 AS sheet_row FROM gate WHERE r_{r}) x WHERE pos <= 5"""
        for r in rules)
    def firstk(rule, col, k, flag):
        return f"""SELECT {K.q(rule)}, CAST(row_number() OVER (ORDER BY row_index) AS INTEGER), CAST(NULL AS BIGINT), {col}
  FROM (SELECT {col}, row_index FROM gate WHERE {flag} ORDER BY row_index LIMIT {k}) x"""
    def distinctk(rule, col, flag):
        return f"""SELECT {K.q(rule)}, CAST(row_number() OVER (ORDER BY first_row) AS INTEGER), CAST(NULL AS BIGINT), {col}
  FROM (SELECT {col}, min(row_index) AS first_row FROM gate WHERE {flag} GROUP BY {col} ORDER BY first_row LIMIT 5) x"""
    values = [
        firstk("date_format", '"Date"', 1, "r_date_format"),
        firstk("revenue_not_numeric", '"Revenue"', 3, "r_revenue_not_numeric"),
        distinctk("category_invalid", '"Category"', "r_category_invalid"),
        distinctk("region_invalid", '"Region"', "r_region_invalid"),
        distinctk("segment_unknown", '"CustomerSegment"', "w_segment_unknown"),
    ]
    return f"""WITH sales_raw AS ({sales_raw_sql()}), {gate_ctes()}
{firsts}
UNION ALL
""" + "\nUNION ALL\n".join(values)


QUALITY_SPLIT = f"""WITH sales_raw AS ({sales_raw_sql()}), {gate_ctes()}
SELECT "OrderID", "Date", "Revenue", "Category", "Region",
  CASE WHEN failed_rules = '' THEN 'clean' ELSE 'rejected' END AS status, failed_rules FROM gate"""

UPLOAD_BACKUP = f"""WITH sales_raw AS ({sales_raw_sql()}), {gate_ctes()}
SELECT copy, "OrderID", "Date", "Revenue", "Category", "Region" FROM gate, (VALUES ('current'), ('backup')) AS c(copy)
WHERE failed_rules = '' AND (copy = 'backup' OR "OrderID" LIKE '%1')"""

PREVIEW = f"""WITH sales_raw AS ({sales_raw_sql()}), {gate_ctes()}
SELECT * FROM (SELECT 'raw' AS frame, "OrderID", "Date", "Region", "Product", "Revenue" FROM gate ORDER BY row_index LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'clean' AS frame, "OrderID", "Date", "Region", "Product", "Revenue" FROM gate
  WHERE failed_rules = '' ORDER BY row_index LIMIT 10)"""


def sales_fits():
    """Rows that the warehouse can hold: no text over its limit, no number beyond its decimal type."""
    from storeloom.contracts import VARCHAR_LIMITS
    longest = {s: VARCHAR_LIMITS["fact_marketing_sales", d] for s, d in SALES_FACT_COLUMNS if ("fact_marketing_sales", d) in VARCHAR_LIMITS}
    longest |= {"region": 50, "category": 100}
    tests = [f"coalesce(length({c}) <= {n}, true)" for c, n in longest.items()]
    tests += [f"({s} IS NULL OR TRY_CAST({s} AS DECIMAL({p},{sc})) IS NOT NULL)" for s, d in SALES_FACT_COLUMNS for p, sc in [SALES_FACT_DECIMALS.get(d, (0, 0))] if p]
    return " AND ".join(tests)


def _sales_tables(p):
    """The sales tables from rows ``{p}_ok``, as CTEs with the prefix."""
    return f"""{p}_fact0 AS (SELECT {_fact_cols()} FROM {p}_ok),
{p}_fact AS (SELECT *, CAST(coalesce(revenue, 0) - coalesce(target, 0) AS DECIMAL(18,2)) AS target_gap,
  {K.ratio('revenue', 'target', 2, 2)} AS target_achievement_rate, {K.ratio('profit', 'budget', 2, 2)} AS roi_marketing_calc FROM {p}_fact0),
{p}_branch AS (SELECT branch AS branch_name, arg_min(region, (o1, o2, o3, o4, o5)) AS region_name FROM {p}_ok WHERE branch IS NOT NULL GROUP BY branch),
{p}_product AS (SELECT product AS product_name, arg_min(category, (o1, o2, o3, o4, o5)) AS category_name FROM {p}_ok WHERE product IS NOT NULL GROUP BY product)"""


def warehouse_ctes(second):
    """All 14 tables after one load, or after a second one that overlaps it (w_<table>)."""
    feeds = f"""{sales_ctes()}, s1_ok AS (SELECT * FROM sales_clean WHERE {sales_fits()}), {_sales_tables('s1')}, {ADS_CTES}, {WEATHER_CTES}"""
    if second:
        later = ADS_CTES[ADS_CTES.index("ads_typed AS"):].replace("ads_", "ads2_")
        feeds += f""", sales2_raw AS (SELECT * REPLACE ('777.5' AS "Revenue", 'Miền Nam' AS "Region", 'M-new' AS "Machine", 'Return' AS "Stage", 'Snack' AS "Category")
  FROM sales_raw WHERE "OrderID" LIKE '%1'),
{sales_ctes('sales2_raw', 's2', with_raw=False)}, s2_ok AS (SELECT * FROM s2_clean WHERE {sales_fits()}), {_sales_tables('s2')},
ads2_raw AS (SELECT * REPLACE ('10' AS spend) FROM ads_raw WHERE o1 % 10 = 0), {later}"""
    both = lambda one: f"{one.format(k=1)} UNION {one.format(k=2)}" if second else one.format(k=1)
    newest = lambda key, one, two: f"SELECT * FROM {two} UNION ALL SELECT * FROM {one} WHERE ({key}) NOT IN (SELECT ({key}) FROM {two})" if second else f"SELECT * FROM {one}"
    names = {"customer_segment": "customer_segment", "department": "department", "machine": "machine", "information": "information"}
    ads_days = "SELECT date FROM ads_daily" + (" UNION SELECT date FROM ads2_daily" if second else "")
    ads_names = ads_days.replace("SELECT date", "SELECT campaign")
    stages = ", ".join(K.q(x) for x in STAGE_ORDER)
    tables = {
        "dim_region": both("SELECT region AS region_name FROM s{k}_ok WHERE region IS NOT NULL") + " UNION SELECT region FROM weather_clean",
        "dim_branch": newest("branch_name", "s1_branch", "s2_branch"), "dim_product": newest("product_name", "s1_product", "s2_product"),
        "dim_date": f"""SELECT date AS full_date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name,
  CAST(quarter(date) AS INTEGER) AS quarter, strftime(date, '%Y-%m') AS year_month FROM ({both("SELECT date FROM s{k}_ok")} UNION {ads_days} UNION SELECT date FROM weather_clean) d""",
        "dim_stage": f"""SELECT * FROM ({_SEED}) seed UNION ALL SELECT stage, 99, 'Other' FROM ({both("SELECT stage FROM s{k}_ok")}) x WHERE stage IS NOT NULL AND stage NOT IN ({stages})""".replace("UNION ALL SELECT stage, 99, 'Other' FROM (SELECT stage FROM s1_ok)", "UNION ALL SELECT DISTINCT stage, 99, 'Other' FROM (SELECT stage FROM s1_ok)"),
        "dim_channel": f"""SELECT DISTINCT channel AS channel_name, {K.channel_type('channel')} AS channel_type FROM ({both("SELECT channel FROM s{k}_ok")} UNION SELECT 'Facebook') x WHERE channel IS NOT NULL""",
        "dim_campaign": f"""SELECT DISTINCT campaign AS campaign_name, {K.campaign_type('campaign')} AS campaign_type FROM ({both("SELECT campaign FROM s{k}_ok")} UNION {ads_names}) x WHERE campaign IS NOT NULL""",
        "fact_marketing_sales": newest("order_id", "s1_fact", "s2_fact"), "fact_ad_spend": newest("full_date, campaign_name", "ads_fact", "ads2_fact"),
        "fact_weather_daily": "SELECT * FROM weather_fact",
    }
    for t, c in names.items():
        tables[f"dim_{t}"] = f"SELECT DISTINCT {c} AS {'segment_name' if t == 'customer_segment' else t + '_name'} FROM ({both(f'SELECT {c} FROM s{{k}}_ok')}) x WHERE {c} IS NOT NULL"
    return feeds + ", " + ",\n".join(f"w_{t} AS ({body})" for t, body in tables.items())


def _columns(table):
    from storeloom.contracts import ADS_FACT_DECIMALS, WEATHER_FACT_DECIMALS
    own = {"dim_region": ["region_name"], "dim_branch": ["branch_name", "region_name"], "dim_product": ["product_name", "category_name"],
           "dim_date": ["full_date", "year", "month", "month_name", "quarter", "year_month"], "dim_stage": ["stage_name", "stage_order", "stage_group"],
           "dim_channel": ["channel_name", "channel_type"], "dim_campaign": ["campaign_name", "campaign_type"], "dim_customer_segment": ["segment_name"],
           "dim_department": ["department_name"], "dim_machine": ["machine_name"], "dim_information": ["information_name"],
           "fact_marketing_sales": [d for _, d in SALES_FACT_COLUMNS] + ["target_gap", "target_achievement_rate", "roi_marketing_calc"],
           "fact_ad_spend": ["full_date", "campaign_name", "channel_name", *ADS_FACT_DECIMALS, "ctr", "cost_per_click"],
           "fact_weather_daily": ["full_date", "region_name", *WEATHER_FACT_DECIMALS]}
    return own[table]


def _tables_as_text(second):
    from storeloom.contracts import PRIMARY_KEYS
    body = "\nUNION ALL\n".join("SELECT '{}' AS table_name, concat_ws('|', {}) AS row FROM w_{}".format(
        t, ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in _columns(t)), t) for t in PRIMARY_KEYS)
    return f"WITH {warehouse_ctes(second)}\n{body}"


def _file_fed_load():
    """Counts of a load without the ads feed."""
    from storeloom.contracts import PRIMARY_KEYS
    ctes = warehouse_ctes(False).replace("UNION SELECT date FROM ads_daily ", "").replace("UNION SELECT campaign FROM ads_daily", "").replace(" UNION SELECT 'Facebook'", "")
    return f"WITH {ctes}\n" + "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM w_{t}" for t in PRIMARY_KEYS if t != "fact_ad_spend")


def _warehouse_constraints():
    from storeloom.contracts import ADS_FACT_DECIMALS, FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, VARCHAR_LIMITS, WEATHER_FACT_DECIMALS
    changed = {
        "fact_marketing_sales": """SELECT * REPLACE (CASE WHEN order_id % 1000 <> 1 THEN revenue END AS revenue, CASE WHEN order_id % 1000 = 2 THEN 'No such stage' ELSE stage_name END AS stage_name,
  CASE WHEN order_id % 1000 = 3 THEN repeat('x', 151) ELSE product_name END AS product_name) FROM (SELECT * FROM w_fact_marketing_sales UNION ALL SELECT * FROM w_fact_marketing_sales WHERE order_id % 1000 = 4)""",
        "dim_branch": "SELECT * REPLACE (CASE WHEN branch_name LIKE 'B%' THEN 'Nowhere' ELSE region_name END AS region_name) FROM w_dim_branch",
        "dim_date": "SELECT * REPLACE (CASE WHEN year_month <> '1995-02' THEN month END AS month) FROM w_dim_date",
        "dim_stage": "SELECT * REPLACE (CASE WHEN stage_name <> 'Click' THEN stage_order END AS stage_order) FROM w_dim_stage",
        "fact_ad_spend": "SELECT * REPLACE (CASE WHEN day(full_date) = 3 THEN 'Radio' ELSE channel_name END AS channel_name) FROM w_fact_ad_spend",
        "fact_weather_daily": "SELECT * REPLACE (CASE WHEN day(full_date) <> 7 THEN region_name END AS region_name) FROM w_fact_weather_daily",
    }
    ctes = ",\n".join(f"x_{t} AS ({changed.get(t, f'SELECT * FROM w_{t}')})" for t in PRIMARY_KEYS)
    rows = [("not_null", t, c, f"SELECT count(*) FROM x_{t} WHERE {c} IS NULL") for t, k in PRIMARY_KEYS.items() for c in dict.fromkeys([*k, *NOT_NULL.get(t, [])])]
    rows += [(f"max_length_{n}", t, c, f"SELECT count(*) FROM x_{t} WHERE length({c}) > {n}") for (t, c), n in VARCHAR_LIMITS.items()]
    rows += [("primary_key", t, ",".join(k), f"SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM x_{t} GROUP BY {', '.join(k)}) g") for t, k in PRIMARY_KEYS.items()]
    rows += [("foreign_key", t, c, f"SELECT count(*) FROM x_{t} WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM x_{p} p WHERE p.{k} = x_{t}.{c})") for (t, c), (p, k) in FOREIGN_KEYS.items()]
    feeds = [("fact_marketing_sales", "sales_clean", {d: (s, SALES_FACT_DECIMALS[d]) for s, d in SALES_FACT_COLUMNS if d in SALES_FACT_DECIMALS}),
             ("fact_ad_spend", "ads_daily", {c: (c, ps) for c, ps in ADS_FACT_DECIMALS.items()}), ("fact_weather_daily", "weather_clean", {c: (c, ps) for c, ps in WEATHER_FACT_DECIMALS.items()})]
    rows += [(f"fits_decimal({p},{sc})", t, d, f"SELECT count(*) FROM {feed} WHERE {s} IS NOT NULL AND TRY_CAST({s} AS DECIMAL({p},{sc})) IS NULL") for t, feed, own in feeds for d, (s, (p, sc)) in own.items()]
    body = "\nUNION ALL\n".join(f"SELECT '{ch}' AS check_name, '{t}' AS table_name, '{c}' AS column_name, CAST(({q}) AS BIGINT) AS violations" for ch, t, c, q in rows)
    return f"WITH {warehouse_ctes(False)},\n{ctes}\n{body}"


def _end_to_end():
    from storeloom.contracts import STAGE_ORDER as SO
    g = f"""WITH sales_raw AS ({sales_raw_sql()}), {gate_ctes()},
gated AS (SELECT * EXCLUDE (failed_rules, row_index) FROM gate WHERE failed_rules = ''),
{sales_ctes('gated', 'g', with_raw=False).replace('g_clean AS', 'g_every AS')},
g_clean AS (SELECT * FROM g_every WHERE {sales_fits()}), {ADS_CTES}, {WEATHER_CTES}"""
    d = lambda col: f"(SELECT count(DISTINCT {col}) FROM g_clean WHERE {col} IS NOT NULL)"
    stages = ", ".join(K.q(x) for x in SO)
    counts = [
        ("dim_region", "(SELECT count(*) FROM (SELECT region FROM g_clean WHERE region IS NOT NULL "
                       "UNION SELECT region FROM weather_clean))"),
        ("dim_branch", d("branch")),
        ("dim_product", d("product")),
        ("dim_date", "(SELECT count(*) FROM (SELECT date FROM g_clean UNION SELECT date FROM ads_daily "
                     "UNION SELECT date FROM weather_clean))"),
        ("dim_stage", f"({len(SO)} + (SELECT count(DISTINCT stage) FROM g_clean WHERE stage IS NOT NULL "
                      f"AND stage NOT IN ({stages})))"),
        ("dim_channel", "(SELECT count(*) FROM (SELECT channel FROM g_clean WHERE channel IS NOT NULL "
                        "UNION SELECT 'Facebook'))"),
        ("dim_customer_segment", d("customer_segment")),
        ("dim_campaign", "(SELECT count(*) FROM (SELECT campaign FROM g_clean WHERE campaign IS NOT NULL "
                         "UNION SELECT campaign FROM ads_daily))"),
        ("dim_department", d("department")),
        ("dim_machine", d("machine")),
        ("dim_information", d("information")),
        ("fact_marketing_sales", "(SELECT count(*) FROM g_clean)"),
        ("fact_ad_spend", "(SELECT count(*) FROM ads_daily)"),
        ("fact_weather_daily", "(SELECT count(*) FROM weather_clean)"),
    ]
    body = "\nUNION ALL\n".join(f"SELECT {K.q(t)} AS table_name, CAST({c} AS BIGINT) AS rows" for t, c in counts)
    return f"{g}\n{body}"


ORACLE.update({
    "text_scan_nulls": TEXT_SCAN_NULLS,
    "feed_arrays": FEED_ARRAYS,
    "upsert_update": UPSERT_UPDATE,
    "upsert_ignore": UPSERT_IGNORE,
    "upsert_idempotent": UPSERT_UPDATE,
    "fk_violations": FK_VIOLATIONS,
    "constraint_report": _constraint_report(),
    "quality_report": _quality_report(),
    "quality_samples": _quality_samples(),
    "quality_split": QUALITY_SPLIT,
    "upload_backup": UPLOAD_BACKUP,
    "preview": PREVIEW,
    "end_to_end_load": _end_to_end(),
    "file_summary": f"""WITH sales_raw AS ({sales_raw_sql()}) SELECT count(*) AS rows, 37 AS columns, '{",".join(K.SALES_CANON)}' AS header FROM sales_raw""",
    "file_status": f"""WITH sales_raw AS ({sales_raw_sql()}), a AS (SELECT count(*) AS rows, CAST(sum({K.to_decimal('"Revenue"', 38, 2)}) * 100 AS HUGEINT) AS cents FROM sales_raw)
SELECT rows, CAST(CAST({K.half_up_int('cents', 'CAST(10000000 AS HUGEINT)')} AS DECIMAL(37,0)) * 0.1 AS DECIMAL(38,1)) AS amount_m FROM a""",
    "file_fed_load": _file_fed_load(),
    "gate_decisions": f"""WITH sales_raw AS ({sales_raw_sql()}), {gate_ctes()}
SELECT 'as_it_is' AS upload, CASE WHEN count_if(failed_rules <> '') > 0 THEN 'blocked' ELSE 'loads' END AS outcome,
  CASE WHEN count_if(failed_rules <> '') > 0 THEN 0 ELSE count(*) END AS rows_to_load FROM gate
UNION ALL SELECT 'auto_filter', 'loads', count_if(failed_rules = '') FROM gate UNION ALL SELECT 'no_cost_column', 'hard_error', 0""",
    "loaded_tables": _tables_as_text(False),
    "reloaded_tables": _tables_as_text(True),
    "warehouse_constraints": _warehouse_constraints(),
    "sales_weather": f"""WITH {warehouse_ctes(False)}
SELECT f.*, b.region_name, p.category_name, w.temp_mean, w.temp_max, w.rain_mm FROM w_fact_marketing_sales f
LEFT JOIN w_dim_branch b ON b.branch_name = f.branch_name LEFT JOIN w_dim_product p ON p.product_name = f.product_name
LEFT JOIN w_fact_weather_daily w ON w.full_date = f.full_date AND w.region_name = b.region_name""",
})


# ---------------------------------------------------------------------------
# deliveries
# ---------------------------------------------------------------------------

def _stage_counts():
    feeds = {"sales": ("sales_raw", "(SELECT * FROM sales_typed WHERE drop_reason IS NULL)", "sales_clean", sales_fits()),
             "ads": ("ads_raw", "ads_kept", "ads_daily", "true"),
             "weather": ("weather_raw", "(SELECT * FROM weather_typed WHERE date IS NOT NULL AND region IS NOT NULL AND temp_mean IS NOT NULL)", "weather_clean", "true")}
    n = "(SELECT count(*) FROM {})".format
    rows = [(feed, stage, count) for feed, (raw, kept, clean, fits) in feeds.items() for stage, count in (
        ("staged", n(raw)), ("dropped", f"{n(raw)} - {n(kept)}"), ("merged", f"{n(kept)} - {n(clean)}"),
        ("quarantined", f"{n(clean)} - {n(f'{clean} WHERE {fits}')}"), ("loaded", n(f"{clean} WHERE {fits}")))]
    body = "\nUNION ALL\n".join(f"SELECT '{f}' AS feed, '{s}' AS stage, CAST({c} AS BIGINT) AS rows" for f, s, c in rows)
    return f"WITH {SALES_CTES}, {ADS_CTES}, {WEATHER_CTES}\n{body}"


def _repeated_deliveries():
    first = [(p, s) for p in ("sales", "ads", "weather") for s in ("begun", "done")]
    second = [("sales", "begun"), ("sales", "done"), ("ads", "begun")]  # the ads phase fails
    resumed = [("ads", "begun"), ("ads", "done")]
    values = ", ".join(f"('ledger', '{k}|{p}|{s}')" for k, (p, s) in enumerate(first + second + resumed, 1))
    return f"{_tables_as_text(True)}\nUNION ALL SELECT * FROM (VALUES {values}) AS ledger(table_name, row)"


def _replay_ctes():
    rules, warns = _rule_names()
    flags = ", ".join([*(f"r_{r}" for r in rules), *(f"w_{w}" for w in warns), "failed_rules", "row_index"])
    again = gate_ctes("mended").replace("gate0", "again0").replace("gate AS", "again AS")
    return f"""sales_raw AS ({sales_raw_sql()}), {gate_ctes()},
mended AS (SELECT * EXCLUDE ({flags}) REPLACE (coalesce(strftime({K.parse_date('"Date"')}, '%Y-%m-%d'), "Date") AS "Date",
  CASE WHEN "Category" IN ({', '.join(K.q(v) for v in VALID_CATEGORIES)}) THEN "Category" ELSE {K.q(VALID_CATEGORIES[0])} END AS "Category")
  FROM gate WHERE failed_rules <> ''),
{again}"""


_QUARANTINE_COLUMNS = '"OrderID", "Date", "Revenue", "Category", "Region", failed_rules'
ORACLE.update({
    "stage_counts": _stage_counts(),
    "repeated_deliveries": _repeated_deliveries(),
    "last_good_feed": f"WITH {WEATHER_CTES} SELECT *, 'r1' AS source_run FROM weather_fact",
    "quarantine_contents": f"""WITH {_replay_ctes()}
SELECT 'first' AS run, {_QUARANTINE_COLUMNS} FROM gate WHERE failed_rules <> ''
UNION ALL SELECT 'second', {_QUARANTINE_COLUMNS} FROM again WHERE failed_rules <> ''""",
    "quarantine_replay": f"""WITH {_replay_ctes()},
back AS (SELECT * FROM gate WHERE failed_rules = '' UNION ALL SELECT * FROM again WHERE failed_rules = ''),
{sales_ctes('back', 'b', with_raw=False)}
SELECT order_id, date, category, region, revenue FROM b_clean""",
})
