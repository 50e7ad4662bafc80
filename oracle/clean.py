"""DuckDB SQL for the cleaning rules, written independently of the Spark code."""

from storeloom.contracts import (
    CAMPAIGN_SLUG_MAP, CAMPAIGN_TYPE_MAP, CHANNEL_TYPE, SALES_RAW_COLUMNS, STAGE_ORDER,
)

NUM_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
ISO_RE = r"^(\d{4}-\d{1,2}-\d{1,2})([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
DMY_RE = r"^\d{1,2}[/.-]\d{1,2}[/.-]\d{4}$"


def q(s):
    return "'" + str(s).replace("'", "''") + "'"


def strip(x):
    """White space by Unicode property (separators) and the control characters that count as such."""
    space = r"[\x09-\x0D\x1C-\x1F\x{85}\p{Z}]+"
    return f"regexp_replace(regexp_replace({x}, '^{space}', ''), '{space}$', '')"


def clean_text(x):
    s = strip(x)
    return f"CASE WHEN {s} IN ('', 'nan', 'None') THEN NULL ELSE {s} END"


def to_number(x):
    s = strip(x)
    d = f"TRY_CAST({s} AS DOUBLE)"
    return f"CASE WHEN regexp_matches({s}, '{NUM_RE}') AND isfinite({d}) THEN {d} END"


def to_decimal(x, p, s_):
    s = strip(x)
    return f"CASE WHEN regexp_matches({s}, '{NUM_RE}') THEN TRY_CAST({s} AS DECIMAL({p},{s_})) END"


def to_id(x):
    s = strip(x)
    n = to_number(x)
    # whole numbers through a 38-digit integer, others through their truncated double; out of range is NULL
    whole = f"TRY_CAST(TRY_CAST({s} AS HUGEINT) AS BIGINT)"
    return (f"CASE WHEN ltrim(translate({s}, '0123456789', ''), '+-') = '' AND regexp_matches({s}, '^[+-]?[0-9]') THEN {whole} "
            f"ELSE TRY_CAST(trunc({n}) AS BIGINT) END")


def parse_date(x):
    t = strip(x)
    slashed = f"regexp_replace({t}, '[.-]', '/', 'g')"
    return (f"CASE WHEN regexp_matches({t}, '{ISO_RE}') "
            f"THEN CAST(try_strptime(regexp_extract({t}, '{ISO_RE}', 1), '%Y-%m-%d') AS DATE) "
            f"WHEN regexp_matches({t}, '{DMY_RE}') THEN CAST(coalesce(try_strptime({slashed}, '%d/%m/%Y'), "
            f"try_strptime({slashed}, '%m/%d/%Y')) AS DATE) "
            f"WHEN regexp_matches({t}, '^\\d{{8}}$') THEN CAST(try_strptime({t}, '%Y%m%d') AS DATE) END")


def strict_date(x):
    return (f"coalesce(regexp_matches({x}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') "
            f"AND try_strptime({x}, '%Y-%m-%d') IS NOT NULL, false)")


def map_case(x, mapping, default="NULL"):
    arms = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {x} {arms} ELSE {default} END"


def campaign_from_slug(x):
    return map_case(f"lower({strip(x)})", CAMPAIGN_SLUG_MAP)


def with_default(x, mapping):
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE {map_case(x, mapping, q('Other'))} END"


def campaign_type(x):
    return with_default(x, CAMPAIGN_TYPE_MAP)


def channel_type(x):
    return with_default(x, CHANNEL_TYPE)


def half_up_int(n_int, d_int):
    """round-half-away-from-zero of n/d for integer expressions."""
    return (f"(sign({n_int}) * sign({d_int}) * ((abs({n_int}) * 2 + abs({d_int})) // (2 * abs({d_int}))))")


def ratio(n, d, sn, sd, scale=6, out="DECIMAL(18,6)"):
    """CASE WHEN d IS NULL OR d = 0 THEN NULL ELSE n/d END, exact, rounded half-up to ``scale``."""
    ni = f"CAST({n} * {10 ** sn} AS HUGEINT)"
    di = f"CAST({d} * {10 ** sd} AS HUGEINT)"
    shift = scale + sd - sn
    num = f"({ni} * CAST({10 ** shift} AS HUGEINT))" if shift >= 0 else ni
    qi = half_up_int(num, di)
    return (f"CASE WHEN {d} IS NULL OR {d} = 0 THEN NULL ELSE "
            f"TRY_CAST(CAST({qi} AS DECIMAL(38,0)) * CAST({q('0.' + '0' * (scale - 1) + '1')} AS DECIMAL(38,{scale})) AS {out}) END")


# canonical column of each raw sales header (same file order)
SALES_CANON = {
    "OrderID": "order_id", "Date": "date", "Year": "year", "Month": "month", "Region": "region",
    "Branch": "branch", "Department": "department", "Product": "product", "Category": "category",
    "Stage": "stage", "Channel": "channel", "Information": "information", "Machine": "machine",
    "Quantity": "quantity", "Revenue": "revenue", "Cost": "cost", "Profit": "profit",
    "ProfitMargin": "profit_margin", "InventoryLevel": "inventory_level", "Calls": "calls",
    "WaitingTime": "waiting_time", "Budget": "budget", "Target": "target",
    "RawMaterialCost": "raw_material_cost", "LaborCost": "labor_cost",
    "LogisticsCost": "logistics_cost", "MarketingCost": "marketing_cost", "UnitCost": "unit_cost",
    "RevenuePerUnit": "revenue_per_unit", "ROI_Marketing": "roi_marketing",
    "ConversionProxy": "conversion_proxy", "CostPerMachineUnit": "cost_per_machine_unit",
    "RegionProfitShare": "region_profit_share", "MarketSize": "market_size",
    "MarketShare": "market_share", "CustomerSegment": "customer_segment",
    "PromotionCampaign": "campaign",
}
assert list(SALES_CANON) == SALES_RAW_COLUMNS

TEXT = {"region", "branch", "department", "product", "category", "stage", "channel",
        "information", "machine", "customer_segment", "campaign"}

STAGE_NAMES = list(STAGE_ORDER)
