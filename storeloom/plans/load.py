"""The load: staging -> clean -> conformed dimensions -> facts (R1), behind the gate (R2).

Order and precedence follow the original: sales first with DO UPDATE for
its dimensions, then ads and weather with DO NOTHING for theirs; each
table is published after its checks, dimensions before facts.
"""

from __future__ import annotations

import datetime
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storeloom.contracts import (
    ADS_CHANNEL, ADS_FACT_DECIMALS, ADS_RAW_COLUMNS, FOREIGN_KEYS, PRIMARY_KEYS, SALES_FACT_COLUMNS, SALES_FACT_DECIMALS, SALES_RAW_COLUMNS,
    VARCHAR_LIMITS, WEATHER_FACT_DECIMALS, WEATHER_RAW_COLUMNS,
)
from storeloom.operators import dims as D
from storeloom.operators import facts as FX
from storeloom.operators import quality as V
from storeloom.operators.constraints import asserted, reject_broken_keys, unique_rows, violations_of
from storeloom.operators.upsert import insert_if_absent, upsert_update
from storeloom.plans import clean as C
from storeloom.plans.warehouse import Homes, Warehouse, month_of
from storeloom.session import CODEC, freed_shuffles, passing_folder
from storeloom.sources.staging import land, path_exists
from storeloom.sources.text import read_text_table

#: Dimensions that refer to another one: published after the others.
CHILDREN = {t for t, _ in FOREIGN_KEYS if t.startswith("dim_")}
#: Facts without an insert time.
UNSTAMPED = {"fact_weather_daily"}


#: Limits that a cleaned feed row must meet: (column -> length), (column -> decimal type).
SALES_LIMITS = ({s: VARCHAR_LIMITS["fact_marketing_sales", d] for s, d in SALES_FACT_COLUMNS if ("fact_marketing_sales", d) in VARCHAR_LIMITS}
                | {"region": VARCHAR_LIMITS["dim_region", "region_name"], "category": VARCHAR_LIMITS["dim_product", "category_name"]},
                {s: SALES_FACT_DECIMALS[d] for s, d in SALES_FACT_COLUMNS if d in SALES_FACT_DECIMALS})
ADS_LIMITS = ({"campaign": VARCHAR_LIMITS["fact_ad_spend", "campaign_name"]}, ADS_FACT_DECIMALS)
WEATHER_LIMITS = ({"region": VARCHAR_LIMITS["fact_weather_daily", "region_name"]}, WEATHER_FACT_DECIMALS)
VIOLATIONS = "violations"


def _checked(wh: Warehouse, table: str, df: DataFrame) -> DataFrame:
    """The rows to publish, in a plan that raises at the first one that breaks NOT NULL, a length or a foreign key."""
    return asserted(df, table, _parents(wh, table))


def _parents(wh: Warehouse, table: str) -> dict[str, DataFrame]:
    return {p: wh.read(p) for (t, _), (p, _) in FOREIGN_KEYS.items() if t == table}


def _loadable(wh: Warehouse, feed: str, clean: DataFrame, limits: tuple[dict, dict], run_id: str, root: str) -> DataFrame:
    """The rows of a cleaned feed that meet the contract, from a snapshot landed under ``root``; the others go to the quarantine.

    A database would reject the whole load at the first such row; here the rows
    that can't be stored are kept apart with the reasons, and the rest is loaded.
    """
    flagged = land(clean.withColumn(VIOLATIONS, violations_of(*limits)), f"{root}/{feed}")
    bad = flagged.where(F.size(VIOLATIONS) > 0)
    if bad.limit(1).count():
        quarantine(bad, f"{wh.root}/constraints/{feed}", run_id)
    return flagged.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)


def touched_parts(wh: Warehouse, table: str, batch: DataFrame) -> tuple[list[str], list[str]]:
    """Months a fact upsert must rewrite: the batch's, plus, when the key does not contain the date
    (sales), those where its keys live now; and which of the latter the batch leaves without rows.

    Both are one string per calendar month, bounded lists. No fact row is read for
    the first (``Homes``), and only months that the batch brings nothing to for the second.
    """
    keys = PRIMARY_KEYS[table]
    own = {r.m for r in batch.select(month_of().alias("m")).distinct().collect() if r.m is not None}
    if "full_date" in keys:
        return sorted(own), []
    homes = Homes(wh, table, keys[0])
    known = homes.of(batch, month_of())
    left = sorted({r.part for r in known.select("part").distinct().collect()} - own) if known is not None and wh.exists(table) else []
    homes.add(batch, month_of())
    if not left:
        return sorted(own), []
    stay = wh.read(table, parts=left).join(batch.select(*keys), keys, "left_anti").select(month_of().alias("m")).distinct().collect()
    return sorted(own | set(left)), sorted(set(left) - {r.m for r in stay})


def _merge_fact(wh: Warehouse, table: str, batch: DataFrame) -> None:
    """K3 into a month-partitioned fact: rewrite only the touched months.

    Keys are checked ahead, over their columns alone: whole rows are joined with the
    target's, if there are any, and dealt to their months, and that is all.
    """
    keys = PRIMARY_KEYS[table]
    stamped = table not in UNSTAMPED
    first = not wh.exists(table)
    with freed_shuffles(wh.spark), passing_folder(wh.spark, f"merged-{table}") as root:
        # the target's rows passed this when they were published, and a parent never loses a key
        reject_broken_keys(batch, table, _parents(wh, table))
        touched, emptied = touched_parts(wh, table, batch)
        if first:  # nothing to join
            merged = _with_created(batch) if stamped else batch
        else:
            merged = upsert_update(wh.read(table, parts=touched), batch, keys, created_at="created_at" if stamped else None)
        wh.publish(table, asserted(merged, table, {}), month_of(), emptied, None if first else f"{root}/rows")


def _publish_dimension(wh: Warehouse, table: str, batches: list[tuple[DataFrame, bool]]) -> None:
    """Apply the batches in feed order (DO UPDATE or DO NOTHING each), publish once."""
    keys = PRIMARY_KEYS[table]
    state = wh.read(table, schema=batches[0][0].schema)
    for batch, update in batches:
        batch = unique_rows(batch, table)
        state = (upsert_update(state, batch, keys, created_at=None) if update
                 else insert_if_absent(state, batch, keys, created_at=None))
    wh.publish(table, _checked(wh, table, state))


def _with_created(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.current_timestamp())


def dimension_batches(sales: DataFrame, ads: DataFrame | None, weather: DataFrame | None) -> dict:
    """table -> [(batch, DO UPDATE?)] in load order: sales first (DO UPDATE for its
    attribute dimensions, DO NOTHING for name-only ones), then ads, then weather
    (DO NOTHING)."""
    dims = D.sales_dimensions(sales)
    plan = {t: [(dims[t], True)] for t in ("dim_date", "dim_stage", "dim_channel", "dim_campaign",
                                          "dim_branch", "dim_product")}
    plan.update({t: [(dims[t], False)] for t in D.NAME_DIMS})
    for phase, feed in (("ads", ads), ("weather", weather)):
        if feed is not None:
            for table, batches in phase_batches(phase, feed).items():
                plan[table] += batches
    return plan


def phase_batches(phase: str, rows: DataFrame) -> dict:
    """table -> [(batch, DO UPDATE?)] that one phase (sales, ads or weather) brings to the dimensions."""
    if phase == "sales":
        return dimension_batches(rows, None, None)
    if phase == "ads":
        channel = rows.sparkSession.createDataFrame([ADS_CHANNEL], "channel_name string, channel_type string")
        return {"dim_date": [(D.dim_date(rows.select("date")), False)], "dim_campaign": [(D.dim_campaign(rows), False)], "dim_channel": [(channel, False)]}
    return {"dim_date": [(D.dim_date(rows.select("date")), False)], "dim_region": [(D.distinct_names(rows, "region", "region_name"), False)]}


def load_sales(wh: Warehouse, clean: DataFrame) -> None:
    """The sales phase alone: its dimensions, then its fact."""
    with passing_folder(wh.spark, "clean") as root:
        clean = _loadable(wh, "sales", clean, SALES_LIMITS, new_run_id(), root)
        batches = dimension_batches(clean, None, None)
        for table in sorted(batches, key=lambda t: t in CHILDREN):
            _publish_dimension(wh, table, batches[table])
        _merge_fact(wh, "fact_marketing_sales", FX.sales_fact(clean))


def _in_parallel(fn, items, threads: int) -> None:
    """Run independent publishes as concurrent Spark jobs from driver threads."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        for f in [pool.submit(fn, *item) for item in items]:
            f.result()


def run_load(spark: SparkSession, warehouse_root: str, sales_raw: DataFrame,
             ads_raw: DataFrame | None = None, weather_raw: DataFrame | None = None,
             threads: int = 4) -> Warehouse:
    """Load the three feeds; a missing optional feed (None) is skipped.

    Each cleaned feed is landed once with what its rows violate, and feeds a dozen
    table writes from there. Every dimension folds its batches from all feeds in
    load order into one publish; parents are published before children and
    dimensions before facts (K12), independent tables concurrently. A publish
    whose rows violate the contract raises and leaves the previous version.
    """
    wh = Warehouse(spark, warehouse_root)
    run_id = new_run_id()
    with passing_folder(spark, "clean") as root:
        sales = _loadable(wh, "sales", C.clean_sales(sales_raw), SALES_LIMITS, run_id, root)
        ads = _loadable(wh, "ads", C.clean_ads(ads_raw), ADS_LIMITS, run_id, root) if ads_raw is not None else None
        weather = _loadable(wh, "weather", C.clean_weather(weather_raw), WEATHER_LIMITS, run_id, root) if weather_raw is not None else None
        batches = dimension_batches(sales, ads, weather)
        for wave in (set(batches) - CHILDREN, set(batches) & CHILDREN):
            _in_parallel(lambda t, b: _publish_dimension(wh, t, b), [(t, b) for t, b in batches.items() if t in wave], threads)
        facts = [("fact_marketing_sales", FX.sales_fact(sales))]
        if ads is not None:
            facts.append(("fact_ad_spend", FX.ads_fact(ads)))
        if weather is not None:
            facts.append(("fact_weather_daily", FX.weather_fact(weather)))
        _in_parallel(lambda t, b: _merge_fact(wh, t, b), facts, threads)
    return wh


def load_files(spark: SparkSession, warehouse_root: str, sales: str, ads: str | None = None, weather: str | None = None) -> Warehouse:
    """R1 from landed delimited files: each against its staging contract (K2), in file order; optional files that are missing are skipped."""
    def feed(path: str, contract: list[str]) -> DataFrame:
        return read_text_table(spark, path, contract, ordinal=C.ORDINAL)

    def optional(path: str | None, contract: list[str]) -> DataFrame | None:
        return feed(path, contract) if path and path_exists(spark, path) else None
    return run_load(spark, warehouse_root, feed(sales, SALES_RAW_COLUMNS), optional(ads, ADS_RAW_COLUMNS), optional(weather, WEATHER_RAW_COLUMNS))


def gate(sales_raw: DataFrame, auto_filter: bool) -> tuple[DataFrame | None, DataFrame, DataFrame]:
    """(rows to load or None when blocked, flagged rows, rejected rows).

    A missing required header raises ``HardError`` (V1). With row errors the
    load proceeds only when ``auto_filter`` is set, and then with the clean rows.
    """
    flagged = V.flag(sales_raw)
    clean, rejected = V.split(flagged)
    has_errors = rejected.limit(1).count() > 0
    if not has_errors:
        return flagged.drop("failed_rules", "warnings"), flagged, rejected
    return (clean if auto_filter else None), flagged, rejected


def new_run_id() -> str:
    """Unique, and sorted by time."""
    return datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%dT%H%M%S") + f"-{uuid.uuid4().hex[:12]}"


def quarantine(rejected: DataFrame, root: str, run_id: str) -> str:
    """K8: rejected rows with their original columns and ``failed_rules``, one folder per run (never overwritten)."""
    path = f"{root.rstrip('/')}/quarantine/run={run_id}"
    with freed_shuffles(rejected.sparkSession):
        rejected.write.mode("errorifexists").option("compression", CODEC).parquet(path)
    return path


def accept_upload(wh: Warehouse, clean: DataFrame, run_id: str) -> None:
    """K9: keep a copy of the accepted upload before this run, then put the new one in its place."""
    wh.backup("upload_sales", run_id)
    wh.publish("upload_sales", clean)


def gate_and_load(spark: SparkSession, warehouse_root: str, sales_raw: DataFrame,
                  ads_raw: DataFrame | None = None, weather_raw: DataFrame | None = None,
                  auto_filter: bool = True, run_id: str | None = None) -> tuple[Warehouse | None, dict]:
    """R2: gate the upload, quarantine rejects (K8), publish the accepted upload and keep a copy
    of the previous one (K9), then load from it (R1).

    The counts (G9) are observed while the flagged upload is landed, so the gate
    decision (V13) costs no extra pass. Returns the warehouse (None when the
    gate blocks: row errors and no auto-filter) and the counts.
    """
    run_id = run_id or new_run_id()
    wh = Warehouse(spark, warehouse_root)
    seen = Observation(f"upload-{run_id}")
    # landed once: the rules are evaluated once, and both writes below read the snapshot
    with passing_folder(spark, "flagged-upload") as root:
        flagged = land(V.flag(sales_raw).observe(
            seen, F.count(F.lit(1)).alias("upload_rows"),
            F.count_if(F.size("failed_rules") > 0).alias("rejected_rows")), f"{root}/rows")
        clean, rejected = V.split(flagged)
        quarantine(rejected, warehouse_root, run_id)
        counts = dict(seen.get)
        counts["accepted_rows"] = counts["upload_rows"] - counts["rejected_rows"]
        if counts["rejected_rows"] and not auto_filter:
            return None, counts
        accept_upload(wh, clean, run_id)
    run_load(spark, warehouse_root, wh.read("upload_sales"), ads_raw, weather_raw)
    return wh, counts


def table_counts(wh: Warehouse, tables: list[str]) -> DataFrame:
    """Rows per published table, as one small DataFrame."""
    frames = [wh.read(t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows")
              for t in tables]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


ALL_TABLES = ["dim_region", "dim_branch", "dim_product", "dim_date", "dim_stage", "dim_channel",
              "dim_customer_segment", "dim_campaign", "dim_department", "dim_machine",
              "dim_information", "fact_marketing_sales", "fact_ad_spend", "fact_weather_daily"]
