"""Scalar column functions on the literal fixtures."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from storeloom import functions as X
from storeloom.contracts import NA_TOKENS
from storeloom.operators.mapping import canonical_names, spelling
from tests.conftest import rows


def one(spark, values, expr_fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr_fn("v")).collect()]


def test_to_number_accepts_and_rejects(spark):
    good = [" 12 ", "1e3", "+5", ".5", "5."]
    assert one(spark, good, X.to_number) == [12.0, 1000.0, 5.0, 0.5, 5.0]
    bad = ["1,234", "1_000", "0x10", "True", "5d", "5f", "1e400", "inf", "nan", "", None]
    assert one(spark, bad, X.to_number) == [None] * len(bad)


def test_to_decimal_rounds_half_up_and_overflow_is_null(spark):
    assert one(spark, ["1.005", "-1.005", "1e17", "12"], lambda c: X.to_decimal(c, 18, 2)) == [
        Decimal("1.01"), Decimal("-1.01"), None, Decimal("12.00")]


def test_to_id_truncates_toward_zero(spark):
    assert one(spark, ["12.7", "-12.7", "42", " 7 ", "abc"], X.to_id) == [12, -12, 42, 7, None]


def test_reader_null_tokens(spark):
    assert one(spark, NA_TOKENS, X.reader_nulls) == [None] * len(NA_TOKENS)
    kept = ["na", "none", "-", " "]
    assert one(spark, kept, X.reader_nulls) == kept


def test_clean_text_strips_unicode_blanks_then_nulls_tokens(spark):
    vals = [" \ta ", " nan ", "None", "NA", "", "\n"]
    assert one(spark, vals, X.clean_text) == ["a", None, None, "NA", None, None]
    assert one(spark, [" \ta  "], lambda c: F.length(X.strip(c))) == [1]


def test_parse_date_precedence(spark):
    vals = ["2024-1-5", "2024-01-05", "05/01/2024", "05-01-2024", "05.01.2024", "20240506",
            "12/31/2024", "2021-01-02 00:00:00", "2024-02-30", "2024-13-01", "junk", "5/1/24", None]
    jan5 = dt.date(2024, 1, 5)
    assert one(spark, vals, X.parse_date) == [
        jan5, jan5, jan5, jan5, jan5, dt.date(2024, 5, 6), dt.date(2024, 12, 31), dt.date(2021, 1, 2),
        None, None, None, None, None]


def test_strict_date(spark):
    vals = ["2024-1-5", "2024-02-30", "05/01/2024", " 2024-01-05", None]
    assert one(spark, vals, X.is_strict_iso_date) == [True, False, False, False, False]


def test_calendar_columns(spark):
    df = spark.createDataFrame([(dt.date(2024, 5, 17),)], "d date")
    assert rows(df.select(*X.calendar_columns("d"))) == [(2024, 5, "May", 2, "2024-05")]


def test_lookups(spark):
    assert one(spark, [" Tet_Promotion ", "unknown"], X.campaign_from_slug) == ["Tet Promotion", None]
    assert one(spark, ["Tet Promotion", "Zzz", None], X.campaign_type) == ["Seasonal", "Other", None]
    assert one(spark, ["TV", "Radio", None], X.channel_type) == ["Broadcast", "Other", None]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(Decimal("3"), Decimal("640")), (Decimal("3"), Decimal("0")), (Decimal("1"), None)],
                               "n decimal(18,2), d decimal(18,2)")
    assert [r[0] for r in df.select(X.safe_ratio("n", "d")).collect()] == [Decimal("0.004688"), None, None]


def test_headers():
    assert spelling(" Doanh_Thu ") == "doanhthu"
    assert spelling("Ngày") == "ngy"
    names = canonical_names(["Doanh_Thu", "ROI_Marketing", "Ngày", "Campaign", "campaign"])
    assert names == ["revenue", "roi_marketing", "Ngày", "Campaign", "campaign"]


def test_later_header_wins_when_two_normalise_alike():
    assert canonical_names(["Order ID", "order_id"]) == ["Order ID", "order_id"]
    assert canonical_names(["OrderID", "Order-ID"]) == ["OrderID", "order_id"]


def test_best_alias_wins_before_the_later_header():
    assert canonical_names(["promotion_campaign", "campaign name", "PromotionCampaign "]) == ["promotion_campaign", "campaign name", "campaign"]


def test_ids_are_exact_over_bigint(spark):
    got = one(spark, ["1234567890123456789", "1234567890123456788", "+9223372036854775807", "9223372036854775808", "-9223372036854775808",
                      "1e3", "12.9", "1e19", "x", "--5"], X.to_id)
    assert got == [1234567890123456789, 1234567890123456788, 9223372036854775807, None, -9223372036854775808, 1000, 12, None, None, None]


def test_strip_takes_all_unicode_space(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert one(spark, [f"{s}a{s}b{s}{s}" for s in spaces], X.strip) == [f"a{s}b" for s in spaces]
    assert one(spark, ["\u200ba\ufeff"], X.strip) == ["\u200ba\ufeff"]
