"""Edge rows for the scalar functions (NULL, blank, NBSP, bad text, case)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlens import functions as fn
from marketlens import vocab

NB = " "


def one_col(spark, values, expr, t="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {t}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_money_lenient(spark):
    vals = [None, "", "0", "1 234,56", f"1{NB}234,56", "1,234.56", "1e3", "abc"]
    out = one_col(spark, vals, fn.money_lenient)
    assert out == [Decimal("0"), Decimal("0"), Decimal("0"), Decimal("1234.56"), Decimal("0"), Decimal("0"),
                   Decimal("1000"), Decimal("0")]


def test_money_strict_raises_on_bad_text(spark):
    assert one_col(spark, [None, "1 234,56", "-5"], fn.money_strict) == [Decimal("0"), Decimal("1234.56"), Decimal("-5")]
    with pytest.raises(Exception):
        one_col(spark, [""], fn.money_strict)
    with pytest.raises(Exception):
        one_col(spark, ["abc"], fn.money_strict)


def test_money_localized(spark):
    out = one_col(spark, [None, "", "  ", f"1{NB}811,00", " 1 811,00 "], fn.money_localized)
    assert out == [Decimal("0"), Decimal("0"), Decimal("0"), Decimal("1811"), Decimal("1811")]
    with pytest.raises(Exception):
        one_col(spark, ["n/a"], fn.money_localized)
    daily = lambda c: fn.money_localized(c, strip_nbsp=False)
    assert one_col(spark, [None, "", "1 811,00"], daily) == [Decimal("0"), Decimal("0"), Decimal("1811")]
    with pytest.raises(Exception):
        one_col(spark, [f"1{NB}811,00"], daily)


def test_money_report(spark):
    assert one_col(spark, [None, "NaN", "12,5"], fn.money_report) == [Decimal("0"), Decimal("0"), Decimal("12.5")]


def test_customer_from_posting(spark):
    vals = [None, " ", "47-02-1", "a_b_c", "a_b-c", "plain", "-x"]
    assert one_col(spark, vals, fn.customer_from_posting) == [
        vocab.UNKNOWN_CUSTOMER, vocab.UNKNOWN_CUSTOMER, "47", "a", "a_b", "plain", ""]
    assert one_col(spark, [None, "", " 47-1", "plain"], fn.customer_from_posting_simple) == ["", "", " 47", "plain"]


def test_date_any(spark):
    vals = ["2025-12-05", "05.12.2025", "5.12.2025", "05/12/2025", "", None]
    out = one_col(spark, vals, fn.date_any)
    import datetime as dt
    d = dt.date(2025, 12, 5)
    assert out == [d, d, d, d, None, None]
    with pytest.raises(Exception):
        one_col(spark, ["2025/12/05"], fn.date_any)
    assert one_col(spark, ["2025/12/05", "2025-12-05T10:11:12Z"], fn.date_any_lenient) == [None, d]


def test_fee_group_classify(spark):
    vals = ["КОМИССИЯ за продажу", "Вознаграждение за доставку", "LastMile", "last mile courier", "Оплата за клик",
            "MarketplaceRedistributionOfAcquiringOperation", None, "Хранение"]
    out = one_col(spark, vals, fn.fee_group_classify)
    assert out == [vocab.FEE_GROUP_COMMISSION, vocab.FEE_GROUP_COMMISSION, vocab.FEE_GROUP_OTHER,
                   vocab.FEE_GROUP_DELIVERY, vocab.FEE_GROUP_ADS, vocab.FEE_GROUP_ACQUIRING, vocab.FEE_GROUP_OTHER,
                   vocab.FEE_GROUP_OTHER]


def test_fee_name_normalize(spark):
    out = one_col(spark, [None, "", "MarketplaceServiceItemDirectFlowLogistic", "Other"], fn.fee_name_normalize)
    assert out == ["UNKNOWN", "UNKNOWN", vocab.FEE_NAME_MAP["MarketplaceServiceItemDirectFlowLogistic"], "Other"]


def test_fee_uid_nulls_and_zero_sku(spark):
    import hashlib
    df = spark.createDataFrame([("finance_api", None, 0), ("finance_api", "o-1", 12)], "s string, o string, k bigint")
    n = F.lit(None).cast("string")
    out = [r[0] for r in df.select(fn.fee_uid(F.col("s"), F.col("o"), n, n, n, n, n, F.col("k"))).collect()]
    expect = [hashlib.md5("finance_api|||||||".encode()).hexdigest(),
              hashlib.md5("finance_api|o-1||||||12".encode()).hexdigest()]
    assert out == expect


def test_posting_id_and_ints(spark):
    assert one_col(spark, [" 1-2-3 ", "1-2", "a-2-3", None], fn.posting_id_normalize) == ["1-2-3", None, None, None]
    assert one_col(spark, ["12", " 12 ", "12.5", "abc", None], fn.int_lenient) == [12, 12, None, None, None]


def test_first_present(spark):
    df = spark.createDataFrame([("", None, "c"), (None, "b", "c"), ("", "", "")], "a string, b string, c string")
    out = [r[0] for r in df.select(fn.first_present("a", "b", "c", default="0")).collect()]
    assert out == ["c", "b", "0"]


def test_iso_z(spark):
    df = spark.sql("select timestamp_ntz'2025-01-02 03:04:05' as t")
    assert df.select(fn.iso_z("t")).first()[0] == "2025-01-02T03:04:05Z"
    assert spark.sql("select '2025-01-02T03:04:05Z' as s").select(fn.text_to_ntz("s")).first()[0].hour == 3


def test_parsers_do_not_depend_on_ansi_mode(spark):
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert one_col(spark, ["12.5", " 12 "], fn.int_lenient) == [None, 12]
        assert one_col(spark, ["abc"], fn.money_lenient) == [Decimal("0")]
        with pytest.raises(Exception):
            one_col(spark, ["abc"], fn.money_strict)
        with pytest.raises(Exception):
            one_col(spark, ["2025/12/05"], fn.date_any)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)
