"""Fee logic: three-valued double-count filter and conservation of sums."""

from decimal import Decimal

from pyspark.sql import functions as F

from marketlens import vocab
from marketlens.functions.fees import not_double_counted
from marketlens.operators import fees as fo

C, D = vocab.FEE_GROUP_COMMISSION, vocab.FEE_GROUP_DELIVERY


def fee_rows(spark):
    rows = [("o1", "finance_api", C, "1"), ("o1", "finance_api", None, "2"), ("o1", None, C, "4"),
            ("o1", "posting_financial", None, "8"), ("o1", "posting_financial", D, "16"),
            ("o1", "finance_report", vocab.FEE_GROUP_SALES, "32"), ("o2", "finance_api", C, "64")]
    return spark.createDataFrame(rows, "order_id string, source string, fee_group string, amount string") \
        .withColumn("amount", F.col("amount").cast("decimal(18,4)"))


def test_three_valued_filter(spark):
    kept = sorted(int(r[0]) for r in fee_rows(spark).filter(not_double_counted()).select("amount").collect())
    # dropped: finance_api+commission (1, 64), finance_api+NULL group (2), NULL source+commission (4)
    assert kept == [8, 16, 32]


def test_breakdown_conservation(spark):
    orders = spark.createDataFrame([("o1", "100"), ("o2", "5"), ("o3", "7")], "order_id string, revenue string") \
        .withColumn("revenue", F.col("revenue").cast("decimal(18,4)"))
    out = {r["order_id"]: r for r in fo.recalc_order_finance(orders, fee_rows(spark)).collect()}
    o1 = out["o1"]
    assert o1["fees_total"] == Decimal("56")                       # 8 + 16 + 32
    assert o1["delivery_fee"] == Decimal("16") and o1["other_fee"] == Decimal("32")
    buckets = sum(o1[c] for c, _ in vocab.FEE_BUCKETS) + o1["other_fee"]
    assert buckets + Decimal("8") == o1["fees_total"]              # NULL-group amount is in no bucket
    assert o1["profit"] == Decimal("156") and o1["payout"] == Decimal("156")
    assert o1["sales_report"] == Decimal("32")
    assert out["o2"]["fees_total"] is None                         # only a double-counted row: not updated
    assert out["o3"]["payout"] == Decimal("7")                     # payout is set for every order
