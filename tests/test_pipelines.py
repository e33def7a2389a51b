"""Batch plans and streams: idempotence and replay safety."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from conftest import SMALL
from marketlens import schemas, vocab
from marketlens.functions.money import money_lenient
from marketlens.operators import flatten, resolve, upsert
from marketlens.plans import batch
from marketlens.plans.inputs import Inputs
from marketlens.session import scratch_path
from marketlens.sources import accruals, json_docs
from marketlens.sources.store import PART, Store, read_by_day, upsert_by_day


def snapshot(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_batch_orders_twice_equals_once(spark):
    inp = Inputs(spark, SMALL)
    wh = Store(spark, scratch_path(spark, "wh-test"))
    args = ("1995-01-01", "2002-01-01", "2025-01-01 00:00:00", inp.products())
    batch.batch_orders(wh, inp.postings(), *args)
    cols = ["order_id", "customer_id", "revenue", "fees_total", "payout", "profit", "is_first_order", "missing"]
    once = snapshot(wh.read("orders"), cols)
    fees_once = wh.read("order_fee_items").count()
    batch.batch_orders(wh, inp.postings(), *args)
    assert snapshot(wh.read("orders"), cols) == once
    assert wh.read("order_fee_items").count() == fees_once


def test_batch_finance_twice_equals_once(spark):
    inp = Inputs(spark, SMALL)
    wh = Store(spark, scratch_path(spark, "wh-test"))
    batch.batch_orders(wh, inp.postings(), "1995-01-01", "2002-01-01", "2025-01-01 00:00:00", inp.products())
    batch.batch_finance(wh, inp.finance_operations(), "1995-01-01", "2002-01-01")
    cols = ["order_id", "fees_total", "payout", "profit"]
    once = snapshot(wh.read("orders"), cols)
    n = wh.read("order_fee_items").groupBy("source").count().collect()
    batch.batch_finance(wh, inp.finance_operations(), "1995-01-01", "2002-01-01")
    assert snapshot(wh.read("orders"), cols) == once
    assert sorted(wh.read("order_fee_items").groupBy("source").count().collect()) == sorted(n)


def test_relinking_replaces_unlinked_rows(spark):
    """A finance row first loaded without its order, then re-delivered once
    the order exists, replaces the unlinked copy (no double count)."""
    inp = Inputs(spark, SMALL)
    wh = Store(spark, scratch_path(spark, "wh-test"))
    ops = inp.finance_operations()
    batch.batch_finance(wh, ops, "1995-01-01", "2002-01-01")          # no orders yet: all unlinked
    first = wh.read("order_fee_items").count()
    batch.batch_orders(wh, inp.postings(), "1995-01-01", "2002-01-01", "2025-01-01 00:00:00", inp.products())
    posting_rows = wh.read("order_fee_items").filter(F.col("source") == "posting_financial").count()
    batch.batch_finance(wh, ops, "1995-01-01", "2002-01-01")
    fin = wh.read("order_fee_items").filter(F.col("source") == "finance_api")
    assert fin.count() == first
    assert fin.filter(F.col("order_id").isNotNull()).count() > 0
    assert wh.read("order_fee_items").count() == first + posting_rows


DAY_SCHEMA = StructType([StructField("k", StringType()), StructField("d", DateType()), StructField("v", LongType())])


def files(wh, name):
    """Files of each partition."""
    out = {}
    for f in wh.read(name, with_part=True).inputFiles():
        out.setdefault(f.split(f"/{PART}=")[1].split("/")[0], set()).add(f)
    return out


def test_partitioned_upsert_rewrites_only_touched_days(spark):
    path = scratch_path(spark, "ptab")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    wh = Store(spark, path, {"rows": DAY_SCHEMA})
    upsert_by_day(spark, path, spark.createDataFrame([("a", d1, 1), ("b", d2, 2)], DAY_SCHEMA), ["k", "d"], "d", DAY_SCHEMA)
    before = files(wh, "rows")
    second = spark.createDataFrame([("b", d2, 20), ("c", d2, 3)], DAY_SCHEMA)
    upsert_by_day(spark, path, second, ["k", "d"], "d", DAY_SCHEMA)
    upsert_by_day(spark, path, second, ["k", "d"], "d", DAY_SCHEMA)  # replay
    now = files(wh, "rows")
    assert now["2024-01-01"] == before["2024-01-01"] and now["2024-01-02"] != before["2024-01-02"]
    assert sorted(tuple(r) for r in read_by_day(spark, path, DAY_SCHEMA).select("k", "v").collect()) == [("a", 1), ("b", 20), ("c", 3)]


def test_a_run_that_dies_while_it_overwrites_is_finished_by_the_next(spark, monkeypatch):
    wh = Store(spark, scratch_path(spark, "wh-test"), {"t": DAY_SCHEMA, "u": DAY_SCHEMA})
    d = dt.date(2024, 1, 1)
    row = lambda v, part="p": spark.createDataFrame([("a", d, v, part)], "k string, d date, v long, _part string")
    b = wh.begin()
    b.write("t", row(1), ["p"])
    b.write("u", row(1).unionByName(row(5, "q")), ["p", "q"])
    assert wh.read("t").count() == 0                 # staged, not yet in place
    b.publish()
    dead = wh.begin()                                # staged, then dies before it is listed: nothing happens
    dead.write("t", row(2), ["p"])
    dead.written("t")
    assert [r["v"] for r in wh.read("t").collect()] == [1]
    dies = wh.begin()
    dies.write("t", row(3), ["p"])
    dies.write("u", row(3), ["p", "q"])              # q becomes empty
    put = Store.overwrite
    monkeypatch.setattr(Store, "overwrite", lambda self, name, *a: put(self, name, *a) if name == "t" else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        dies.publish()
    monkeypatch.undo()
    for _ in range(2):
        wh.begin()
        assert [r["v"] for r in wh.read("t").collect()] == [3] and [r["v"] for r in wh.read("u").collect()] == [3]


def test_rows_from_before_a_column_take_its_default(spark, monkeypatch):
    """Old and new files read together."""
    from pyspark.sql.types import BooleanType, IntegerType
    root = scratch_path(spark, "wh-test")
    first = Store(spark, root, {"t": DAY_SCHEMA}).begin()
    first.write("t", spark.createDataFrame([("a", None, 1, "p"), ("b", None, 2, "q")], "k string, d date, v long, _part string"), ["p", "q"])
    first.publish()
    wider = StructType([*DAY_SCHEMA.fields, StructField("flag", BooleanType()), StructField("level", IntegerType())])
    monkeypatch.setitem(schemas.ADDED, "t", [(2, "flag", False), (3, "level", 7)])
    wh = Store(spark, root, {"t": wider})
    b = wh.begin()
    b.write("t", spark.createDataFrame([("c", None, 3, None, None, "q")], "k string, d date, v long, flag boolean, level int, _part string"), ["q"])
    b.publish()
    assert sorted((r["k"], r["flag"], r["level"]) for r in wh.read("t").collect()) == [("a", False, 7), ("c", None, None)]


def posting(number, day, items, status="s"):
    """items: (sku, name, price, commission)"""
    return {"posting_number": number, "in_process_at": f"{day}T10:00:00Z", "status": status,
            "products": [{"sku": s, "name": n, "quantity": "1", "price": p} for s, n, p, _ in items],
            "financial_data": {"products": [{"product_id": s, "commission_amount": c} for s, _, p, c in items]}}


def landed(spark, pages, folder=None, name="part.json", landing=None):
    root = folder or scratch_path(spark, "landed").removeprefix("file:")
    at = os.path.join(root, f"landing-{landing:015d}") if landing else root
    os.makedirs(at, exist_ok=True)
    with open(os.path.join(at, name), "w") as f:
        f.write("\n".join(p if isinstance(p, str) else json.dumps(p) for p in pages))
    return root


CATALOG = "sku long, flavor string, grams int"


def load(spark, wh, postings, day_from="2024-01-01", day_to="2024-12-31"):
    docs = json_docs.read_postings(spark, landed(spark, [{"result": postings}])) if isinstance(postings, list) else postings
    return batch.batch_orders(wh, docs, day_from, day_to, "2025-01-01 00:00:00", spark.createDataFrame([], CATALOG))


def test_last_version_of_a_posting_counts(spark):
    wh = Store(spark, scratch_path(spark, "wh-test"))
    out = load(spark, wh, [posting("9-1-1", "2024-03-01", [("1", "a", "10", "-1")]), {"posting_number": ""},
                           posting("9-1-1", "2024-03-01", [("1", "a", "10", "-1")], "new")])
    assert out["_counts"] == {"postings": 3, "orders": 1, "skipped": 1}
    r = wh.read("orders").first()
    assert (wh.read("order_items").count(), wh.read("order_fee_items").count(), r["status"]) == (1, 1, "new")
    assert (float(r["fees_total"]), float(r["profit"])) == (-1, 9)


def test_product_name_of_the_last_arrival(spark):
    """Order 10 lands after order 9, though it sorts before it as text; landing order beats file names."""
    wh = Store(spark, scratch_path(spark, "wh-test"))
    root = landed(spark, [{"result": [posting("9-1-1", "2024-03-01", [("1", "older", "1", "0")])]}], name="z.json", landing=1)
    landed(spark, [{"result": [posting("10-1-1", "2024-03-01", [("1", "newer", "1", "0")])]}], root, "a.json", landing=2)
    load(spark, wh, json_docs.read_postings(spark, root))
    assert wh.read("products").first()["name"] == "newer"


def test_modification_time_orders_plain_files(spark):
    root = landed(spark, [{"rows": [{"id": "c", "date": "2024-01-01", "clicks": "1"}]}], name="z.json")
    landed(spark, [{"rows": [{"id": "c", "date": "2024-01-01", "clicks": "2"}]}], root, "a.json")
    os.utime(os.path.join(root, "z.json"), (1, 1_000))
    rows = json_docs.read_campaign_daily(spark, root)
    assert [r["clicks"] for r in rows.orderBy("_ordinal").collect()] == ["1", "2"]


def test_a_day_of_orders_touches_its_month_alone(spark):
    wh = Store(spark, scratch_path(spark, "wh-test"))
    load(spark, wh, [posting("1-1-1", "2024-01-10", [("1", "a", "5", "-1")]), posting("2-2-1", "2024-02-10", [("2", "b", "6", "-2")]),
                     posting("3-3-1", "2024-03-10", [("3", "c", "7", "-3")])])
    names = ("orders", "order_items", "order_fee_items", "order_fee_parts")
    before = {t: files(wh, t) for t in names}
    load(spark, wh, [posting("2-2-1", "2024-02-10", [("2", "b", "8", "-4")]), posting("4-4-1", "2024-02-11", [("2", "b", "1", "0")])], "2024-02-10", "2024-02-12")
    for t, was in before.items():
        now = files(wh, t)
        assert {p for p in now if now[p] != was.get(p)} - {"unknown"} == {p for p in now if p.endswith("2024-02")}, t
    assert {r["order_id"]: float(r["profit"] or 0) for r in wh.read("orders").collect()} == {"1-1-1": 4, "2-2-1": 4, "3-3-1": 4, "4-4-1": 0}
    # an order that moves to another month leaves its old one; a missing one is marked
    load(spark, wh, [posting("2-2-1", "2024-03-20", [("2", "b", "8", "-4")])], "2024-02-01", "2024-03-01")
    rows = {r["order_id"]: r for r in wh.read("orders").collect()}
    assert len(rows) == 4 and rows["4-4-1"]["missing"] and not rows["2-2-1"]["missing"] and wh.read("order_items").count() == 4


def test_first_orders_follow_an_older_order(spark):
    wh = Store(spark, scratch_path(spark, "wh-test"))
    load(spark, wh, [posting("7-1-1", "2024-05-01", []), posting("8-1-1", "2024-05-01", [])])
    load(spark, wh, [posting("7-2-1", "2024-01-01", [])], "2024-01-01", "2024-01-02")
    assert {r["order_id"]: r["is_first_order"] for r in wh.read("orders").collect()} == {"7-1-1": False, "7-2-1": True, "8-1-1": True}
    assert {r["customer_id"]: r["orders_count"] for r in wh.read("customers").collect()} == {"7": 2, "8": 1}


def test_ad_row_moves_to_the_newer_order(spark):
    wh = Store(spark, scratch_path(spark, "wh-test"))
    ads = [{"rows": [{"campaignId": "c1", "date": "2024-03-05", "orderNumber": "5", "moneySpent": "7,00"}]}]
    rows = json_docs.read_attribution(spark, landed(spark, ads))
    load(spark, wh, [posting("5-1-1", "2024-03-01", [])])
    assert batch.batch_attribution(wh, rows, "2024-03-01", "2024-03-31")["_counts"] == {"matched": 1, "unmatched": 0}
    load(spark, wh, [posting("5-2-1", "2024-03-04", [])], "2024-03-04", "2024-03-05")
    batch.batch_attribution(wh, rows, "2024-03-01", "2024-03-31")
    assert wh.read("order_attribution").count() == 1
    assert {r["order_id"]: (r["campaign_id"], r["ads_attributed"]) for r in wh.read("orders").collect()} == {"5-1-1": (None, None), "5-2-1": ("c1", 7)}


def test_a_one_day_batch_reads_touched_partitions_only(spark, monkeypatch):
    """No plan of a small batch scans other months of orders, items or fee rows, or other hash partitions of the key tables."""
    wh = Store(spark, scratch_path(spark, "wh-test"), buckets=64)
    many = [posting(f"{c}-{m}-1", f"2024-{m:02d}-10", [("1", "a", "5", "-1")]) for c in range(40) for m in range(1, 9)]
    load(spark, wh, many)
    seen = {}
    read = Store.read

    def spy(self, name, parts=None, with_part=False):
        df = read(self, name, parts, with_part)
        seen.setdefault(name, []).append((parts, df))
        return df

    ops = [{"operation_id": "1", "operation_date": "2024-08-11 00:00:00", "operation_type": "t", "amount": "-3", "posting": {"posting_number": "7-8"}, "services": []}]
    fin = json_docs.read_finance_ops(spark, landed(spark, [{"result": {"operations": ops}}]))
    monkeypatch.setattr(Store, "read", spy)
    load(spark, wh, [posting("7-8-1", "2024-08-10", [("1", "a", "6", "-2")])], "2024-08-10", "2024-08-11")
    out = batch.batch_finance(wh, fin, "2024-08-10", "2024-08-12")
    monkeypatch.undo()
    assert out["_counts"] == {"rows": 1, "matched": 1, "unmatched": 0}
    for name, reads in seen.items():
        for parts, df in reads:
            if parts is None:        # what the plans return to the caller
                continue
            if name in ("order_keys", "customer_months", "customers", "products"):
                assert len(parts) <= 3, (name, parts)      # the prefixes of one id
            else:
                assert all(p.endswith("2024-08") or p in ("unknown", "none") for p in parts), (name, parts)
            if df.inputFiles():      # a table without files yet has no partitions to prune
                assert "PartitionFilters: []" not in df._jdf.queryExecution().executedPlan().toString(), name
    rows = {r["order_id"]: r for r in wh.read("orders").collect()}
    assert len(rows) == 320 and float(rows["7-8-1"]["fees_total"]) == -5 and float(rows["7-7-1"]["fees_total"]) == -1


def test_partial_aggregates_equal_a_full_recompute(spark):
    """Random inserts, moves to other months, corrections and fee rows: customers, first-order flags, prefix lookup and order finance
    are what a recompute from all orders and all fee rows gives."""
    from marketlens.operators import fees as fo
    from marketlens.operators import orders as oo
    rng = random.Random(11)
    wh = Store(spark, scratch_path(spark, "wh-test"), buckets=4)
    ids = [f"{c}-{n}-{k}" for c in range(6) for n in range(4) for k in (1, 2)]
    for step in range(3):
        some = [posting(rng.choice(ids), f"2024-{rng.randint(1, 5):02d}-{rng.randint(1, 28):02d}", [(str(rng.randint(1, 3)), "a", str(rng.randint(1, 50)), str(-rng.randint(0, 3)))
                        for _ in range(rng.randint(0, 2))], f"s{step}") for _ in range(14)]
        load(spark, wh, some, f"2024-{step + 1:02d}-01", f"2024-{step + 1:02d}-20")
        ops = [{"operation_id": str(n), "operation_date": f"2024-{rng.randint(1, 5):02d}-15 00:00:00", "operation_type": f"t{n}", "amount": str(-rng.randint(1, 9)),
                "posting": {"posting_number": rng.choice([*ids, "3", "4-1", "99-1"])}, "services": []} for n in range(8)]
        batch.batch_finance(wh, json_docs.read_finance_ops(spark, landed(spark, [{"result": {"operations": ops}}])), "2024-01-01", "2024-12-31")
    orders, fees = wh.read("orders"), wh.read("order_fee_items")
    cols = ["customer_id", "first_order_date", "last_order_date", "orders_count", "total_revenue"]
    assert snapshot(wh.read("customers"), cols) == snapshot(oo.customer_aggregates(orders), cols)
    flags = ["order_id", "is_first_order"]
    assert snapshot(orders, flags) == snapshot(oo.first_order_flag(orders), flags)
    lookup = ["key", "resolved_id", "is_exact"]
    assert snapshot(resolve.merged_lookup(wh.read("order_keys")), lookup) == snapshot(resolve.order_lookup(orders), lookup)
    full = resolve.order_lookup(orders, include_exact=False).select("key", "resolved_id")
    assert snapshot(resolve.merged_lookup(wh.read("order_keys"), include_exact=False), ["key", "resolved_id"]) == snapshot(full, ["key", "resolved_id"])
    money = ["order_id", "fees_total", "payout", "profit", "sale_commission", "other_fee"]
    assert snapshot(orders, money) == snapshot(fo.recalc_order_finance(orders, fees), money)
    sums = fo.order_fee_sums(fees)
    assert snapshot(fo.merged_fee_sums(wh.read("order_fee_parts")), sums.columns) == snapshot(sums, sums.columns)
    assert orders.count() == orders.select("order_id").distinct().count()


def test_touched_keys_are_checked_without_the_rest(spark):
    from marketlens.operators import quality
    wh = Store(spark, scratch_path(spark, "wh-test"), buckets=4)
    load(spark, wh, [posting("1-1-1", "2024-01-10", []), posting("2-1-1", "2024-02-10", []), posting("3-1-1", "2024-03-10", [])])
    assert quality.dq_touched_keys(wh, "orders", ["2024-02"]).count() == 0 and quality.dq_touched_keys(wh, "customers", wh.parts("customers")).count() == 0
    b = wh.begin()                                     # a faulty batch puts an order of January into February too
    twice = wh.read("orders", ["2024-02"], with_part=True).unionByName(wh.read("orders", ["2024-01"]).withColumn(PART, F.lit("2024-02")))
    b.write("orders", twice, ["2024-02"])
    keys = wh.read("order_keys", with_part=True)
    more = keys.filter("exact and order_id = '1-1-1'").withColumn("month", F.lit("2024-02"))
    b.write("order_keys", keys.unionByName(more), wh.parts("order_keys"))
    b.publish()
    got = [tuple(r) for r in quality.dq_touched_keys(wh, "orders", ["2024-02"]).collect()]
    assert got == [tuple(r) for r in quality.dq_primary_key(wh.read("orders"), ["order_id"]).collect()] == [("1-1-1", 2)]


def test_lost_parents_shuffle_values_not_rows(spark):
    from marketlens.operators import quality
    child = spark.range(10_000).select((F.col("id") % 5).alias("fk"))
    parent = spark.range(1, 4).select(F.col("id").alias("pk"))
    got = quality.lost_parents(child, parent, "fk", "pk")
    assert sorted(tuple(r) for r in got.collect()) == [(0, 2000), (4, 2000)]
    assert quality.dq_foreign_key(child, parent, "fk", "pk").count() == 4000


def test_fees_of_an_order_that_comes_later_count(spark):
    """Accrual rows name an order before it is loaded: their sums wait in the partition of unknown orders."""
    wh = Store(spark, scratch_path(spark, "wh-test"))
    report = spark.createDataFrame([("1-2-3", "g", "t", "5", "2024-01-01 10:00:00", "-4")],
                                   "accrual_id string, service_group string, accrual_type string, sku string, accepted_at string, total_amount string")
    batch.batch_accruals(wh, report)
    load(spark, wh, [posting("1-2-3", "2024-02-10", [("1", "a", "5", "-1")])])
    load(spark, wh, [posting("1-2-3", "2024-03-10", [("1", "a", "5", "-1")])])   # moves on
    r = wh.read("orders").first()
    assert (float(r["fees_total"]), float(r["profit"])) == (-5, 0)
    assert wh.read("order_fee_parts").filter("order_id = '1-2-3'").count() == 2


@pytest.mark.parametrize("read,page", [
    (json_docs.read_postings, '{"result": "none"}'), (json_docs.read_postings, '{"x": 1}'), (json_docs.read_postings, '{"result": [{"posting_'),
    (json_docs.read_finance_ops, '{"result": {"operations": [{"amount": "1"}, {"am'), (json_docs.read_campaign_daily, '{"rows": [{"id": "c"}'),
    (json_docs.read_attribution, '{"rows": {"campaignId": "c"}}'), (json_docs.read_campaigns, '{"list": "x"}'), (json_docs.read_campaigns, '{"list": [')])
def test_undecodable_pages_fail_the_load(spark, read, page):
    good = {"result": {"operations": [{"amount": "1"}]}} if read is json_docs.read_finance_ops else {"result": []} if read is json_docs.read_postings else {"rows": [], "list": []}
    with pytest.raises(Exception):
        read(spark, landed(spark, [good, page])).collect()


def test_empty_pages_and_undeclared_fields(spark):
    assert json_docs.read_postings(spark, landed(spark, [{"result": {"has_next": False}}, {"result": []}, {"result": {"postings": None}}])).count() == 0
    row = json_docs.read_campaigns(spark, landed(spark, [{"list": [{"id": "1", "title": "t", "budget": {"daily": 5}}]}])).first()
    assert row["id"] == "1" and json.loads(row["_raw"])["budget"] == {"daily": 5}


HEAD = ["ID начисления", "Дата начисления", "Группа услуг", "Тип начисления", "SKU", "Дата принятия заказа в обработку или оказания услуги", "Сумма итого, руб."]


def test_accrual_files_keep_every_row_and_their_own_header(spark):
    root = scratch_path(spark, "accruals").removeprefix("file:")
    os.makedirs(root)

    def report(name, order, rows):
        with open(os.path.join(root, name), "w") as f:
            f.write("\n".join(["Период: 01.2024", ";".join(HEAD[i] for i in order), *[";".join(r[i] for i in order) for r in rows]]))

    report("a.csv", range(7), [("1-2-3", "2024-01-01", "g", "t", "5", "2024-01-01 10:00:00", "1,5"), ("Период: x", "", "g", "t", "", "", "2")])
    report("b.csv", [6, 5, 4, 3, 2, 1, 0], [("9", "2024-01-02", "h", "u", "6", "02.01.2024", "3")])
    got = sorted(tuple(r) for r in accruals.read_accruals(spark, root, vocab.ACCRUAL_LABELS).select("accrual_id", "service_group", "total_amount").collect())
    assert got == [("1-2-3", "g", "1,5"), ("9", "h", "3"), ("Период: x", "g", "2")]
    flat = flatten.flatten_accruals(accruals.read_accruals(spark, root, vocab.ACCRUAL_LABELS))
    assert sorted(str(r["occurred_at"]) for r in flat.collect()) == ["2024-01-01 10:00:00", "2024-01-02 00:00:00", "None"]
    report("c.csv", range(6), [])
    with pytest.raises(Exception, match="misses columns"):
        accruals.read_accruals(spark, root, vocab.ACCRUAL_LABELS).collect()


def test_bad_values_raise(spark):
    bad = spark.createDataFrame([("123456789012345", "soon")], "m string, d string")
    for c in (money_lenient("m"), flatten._accepted_at(F.col("d"))):
        with pytest.raises(Exception):
            bad.select(c).collect()


def test_null_keys_do_not_pile_up(spark):
    """Three quarters of the rows have a NULL key: no task of the join gets them all."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(40_000).select(F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).alias("cand"), F.col("id").cast("string").alias("uid"))
        orders = spark.range(0, 40_000, 8).select(F.concat(F.col("id").cast("string"), F.lit("-1")).alias("order_id"), F.lit(None).cast("timestamp_ntz").alias("order_date"))
        out = resolve.resolve_order_id(rows, orders, "cand")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 40_000 and max(sizes) < 2 * 40_000 / len(sizes)
        old = rows.select(F.col("cand").alias("k"), "uid")
        for made in (upsert.replace_by_key(old, old.limit(0), "k"), upsert.replace_scope(old, old.limit(0), old.select("k").limit(5), "k")):
            joined = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
            assert max(joined) < 40_000 / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
