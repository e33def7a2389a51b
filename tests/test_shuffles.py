"""What the shared steps shuffle, and that their rows are those of the plainer plan."""

import datetime as dt
import re
import time

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from marketlens import schemas, vocab
from marketlens.functions import dates
from marketlens.operators import attribution as ao
from marketlens.operators import flatten, resolve, upsert
from marketlens.plans import batch
from marketlens.plans.inputs import Inputs
from marketlens.sources import accruals, json_docs
from marketlens.sources import testdata as td
from marketlens.sources.store import FREE, Store


@pytest.fixture
def no_broadcast(spark):
    """As on tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def orders(spark):
    return spark.createDataFrame([("7-1-1", dt.datetime(2024, 1, 1)), ("7-2-1", dt.datetime(2024, 2, 1)), ("8-3-1", None)],
                                 "order_id string, order_date timestamp_ntz")


CANDS = ["7", " 7", "7-1", "7-1-1", "9-9", None, ""]


def test_attribution_meets_its_copies_in_the_join(spark, no_broadcast):
    day = dt.date(2024, 3, 1)
    raw = [(c, i % 2, "c1", "t", day, None, "offer", 1, 2, 3, 4, 5, None) for c in CANDS for i in (0, 1, 2, 3)]
    fields = spark.createDataFrame(raw, "cand string, sku bigint, campaign_id string, campaign_title string, stat_date date, product_name string, "
                                   "offer_id string, price int, amount int, spent int, bid int, bid_percent int, qty bigint")
    got = ao.resolved_rows(fields, orders(spark))
    once = flatten.attribution_rows(resolve.resolve_order_id(fields, orders(spark), "cand", exact=False)).dropDuplicates(["row_key"])
    assert "hashpartitioning(row_key" in plan(once) and "hashpartitioning(row_key" not in plan(got)
    assert rows(got) == rows(once) and got.columns == once.columns and got.count() == 2 * len(CANDS)


def test_finance_versions_meet_in_the_join(spark, no_broadcast):
    ops = [(c, "2024-03-01", t, s, a) for c in CANDS for t in ("A", None) for s in (None, 0, 5) for a in (1, 2, 3)]
    svc = spark.createDataFrame(ops, "cand string, op_date string, operation_type string, sku bigint, _ordinal int")
    svc = svc.select("cand", "op_date", "operation_type", F.lit("g").alias("fee_group"), F.lit("n").alias("fee_name"),
                     F.col("_ordinal").cast("decimal(18,4)").alias("amount"), "sku", "_ordinal", F.lit(0).alias("pos"))
    by = F.xxhash64("op_date", "operation_type", "fee_name")
    keyed = flatten.finance_fee_rows(resolve.resolve_order_id(svc, orders(spark), "cand", out_key="_key", spread=by)).drop("pos")
    plain = flatten.finance_fee_rows(resolve.resolve_order_id(svc, orders(spark), "cand")).drop("pos")
    got = upsert.last_write_wins(keyed, ["_key", "uid"], "_ordinal").drop("_key")
    want = upsert.last_write_wins(plain, "uid", "_ordinal")
    # a sku of 0 and none share a uid, and so must not be told apart by the key
    assert rows(got.drop("sku")) == rows(want.drop("sku")) and got.columns == want.columns
    fees = plan(Inputs(spark, SMALL).finance_fees())
    assert fees.count("Scan parquet") == Inputs(spark, SMALL).finance_resolved()._jdf.queryExecution().executedPlan().toString().count("Scan parquet")
    assert "hashpartitioning(uid" not in fees and "hashpartitioning(_key, uid" not in fees


def test_postings_shuffle_numbers(spark, no_broadcast):
    """The texts of a document do not pass the shuffle."""
    gathered = plan(td.postings(spark, SMALL)).split("partial_collect_list", 1)[1].split("\n")[0]
    assert "l_partkey" in gathered and "commission_amount" not in gathered


def test_a_batch_keeps_no_shuffle_files(spark, tmp_path, no_broadcast):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    b = Store(spark, str(tmp_path / "wh")).begin()
    before = files()
    b.stage("one", spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    deadline = time.time() + 10
    while files() - before and time.time() < deadline:
        time.sleep(0.1)
    assert not files() - before
    b.publish()
    assert spark.conf.get(FREE, "false") == "false"


def test_report_lines_are_parsed_at_their_width_where_they_are_read(spark, tmp_path):
    names = list(vocab.ACCRUAL_LABELS)
    cells = {"accrual_id": ["1-2-3", '"a;b"', "7"], "total_amount": ["1,5", "", '"2']}

    def report(file, head, lines):
        (tmp_path / file).write_text("\n".join(["Период", ";".join(head), *lines]))

    def line(head, i, upto=None):
        return ";".join([cells.get(vocab.ACCRUAL_LABELS.get(h), ["x"] * 3)[i] for h in head][:upto])

    wide = [*(f"other {i}" for i in range(accruals.MAX_COLUMNS - len(names))), *names]
    report("narrow.csv", names, [line(names, 0), line(names, 1), line(names, 0, 3), line(names, 0) + ";more;cells"])
    report("wide.csv", wide, [line(wide, 1), line(wide, 2), line(wide, 0, 60)])
    got = accruals.read_accruals(spark, str(tmp_path), vocab.ACCRUAL_LABELS)
    whole = got._jdf.queryExecution().optimizedPlan().toString() + plan(got)
    assert "hashpartitioning" not in plan(got) and "SortMergeJoin" not in whole
    assert f"StructField(_c{len(names) - 1}," in whole and len(rows(got)) == 7
    ids = sorted((r["accrual_id"], r["total_amount"]) for r in got.na.fill("-").collect())
    short = sum(1 for i, t in ids if t == "-" and i in ("1-2-3", "-"))
    assert ids.count(("1-2-3", "1,5")) == 2 and ids.count(("a;b", "-")) == 2 and short == 2


def test_a_reload_by_uid_shuffles_rows_once(spark, no_broadcast):
    """Old rows, reloaded rows and their keys meet where the join put them: none is shuffled again by its uid."""
    import __spark_entry__ as entry
    got = entry.queries()["upsert_fees_by_uid"](spark, SMALL)
    assert "hashpartitioning(uid" not in plan(got) and "hashpartitioning(_key, uid" not in plan(got)


DOC = ("posting_number string, in_process_at string, status string, products array<struct<sku:string,name:string,quantity:string,price:string>>, "
       "financial_data struct<products:array<struct<product_id:string,commission_amount:string,commission_percent:string,payout:string,"
       "total_discount_value:string,total_discount_percent:string>>>")
OP = ("operation_id string, operation_date string, date string, operation_type string, operation_type_name string, amount string, "
      "posting struct<posting_number:string>, posting_number string, order_id string, "
      "services array<struct<name:string,type:string,price:string,amount:string,sku:string>>, _ordinal int")
RANGE = ("2024-01-01", "2024-12-31")


def first_load(spark, wh, ids):
    docs = [(i, "2024-03-01T10:00:00Z", "s", [("1", "a", "1", "10")] * 2, ([("1", "-1", None, "9", "2", None)] * 2,)) for i in ids]
    catalog = spark.createDataFrame([], "sku long, flavor string, grams int")
    batch.batch_orders(wh, spark.createDataFrame(docs, DOC), *RANGE, "2025-01-01 00:00:00", catalog)


def operation(cand, kind, amount, n):
    return (str(n), "2024-03-02 00:00:00", None, kind, "n", amount, (cand,), None, None, [], n)


def test_a_first_load_joins_with_no_absent_partition(spark, no_broadcast, tmp_path, monkeypatch):
    """Tables without the partitions met take no part in a plan; items and fee rows know their month without a join; and
    versions of a finance row meet where the join on the candidate put them."""
    wh, plans, shaped = Store(spark, str(tmp_path / "wh")), {}, Store.shaped

    def spy(self, name, rows):
        plans.setdefault(name, []).append(plan(rows))
        return shaped(self, name, rows)

    monkeypatch.setattr(Store, "shaped", spy)
    first_load(spark, wh, ["7-1-1", "8-2-1"])
    loaded, plans = plans, {}
    ops = [operation(c, "t", f"-{a}", a) for c in ("7-1-1", "8", "9-9", None) for a in (1, 2)]
    counts = batch.batch_finance(wh, spark.createDataFrame(ops, OP), *RANGE)["_counts"]
    monkeypatch.undo()
    assert not any("hashpartitioning" in p for p in loaded["order_items"] + loaded["order_fee_items"])
    assert not any("Join" in p for p in loaded["order_keys"])
    assert not any("hashpartitioning(uid" in p or "hashpartitioning(_key, uid" in p for p in plans["order_fee_items"])
    assert counts == {"rows": 8, "matched": 4, "unmatched": 2}
    fin = wh.read("order_fee_items").filter("source = 'finance_api'")
    assert rows(fin.select("order_id", "ext_order_id", F.col("amount").cast("int"))) == rows(spark.createDataFrame(
        [("7-1-1", None, -2), ("8-2-1", "8", -2), (None, "9-9", -2), (None, None, -2)], "a string, b string, c int"))
    got = {r["order_id"]: float(r["fees_total"]) for r in wh.read("orders").collect()}
    assert got == {"7-1-1": -8, "8-2-1": -8}       # two commissions of -1, two discounts of -2, the last version of -2


def test_candidates_that_share_a_uid_leave_one_row(spark, no_broadcast, tmp_path):
    """The uid joins its parts by '|': an id that holds one may give the uid of another id."""
    wh = Store(spark, str(tmp_path / "wh"))
    ops = [operation("x|y", "z", "-1", 1), operation("x", "y|z", "-2", 2), operation("x", "z", "-3", 3)]
    for _ in range(2):
        counts = batch.batch_finance(wh, spark.createDataFrame(ops, OP), *RANGE)["_counts"]
        assert counts == {"rows": 3, "matched": 0, "unmatched": 3}
        assert rows(wh.read("order_fee_items").select("ext_order_id", F.col("amount").cast("int"))) == [("x", -2), ("x", -3)]


def test_a_batch_of_some_orders_leaves_the_finance_of_others(spark, no_broadcast):
    table = spark.createDataFrame([("a", 10, 3, 99), ("b", 20, None, 98), (None, 5, 1, 97)], "order_id string, revenue int, fees_total int, payout int")
    table = table.select("order_id", *[F.col(c).cast("decimal(18,4)").alias(c) for c in table.columns[1:]])
    fees = spark.createDataFrame([("b", "commission", -4, "g")], "order_id string, source string, amount int, fee_group string")
    fees = fees.select("order_id", "source", "fee_group", F.col("amount").cast("decimal(18,4)").alias("amount"), F.lit("n").alias("fee_name"))
    from marketlens.operators import fees as fo
    wide = fo._ensure(table, ["sales_report", "profit", "other_fee", "delivery_fee", "acquiring_fee", "ads_fee", "sale_commission", "discount"])
    done = batch._finance(wide, spark.createDataFrame([("b",)], "order_id string"), fo.order_fee_sums(fees))
    assert done.columns == wide.columns and plan(done).count("Scan ExistingRDD") == 3     # the orders are read once
    assert [r[:2] for r in rows(done.select("order_id", F.col("payout").cast("int")))] == [("a", 99), ("b", 16), (None, 97)]


def test_landed_pages_are_small_and_keep_their_order(spark, tmp_path):
    """Pages lie compressed, their documents are shuffled as text, and those that come at one place stay in the order of their fields."""
    lines = [(i // 3, None if i % 4 == 0 else "ab"[i % 2] * (i % 3 + 1), [("x" if i % 5 else None, "Товар")] * (i % 3)) for i in range(300)]
    docs = spark.createDataFrame(lines, "seq int, name string, items array<struct<id:string,title:string>>")
    json_docs.land_pages(docs, str(tmp_path), lambda a, p: F.when(p % 2 == 0, F.to_json(F.struct(a.alias("rows")))).otherwise(
        F.to_json(F.struct(F.array().alias("rows"), a.alias("list")))), "seq", 10, as_text=True)
    files = [f for f in tmp_path.glob("landing-*/part-*")]
    assert files and all(f.name.endswith(".txt.gz") for f in files)
    got = [r["value"] for r in spark.read.option("recursiveFileLookup", True).text(str(tmp_path)).collect()]
    whole = docs.groupBy(F.floor(F.col("seq") / 10).alias("p")).agg(F.sort_array(F.collect_list(F.struct("seq", F.struct("name", "items").alias("d")))).alias("e"))
    whole = whole.select("p", F.transform("e", lambda x: x["d"]).alias("a"))
    want = whole.select(F.when(F.col("p") % 2 == 0, F.to_json(F.struct(F.col("a").alias("rows")))).otherwise(
        F.to_json(F.struct(F.array().alias("rows"), F.col("a").alias("list")))).alias("v"))
    assert sorted(got) == sorted(r["v"] for r in want.collect()) and len(got) == 10


def test_attribution_loads_meet_where_they_lie(spark, no_broadcast):
    """Old rows and rows landed again come from one exchange by candidate; none is shuffled again by its content."""
    import __spark_entry__ as entry
    for name in ("relink_attribution", "insert_ignore_attribution"):
        df = entry.queries()[name](spark, SMALL)
        p = plan(df)
        assert "hashpartitioning(row_key" not in p and "hashpartitioning(_key, row_key" not in p and "isnotnull(sha2" not in p
    inp = Inputs(spark, SMALL)
    assert rows(inp.attribution(keyed=True).drop("_key")) == rows(inp.attribution())


def test_a_batch_of_attribution_is_written_once_by_label(spark, no_broadcast, tmp_path, monkeypatch):
    """New rows are laid out where they are stored, not staged before; a row that comes again takes its order, no copy stays."""
    wh, staged, stage = Store(spark, str(tmp_path / "wh")), [], batch.Batch.stage
    first_load(spark, wh, ["7-1-1"])
    monkeypatch.setattr(batch.Batch, "stage", lambda self, name, df: staged.append(name) or stage(self, name, df))
    cols = [f.name for f in schemas.ATTRIBUTION_ROW.fields]
    raw = [tuple({"campaignId": "c1", "date": d, "orderNumber": c, "moneySpent": "1,5"}.get(n) for n in cols) for c, d in (("7", "2024-03-01"), ("8", "2.3.2024"), ("7", "2024-03-01"))]
    df = spark.createDataFrame(raw, schemas.ATTRIBUTION_ROW)
    batch.batch_attribution(wh, df, *RANGE)
    monkeypatch.undo()
    assert "fields" in staged and "attribution" not in staged
    first_load(spark, wh, ["8-2-1"])
    batch.batch_attribution(wh, df, *RANGE)
    assert rows(wh.read("order_attribution").select("order_id", "ext_order_id")) == [("7-1-1", "7"), ("8-2-1", "8")]


def test_dates_are_tried_only_where_their_separators_are(spark):
    texts = ["2024-03-01", "1.3.2024", "01/03/2024", "2024-3-1", " 2024-03-01 ", "2024-03-01T10:00:00Z", "2024-03-01 10:00:00", "2024-03-01 10:00:00.5", "1-3-2024", "x", "2024.03-01", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for layout in [*dates.DATE_FORMATS, *dates.LENIENT_FORMATS]:
        got = df.select(dates.tried(F.col("t"), layout, F.try_to_date).alias("a"), F.try_to_date("t", layout).alias("b"))
        assert got.filter("not (a <=> b)").isEmpty()
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_finance_and_accrual_rows_share_the_lines(spark, no_broadcast):
    """Both read the lines with the same columns through the same shuffle, which is then run once; the rows are those of the plainer plan."""
    finance, accruals_ = (lambda w: td.finance_operations(spark, SMALL, w)), (lambda w: td.accrual_rows(spark, SMALL, w))
    read = [{re.sub(r"#\d+L?", "", c) for c in re.findall(r"FileScan parquet (\[l_orderkey.*?\])", plan(f(True)))} for f in (finance, accruals_)]
    assert read[0] == read[1] and len(read[0]) == 1
    for f in (finance, accruals_):
        assert rows(f(True)) == rows(f(False)) and f(True).columns == f(False).columns
