"""Batch plans (K01-K04): landed documents -> maintained tables.

Each plan is one batch on a ``Store`` (``sources.store``): it reads the partitions that its documents meet, stages their new
content, and overwrites just those. Orders and items are partitioned by the month of the order, fee rows by source and
month, attribution by month, daily statistics by day, period costs by month, tables with one row a key by a hash of the key.

What a batch needs to know of orders outside its months comes from three small tables of partial aggregates, kept by key and part:
``order_keys`` (the newest order of a month for every id prefix, J04/J05), ``customer_months`` (a customer's orders of a month,
A03/A04) and ``order_fee_parts`` (an order's sums over one partition of fee rows, A05-A08). A batch computes the partial rows of its keys and
parts anew and replaces them, so a correction is a row replaced, never a difference added, and a run repeated gives the same.
Only the hash partitions of the keys met, or the months of the orders met, are read; no plan scans all orders or all fee rows.
Staged folders cut the lineage (no ``localCheckpoint``): a lost executor repeats the current step from durable inputs."""

from __future__ import annotations

import json
import time
import traceback
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marketlens import vocab
from marketlens.functions.dates import text_to_ntz
from marketlens.functions.ids import fee_uid
from marketlens.operators import attribution as ao
from marketlens.operators import fees as fo
from marketlens.operators import flatten, resolve, upsert
from marketlens.operators import orders as oo
from marketlens.sources.store import PART, Batch, Store, labels_of

ORDER_LOADED = ["customer_id", "order_date", "status", "revenue", "fees_total", "payout"]
UNKNOWN = "unknown"        # partition of the fee sums of ids that no order has (yet)


def month(c: str) -> Column:
    return F.coalesce(F.date_format(c, "yyyy-MM"), F.lit("none"))


def fee_part(source: str, at: Column) -> Column:
    return F.concat(F.lit(source + "~"), at)


def _ordered(df: DataFrame) -> DataFrame:
    """Rows without an arrival ordinal get one from their content: the same on every run, however the input is split."""
    return df if "_ordinal" in df.columns else df.withColumn("_ordinal", F.xxhash64(*df.columns))


def _between(parts: list[str], date_from, date_to, prefix: str = "") -> list[str]:
    """Labels of the months from ``date_from`` to ``date_to``."""
    return [p for p in parts if p.startswith(prefix) and str(date_from)[:7] <= p[len(prefix):] <= str(date_to)[:7]]


def known_keys(b: Batch, keys: DataFrame, exact_only: bool = False) -> DataFrame:
    """Rows of ``order_keys`` for these keys (column ``key``): only their hash partitions are read."""
    keys = keys.select("key", b.store.bucket("key").alias(PART))
    found = b.read("order_keys", labels_of(keys)).join(keys.select("key").distinct(), "key", "left_semi")
    return found.filter("exact") if exact_only else found


def order_months(b: Batch, ids: DataFrame) -> DataFrame:
    """``(order_id, month)`` of the orders among ``ids``."""
    found = known_keys(b, ids.select(F.col("order_id").alias("key")).filter("key is not null"), exact_only=True)
    return found.select("order_id", "month").distinct()


def _update_keys(b: Batch, ids: DataFrame, orders: DataFrame, months: list[str], others: bool) -> None:
    """``order_keys`` of the ids met and their prefixes, in the months rewritten; ``orders`` is their new content (``others``: it
    may hold orders besides those met)."""
    met = ids.select(F.explode(F.concat(resolve.hyphen_prefixes("order_id"), F.array("order_id"))).alias("key")).distinct()
    met = b.stage("keys_met", met.withColumn(PART, b.store.bucket("key")))
    touched = labels_of(met)
    new = resolve.key_parts(orders, month("order_date"), met if others else None).withColumn(PART, b.store.bucket("key"))
    old = b.read("order_keys", touched, with_part=True)
    gone = met.select("key").withColumn("_met", F.lit(True))
    kept = old.join(gone, "key", "left").filter(F.col("_met").isNull() | ~F.col("month").isin(months)).select(*old.columns)
    b.write("order_keys", kept.unionByName(new), touched)


def _update_fee_parts(b: Batch, ids: DataFrame, placed: DataFrame, fee_rows: DataFrame, dropped: Column, also: list[str]) -> tuple[DataFrame, list[str]]:
    """``order_fee_parts`` of the orders ``ids``: rows that ``dropped`` names go, those of ``fee_rows`` (of these orders or of none) come, and every row
    is in the month of its order (``placed``: ``order_id, month``). Returns the sums of these orders, and their months."""
    placed = b.stage("placed", ids.join(placed, "order_id", "left").select("order_id", F.coalesce("month", F.lit(UNKNOWN)).alias(PART)))
    months = labels_of(placed)
    touched = sorted({*months, *also, UNKNOWN})
    old = b.read("order_fee_parts", touched, with_part=True)
    others = old.join(ids, "order_id", "left_anti")
    mine = old.join(ids, "order_id", "left_semi").filter(~dropped).drop(PART)
    new = fo.order_fee_parts(fee_rows, F.col(PART))
    cols = mine.columns
    mine = b.lay("order_fee_parts", mine.unionByName(new.select(*[F.col(c).cast(mine.schema[c].dataType).alias(c) for c in cols])).join(placed, "order_id"))
    b.write("order_fee_parts", others, touched)
    return fo.merged_fee_sums(mine.drop(PART)), [m for m in months if m != UNKNOWN]


def batch_orders(wh: Store, postings: DataFrame, date_from, date_to, now,
                 catalog: DataFrame, mark: bool = True) -> dict[str, DataFrame]:
    """Flatten postings -> upsert orders / customers / products / items /
    posting fees -> mark missing -> customer aggregates -> first-order flags
    -> order finance and fee breakdown. Of a posting that comes more than once
    the last version counts, with its items and fees. With ``mark=False`` no order is marked missing: the postings
    are a part of the window's (``mark_window`` marks when all have come)."""
    b = wh.begin()
    seen = Observation()
    no_id = F.col("posting_number").isNull() | (F.col("posting_number") == "")
    landed = _ordered(postings).observe(seen, F.count(F.lit(1)).alias("postings"), F.count_if(no_id).alias("skipped"))
    postings = b.stage("postings", upsert.latest_documents(landed, "posting_number"))
    header = b.stage("header", flatten.flatten_order_header(postings).drop("_ordinal"))
    b.counts = {**seen.get, "orders": header.count()}
    ids = header.select("order_id")
    dated = postings.withColumn(PART, month(text_to_ntz(F.col("in_process_at"))))     # as ``now_in``, without a join

    # Months that change: those where the batch's orders are or were, and the window.
    now_in = header.select("order_id", month("order_date").alias(PART))
    was_in = order_months(b, ids).withColumnRenamed("month", PART)
    own = labels_of(now_in.unionByName(was_in))
    months = sorted({*own, *(_between(b.store.parts("orders"), date_from, date_to) if mark else [])})
    old = b.read("orders", months)
    # Independent parts run beside each other: their small steps do not fill a cluster.
    b.branch(lambda: _items(b, dated, ids, own, catalog))
    fees = b.branch(lambda: _posting_fees(b, dated, ids, now_in, own))

    # Six loaded columns are replaced, derived columns of known orders kept. A customer is met if an order of the batch is
    # or was theirs; A03 and the first order times follow from the months rewritten and the customer's other months.
    loaded = b.stage("orders_loaded", upsert.upsert(old, header, "order_id", update_cols=ORDER_LOADED))
    others = bool({*own} & {*b.store.parts("orders")})
    b.branch(lambda: _update_keys(b, ids, loaded.filter(month("order_date").isin(own)), own, others))
    met = header.select("customer_id").unionByName(old.join(ids, "order_id", "left_semi").select("customer_id"))
    met = b.stage("met", met.filter("customer_id is not null").distinct().withColumn(PART, b.store.bucket("customer_id")))
    buckets = labels_of(met)
    was = b.read("customer_months", buckets, with_part=True)
    keep = was.join(met.select("customer_id", F.lit(True).alias("_met")), "customer_id", "left")
    keep = keep.filter(F.col("_met").isNull() | ~F.col("month").isin(months)).select(*was.columns)
    parts = oo.customer_months(loaded, month("order_date"), met).withColumn(PART, b.store.bucket("customer_id"))
    parts = keep.unionByName(parts.select(*was.columns))
    b.write("customer_months", parts, buckets)
    totals = b.stage("totals", oo.merged_customers(parts.join(met.select("customer_id"), "customer_id", "left_semi")))
    have = b.read("customers", buckets, with_part=True)
    mine = upsert.insert_absent(have.drop(PART).join(met.select("customer_id"), "customer_id", "left_semi"), met, "customer_id")
    mine = upsert.upsert(mine, totals.drop("first_at"), "customer_id").withColumn(PART, b.store.bucket("customer_id"))
    b.write("customers", have.join(met.select("customer_id"), "customer_id", "left_anti").unionByName(mine.select(*have.columns)), buckets)

    # A customer's first order may be one of another month: the months of the old and of the new first order change too.
    before = oo.merged_customers(was.drop(PART).join(met.select("customer_id"), "customer_id", "left_semi")).select("customer_id", F.col("first_at").alias("_was"))
    moved = before.join(totals, "customer_id").filter(~F.col("_was").eqNullSafe(F.col("first_at")))
    moved = moved.select(F.explode(F.array(month("_was"), month("first_at"))).alias(PART))
    more = [m for m in labels_of(moved) if m not in months and m != "none"]
    orders = loaded if not more else loaded.unionByName(b.read("orders", more))
    orders = oo.flag_first_orders(orders, totals)
    orders = oo.mark_missing(orders, ids, date_from, date_to, now, unseen=mark)
    b.write("orders", _finance(orders, ids, fees.result()).withColumn(PART, month("order_date")), months + more)
    b.publish()
    return {"orders": wh.read("orders"), "customers": wh.read("customers"), "order_fee_items": wh.read("order_fee_items"), "_counts": b.counts}


def mark_window(wh: Store, seen: DataFrame, date_from, date_to, now) -> dict[str, DataFrame]:
    """J07 alone: ``seen`` (a column ``order_id``) are all ids that came for the window."""
    b = wh.begin()
    months = _between(b.store.parts("orders"), date_from, date_to)
    orders = oo.mark_missing(b.read("orders", months), seen, date_from, date_to, now)
    b.write("orders", orders.withColumn(PART, month("order_date")), months)
    b.publish()
    return {"orders": wh.read("orders")}


def _items(b: Batch, postings: DataFrame, ids: DataFrame, months: list[str], catalog: DataFrame) -> None:
    """Items are deleted, then inserted, for each incoming order, in the months it is or was in. U03: products from the items,
    enriched from the catalog (J02); the last to arrive wins."""
    items = flatten.flatten_order_items(postings, keep=(PART,))
    kept = b.read("order_items", months, with_part=True).join(ids, "order_id", "left_anti")
    new = items.select("order_id", "sku", "quantity", "price", "revenue", PART)
    b.write("order_items", kept.unionByName(new), months)
    products = upsert.last_write_wins(flatten.products_from_items(items, catalog).select("sku", "name", "flavor", "grams", "_ordinal"), "sku", "_ordinal")
    b.merge("products", b.stage("products", products.withColumn(PART, b.store.bucket("sku"))), ["sku"])


def _posting_fees(b: Batch, postings: DataFrame, ids: DataFrame, now_in: DataFrame, months: list[str]) -> DataFrame:
    """U05 likewise for the fees of the postings. Returns the sums over all fees of the incoming orders."""
    source = vocab.SOURCE_POSTING
    labels = [f"{source}~{m}" for m in months]
    kept = b.read("order_fee_items", labels, with_part=True).join(ids, "order_id", "left_anti")
    new = b.lay("order_fee_items", flatten.flatten_posting_fees(postings, keep=(PART,)).withColumn(PART, fee_part(source, F.col(PART))))
    b.write("order_fee_items", kept, labels)
    return _update_fee_parts(b, ids, now_in.withColumnRenamed(PART, "month"), new, F.col("fee_part").startswith(source + "~"), months)[0]


def _finance(orders: DataFrame, ids: DataFrame, sums: DataFrame) -> DataFrame:
    """A05-A08 for the orders ``ids``; the others stay as they are: without sums of theirs only the payout would change."""
    marked = orders.join(ids.withColumn("_theirs", F.lit(True)), "order_id", "left").withColumn("_payout", F.col("payout"))
    done = fo.recalc_order_finance(marked, None, sums=sums)
    return done.withColumn("payout", F.when(F.col("_theirs"), F.col("payout")).otherwise(F.col("_payout"))).select(*orders.columns)


def raw_fee_key(df: DataFrame) -> DataFrame:
    """Key of a finance row before resolution (Z4): the candidate id instead
    of the resolved one, so a row whose order appears later replaces its
    unlinked version instead of doubling it."""
    cand = F.coalesce(F.col("ext_order_id"), F.col("order_id"))
    return df.withColumn("_raw_key", fee_uid(F.col("source"), cand, F.lit(None), F.col("operation_type"),
                                             F.col("fee_group"), F.col("fee_name"),
                                             F.col("occurred_at").cast("string"), F.col("sku")))


def finance_rows(services: DataFrame, lookup: DataFrame, key: bool) -> DataFrame:
    """Fee rows of services, with their arrival order ``_ord``; with ``key`` rows of one candidate have one ``_key``."""
    # of the parts of a uid those that are never blank, so that equal uids have equal keys
    content = F.xxhash64("op_date", "operation_type", "fee_name")
    rows = resolve.resolve_order_id(services, None, "cand", lookup=lookup, out_key="_key" if key else None, spread=content if key else None)
    return flatten.finance_fee_rows(rows).withColumn("_ord", F.struct("_ordinal", "pos")).drop("_ordinal", "pos")


def _recalc(b: Batch, ids: DataFrame, fees: DataFrame, labels: list[str]) -> None:
    """A05-A08 for the orders ``ids`` (Z5: the breakdown too) after the fee partitions ``labels`` took the rows ``fees``: their sums over
    other partitions are on record, so no other fee rows are read."""
    sums, months = _update_fee_parts(b, ids, order_months(b, ids), fees, F.col("fee_part").isin(labels), [])
    old = b.read("orders", months)
    b.write("orders", _finance(old, ids, sums).withColumn(PART, month("order_date")), months)


def batch_finance(wh: Store, operations: DataFrame, date_from, date_to) -> dict[str, DataFrame]:
    """P20 -> J05 -> P11 -> U06 -> A05-A08 -> A09/U08 (period costs)."""
    b = wh.begin()
    svc = b.stage("services", flatten.finance_service_rows(_ordered(operations)))
    lookup = resolve.merged_lookup(known_keys(b, resolve.candidate_keys(svc, "cand")))
    source = vocab.SOURCE_FINANCE_API

    def seen(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
        o = Observation(name)
        return rows.observe(o, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("order_id").isNotNull()).alias("matched"),
                            F.count_if(F.col("order_id").isNull() & F.col("ext_order_id").isNotNull()).alias("unmatched")), o

    # The uid covers the candidate, so versions of a row meet where the join on the candidate has put them, and no second shuffle
    # moves them. Only where a part holds the uid's separator may two candidates share a uid: those few rows meet by the uid.
    odd = F.concat_ws("", "cand", "op_date", "operation_type", "fee_group", "fee_name").contains("|")
    rows, counted = seen(finance_rows(svc.filter(~odd), lookup, True), "plain")
    rows, counted = upsert.last_write_wins(rows, ["_key", "uid"], "_ord").drop("_key"), [counted]
    if not svc.filter(odd).isEmpty():
        more, o = seen(finance_rows(svc.filter(odd), lookup, False), "odd")
        rows, counted = rows.unionByName(upsert.last_write_wins(more, "uid", "_ord")), [*counted, o]
    rows = b.lay("order_fee_items", rows.withColumn(PART, fee_part(source, month("occurred_at"))))
    b.counts = {k: sum(o.get[k] for o in counted) for k in ("rows", "matched", "unmatched")}
    labels = labels_of(rows)
    old = b.read("order_fee_items", labels, with_part=True)
    # Old rows whose pre-resolution key is delivered again go; so do those with the same uid.
    new_keys = raw_fee_key(rows).select("_raw_key").distinct()
    keyed = raw_fee_key(old)
    kept = keyed.join(new_keys, "_raw_key", "left_anti").drop("_raw_key")
    left = keyed.join(new_keys, "_raw_key", "left_semi").select("order_id")
    b.write("order_fee_items", upsert.kept_by_key(kept.select(*old.columns), rows, "uid"), labels)
    fees = b.written("order_fee_items")
    ids = b.stage("finance_ids", rows.select("order_id").unionByName(left).filter("order_id is not null").distinct())
    # besides the new rows, whose orders are the ids, there are the rows kept
    theirs = fees.join(ids, "order_id", "left_semi") if {*labels} & {*b.store.parts("order_fee_items")} else rows
    _recalc(b, ids, theirs, labels)
    # Unlinked rows of the months of the range, those of this batch as they are now
    within = _between(sorted({*b.store.parts("order_fee_items"), *labels}), date_from, date_to, source + "~")
    theirs = b.read("order_fee_items", [p for p in within if p not in labels]).unionByName(fees.filter(F.col(PART).isin(within)).drop(PART))
    new = fo.period_costs(theirs, date_from, date_to)
    touched = sorted({"none", *_between(b.store.parts("period_costs"), date_from, date_to), *[p.split("~")[1] for p in within]})
    costs = fo.replace_range_period_costs(b.read("period_costs", touched), new, date_from, date_to)
    b.write("period_costs", costs.withColumn(PART, month("cost_date")), touched)
    b.publish()
    return {"orders": wh.read("orders"), "order_fee_items": wh.read("order_fee_items"), "period_costs": wh.read("period_costs"), "_counts": b.counts}


def batch_accruals(wh: Store, report: DataFrame) -> dict[str, DataFrame]:
    """Accrual reports: P24 -> U11 (all rows of the source are replaced) -> A05-A08 of the
    orders that have or had such rows."""
    b = wh.begin()
    source = vocab.SOURCE_FINANCE_REPORT
    rows = flatten.flatten_accruals(report).withColumn(PART, fee_part(source, month("occurred_at")))
    rows = b.stage("accruals", b.store.shaped("order_fee_items", rows))
    mine = [p for p in b.store.parts("order_fee_items") if p.startswith(source + "~")]
    labels = sorted({*mine, *labels_of(rows)})
    old = b.read("order_fee_items", mine, with_part=True)
    ids = b.stage("accrual_ids", old.select("order_id").unionByName(rows.select("order_id")).filter("order_id is not null").distinct())
    b.write("order_fee_items", upsert.replace_source(old, rows, source), labels)
    _recalc(b, ids, rows, labels)
    b.counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("order_id").isNull()).alias("unmatched")).first().asDict()
    b.publish()
    return {"orders": wh.read("orders"), "order_fee_items": wh.read("order_fee_items"), "_counts": b.counts}


def batch_attribution(wh: Store, rows: DataFrame, date_from, date_to) -> dict[str, DataFrame]:
    """P23 -> J04 -> U10 (content key; a row landed again takes its new order) -> A10 + A11.
    An order that loses its last row to another one loses its campaign and spend."""
    b = wh.begin()
    fields = b.stage("fields", flatten.attribution_fields(rows))
    lookup = resolve.merged_lookup(known_keys(b, resolve.candidate_keys(fields, "cand")), include_exact=False)
    # equal keys are equal rows but for the order: a new row takes the place of the old one with its key
    new = b.lay("order_attribution", ao.resolved_rows(fields, None, lookup).withColumn(PART, month("stat_date")))
    b.counts = ao.attribution_match_rate(new).first().asDict()
    labels = labels_of(new)
    old = b.read("order_attribution", labels, with_part=True)
    moved = (old.select("row_key", F.col("order_id").alias("_was")).join(new.select("row_key", "order_id"), "row_key")
             .filter("_was is not null and not (_was <=> order_id)").select(F.col("_was").alias("order_id")).distinct())
    moved = b.stage("attribution_moved", moved)
    b.write("order_attribution", upsert.kept_by_key(old, new, "row_key"), labels)
    now = b.written("order_attribution")
    within = _between(sorted({*b.store.parts("order_attribution"), *labels}), date_from, date_to)
    table = b.read("order_attribution", [p for p in within if p not in labels]).unionByName(now.filter(F.col(PART).isin(within)).drop(PART))
    ids = b.stage("attribution_ids", ao.order_campaign_agg(table, date_from, date_to).select("order_id").unionByName(moved).distinct())
    months = labels_of(order_months(b, ids), "month")
    before = b.read("orders", months)
    cleared = before.join(moved.withColumn("_moved", F.lit(True)), "order_id", "left")
    cleared = cleared.select(*[F.when(F.col("_moved").isNull(), F.col(c)).alias(c) if c in ("campaign_id", "campaign_title", "ads_attributed")
                               else F.col(c) for c in before.columns])
    b.write("orders", ao.apply_attribution(cleared, table, date_from, date_to).withColumn(PART, month("order_date")), months)
    b.publish()
    return {"orders": wh.read("orders"), "order_attribution": wh.read("order_attribution"), "_counts": b.counts}


def batch_campaigns(wh: Store, campaigns: DataFrame) -> dict[str, DataFrame]:
    """Campaign list -> U07 (created_at insert-only)."""
    b = wh.begin()
    rows = b.stage("campaigns", upsert.last_write_wins(flatten.flatten_campaigns(_ordered(campaigns)), "campaign_id", "_ordinal"))
    touched = labels_of(rows.select(b.store.bucket("campaign_id").alias(PART)))
    out = upsert.upsert(b.read("campaigns", touched), rows, "campaign_id", insert_only_cols=["created_at"])
    b.write("campaigns", out.withColumn(PART, b.store.bucket("campaign_id")), touched)
    b.publish()
    return {"campaigns": wh.read("campaigns")}


def batch_daily(wh: Store, daily_rows: DataFrame) -> dict[str, DataFrame]:
    """Daily statistics -> U09 by (campaign_id, stat_date)."""
    b = wh.begin()
    keys = ["campaign_id", "stat_date"]
    rows = upsert.last_write_wins(flatten.flatten_campaign_daily(_ordered(daily_rows)), keys, "_ordinal")
    rows = b.stage("daily", rows.withColumn(PART, F.coalesce(F.col("stat_date").cast("string"), F.lit("none"))))
    b.merge("campaign_daily", rows, keys)
    b.publish()
    return {"campaign_daily": wh.read("campaign_daily")}


@dataclass
class Step:
    name: str
    fn: object
    required: bool


def batch_all(wh: Store, inputs: dict[str, DataFrame], date_from, date_to, now, catalog: DataFrame,
              enable: dict[str, bool] | None = None, strict: bool = True):
    """Orders -> finance -> accruals -> (campaigns, daily, attribution),
    each behind an enable flag. Required steps always raise; optional ones raise in
    strict mode and are logged otherwise. Returns (tables, step log).

    One range for every step: ``[date_from, date_to)``; attribution, whose
    bounds are inclusive dates, gets ``[date_from, date_to - 1 day]``."""
    import datetime as _dt
    attr_to = (_dt.date.fromisoformat(str(date_to)[:10]) - _dt.timedelta(days=1)).isoformat()
    enable = {"finance": True, "accruals": True, "campaigns": True, "daily": True, "attribution": True, **(enable or {})}
    steps = [Step("orders", lambda: batch_orders(wh, inputs["postings"], date_from, date_to, now, catalog), True)]
    if enable["finance"] and "operations" in inputs:
        steps.append(Step("finance", lambda: batch_finance(wh, inputs["operations"], date_from, date_to), True))
    if enable["accruals"] and "accruals" in inputs:
        steps.append(Step("accruals", lambda: batch_accruals(wh, inputs["accruals"]), True))
    if enable["campaigns"] and "campaigns" in inputs:
        steps.append(Step("campaigns", lambda: batch_campaigns(wh, inputs["campaigns"]), False))
    if enable["daily"] and "daily" in inputs:
        steps.append(Step("daily", lambda: batch_daily(wh, inputs["daily"]), False))
    if enable["attribution"] and "attribution" in inputs:
        steps.append(Step("attribution", lambda: batch_attribution(wh, inputs["attribution"], date_from, attr_to), False))
    out: dict[str, DataFrame] = {}
    log = []
    for s in steps:
        t0 = time.time()
        try:
            made = s.fn()
            counts = made.pop("_counts", None)
            out.update(made)
            log.append((s.name, s.required, "ok", round(time.time() - t0, 3), None, json.dumps(counts) if counts else None))
        except Exception as e:  # noqa: BLE001
            log.append((s.name, s.required, "failed", round(time.time() - t0, 3),
                        f"{type(e).__name__}: {str(e)[:300]}", None))
            if s.required or strict:
                raise
            traceback.print_exc()
    log_df = wh.spark.createDataFrame(log, "step string, required boolean, status string, seconds double, error string, counts string")
    return out, log_df

