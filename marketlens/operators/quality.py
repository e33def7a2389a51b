"""Schema conformance (M01), data-quality checks (Q01-Q05), row guards
and time windows (F02, A23)."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens import schemas


def conform_schema(df: DataFrame, target: StructType, defaults: dict | None = None) -> DataFrame:
    """Give ``df`` exactly the target columns: present ones are cast,
    missing ones are the default (or NULL) of the target type. Re-runnable."""
    defaults = defaults or {}
    have = set(df.columns)
    cols = []
    for f in target.fields:
        if f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def dq_primary_key(df: DataFrame, keys: list[str], nulls_exempt: bool = True) -> DataFrame:
    """Q01: key values held by more than one row (NULL keys exempt, as a
    UNIQUE index treats them)."""
    x = df
    if nulls_exempt:
        for k in keys:
            x = x.filter(F.col(k).isNotNull())
    return x.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n")).filter(F.col("n") > 1)


def dq_foreign_key(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Q02: child rows whose non-NULL foreign key has no parent."""
    p = parent.select(F.col(pk).alias("_pk")).distinct()
    return child.filter(F.col(fk).isNotNull()).join(p, F.col(fk) == F.col("_pk"), "left_anti")


def dq_primary_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Q01 for the declared key of each table: ``table_name, key (its parts as
    text, joined by '|'), n``."""
    out = []
    for name, df in tables.items():
        keys = schemas.TABLE_KEYS[name]
        found = dq_primary_key(df, keys)
        out.append(found.select(F.lit(name).alias("table_name"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"), "n"))
    return reduce(DataFrame.unionByName, out)


def dq_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Q02 for each declared reference: ``child, column, value, n`` (child rows without that parent)."""
    out = []
    for child, fk, parent, pk in schemas.REFERENCES:
        lost = lost_parents(tables[child], tables[parent], fk, pk)
        out.append(lost.select(F.lit(child).alias("child"), F.lit(fk).alias("column"), F.col(fk).cast("string").alias("value"), "n"))
    return reduce(DataFrame.unionByName, out)


def lost_parents(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Q02 by value: ``fk, n``. The child is reduced to one row for each value and map task before the shuffle, and the anti join
    uses that same shuffle, so child rows are never shuffled, however many share a value. (A Bloom filter of the parents could only
    prove a value lost; those it lets through must be looked up all the same.)"""
    counted = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    p = parent.select(F.col(pk).alias("_pk")).distinct()
    return counted.join(p, F.col(fk) == F.col("_pk"), "left_anti")


#: Tables whose key fixes the partition: a key cannot be in two of them.
KEY_IN_PART = ("customers", "products", "campaigns", "campaign_daily", "order_attribution", "order_fee_items", "period_costs")


def dq_touched_keys(store, name: str, parts: list[str]) -> DataFrame:
    """Q01 after a batch that touched ``parts``: key values held by more than one row, as ``dq_primary_key`` on the whole table finds
    them if it had none before. Only these partitions are read. The key of an order does not fix its month: ids that are new to a touched
    month are looked up in ``order_keys``, which holds every month an id is in, at the hash partitions of these ids."""
    keys = schemas.TABLE_KEYS.get(name, ["row_key"])
    rows = store.read(name, parts)
    found = dq_primary_key(rows, keys)
    if name in KEY_IN_PART:
        return found
    ids = rows.select(F.col(keys[0]).alias("key")).filter("key is not null").distinct()
    buckets = sorted(r[0] for r in ids.select(store.bucket("key")).distinct().collect())   # partition labels
    apart = (store.read("order_keys", buckets).filter("exact").join(ids, "key", "left_semi").groupBy("key")
             .agg(F.count(F.lit(1)).cast("bigint").alias("n")).filter("n > 1").select(F.col("key").alias(keys[0]), "n"))
    return found.unionByName(apart).groupBy(keys[0]).agg(F.max("n").alias("n"))


def dq_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Q03: NULL count per required column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "null_count")


def dq_counts_by_source(fees: DataFrame) -> DataFrame:
    """Q04: fee rows per source (re-running a load must not change it)."""
    return fees.groupBy("source").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def dq_date_bounds(orders: DataFrame, col: str = "order_date") -> DataFrame:
    """Q05: first and last order date."""
    return orders.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))


def drop_keyless_rows(df: DataFrame, key_cols: list[str], name: str = "keyless") -> tuple[DataFrame, object]:
    """drop rows whose key is NULL or blank. Returns the kept rows and an
    ``Observation`` whose ``dropped`` metric is filled once an action runs."""
    from pyspark.sql import Observation
    ok = None
    for k in key_cols:
        c = F.col(k).isNotNull() & (F.col(k).cast("string") != F.lit(""))
        ok = c if ok is None else (ok & c)
    obs = Observation(name)
    observed = df.observe(obs, F.count_if(~ok).alias("dropped"), F.count(F.lit(1)).alias("seen"))
    return observed.filter(ok), obs


def lookback_range(date_to, days: int = 30) -> tuple[_dt.date, _dt.date]:
    """``[date_to - days, date_to]`` (both dates inclusive)."""
    to = date_to if isinstance(date_to, _dt.date) else _dt.date.fromisoformat(str(date_to))
    return to - _dt.timedelta(days=days), to


def lookback_window(df: DataFrame, col: str, date_to, days: int = 30) -> DataFrame:
    """rows whose ``col`` falls on the days ``[date_to - days, date_to]``."""
    lo, hi = lookback_range(date_to, days)
    c = F.col(col)
    return df.filter((c >= F.lit(lo.isoformat()).cast("timestamp_ntz"))
                     & (c < F.lit((hi + _dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")))


def window_index(col: str, date_from, days: int) -> Column:
    """Index of the ``days``-long window, anchored at ``date_from``, holding ``col``."""
    return F.floor(F.datediff(F.to_date(F.col(col)), F.lit(str(date_from)).cast("date")) / F.lit(days)).cast("bigint")


def backfill_window_counts(df: DataFrame, col: str, date_from, date_to, days: int) -> DataFrame:
    """Rows per fixed-size window in ``[date_from, date_to)``; windows are
    half-open ``[start, start + days)``."""
    c = F.to_date(F.col(col))
    lo = F.lit(str(date_from)).cast("date")
    x = df.filter((c >= lo) & (c < F.lit(str(date_to)).cast("date")))
    g = x.groupBy(window_index(col, date_from, days).alias("window_no")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
    return g.select("window_no", F.date_add(lo, (F.col("window_no") * days).cast("int")).alias("window_start"),
                    F.date_add(lo, ((F.col("window_no") + 1) * days).cast("int")).alias("window_end"), "n")
