"""Resolving finance / ad rows to orders.

A candidate id matches an order either exactly or as a prefix: ``cand``
matches order ``o`` when ``o`` starts with ``cand || '-'``. A ``startswith``
join condition plans as a nested-loop join (O(n*m)). Instead each order emits
every hyphen prefix of its id as an equi-join key; the prefixes are reduced to
one winner per key with a partial aggregate (so a hot customer prefix is
collapsed map-side before the shuffle); candidates then hash-join on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.ids import strip


NULL_KEYS = 4096   # keys over which rows without a candidate are spread: a power of two
NOWHERE = "\u0000"  # how they begin


def hyphen_prefixes(order_id) -> Column:
    """All texts before some '-' of the id: 'a-b-c' -> ['a', 'a-b'].

    Guarded for ids without a hyphen (``sequence(1, 0)`` is ``[1, 0]``)."""
    c = F.col(order_id) if isinstance(order_id, str) else order_id
    parts = F.split(c, "-", -1)
    n = F.size(parts)
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1),
                                     lambda i: F.array_join(F.slice(parts, 1, i), "-"))) \
        .otherwise(F.array().cast("array<string>"))


def _newest_rank(date_col: Column, id_col: Column) -> Column:
    """Ordering of 'ORDER BY order_date DESC' as the source database sorts it:
    NULL dates first, then newest; the id breaks ties deterministically."""
    return F.struct(date_col.isNull().alias("n"), date_col.alias("d"), id_col.alias("i"))


def order_lookup(orders: DataFrame, include_exact: bool = True, order_id: str = "order_id",
                 order_date: str = "order_date") -> DataFrame:
    """key -> (resolved order_id, is_exact).

    Exact keys (the ids themselves) beat prefix keys; among prefix matches the
    newest order wins (W01).
    """
    o = orders.select(F.col(order_id).alias("_oid"), F.col(order_date).alias("_od")) \
        .filter(F.col("_oid").isNotNull())
    prefix = o.select(F.explode(hyphen_prefixes("_oid")).alias("key"), F.lit(0).alias("_exact"),
                      "_oid", "_od")
    keyed = prefix
    if include_exact:
        keyed = keyed.unionByName(o.select(F.col("_oid").alias("key"), F.lit(1).alias("_exact"),
                                           "_oid", "_od"))
    rank = F.struct(F.col("_exact").alias("e"), _newest_rank(F.col("_od"), F.col("_oid")).alias("r"))
    return keyed.groupBy("key").agg(
        F.max_by("_oid", rank).alias("resolved_id"),
        (F.max("_exact") == 1).alias("is_exact"))


def key_parts(orders: DataFrame, part: Column, keys: DataFrame | None = None) -> DataFrame:
    """Partial result of ``order_lookup`` for each ``part`` of the orders: ``key, exact, month, order_id,
    order_date``, the newest order of the part with that prefix (or that id). With ``keys`` (a column ``key``) of these keys only."""
    o = orders.select(F.col("order_id").alias("_oid"), F.col("order_date").alias("_od"), part.alias("month")).filter("_oid is not null")
    # one explode, not a union of two: rows that a join put by their key are grouped there
    own = F.array(F.struct(F.col("_oid").alias("key"), F.lit(True).alias("exact")))
    keyed = o.select(F.inline(F.concat(F.transform(hyphen_prefixes("_oid"), lambda k: F.struct(k.alias("key"), F.lit(False).alias("exact"))), own)), "month", "_oid", "_od")
    if keys is not None:
        keyed = keyed.join(keys.select("key").distinct(), "key", "left_semi")
    newest = F.max(_newest_rank(F.col("_od"), F.col("_oid"))).alias("_o")     # the rank holds the order's id and date
    return keyed.groupBy("key", "exact", "month").agg(newest).select(
        "key", "exact", "month", F.col("_o")["i"].alias("order_id"), F.col("_o")["d"].alias("order_date"))


def merged_lookup(parts: DataFrame, include_exact: bool = True) -> DataFrame:
    """``order_lookup`` from its partial results: key -> (resolved order_id, is_exact)."""
    if not include_exact:
        parts = parts.filter(~F.col("exact"))
    rank = F.struct("exact", _newest_rank(F.col("order_date"), F.col("order_id")))
    return parts.groupBy("key").agg(F.max_by("order_id", rank).alias("resolved_id"), F.max("exact").alias("is_exact"))


def candidate_keys(df: DataFrame, cand_col: str) -> DataFrame:
    """The distinct candidates of ``resolve_order_id``, as ``key``."""
    return df.select(strip(F.col(cand_col)).alias("key")).filter("key is not null and key <> ''").distinct()


def latest_per_key(df: DataFrame, key: str | list[str], value: str, order_col: str,
                   out: str = "latest") -> DataFrame:
    """Per key, the value of the row with the newest ``order_col``
    (NULL first, as a DESC sort in the source database puts it)."""
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(
        F.max_by(value, _newest_rank(F.col(order_col), F.col(value))).alias(out))


def resolve_order_id(df: DataFrame, orders: DataFrame, cand_col: str, *, exact: bool = True,
                     out_order: str = "order_id", out_ext: str = "ext_order_id",
                     lookup: DataFrame | None = None, out_key: str | None = None, spread: Column | None = None) -> DataFrame:
    """J05 (exact=True) / J04 (exact=False).

    blank candidate -> (NULL, NULL); exact id -> (id, NULL);
    prefix of orders -> (newest such order, cand); else (NULL, cand).
    The input's columns are kept; ``out_order``/``out_ext`` are added/replaced.

    ``out_key`` names a column to keep the join's key in: rows with one candidate have one key, and rows without a
    candidate one by ``spread`` (a hash of their content). Grouped by it and more, rows stay where the join put them.
    """
    lk = lookup if lookup is not None else order_lookup(orders, include_exact=exact)
    cand = strip(F.col(cand_col))
    cand = F.when(cand != F.lit(""), cand)
    keep = [c for c in df.columns if c not in (out_order, out_ext)]
    # Rows without a candidate match nothing. They get keys that no order has, so
    # that the shuffle spreads them instead of sending them all to one task.
    number = F.monotonically_increasing_id() if spread is None else spread
    nowhere = F.concat(F.lit(NOWHERE), number.bitwiseAND(NULL_KEYS - 1).cast("string"))   # not nullable, so neither is the key
    left = df.select(*keep, F.coalesce(cand, nowhere).alias("_key"))
    j = left.join(lk, left["_key"] == lk["key"], "left")
    return j.select(
        *keep,
        F.col("resolved_id").alias(out_order),
        F.when(cand.isNotNull() & ~F.coalesce(F.col("is_exact"), F.lit(False)), cand).alias(out_ext),
        *([F.col("_key").alias(out_key)] if out_key else []),
    )


def resolve_exact(df: DataFrame, orders: DataFrame, cand_col: str, out: str = "exists") -> DataFrame:
    """Does an order with exactly this id exist (left join against
    distinct ids; no fan-out)."""
    ids = orders.select(F.col("order_id").alias("_hit_id")).distinct()
    cand = strip(F.col(cand_col))
    j = df.join(ids, cand == F.col("_hit_id"), "left")
    return j.withColumn(out, F.col("_hit_id").isNotNull()).drop("_hit_id")
