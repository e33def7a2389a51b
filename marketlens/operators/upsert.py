"""Keyed table maintenance: last write wins (W02), upserts (U01-U11) and
UPDATE ... FROM (J06).

Parquet tables have no MERGE, so an upsert is a join on the key followed by
a per-column choice between the old and the new value. Each function returns
the new rows as a DataFrame; ``sources.store`` stages them before it overwrites
partitions.

Every operator here is one shuffle on the key (join or aggregate). Hot keys
are handled by map-side partial aggregation (``max_by``) and AQE skew-join
splitting, never by collecting a key's rows into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OLD = "_old_present"
_NEW = "_new_present"


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _any_null(keys: list[str]) -> Column:
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return cond


def last_write_wins(df: DataFrame, keys, ordinal: str, null_keys_pass: bool = True) -> DataFrame:
    """Keep the row with the greatest ``ordinal`` per key.

    Sequential ``INSERT ... ON CONFLICT DO UPDATE`` in arrival order leaves the
    last version of each key; ``ordinal`` is that arrival order (file, page,
    position). Rows whose key has a NULL never conflict and all pass through.
    The ordinal column is dropped from the output.
    """
    keys = _keys(keys)
    payload = [c for c in df.columns if c not in keys and c != ordinal]
    keyed = df.filter(~_any_null(keys)) if null_keys_pass else df
    latest = keyed.groupBy(*keys).agg(
        F.max_by(F.struct(*payload), F.col(ordinal)).alias("_row"))
    out = latest.select(*keys, *[F.col("_row")[c].alias(c) for c in payload])
    if null_keys_pass:
        out = out.unionByName(df.filter(_any_null(keys)).drop(ordinal))
    return out.select(*[c for c in df.columns if c != ordinal])


def latest_documents(df: DataFrame, key: str, ordinal: str = "_ordinal") -> DataFrame:
    """The last version of each document of a load, with its ordinal. Documents
    without a key are left out (F03)."""
    keyed = df.filter(F.col(key).isNotNull() & (F.col(key) != F.lit(""))).withColumn("_last", F.col(ordinal))
    return last_write_wins(keyed, key, "_last", null_keys_pass=False)   # none is NULL


def replace_by_key(old: DataFrame, new: DataFrame, keys, ordinal: str | None = None) -> DataFrame:
    """Upsert where every column of a matched row is overwritten.

    old rows whose key is not in ``new`` + all (deduplicated) new rows. Old
    rows with a NULL key are kept (they never conflict), new ones appended.
    """
    keys = _keys(keys)
    if ordinal is not None:
        new = last_write_wins(new, keys, ordinal)
    return kept_by_key(old, new, keys).unionByName(new.select(*old.columns))


def kept_by_key(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """The old rows that ``replace_by_key`` keeps."""
    keys = _keys(keys)
    new_keys = new.filter(~_any_null(keys)).select(*keys).distinct()
    # NULL keys match nothing: their rows go round the join, not through one task of it
    kept = old.filter(~_any_null(keys)).join(new_keys, keys, "left_anti").select(*old.columns)
    return kept.unionByName(old.filter(_any_null(keys)))


def upsert(old: DataFrame, new: DataFrame, keys, update_cols: list[str] | None = None,
           insert_only_cols: list[str] | None = None, ordinal: str | None = None) -> DataFrame:
    """General upsert (U01, U07): one full-outer join on the key.

    - key only in old: row unchanged;
    - key only in new: inserted; columns missing from ``new`` are NULL;
    - key in both: ``update_cols`` take the new value, every other column keeps
      the old one (``insert_only_cols`` are listed for clarity: they are never
      updated).
    """
    keys = _keys(keys)
    insert_only_cols = list(insert_only_cols or [])
    if ordinal is not None:
        new = last_write_wins(new, keys, ordinal)
    new_cols = [c for c in new.columns if c not in keys]
    if update_cols is None:
        update_cols = [c for c in new_cols if c not in insert_only_cols]
    o = old.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in old.columns if c not in keys],
                   F.lit(True).alias(_OLD))
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in new_cols], F.lit(True).alias(_NEW))
    j = o.join(n, keys, "full_outer")
    out = []
    for c in old.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        old_v = F.col(f"_o_{c}")
        if c in new_cols:
            new_v = F.col(f"_n_{c}")
            if c in update_cols:
                v = F.when(F.col(_NEW).isNotNull(), new_v).otherwise(old_v)
            else:
                v = F.when(F.col(_OLD).isNotNull(), old_v).otherwise(new_v)
        else:
            v = old_v
        out.append(v.alias(c))
    return j.select(*out)


def insert_absent(old: DataFrame, new: DataFrame, keys) -> DataFrame:
    """``ON CONFLICT DO NOTHING`` (U02, U10): new keys not yet present are
    added (once each); existing rows are untouched."""
    keys = _keys(keys)
    types = dict(old.dtypes)
    shaped = new.select(*[F.col(c) if c in new.columns else F.lit(None).cast(types[c]).alias(c)
                          for c in old.columns])
    fresh = shaped.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti")
    return old.unionByName(fresh)


def replace_scope(old: DataFrame, new: DataFrame, scope_keys: DataFrame, keys,
                  predicate: Column | None = None) -> DataFrame:
    """Delete-then-insert (U04, U05): old rows whose key is in ``scope_keys``
    (and, if given, satisfy ``predicate``) are replaced by ``new``.

    ``scope_keys`` lists every incoming parent key, so a parent that now has
    zero children still has its old children deleted.
    """
    keys = _keys(keys)
    scope = scope_keys.select(*keys).distinct()
    may = ~_any_null(keys)
    if predicate is not None:
        may = may & F.coalesce(predicate, F.lit(False))
    # only rows that can be in scope take part in the join; the others (NULL keys, other
    # sources) go round it
    kept = old.filter(may).join(scope, keys, "left_anti").unionByName(old.filter(~may))
    return kept.select(*old.columns).unionByName(new.select(*old.columns))


def replace_source(old: DataFrame, new: DataFrame, source: str, column: str = "source") -> DataFrame:
    """All old rows of ``source`` are replaced by ``new``; rows without a
    source stay. A filter and a union, no shuffle."""
    kept = old.filter(~F.coalesce(F.col(column) == F.lit(source), F.lit(False)))
    return kept.unionByName(new.select(*old.columns))


def update_from(target: DataFrame, agg: DataFrame, keys, columns: dict[str, Column]) -> DataFrame:
    """``UPDATE target SET c = expr FROM agg WHERE key = key``.

    Matched rows take ``columns[c]`` (expressions may use the target's and the
    aggregate's columns); unmatched rows keep their old values.
    """
    keys = _keys(keys)
    marked = agg.withColumn("_matched", F.lit(True))
    a_cols = [c for c in marked.columns if c not in keys]
    clash = {c for c in a_cols if c in target.columns}
    a = marked.select(*keys, *[F.col(c).alias(f"_a_{c}") if c in clash else F.col(c) for c in a_cols])
    j = target.join(a, keys, "left")
    out = []
    for c in target.columns:
        if c in columns:
            out.append(F.when(F.col("_matched").isNotNull(), columns[c]).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)

