"""Upserts: last write wins, keep-old columns, insert-only, scope deletes,
NULL keys, and idempotence (applying twice equals applying once)."""

from pyspark.sql import functions as F

from marketlens.operators import upsert


def sorted_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_last_write_wins_and_null_keys(spark):
    df = spark.createDataFrame([("k", 1, 1), ("k", 2, 3), ("k", 3, 2), (None, 4, 1), (None, 5, 2)],
                               "key string, v int, ord int")
    out = upsert.last_write_wins(df, "key", "ord")
    assert sorted_rows(out.fillna("~", ["key"])) == [("k", 2), ("~", 4), ("~", 5)]


def test_replace_by_key_idempotent(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), (None, 9)], "k string, v int")
    new = spark.createDataFrame([("b", 20, 1), ("c", 30, 1), ("c", 31, 2)], "k string, v int, o int")
    once = upsert.replace_by_key(old, new, "k", ordinal="o")
    twice = upsert.replace_by_key(once, new, "k", ordinal="o")
    assert sorted_rows(once.fillna("~")) == [("a", 1), ("b", 20), ("c", 31), ("~", 9)]
    assert sorted_rows(twice.fillna("~")) == sorted_rows(once.fillna("~"))


def test_upsert_keeps_derived_and_insert_only(spark):
    old = spark.createDataFrame([("a", "x", "2024", True)], "id string, title string, created string, flag boolean")
    new = spark.createDataFrame([("a", "y", "2030"), ("b", "z", "2031")], "id string, title string, created string")
    out = upsert.upsert(old, new, "id", insert_only_cols=["created"])
    assert sorted_rows(out.fillna(False, ["flag"])) == [("a", "y", "2024", True), ("b", "z", "2031", False)]
    again = upsert.upsert(out, new, "id", insert_only_cols=["created"])
    assert sorted_rows(again.fillna(False, ["flag"])) == sorted_rows(out.fillna(False, ["flag"]))


def test_replace_scope_with_predicate(spark):
    old = spark.createDataFrame([("o1", "p", 1), ("o1", "f", 2), ("o2", "p", 3), ("o3", None, 4)],
                                "order_id string, source string, v int")
    new = spark.createDataFrame([("o1", "p", 10)], "order_id string, source string, v int")
    scope = spark.createDataFrame([("o1",), ("o3",)], "order_id string")  # o3 now has no rows
    out = upsert.replace_scope(old, new, scope, "order_id", F.col("source") == "p")
    assert sorted_rows(out.fillna("~")) == [("o1", "f", 2), ("o1", "p", 10), ("o2", "p", 3), ("o3", "~", 4)]


def test_insert_absent(spark):
    old = spark.createDataFrame([("a", 1)], "k string, n int")
    new = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    out = upsert.insert_absent(old, new, "k")
    assert sorted_rows(out.fillna(0)) == [("a", 1), ("b", 0)]


def test_update_from_keeps_unmatched(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    agg = spark.createDataFrame([("a", 10)], "k string, s int")
    out = upsert.update_from(t, agg, "k", {"v": F.col("s")})
    assert sorted_rows(out) == [("a", 10), ("b", 2)]
