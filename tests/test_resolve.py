"""Order resolution by exact id and id prefix."""

import datetime as dt

from marketlens.operators import resolve


def orders(spark):
    rows = [("100-1-1", dt.datetime(2025, 1, 1)), ("100-2-1", dt.datetime(2025, 1, 5)),
            ("200-9-1", None), ("200-8-1", dt.datetime(2025, 3, 1)),
            ("300", dt.datetime(2025, 1, 1)), ("400-", dt.datetime(2025, 1, 1)),
            ("a_b-1-1", dt.datetime(2025, 1, 1)), ("500-1-1", dt.datetime(2025, 2, 2)),
            ("500-1-2", dt.datetime(2025, 2, 2))]
    return spark.createDataFrame(rows, "order_id string, order_date timestamp_ntz")


def resolved(spark, cands, exact=True):
    df = spark.createDataFrame([(c,) for c in cands], "cand string")
    out = resolve.resolve_order_id(df, orders(spark), "cand", exact=exact)
    return {r["cand"]: (r["order_id"], r["ext_order_id"]) for r in out.collect()}


def test_cascade(spark):
    got = resolved(spark, ["100-1-1", "100", "100-2", "200", "300", "400", " ", "999", "a_b", "a%b", "500-1"])
    assert got["100-1-1"] == ("100-1-1", None)          # exact
    assert got["100"] == ("100-2-1", "100")             # newest of two prefix matches
    assert got["100-2"] == ("100-2-1", "100-2")
    assert got["200"] == ("200-9-1", "200")             # a NULL date sorts first (DESC NULLS FIRST)
    assert got["300"] == ("300", None)                  # no hyphen: exact only
    assert got["400"] == ("400-", "400")                # id ending in '-'
    assert got[" "] == (None, None)                     # blank candidate
    assert got["999"] == (None, "999")                  # unresolved
    assert got["a_b"] == ("a_b-1-1", "a_b")             # '_' is literal
    assert got["a%b"] == (None, "a%b")                  # '%' is literal
    assert got["500-1"] == ("500-1-2", "500-1")         # equal dates: deterministic tie-break


def test_prefix_only_skips_exact(spark):
    got = resolved(spark, ["300", "100"], exact=False)
    assert got["300"] == (None, "300")
    assert got["100"] == ("100-2-1", "100")


def test_no_nested_loop_join(spark):
    df = spark.createDataFrame([("100",)], "cand string")
    plan = resolve.resolve_order_id(df, orders(spark), "cand")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hyphen_prefixes(spark):
    df = spark.createDataFrame([("a-b-c",), ("abc",), ("a--b",)], "id string")
    out = [r[0] for r in df.select(resolve.hyphen_prefixes("id")).collect()]
    assert out == [["a", "a-b"], [], ["a", "a-"]]
