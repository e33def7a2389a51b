"""Plan assertions over all registered queries: no nested-loop or cartesian
joins, no Python evaluation, scans read pruned schemas."""

import io
import re
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as E
from conftest import SMALL
from marketlens.plans.registry import QUERIES as REGISTERED

# Queries that write (sources, batch plans, streams) are checked through their
# operators elsewhere; explaining them would re-run their landing steps.
SKIP_PREFIX = ("src_", "batch_", "stream_", "dim_catalog")
NAMES = sorted(n for n in REGISTERED if not n.startswith(SKIP_PREFIX))


@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SMALL)
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"
    # every lineitem scan reads a pruned column set
    for m in re.finditer(r"ReadSchema: struct<([^>]*)>", plan):
        assert m.group(1).count(":") < 11 or "l_" not in m.group(1)
