"""Fee vocabulary functions (P09, P10) and the double-count predicate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlens import vocab
from marketlens.functions.money import _col


def fee_group_of_lower(lc) -> Column:
    """P10 over an already lower-cased name: keyword rules top-down, first
    match wins, else 'other'. Reference a column computed in an earlier
    projection so the lower-casing runs once per row, not once per keyword."""
    s = _col(lc)
    out = None
    for group, keywords in vocab.FEE_GROUP_RULES:
        cond = None
        for k in keywords:
            hit = F.instr(s, k) > 0
            cond = hit if cond is None else (cond | hit)
        out = F.when(cond, F.lit(group)) if out is None else out.when(cond, F.lit(group))
    return out.otherwise(F.lit(vocab.FEE_GROUP_OTHER))


def lower_name(c) -> Column:
    return F.lower(F.coalesce(_col(c).cast("string"), F.lit("")))


def fee_group_classify(c) -> Column:
    """P10: ordered keyword rules over the lower-cased name, first match wins."""
    return fee_group_of_lower(lower_name(c))


def fee_name_normalize(c) -> Column:
    """Readable name for known service codes; blank -> 'UNKNOWN'; else as is."""
    s = _col(c).cast("string")
    out = F.when(s.isNull() | (s == F.lit("")), F.lit(vocab.FEE_NAME_UNKNOWN))
    for code, name in vocab.FEE_NAME_MAP.items():
        out = out.when(s == F.lit(code), F.lit(name))
    return out.otherwise(s)


def not_double_counted(source="source", fee_group="fee_group") -> Column:
    """``NOT (source = 'finance_api' AND fee_group = <commission>)``.

    Kept as SQL three-valued logic: a NULL result drops the row in a filter.
    """
    return ~((_col(source) == F.lit(vocab.SOURCE_FINANCE_API))
             & (_col(fee_group) == F.lit(vocab.FEE_GROUP_COMMISSION)))
