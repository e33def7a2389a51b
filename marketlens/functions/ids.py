"""Identifier helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlens import vocab
from marketlens.functions.money import WHITESPACE, _col


def strip(c) -> Column:
    """Python-style strip of surrounding whitespace."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def customer_from_posting(c) -> Column:
    """Customer id = text before the first '-', else before the first '_',
    else the whole (stripped) id; blank or NULL -> 'unknown'."""
    s = strip(c)
    return (F.when(s.isNull() | (s == F.lit("")), F.lit(vocab.UNKNOWN_CUSTOMER))
            .when(F.instr(s, "-") > 0, F.substring_index(s, "-", 1))
            .when(F.instr(s, "_") > 0, F.substring_index(s, "_", 1))
            .otherwise(s))


def customer_from_posting_simple(c) -> Column:
    """Text before the first '-' (whole id if none); NULL/'' -> ''. No trim."""
    s = _col(c).cast("string")
    return F.when(s.isNull() | (s == F.lit("")), F.lit("")).otherwise(F.substring_index(s, "-", 1))


def posting_id_normalize(c) -> Column:
    """Keep the stripped id only if it looks like ``digits-digits-digits``."""
    s = strip(c)
    return F.when(s.rlike(vocab.POSTING_NUMBER_PATTERN), s)


def int_lenient(c) -> Column:
    """Integer, or NULL when the text is not an integer."""
    return (_col(c).cast("string")).try_cast("bigint")


def first_present(*cols, default=None) -> Column:
    """First value that is neither NULL nor '' (Python ``a or b or ...``)."""
    parts = [F.when(_col(c).cast("string") != F.lit(""), _col(c).cast("string")) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def uid_part(c) -> Column:
    """A uid component: NULL or '' -> ''; numbers as text, 0 counts as blank."""
    c = _col(c)
    return F.coalesce(c.cast("string"), F.lit(""))


def sku_uid_part(c) -> Column:
    """``str(sku or '')``: a NULL or 0 sku contributes ''."""
    c = _col(c)
    return F.when(c.isNull() | (c == F.lit(0)), F.lit("")).otherwise(c.cast("string"))


def fee_uid(source, order_id, ext_order_id, operation_type, fee_group, fee_name,
            occurred_at, sku) -> Column:
    """md5 over the eight '|'-joined parts, NULL parts as ''.

    ``concat_ws`` skips NULLs, so every part is coalesced first; ``occurred_at``
    is the raw text the row arrived with.
    """
    parts = [uid_part(source), uid_part(order_id), uid_part(ext_order_id),
             uid_part(operation_type), uid_part(fee_group), uid_part(fee_name),
             uid_part(occurred_at), sku_uid_part(sku)]
    return F.md5(F.concat_ws("|", *parts))
