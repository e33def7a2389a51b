"""Scalar column functions. All are built-in Spark expressions (no UDFs)."""

from marketlens.functions.money import (MONEY, money_lenient, money_strict, money_localized,
                                        money_report, line_revenue)
from marketlens.functions.ids import (strip, customer_from_posting, customer_from_posting_simple,
                                      posting_id_normalize, int_lenient, first_present, fee_uid)
from marketlens.functions.dates import date_any, date_any_lenient, iso_z, text_to_ntz
from marketlens.functions.fees import fee_group_classify, fee_name_normalize, not_double_counted

__all__ = [
    "MONEY", "money_lenient", "money_strict", "money_localized", "money_report", "line_revenue",
    "strip", "customer_from_posting", "customer_from_posting_simple", "posting_id_normalize",
    "int_lenient", "first_present", "fee_uid", "date_any", "date_any_lenient", "iso_z",
    "text_to_ntz", "fee_group_classify", "fee_name_normalize", "not_double_counted",
]
