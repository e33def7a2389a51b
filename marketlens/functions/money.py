"""Money parsing.

Every parser yields ``decimal(18,4)``. Text money arrives as ``'1 234,56'``
(spaces as thousands separators, comma as decimal mark), sometimes with a
no-break space. Strict parsers raise on bad text with ``raise_error``, so the
behaviour does not depend on the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 4)


def zero() -> Column:
    """0 as money (built per call: no Column exists before a session does)."""
    return F.lit(0).cast(MONEY)
NBSP = "\u00a0"
# Characters Python's str.strip() removes (ASCII subset); SQL trim only drops ' '.
WHITESPACE = " \t\n\r\x0b\x0c"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _normalized(c: Column) -> Column:
    """Drop spaces, turn the decimal comma into a point."""
    return F.replace(F.replace(c.cast("string"), F.lit(" "), F.lit("")), F.lit(","), F.lit("."))


def _strict(text: Column, shown: Column) -> Column:
    parsed = (text).try_cast(MONEY)
    return F.coalesce(parsed, F.raise_error(F.concat(F.lit("invalid money value: "), F.coalesce(shown, F.lit("NULL")))).cast(MONEY))


def money_lenient(c) -> Column:
    """NULL -> 0; spaces dropped, ',' -> '.'; unparseable -> 0. A number
    that money cannot hold is not unparseable: it raises."""
    c = _col(c)
    text = _normalized(c)
    amount = text.try_cast(MONEY)
    too_large = amount.isNull() & text.try_cast("double").isNotNull() & ~F.isnan(text.try_cast("double")) \
        & (F.abs(text.try_cast("double")) != float("inf"))
    error = F.raise_error(F.concat(F.lit("money value out of range: "), c.cast("string"))).cast(MONEY)
    return F.when(too_large, error).otherwise(F.coalesce(amount, zero()))


def money_strict(c) -> Column:
    """NULL -> 0; spaces dropped, ',' -> '.'; unparseable (even '') raises."""
    c = _col(c)
    return F.when(c.isNull(), zero()).otherwise(_strict(_normalized(c), c.cast("string")))


def money_localized(c, strip_nbsp: bool = True, blank_is_zero: bool = True) -> Column:
    """Like strict, but surrounding whitespace, spaces and no-break spaces
    are removed and a blank value is 0.

    ``strip_nbsp=False`` gives the daily-statistics variant, which only drops
    plain spaces and treats any falsy value (NULL, '') as 0.
    """
    c = _col(c).cast("string")
    if strip_nbsp:
        cleaned = F.translate(F.btrim(c, F.lit(WHITESPACE)), " " + NBSP, "")
        blank = cleaned == F.lit("")
    else:
        cleaned = F.replace(c, F.lit(" "), F.lit(""))
        blank = c == F.lit("")
    text = F.replace(cleaned, F.lit(","), F.lit("."))
    out = F.when(c.isNull(), zero())
    if blank_is_zero:
        out = out.when(blank, zero())
    return out.otherwise(_strict(text, c))


def money_report(c) -> Column:
    """NULL or NaN -> 0, else strict."""
    c = _col(c)
    s = c.cast("string")
    is_nan = F.lower(F.btrim(s, F.lit(WHITESPACE))) == F.lit("nan")
    return F.when(c.isNull() | is_nan, zero()).otherwise(_strict(_normalized(c), s))


def line_revenue(price, quantity) -> Column:
    """Price x quantity, a NULL quantity counts as 0."""
    return _col(price) * F.coalesce(_col(quantity), zero())
