"""Date parsing and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlens.functions.money import _col
from marketlens.functions.ids import strip

# Accepted report date layouts. Single-letter fields accept one or two digits,
# as a strptime-style parser does ('5.12.2025' and '05.12.2025' both parse).
DATE_FORMATS = ["yyyy-M-d", "d.M.yyyy", "d/M/yyyy"]
LENIENT_FORMATS = ["yyyy-M-d", "d.M.yyyy", "yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m:s'Z'",
                   "yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s.SSSSSS", "yyyy-M-d H:m:s.SSSSSS"]


def tried(s: Column, layout: str, parse) -> Column:
    """``parse(s, layout)``, where the text holds the layout's separators; it could not fit without them, and a text that does
    not fit costs the parser an exception."""
    marks = [c for c in "-./:" if c in layout]
    fits = F.contains(s, F.lit(marks[0]))
    for c in marks[1:]:
        fits = fits & F.contains(s, F.lit(c))
    return F.when(fits, parse(s, layout))


def _first_parse(s: Column, formats) -> Column:
    return F.coalesce(*[tried(s, f, F.try_to_date) for f in formats])


def date_any(c) -> Column:
    """Parse one of three layouts; NULL/'' -> NULL; anything else raises."""
    raw = _col(c).cast("string")
    s = strip(raw)
    parsed = _first_parse(s, DATE_FORMATS)
    return (F.when(raw.isNull() | (raw == F.lit("")), F.lit(None).cast("date"))
            .otherwise(F.coalesce(parsed, F.raise_error(F.concat(F.lit("Unknown date format: "), s)).cast("date"))))


def date_any_lenient(c) -> Column:
    """More layouts, including ISO date-times; unknown -> NULL."""
    raw = _col(c).cast("string")
    s = strip(raw)
    return F.when(raw.isNull() | (raw == F.lit("")), F.lit(None).cast("date")).otherwise(_first_parse(s, LENIENT_FORMATS))


def iso_z(c) -> Column:
    """Format a timestamp as ISO-8601 text with a literal 'Z'."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def text_to_ntz(c) -> Column:
    """ISO text (optionally ending in 'Z') -> wall-clock ``timestamp_ntz``.

    A 'Z' is dropped rather than applied, as a TIMESTAMP-without-zone column
    stores it; unparseable text gives NULL."""
    return strip(c).try_cast("timestamp_ntz")
