"""Lenient casts.

The original pipeline ran on a non-ANSI engine where a bad cast quietly
became NULL. With ANSI on, a plain ``cast`` raises instead, so these are
built from ``try_cast`` and reproduce the legacy results exactly:

* text -> int: blanks and control characters around the text are
  ignored; an optional sign, digits, and optionally a '.' followed only by
  digits; the fraction is cut off toward zero ('3.9' -> 3, '-2.7' -> -2,
  '5.' -> 5, and with no whole digits '.5' / '.' -> 0). Anything else
  ('', '+', ' In', 'VMC', '3.9x', '1.2.3', '1e3') and values outside
  32 bits ('99999999999') are NULL.
* text -> timestamp: the session time zone reads zone-less text; bad text
  is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferryline.functions.text import ColumnOrName, _col

# The text the legacy cast accepts, in one anchored pattern: blanks and
# ASCII control characters around (trimmed), then sign, digits and an
# optional fraction, captured as group 1. No match gives ''.
_LEGACY_INT_TEXT = r"^[\x00-\x20\x7f]*([+-]?[0-9]*(?:\.[0-9]*)?)[\x00-\x20\x7f]*$"


def lenient_int(c: ColumnOrName) -> Column:
    """One regex match validates and captures; ``try_cast`` then only sees
    integer syntax. (``try_cast`` of text that is not an integer, such as
    '17.00', costs an exception per row, about 20x the whole match.)"""
    number = F.regexp_extract(_col(c), _LEGACY_INT_TEXT, 1)  # '' when the text is no number
    whole = F.substring_index(number, ".", 1)
    return (
        F.when(number.isin("", "+", "-"), F.lit(None).cast("int"))
        .when(whole.isin("", "+", "-"), F.lit(0))
        .otherwise(whole.try_cast("int"))
    )


def lenient_timestamp(c: ColumnOrName) -> Column:
    return _col(c).try_cast("timestamp")


def cast_as(c: ColumnOrName, type_name: str) -> Column:
    """Route-column cast by type name; text stays as it is."""
    type_name = type_name.lower()
    if type_name in ("string", "text"):
        return _col(c)
    if type_name in ("int", "integer"):
        return lenient_int(c)
    if type_name == "timestamp":
        return lenient_timestamp(c)
    return _col(c).try_cast(type_name)
