"""Line-level text functions.

Semantics follow the original pipeline exactly: quotes are deleted, not
interpreted, and a line is cut at every separator, keeping empty fields
(trailing ones too). A field past the end of the line is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_quotes(c: ColumnOrName, quote: str = '"') -> Column:
    """Delete every quote character (no CSV quoting rules)."""
    return F.replace(_col(c), F.lit(quote), F.lit(""))


def split_fields_array(c: ColumnOrName, sep: str = ",") -> Column:
    """Split on every separator, keeping empty and trailing-empty fields.

    ``sep`` is a regular expression, as in ``String.split``; a blank line
    gives one empty field.
    """
    return F.split(_col(c), sep, -1)


def field_at(arr: ColumnOrName, ordinal: int) -> Column:
    """0-based field of an array; NULL past the end (never an error)."""
    return F.get(_col(arr), F.lit(ordinal))


def first_field(c: ColumnOrName, sep: str = ",") -> Column:
    """First separated field of a line, used as the message key."""
    return F.substring_index(_col(c), sep, 1) if len(sep) == 1 else field_at(
        split_fields_array(c, sep), 0
    )
