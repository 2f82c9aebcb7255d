"""JSON extraction and parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.text import ColumnOrName, _col


def json_path(c: ColumnOrName, path: str) -> Column:
    """Text at a JSON path. JSON null, a missing path or bad JSON give NULL;
    objects and arrays come back as minified JSON text."""
    return F.get_json_object(_col(c), path)


def parse_json(c: ColumnOrName, schema: T.StructType) -> Column:
    """PERMISSIVE parse against a fixed schema.

    Fields absent from the JSON are NULL, fields absent from the schema are
    dropped, and a JSON number or object read into a string field keeps its
    text. NULL input or text that is not a JSON object gives a NULL struct.
    """
    return F.from_json(_col(c), schema, {"mode": "PERMISSIVE"})
