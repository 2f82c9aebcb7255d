"""Column-level building blocks (all JVM-side, codegen-friendly)."""

from ferryline.functions.casts import cast_as, lenient_int, lenient_timestamp
from ferryline.functions.json import json_path, parse_json
from ferryline.functions.text import field_at, first_field, split_fields_array, strip_quotes

__all__ = [
    "cast_as",
    "field_at",
    "first_field",
    "json_path",
    "lenient_int",
    "lenient_timestamp",
    "parse_json",
    "split_fields_array",
    "strip_quotes",
]
