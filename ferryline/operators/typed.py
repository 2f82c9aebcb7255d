"""Typed projections ("routes") of flat string records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.casts import cast_as


@dataclass(frozen=True)
class Route:
    """An output table: ordered ``(column, type)`` pairs; types are
    ``string``, ``int`` or ``timestamp`` (lenient casts)."""

    name: str
    columns: tuple[tuple[str, str], ...]

    @property
    def fields(self) -> tuple[str, ...]:
        return tuple(c for c, _ in self.columns)

    def apply(self, df: DataFrame) -> DataFrame:
        return typed_select(df, self.columns)


def route_records(changes: DataFrame, route: Route, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Change envelopes -> one typed route, parsing only the route's fields."""
    from ferryline.operators.changes import keep_fields, unwrap_after

    return route.apply(unwrap_after(changes, keep_fields(schema, route.fields), value_col))


def typed_select(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    return df.select(*[cast_as(F.col(name), t).alias(name) for name, t in columns])
