"""Transport rows derived from the warehouse tables.

The registered queries and the benchmark need the pipeline's *inputs*
(accident-style CSV lines, keyed topic rows, JSON change envelopes) at the
size of the given tables. These builders make them from ``lineitem``,
``orders``, ``customer`` and ``events`` with plain column expressions,
so the work grows with the tables. Each line rule is kept as SQL text in
both Spark and DuckDB dialects so the oracle can rebuild the same input
independently of the Spark code.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.functions.text import field_at, split_fields_array, strip_quotes
from ferryline.schemas import CSV_HEADER, INGEST_FIELDS


@dataclass(frozen=True)
class Expr:
    spark: str
    duck: str | None = None

    @property
    def duckdb(self) -> str:
        return self.duck if self.duck is not None else self.spark


def _s(col: str) -> str:
    return f"cast({col} as string)"


# One rule per CSV column (31, header order) over a lineitem row; the names are
# the fixed values of CSV_HEADER.
# Line 3 of an order gets a Location without a comma (later fields shift
# left); line 5 gets an Airport.Name with a comma (later fields shift right).
ACCIDENT_LINE_RULES: tuple[tuple[str, Expr], ...] = (
    ("Event.Id", Expr(f"concat({_s('l_orderkey')}, 'X', {_s('l_linenumber')})")),
    ("Investigation.Type", Expr("CASE WHEN l_returnflag = 'R' THEN 'Incident' ELSE 'Accident' END")),
    ("Accident.Number", Expr(f"concat('ACC', {_s('l_partkey')})")),
    ("Event.Date", Expr("date_format(l_shipdate, 'yyyy-MM-dd')", "strftime(l_shipdate, '%Y-%m-%d')")),
    (
        "Location",
        Expr(
            f"CASE WHEN l_linenumber = 3 THEN concat('\"CITY', {_s('l_suppkey')}, '\"') "
            f"ELSE concat('\"CITY', {_s('l_suppkey')}, ', S', l_linestatus, '\"') END"
        ),
    ),
    ("Country", Expr("'United States'")),
    ("Latitude", Expr("''")),
    ("Longitude", Expr("''")),
    ("Airport.Code", Expr(f"concat('AP', {_s('l_suppkey')})")),
    (
        "Airport.Name",
        Expr(f"CASE WHEN l_linenumber = 5 THEN concat('\"FIELD ', {_s('l_suppkey')}, ', INC\"') ELSE '' END"),
    ),
    (
        "Injury.Severity",
        Expr(f"CASE WHEN l_discount >= 0.08 THEN concat('Fatal(', {_s('l_linenumber')}, ')') ELSE 'Non-Fatal' END"),
    ),
    ("Aircraft.damage", Expr("CASE WHEN l_linestatus = 'F' THEN 'Destroyed' ELSE 'Substantial' END")),
    ("Aircraft.Category", Expr("'Airplane'")),
    ("Registration.Number", Expr(f"concat('N', {_s('l_partkey')})")),
    ("Make", Expr(f"concat('MAKE', {_s('l_suppkey')})")),
    ("Model", Expr(f"concat('M-', {_s('l_linenumber')})")),
    ("Amateur.Built", Expr("CASE WHEN l_tax >= 0.05 THEN 'Yes' ELSE 'No' END")),
    ("Number.of.Engines", Expr(_s("l_linenumber"))),
    ("Engine.Type", Expr("'Reciprocating'")),
    ("FAR.Description", Expr("''")),
    ("Schedule", Expr("''")),
    ("Purpose.of.flight", Expr("'Personal'")),
    ("Air.carrier", Expr("''")),
    ("Total.Fatal.Injuries", Expr("cast(cast(l_quantity as decimal(18,2)) as string)")),
    ("Total.Serious.Injuries", Expr(_s("l_linenumber"))),
    ("Total.Minor.Injuries", Expr(_s("l_suppkey"))),
    ("Total.Uninjured", Expr(_s("l_partkey"))),
    ("Weather.Condition", Expr("CASE WHEN l_linestatus = 'O' THEN 'VMC' ELSE 'IMC' END")),
    (
        "Broad.phase.of.flight",
        Expr("CASE l_returnflag WHEN 'A' THEN 'Cruise' WHEN 'N' THEN 'Landing' ELSE 'Takeoff' END"),
    ),
    ("Report.Status", Expr("'Probable Cause'")),
    ("Publication.Date", Expr("date_format(l_shipdate, 'dd-MM-yyyy')", "strftime(l_shipdate, '%d-%m-%Y')")),
)

assert ",".join(name for name, _ in ACCIDENT_LINE_RULES) == CSV_HEADER

# lineitem columns the rules read (column pruning keeps the scan to these)
LINE_SOURCE_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


def accident_line_sql(dialect: str = "spark") -> str:
    parts = [e.spark if dialect == "spark" else e.duckdb for _, e in ACCIDENT_LINE_RULES]
    return "concat_ws(',', " + ", ".join(parts) + ")"


def accident_lines(lineitem: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One raw accident CSV line (``value``) per lineitem row."""
    return lineitem.select(*keep, F.expr(accident_line_sql("spark")).alias("value"))


# ---------------------------------------------------------------- envelopes


def envelope(after: Column, op: Column, before: Column | None = None, ts_ms: Column | None = None) -> Column:
    """Debezium-style change message text ``{"payload": {...}}``."""
    payload = F.struct(
        (before if before is not None else F.lit(None).cast("string")).alias("before"),
        after.alias("after"),
        op.alias("op"),
        (ts_ms if ts_ms is not None else F.lit(0).cast("long")).alias("ts_ms"),
    )
    return F.to_json(F.struct(payload.alias("payload")), {"ignoreNullFields": "false"})


def change_ops(updated: Column, deleted: Column | None = None) -> Column:
    """The change operations one source row emits, in order: always 'c',
    then 'u' where ``updated`` holds and 'd' where ``deleted`` holds.

    Built from ``concat_ws`` (which skips NULLs) and ``split`` rather than
    a lambda ``filter``, so the explode stays inside whole-stage codegen.
    """
    parts = [F.lit("c"), F.when(updated, F.lit("u"))]
    if deleted is not None:
        parts.append(F.when(deleted, F.lit("d")))
    return F.split(F.concat_ws(",", *parts), ",")


def accident_records(lineitem: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """What the ingest job stores: the 30 named text fields of each line
    (quotes deleted, split on every comma), plus the ``keep`` columns."""
    lines = accident_lines(lineitem, keep=keep)
    split = lines.select(*keep, split_fields_array(strip_quotes("value")).alias("__f"))
    return split.select(*keep, *[field_at("__f", i).alias(n) for i, n in enumerate(INGEST_FIELDS)])


def accident_changes(lineitem: DataFrame) -> DataFrame:
    """Change feed of the ingested accident table, one scan of lineitem.

    Every row is created ('c'); rows with return flag R are updated once
    more (injury_severity set to 'Fatal(1)'); line 7 of orders with line
    status F is deleted afterwards (``after: null``). Output: ``key``
    (the event id) and ``value`` (the envelope).
    """
    rows = accident_records(lineitem, keep=("l_returnflag", "l_linestatus", "l_linenumber"))
    ops = change_ops(
        F.col("l_returnflag") == "R",
        (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 7),
    )
    rows = rows.withColumn("op", F.explode(ops))
    row = F.struct(*[F.col(n) for n in INGEST_FIELDS])
    updated = F.struct(
        *[(F.lit("Fatal(1)") if n == "injury_severity" else F.col(n)).alias(n) for n in INGEST_FIELDS]
    )
    after = F.when(F.col("op") == "c", row).when(F.col("op") == "u", updated)
    before = F.when(F.col("op") != "c", row)
    return rows.select(F.col("event_id").alias("key"), envelope(after, F.col("op"), before).alias("value"))
