"""Fixed record layouts of the accident pipeline.

These values must equal the original pipeline's for identical results, so
they are stated here once, as data, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: field names by ordinal of a quote-stripped, comma-split line ---
LINE_FIELDS: tuple[str, ...] = (
    "event_id",
    "investigation_type",
    "accident_number",
    "event_date",
    "location_city",
    "location_state",
    "country",
    "latitude",
    "longitude",
    "airport_code",
    "airport_name",
    "injury_severity",
    "aircraft_damage",
    "aircraft_category",
    "registration_number",
    "make",
    "model",
    "amateur_built",
    "number_of_engines",
    "engine_type",
    "far_description",
    "schedule",
    "purpose_of_flight",
    "air_carrier",
    "total_fatal_injuries",
    "total_serious_injuries",
    "total_minor_injuries",
    "total_uninjured",
    "weather_condition",
    "broad_phase_of_flight",
    "report_status",
    "publication_date",
)

# The ingest job keeps ordinals 0..29; the change-feed parse schema has all 32.
INGEST_FIELDS: tuple[str, ...] = LINE_FIELDS[:30]
CHANGE_FIELDS: tuple[str, ...] = LINE_FIELDS

# --- fixed values: header line of the accident CSV (31 columns) ---
CSV_HEADER = (
    "Event.Id,Investigation.Type,Accident.Number,Event.Date,Location,Country,"
    "Latitude,Longitude,Airport.Code,Airport.Name,Injury.Severity,Aircraft.damage,"
    "Aircraft.Category,Registration.Number,Make,Model,Amateur.Built,"
    "Number.of.Engines,Engine.Type,FAR.Description,Schedule,Purpose.of.flight,"
    "Air.carrier,Total.Fatal.Injuries,Total.Serious.Injuries,Total.Minor.Injuries,"
    "Total.Uninjured,Weather.Condition,Broad.phase.of.flight,Report.Status,"
    "Publication.Date"
)

# --- fixed values: topic and table names ---
LINE_TOPIC = "csv_to_mysql"
CHANGE_TOPIC = "internal_topic.inventory.aviation_data"
INGEST_TABLE = "aviation_data"
QUANTITATIVE_TABLE = "quantitative_table"
QUALITATIVE_TABLE = "qualitative_table"

# --- fixed values: routed projections, (column, type) in output order ---
QUANTITATIVE_ROUTE: tuple[tuple[str, str], ...] = (
    ("event_date", "timestamp"),
    ("investigation_type", "string"),
    ("location_city", "string"),
    ("location_state", "string"),
    ("country", "string"),
    ("airport_code", "string"),
    ("airport_name", "string"),
    ("injury_severity", "string"),
    ("total_fatal_injuries", "int"),
    ("total_serious_injuries", "int"),
    ("total_minor_injuries", "int"),
    ("total_uninjured", "int"),
    ("weather_condition", "string"),
    ("broad_phase_of_flight", "string"),
)

# Older variant of the quantitative route that also carried report_status
# (NULL for every change from the 30-column ingest table).
QUANTITATIVE_ROUTE_WITH_STATUS: tuple[tuple[str, str], ...] = QUANTITATIVE_ROUTE + (("report_status", "string"),)

QUALITATIVE_ROUTE: tuple[tuple[str, str], ...] = (
    ("event_date", "timestamp"),
    ("investigation_type", "string"),
    ("injury_severity", "string"),
    ("total_fatal_injuries", "int"),
    ("total_serious_injuries", "int"),
    ("total_minor_injuries", "int"),
    ("total_uninjured", "int"),
    ("aircraft_damage", "string"),
    ("aircraft_category", "string"),
    ("registration_number", "string"),
    ("make", "string"),
    ("model", "string"),
    ("amateur_built", "string"),
    ("number_of_engines", "int"),
    ("engine_type", "string"),
    ("purpose_of_flight", "string"),
)


def string_struct(names) -> T.StructType:
    """All-string struct, the shape every field has while in flight."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


CHANGE_SCHEMA: T.StructType = string_struct(CHANGE_FIELDS)
