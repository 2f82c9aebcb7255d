"""Line and change-envelope operators, golden rows and edge cases."""

import json

from ferryline.operators import (
    Route,
    decode_messages,
    keep_fields,
    keyed_messages,
    split_fields,
    typed_select,
    unwrap_after,
    unwrap_after_three_step,
)
from ferryline.schemas import (
    CHANGE_SCHEMA,
    INGEST_FIELDS,
    LINE_FIELDS,
    QUALITATIVE_ROUTE,
    QUANTITATIVE_ROUTE,
    string_struct,
)
from tests.golden import EXPECTED, KEYS, LINES


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_golden_rows_publish_then_split(spark):
    msgs = keyed_messages(lines_df(spark, LINES), "csv_to_mysql")
    got = msgs.collect()
    assert [r.key for r in got] == KEYS
    assert all('"' not in r.value for r in got)
    rows = [tuple(r) for r in split_fields(msgs, INGEST_FIELDS).collect()]
    assert rows == EXPECTED


def test_golden_shift_semantics(spark):
    msgs = keyed_messages(lines_df(spark, LINES), "t")
    rows = split_fields(msgs, LINE_FIELDS).collect()
    # embedded comma shifts right: ' In' lands in total_fatal_injuries
    assert rows[1].total_fatal_injuries == " In"
    # no comma in Location shifts left: 'Probable Cause' in broad_phase_of_flight
    assert rows[2].broad_phase_of_flight == "Probable Cause"
    assert rows[2].publication_date is None  # past the end
    # state keeps its leading blank; empty field is '' not NULL
    assert rows[0].location_state == " ID" and rows[0].latitude == ""


def test_keyed_messages_partition_optional(spark):
    df = lines_df(spark, LINES[:1])
    assert keyed_messages(df, "t").columns == ["key", "value", "topic"]
    pinned = keyed_messages(df, "t", partition=1).first()
    assert pinned.partition == 1 and pinned.topic == "t"


def test_blank_line_gives_empty_key_and_nulls(spark):
    row = split_fields(keyed_messages(lines_df(spark, [""]), "t"), INGEST_FIELDS).first()
    assert row.event_id == "" and all(row[i] is None for i in range(1, 30))


def test_decode_messages(spark):
    df = spark.createDataFrame(
        [(bytearray(b"k"), bytearray("vé".encode()), "t", 0, 5), (None, None, "t", 1, 6)],
        "key binary, value binary, topic string, partition int, offset long",
    )
    got = decode_messages(df).collect()
    assert decode_messages(df).columns == ["key", "value", "topic"]
    assert (got[0].key, got[0].value) == ("k", "vé")
    assert (got[1].key, got[1].value) == (None, None)


def _env(after, op="c", before=None):
    return json.dumps({"payload": {"before": before, "after": after, "op": op, "ts_ms": 1}})


EDGE_VALUES = [
    _env({"event_id": "1", "make": "Bell", "total_uninjured": "3"}),  # insert
    _env({"event_id": "1", "make": "Bell", "total_uninjured": "4"}, "u", {"event_id": "1"}),  # update
    _env(None, "d", {"event_id": "1"}),  # delete
    None,  # tombstone
    "not json at all",
    json.dumps({"schema": {}, "nopayload": 1}),
    _env({"event_id": 7, "make": {"a": 1}, "unknown_field": "x"}),  # number, object, extra field
]


def test_unwrap_edge_cases(spark):
    df = spark.createDataFrame([(v,) for v in EDGE_VALUES], "value string")
    rows = unwrap_after(df, CHANGE_SCHEMA).collect()
    assert len(rows) == len(EDGE_VALUES)  # every message is one row
    assert [r.total_uninjured for r in rows[:2]] == ["3", "4"]  # update appended
    for r in rows[2:6]:
        assert all(v is None for v in r)  # delete / tombstone / junk -> all-NULL row
    assert rows[6].event_id == "7" and rows[6].make == '{"a":1}'
    assert rows[6].report_status is None


def test_nested_parse_equals_three_step(spark):
    df = spark.createDataFrame([(v,) for v in EDGE_VALUES], "value string")
    a = [tuple(r) for r in unwrap_after(df, CHANGE_SCHEMA).collect()]
    b = [tuple(r) for r in unwrap_after_three_step(df, CHANGE_SCHEMA).collect()]
    assert a == b


def test_keep_fields_same_values(spark):
    df = spark.createDataFrame([(v,) for v in EDGE_VALUES], "value string")
    narrow = keep_fields(CHANGE_SCHEMA, ["make", "event_id"])
    assert narrow.fieldNames() == ["event_id", "make"]
    full = unwrap_after(df, CHANGE_SCHEMA).select("event_id", "make").collect()
    assert unwrap_after(df, narrow).collect() == full


def test_routes_types_and_order(spark):
    rec = spark.createDataFrame([EXPECTED[1]], string_struct(INGEST_FIELDS))
    q = typed_select(rec, QUANTITATIVE_ROUTE)
    assert q.columns == [n for n, _ in QUANTITATIVE_ROUTE] and len(q.columns) == 14
    assert dict(q.dtypes)["event_date"] == "timestamp" and dict(q.dtypes)["total_uninjured"] == "int"
    row = q.first()
    # shifted row: ' In' -> NULL, and the shifted-in text lands where it lands
    assert row.total_fatal_injuries is None and row.total_uninjured == 0
    assert row.weather_condition == "1" and row.broad_phase_of_flight == "VMC"
    ql = Route("qualitative_table", QUALITATIVE_ROUTE).apply(rec)
    assert len(ql.columns) == 16 and ql.first().number_of_engines == 1


def test_route_with_report_status_is_null_from_ingest_table(spark):
    from ferryline.schemas import QUANTITATIVE_ROUTE_WITH_STATUS

    df = spark.createDataFrame([(_env({"event_id": "1", "event_date": "2001-02-03"}),)], "value string")
    row = typed_select(unwrap_after(df, CHANGE_SCHEMA), QUANTITATIVE_ROUTE_WITH_STATUS).first()
    assert len(row) == 15 and row.report_status is None


def test_golden_routes_sums_follow_shifted_fields(spark):
    # reference semantics: shifted text ('In', 'Inc', 'Inc.') casts to NULL
    msgs = keyed_messages(lines_df(spark, LINES), "t")
    rec = split_fields(msgs, INGEST_FIELDS)
    rows = typed_select(rec, QUANTITATIVE_ROUTE).collect()
    fatal = [r.total_fatal_injuries for r in rows]
    assert fatal == [2, None, 0, None, 0, None, None]

    def legacy_int(text):
        head = text.strip().split(".")[0]
        return int(head) if head.lstrip("-").isdigit() else None

    ordinal = INGEST_FIELDS.index("total_uninjured")
    assert [r.total_uninjured for r in rows] == [legacy_int(e[ordinal]) for e in EXPECTED]
