"""Streaming jobs: stream equals batch, one checkpoint per query, restart,
fan-out to two sinks from one parse."""

import json

from ferryline.config import TopicConfig
from ferryline.operators import Route, keyed_messages, split_fields, unwrap_after
from ferryline.plans.jobs import DEFAULT_ROUTES, ingest_lines, route_changes
from ferryline.schemas import CHANGE_SCHEMA, INGEST_FIELDS, QUANTITATIVE_ROUTE
from ferryline.sinks import FileTableSink, write_topic
from ferryline.streaming import fan_out, run_available
from ferryline.workspace import fresh_dir
from tests.golden import EXPECTED, LINES


def _await(q):
    q.awaitTermination()
    assert q.exception() is None


def test_ingest_stream_equals_batch(spark):
    topic = TopicConfig("csv_to_mysql", path=fresh_dir(spark, "topic"))
    msgs = keyed_messages(spark.createDataFrame([(x,) for x in LINES], "value string"), topic.name)
    write_topic(msgs, topic)
    sink = FileTableSink(fresh_dir(spark, "table"))
    _await(ingest_lines(spark, topic, sink, fresh_dir(spark, "ckpt"), trigger={"availableNow": True}))
    streamed = sorted(tuple(r) for r in sink.read(spark).collect())
    batch = sorted(tuple(r) for r in split_fields(msgs, INGEST_FIELDS).collect())
    assert streamed == batch == sorted(EXPECTED)


def _envelope(i, op="c"):
    after = None if op == "d" else {"event_id": str(i), "event_date": "2001-02-03", "total_uninjured": str(i),
                                    "make": "M", "investigation_type": "Accident"}
    return json.dumps({"payload": {"before": None, "after": after, "op": op}})


def test_restart_resumes_without_loss_or_duplicates(spark):
    topic = TopicConfig("changes", path=fresh_dir(spark, "topic"))
    sink = FileTableSink(fresh_dir(spark, "table"))
    ckpt = fresh_dir(spark, "ckpt")
    route = Route("q", (("event_id", "string"), ("total_uninjured", "int")))

    def run():
        _await(route_changes(spark, topic, [(route, sink)], ckpt, trigger={"availableNow": True}))

    write_topic(spark.createDataFrame([(str(i), _envelope(i)) for i in range(40)], "key string, value string"), topic)
    run()
    assert sink.read(spark).count() == 40
    write_topic(spark.createDataFrame([(str(i), _envelope(i)) for i in range(40, 50)], "key string, value string"), topic)
    run()
    run()
    rows = sink.read(spark).collect()
    assert sorted(int(r.event_id) for r in rows) == list(range(50))


def test_fan_out_two_sinks_with_delete_rows(spark):
    topic = TopicConfig("changes", path=fresh_dir(spark, "topic"))
    values = [_envelope(1), _envelope(2), _envelope(1, "u"), _envelope(2, "d"), None]
    write_topic(spark.createDataFrame([(None, v) for v in values], "key string, value string"), topic)
    sinks = {r.name: FileTableSink(fresh_dir(spark, r.name)) for r in DEFAULT_ROUTES}
    q = route_changes(spark, topic, [(r, sinks[r.name]) for r in DEFAULT_ROUTES], fresh_dir(spark, "ck"),
                      trigger={"availableNow": True})
    _await(q)
    for r in DEFAULT_ROUTES:
        df = sinks[r.name].read(spark)
        assert df.columns == list(r.fields)
        rows = df.collect()
        assert len(rows) == 5  # insert, insert, update appended, delete and tombstone as all-NULL rows
        assert sum(all(v is None for v in row) for row in rows) == 2
    quant = sinks["quantitative_table"].read(spark)
    assert dict(quant.dtypes)["event_date"] == "timestamp"


def test_fan_out_handler_in_batch(spark):
    df = spark.createDataFrame([(_envelope(i),) for i in range(5)], "value string")
    rec = unwrap_after(df, CHANGE_SCHEMA)
    a, b = (FileTableSink(fresh_dir(spark, x), query_id="q") for x in "ab")
    fan_out([(Route("a", QUANTITATIVE_ROUTE), a), (Route("b", (("make", "string"),)), b)])(rec, 3)
    assert a.read(spark).count() == 5 and b.read(spark).columns == ["make"]


def test_run_available_single_sink(spark):
    from ferryline.plans.jobs import line_records
    from ferryline.sources import read_topic_stream
    from ferryline.streaming import single_sink

    topic = TopicConfig("t", path=fresh_dir(spark, "topic"))
    write_topic(keyed_messages(spark.createDataFrame([(x,) for x in LINES], "value string"), "t"), topic)
    sink = FileTableSink(fresh_dir(spark, "s"))
    run_available(line_records(read_topic_stream(spark, topic)), single_sink(sink), fresh_dir(spark, "ck"))
    assert sink.read(spark).count() == len(LINES)


def test_staged_fan_out_equals_persisted_and_reuses_two_slots(spark):
    import os

    topic = TopicConfig("changes", path=fresh_dir(spark, "topic"), max_files_per_trigger=1)
    for part in range(3):
        values = [_envelope(i, "u" if i % 4 == 0 else "c") for i in range(part * 10, part * 10 + 10)]
        write_topic(spark.createDataFrame([(None, v) for v in values], "key string, value string").coalesce(1), topic)
    out = {}
    stage = fresh_dir(spark, "stage")
    for mode in ("persist", "stage"):
        sinks = {r.name: FileTableSink(fresh_dir(spark, f"{mode}-{r.name}")) for r in DEFAULT_ROUTES}
        _await(route_changes(spark, topic, [(r, sinks[r.name]) for r in DEFAULT_ROUTES], fresh_dir(spark, "ck"),
                             trigger={"availableNow": True}, stage_dir=stage if mode == "stage" else None))
        out[mode] = {n: sorted(tuple(r) for r in s.read(spark).collect()) for n, s in sinks.items()}
        batches = sinks["quantitative_table"].read(spark).selectExpr("regexp_extract(_metadata.file_path, 'batch-[0-9]+', 0)")
        assert batches.distinct().count() == 3
    assert out["persist"] == out["stage"] and all(len(v) == 30 for v in out["stage"].values())
    assert sorted(os.listdir(stage.replace("file:", ""))) == ["slot=0", "slot=1"]


def test_staged_fan_out_of_an_empty_batch(spark):
    empty = unwrap_after(spark.createDataFrame([], "value string"), CHANGE_SCHEMA)
    a, b = (FileTableSink(fresh_dir(spark, x), query_id="q") for x in "ab")
    routes = [(Route("a", QUANTITATIVE_ROUTE), a), (Route("b", (("make", "string"),)), b)]
    fan_out(routes, stage_dir=fresh_dir(spark, "stage"))(empty, 0)
    assert a.read(spark).count() == 0 and b.read(spark).columns == ["make"]


def test_staged_batch_holds_each_field_cast_once(spark):
    """Routes that agree on every type share typed fields; others cast their own."""
    rec = unwrap_after(spark.createDataFrame([(_envelope(i),) for i in range(5)], "value string"), CHANGE_SCHEMA)
    for other, staged, value in (("int", "int", 3), ("string", "string", "3")):
        a, b = (FileTableSink(fresh_dir(spark, x), query_id="q") for x in "ab")
        routes = [(Route("a", (("total_uninjured", "int"), ("make", "string"))), a)]
        routes += [(Route("b", (("event_id", "string"), ("total_uninjured", other))), b)]
        stage = fresh_dir(spark, "stage")
        fan_out(routes, stage_dir=stage)(rec, 0)
        assert dict(spark.read.parquet(f"{stage}/slot=0").dtypes)["total_uninjured"] == staged
        assert sorted(r.total_uninjured for r in a.read(spark).collect()) == [0, 1, 2, 3, 4]
        assert ("3", value) in [tuple(r) for r in b.read(spark).collect()]
