"""Registered queries and their DuckDB oracles.

Each query takes ``(spark, sf_dir)``, builds the pipeline's transport form
(text lines, topic rows or change envelopes) from the given tables in
Spark, runs one operator or job over the whole table, and returns the
resulting rows. The oracle computes the expected rows straight from the
same tables in DuckDB SQL, independently of the Spark code. Queries that
run a stream or write a topic do so under a fresh folder of the shared
root (``spark.checkpoint.dir``) and return a read of what was written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.config import TopicConfig
from ferryline.functions.json import json_path
from ferryline.functions.casts import lenient_int, lenient_timestamp
from ferryline.functions.text import strip_quotes
from ferryline.operators.changes import (
    after_text,
    expand_struct,
    payload_text,
    unwrap_after,
    unwrap_after_three_step,
    with_parsed,
)
from ferryline.operators.decode import decode_messages
from ferryline.operators.lines import keyed_messages, split_fields
from ferryline.operators.typed import Route, route_records
from ferryline.plans.derive import accident_changes, accident_line_sql, accident_lines, change_ops, envelope
from ferryline.plans.jobs import (
    DEFAULT_ROUTES,
    change_records,
    ingest_lines,
    publish_lines,
    route_changes,
)
from ferryline.schemas import (
    CHANGE_FIELDS,
    CHANGE_SCHEMA,
    CHANGE_TOPIC,
    CSV_HEADER,
    INGEST_FIELDS,
    LINE_FIELDS,
    LINE_TOPIC,
    QUALITATIVE_ROUTE,
    QUANTITATIVE_ROUTE,
    QUANTITATIVE_ROUTE_WITH_STATUS,
    QUANTITATIVE_TABLE,
    string_struct,
)
from ferryline.sinks.tables import FileTableSink
from ferryline.sinks.topics import topic_rows, write_topic
from ferryline.sources.text_lines import raw_lines, write_lines
from ferryline.sources.topics import read_topic, read_topic_stream
from ferryline.streaming.runner import run_available
from ferryline.streaming.fanout import single_sink
from ferryline.workspace import discard, fresh_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read in the splits Spark cuts it into."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _await(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _s(c: str):
    return F.col(c).cast("string")


def _dec(c: str):
    return F.col(c).cast("decimal(18,2)").cast("string")


# ----------------------------------------------------------------- inputs

# How the accident lines are stored: compressed, in files that one task reads.
CSV_FILES = {"compression": "lz4", "lines_per_file": 1_000_000}

# Transport-form inputs written ahead of the queries, by (table folder, name);
# a query whose input is not here makes it as part of its run.
_PREPARED: dict[tuple[str, str], str] = {}


def prepare_inputs(spark: SparkSession, sf_dir: str) -> None:
    """Write the inputs derived from ``lineitem`` once, so that what follows
    measures operators and sinks: lines, envelopes, CSV files and topics."""
    lines, changes = fresh_dir(spark, "input-lines"), fresh_dir(spark, "input-changes")
    spread = table(spark, sf_dir, "lineitem").repartition(spark.sparkContext.defaultParallelism)
    accident_lines(spread).write.parquet(lines)
    accident_changes(spread).write.parquet(changes)
    _PREPARED[sf_dir, "lines"], _PREPARED[sf_dir, "changes"] = lines, changes
    _PREPARED[sf_dir, "csv"] = _accident_csv(spark, sf_dir)
    topic = TopicConfig(LINE_TOPIC, path=fresh_dir(spark, "input-topic-lines"))
    publish_lines(spark, _PREPARED[sf_dir, "csv"], topic)
    _PREPARED[sf_dir, "topic-lines"] = topic.path
    topic = TopicConfig(CHANGE_TOPIC, path=fresh_dir(spark, "input-topic-changes"))
    write_topic(spark.read.parquet(changes), topic)
    _PREPARED[sf_dir, "topic-changes"] = topic.path


def discard_inputs(spark: SparkSession, sf_dir: str) -> None:
    for key in [k for k in _PREPARED if k[0] == sf_dir]:
        discard(spark, _PREPARED.pop(key))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accident CSV lines derived from lineitem."""
    ready = _PREPARED.get((sf_dir, "lines"))
    return spark.read.parquet(ready) if ready else accident_lines(table(spark, sf_dir, "lineitem"))


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes derived from lineitem."""
    ready = _PREPARED.get((sf_dir, "changes"))
    return spark.read.parquet(ready) if ready else accident_changes(table(spark, sf_dir, "lineitem"))


def _accident_csv(spark: SparkSession, sf_dir: str) -> str:
    """Accident CSV (header in every part file) derived from lineitem."""
    if (sf_dir, "csv") in _PREPARED:
        return _PREPARED[sf_dir, "csv"]
    path = fresh_dir(spark, "accident-csv")
    write_lines(_lines(spark, sf_dir), path, header=CSV_HEADER, **CSV_FILES)
    return path


# ------------------------------------------------------------------ lines


def raw_line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header's text stands among the lines too (once for every nation)
    and is data there."""
    again = table(spark, sf_dir, "nation").select(F.lit(CSV_HEADER).alias("value"))
    path = fresh_dir(spark, "accident-csv")
    lines = _lines(spark, sf_dir).select("value").unionByName(again)
    write_lines(lines, path, header=CSV_HEADER, **CSV_FILES)
    return raw_lines(spark, path)


def raw_line_scan_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with different first lines (some blank), blank lines skipped."""
    orders = table(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    line = F.when(st == "P", F.lit("  ")).otherwise(F.concat_ws(",", _s("o_orderkey"), st))
    path = fresh_dir(spark, "orders-lines")
    for status, first in (("F", ""), ("O", "o_orderkey,o_orderstatus"), ("P", "o_orderkey;o_orderstatus")):
        write_lines(orders.where(st == status).select(line.alias("value")), f"{path}/status={status}", header=first)
    return raw_lines(spark, f"{path}/*", keep_blank_lines=False)


def publish_keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = TopicConfig(LINE_TOPIC, path=fresh_dir(spark, "topic-lines"))
    publish_lines(spark, _accident_csv(spark, sf_dir), topic)
    return decode_messages(read_topic(spark, topic))


BLANK_LINES_HEADER = "o_orderkey,o_orderstatus,o_orderpriority"


def publish_blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with blank ones among them (an empty line for every order in
    status P, blanks only for status F) through files and the publish job:
    each is still a message, with an empty or blank key."""
    orders = table(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    line = (
        F.when(st == "P", F.lit(""))
        .when(st == "F", F.lit("   "))
        .otherwise(F.concat_ws(",", _s("o_orderkey"), st, F.col("o_orderpriority")))
    )
    path = fresh_dir(spark, "orders-lines")
    write_lines(orders.select(line.alias("value")), path, header=BLANK_LINES_HEADER)
    topic = TopicConfig(LINE_TOPIC, path=fresh_dir(spark, "topic-blank"))
    publish_lines(spark, path, topic)
    return decode_messages(read_topic(spark, topic))


def kafka_row_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    messages = events.select(
        F.when(F.col("event_type") != "error", _s("event_id")).alias("key"),
        F.col("props").alias("value"),
    )
    return decode_messages(topic_rows(messages, TopicConfig("events")))


def _stripped_accident_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    return lines.select(strip_quotes("value").alias("value"))


def split_positional_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_fields(_stripped_accident_lines(spark, sf_dir), INGEST_FIELDS)


def split_projection_32(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_fields(_stripped_accident_lines(spark, sf_dir), LINE_FIELDS)


def split_missing_tail_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    k, c, st = _s("o_orderkey"), _s("o_custkey"), F.col("o_orderstatus")
    rule = F.pmod(F.col("o_orderkey"), F.lit(3))
    line = (
        F.when(rule == 0, F.concat_ws(",", k, c, st))
        .when(rule == 1, F.concat_ws(",", k, c))
        .otherwise(F.concat_ws(",", k, c, st, F.lit("")))
    )
    return split_fields(orders.select(line.alias("value")), ("o_orderkey", "o_custkey", "o_orderstatus", "extra_field"))


def split_blank_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blank message (orders in status P) still becomes a row: key '',
    first field '' and NULL for every later field."""
    orders = table(spark, sf_dir, "orders")
    line = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(
        F.concat_ws(",", _s("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority"))
    )
    msgs = keyed_messages(orders.select(line.alias("value")), LINE_TOPIC)
    return split_fields(msgs, ("o_orderkey", "o_orderstatus", "o_orderpriority"), keep=("key",))


def split_embedded_comma_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    k, nk, bal = _s("c_custkey"), _s("c_nationkey"), _dec("c_acctbal")
    rule = F.pmod(F.col("c_custkey"), F.lit(4))
    line = (
        F.when(rule == 0, F.concat(k, F.lit(',"'), F.col("c_name"), F.lit(", "), F.col("c_mktsegment"), F.lit('",'), nk, F.lit(","), bal))
        .when(rule == 1, F.concat_ws(",", k, nk, bal))
        .otherwise(F.concat_ws(",", k, F.col("c_name"), nk, bal))
    )
    stripped = cust.select(strip_quotes(line).alias("value"))
    return split_fields(stripped, ("c_custkey", "c_name", "c_nationkey", "c_acctbal"))


# ------------------------------------------------------------------- json


def json_path_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        json_path("props", "$.k").alias("k"),
        json_path("props", "$").alias("props_json"),
        json_path("props", "$.missing").alias("missing"),
    )


def _event_after():
    return F.struct(
        _s("event_id").alias("event_id"),
        F.col("event_type"),
        _s("user_id").alias("user_id"),
        _dec("value").alias("value"),
        F.col("props"),
    )


def cdc_payload_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    is_delete = F.col("event_type") == "error"
    value = envelope(F.when(~is_delete, _event_after()), F.when(is_delete, "d").otherwise("c"))
    return after_text(payload_text(events.select(value.alias("value"))))


FIXED_SCHEMA_FIELDS = ("event_id", "ts", "event_type", "user_id", "props", "missing_field")


def from_json_fixed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    after = F.to_json(
        F.struct(
            F.col("event_id"),  # a JSON number, read back as text
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
            F.col("event_type"),
            F.col("user_id"),  # a JSON number
            F.from_json("props", "k bigint").alias("props"),  # a JSON object, read back as text
            F.lit("not in schema").alias("extra_field"),
        )
    )
    parsed = with_parsed(events.select(after.alias("after")), string_struct(FIXED_SCHEMA_FIELDS))
    return expand_struct(parsed)


def struct_star_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    data = F.when(F.col("event_type") != "error", F.struct("event_id", "event_type", "value"))
    return expand_struct(events.select(data.alias("data")))


def cdc_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unwrap_after(_changes(spark, sf_dir), CHANGE_SCHEMA)


def cdc_unwrap_three_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unwrap_after_three_step(_changes(spark, sf_dir), CHANGE_SCHEMA)


DELETE_SCHEMA_FIELDS = ("event_id", "event_type", "user_id")


def _mixed_event_changes(events: DataFrame) -> DataFrame:
    """error -> delete, signup -> tombstone (NULL value), view -> not JSON,
    click / purchase -> create."""
    after = F.struct(_s("event_id").alias("event_id"), F.col("event_type"), _s("user_id").alias("user_id"))
    et = F.col("event_type")
    value = (
        F.when(et == "error", envelope(F.lit(None).cast("string"), F.lit("d"), after))
        .when(et == "signup", F.lit(None).cast("string"))
        .when(et == "view", F.concat(F.lit("not json "), _s("event_id")))
        .otherwise(envelope(after, F.lit("c")))
    )
    return events.select(value.alias("value"))


def cdc_delete_null_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _mixed_event_changes(table(spark, sf_dir, "events"))
    return unwrap_after(changes, string_struct(DELETE_SCHEMA_FIELDS))


def cdc_unwrap_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of every odd shape: ``after`` or ``payload`` as JSON text, a
    raw control character in a value, either of them twice, a delete, and
    an ``after`` that only the second ``payload`` has."""
    events = table(spark, sf_dir, "events")

    def after(kind):
        return F.concat(
            F.lit('{"event_id":"'), _s("event_id"), F.lit('","event_type":"'), kind, F.lit('","user_id":"'),
            _s("user_id"), F.lit('"}'),
        )

    def text(json):
        return F.concat(F.lit('"'), F.replace(F.replace(json, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))

    def message(*payloads):
        inner = [x for p in payloads for x in (F.lit(',"payload":'), p)][1:]
        return F.concat(F.lit('{"payload":'), *inner, F.lit("}"))

    def payload(*afters):
        inner = [x for a in afters for x in (F.lit(',"after":'), a)][1:]
        return F.concat(F.lit('{"after":'), *inner, F.lit("}"))

    own, other = after(F.col("event_type")), after(F.lit("other"))
    shape = F.pmod(F.col("event_id"), F.lit(8))
    value = (
        F.when(shape == 0, message(payload(own)))
        .when(shape == 1, message(payload(text(own))))
        .when(shape == 2, message(text(payload(own))))
        .when(shape == 3, message(payload(after(F.concat(F.col("event_type"), F.lit("\tx"))))))
        .when(shape == 4, message(payload(own, other)))
        .when(shape == 5, message(payload(own), payload(other)))
        .when(shape == 6, message(payload(F.lit("null"))))
        .otherwise(message(F.lit('{"op":"c"}'), payload(own)))
    )
    return unwrap_after(events.select(value.alias("value")), string_struct(DELETE_SCHEMA_FIELDS))


# ------------------------------------------------------------------ casts


def lenient_cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rule = F.pmod(F.col("event_id"), F.lit(8))
    raw = (
        F.when(rule == 0, F.lit(""))
        .when(rule == 1, F.lit(" In"))
        .when(rule == 2, F.concat(F.lit(" "), _s("user_id"), F.lit(" ")))
        .when(rule == 3, _s("user_id"))
        .when(rule == 4, F.lit(None).cast("string"))
        .when(rule == 5, _dec("value"))
        .when(rule == 6, F.concat(F.lit("-"), _dec("value")))
        .otherwise(F.concat(_s("user_id"), F.lit("99999999999")))
    )
    df = events.select("event_id", raw.alias("raw"))
    return df.select("event_id", "raw", lenient_int("raw").alias("as_int"))


def lenient_cast_int_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The legacy cast's corner cases: no whole digits ('.7' -> 0), a bare
    '.' at the end, junk after the fraction, two points, a lone sign,
    control characters around, a blank inside."""
    events = table(spark, sf_dir, "events")
    rule = F.pmod(F.col("event_id"), F.lit(9))
    uid = _s("user_id")
    raw = (
        F.when(rule == 0, F.concat(F.lit("."), uid))
        .when(rule == 1, F.concat(uid, F.lit(".")))
        .when(rule == 2, F.concat(_dec("value"), F.lit("x")))
        .when(rule == 3, F.concat(uid, F.lit("."), _s("event_id"), F.lit(".5")))
        .when(rule == 4, F.lit("+"))
        .when(rule == 5, F.concat(F.lit("\t"), uid, F.lit("\n")))
        .when(rule == 6, F.concat(F.lit("-."), uid))
        .when(rule == 7, F.concat(uid, F.lit(" .5")))
        .otherwise(F.concat(F.lit("+"), _dec("value")))
    )
    df = events.select("event_id", raw.alias("raw"))
    return df.select("event_id", "raw", lenient_int("raw").alias("as_int"))


def lenient_cast_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rule = F.pmod(F.col("o_orderkey"), F.lit(6))
    raw = (
        F.when(rule == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(rule == 1, F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 12:34:56")))
        .when(rule == 2, F.lit(""))
        .when(rule == 3, F.lit("n/a"))
        .when(rule == 4, F.date_format("o_orderdate", "dd-MM-yyyy"))
        .otherwise(F.lit(None).cast("string"))
    )
    df = orders.select("o_orderkey", raw.alias("raw"))
    return df.select("o_orderkey", "raw", lenient_timestamp("raw").alias("as_ts"))


# ----------------------------------------------------------------- routes


def route_quantitative(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _changes(spark, sf_dir)
    return route_records(changes, DEFAULT_ROUTES[0], CHANGE_SCHEMA)


def route_qualitative(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _changes(spark, sf_dir)
    return route_records(changes, DEFAULT_ROUTES[1], CHANGE_SCHEMA)


def route_quantitative_with_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older quantitative route that also carried report_status: the
    field is in the parse schema but not in the ingested table, so it is
    always NULL."""
    changes = _changes(spark, sf_dir)
    return route_records(changes, Route(QUANTITATIVE_TABLE, QUANTITATIVE_ROUTE_WITH_STATUS), CHANGE_SCHEMA)


# -------------------------------------------------------------- streaming


def stream_ingest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = _PREPARED.get((sf_dir, "topic-lines"))
    topic = TopicConfig(LINE_TOPIC, path=ready or fresh_dir(spark, "topic-lines"))
    if not ready:
        publish_lines(spark, _accident_csv(spark, sf_dir), topic)
    sink, checkpoint = FileTableSink(fresh_dir(spark, "table-aviation_data")), fresh_dir(spark, "ckpt-ingest")
    _await(ingest_lines(spark, topic, sink, checkpoint, trigger={"availableNow": True}))
    discard(spark, checkpoint, *([] if ready else [topic.path]))
    return sink.read(spark, string_struct(INGEST_FIELDS))


def stream_two_topics_one_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries, each with its own topic and checkpoint, and a batch
    append into one table: it holds the rows of all three. The first query
    runs twice on its checkpoint and adds nothing the second time."""
    orders = table(spark, sf_dir, "orders")
    fields = ("o_orderkey", "o_orderstatus", "o_orderpriority")
    line = F.concat_ws(",", _s("o_orderkey"), "o_orderstatus", "o_orderpriority").alias("value")
    sink, used = FileTableSink(fresh_dir(spark, "table-orders")), []

    def ingest(topic: TopicConfig, checkpoint: str) -> None:
        _await(ingest_lines(spark, topic, sink, checkpoint, names=fields, trigger={"availableNow": True}))

    for status in ("F", "O"):
        topic = TopicConfig(f"orders_{status}", path=fresh_dir(spark, "topic-orders"))
        messages = keyed_messages(orders.where(F.col("o_orderstatus") == status).select(line), topic.name)
        write_topic(messages, topic)
        checkpoint = fresh_dir(spark, "ckpt-orders")
        for _ in range(2 if status == "F" else 1):
            ingest(topic, checkpoint)
        used += [topic.path, checkpoint]
    rest = F.col("o_orderstatus").isNull() | ~F.col("o_orderstatus").isin("F", "O")
    sink.write(split_fields(orders.where(rest).select(line), fields))
    discard(spark, *used)
    return sink.read(spark, string_struct(fields))


def _run_route(spark: SparkSession, sf_dir: str, routes=DEFAULT_ROUTES, staged: bool = False) -> dict[str, DataFrame]:
    ready = _PREPARED.get((sf_dir, "topic-changes"))
    topic = TopicConfig(CHANGE_TOPIC, path=ready or fresh_dir(spark, "topic-changes"))
    if not ready:
        write_topic(_changes(spark, sf_dir), topic)
    sinks = {r.name: FileTableSink(fresh_dir(spark, f"table-{r.name}")) for r in routes}
    checkpoint, stage = fresh_dir(spark, "ckpt-route"), fresh_dir(spark, "stage-route")
    query = route_changes(
        spark,
        topic,
        [(r, sinks[r.name]) for r in routes],
        checkpoint,
        trigger={"availableNow": True},
        stage_dir=stage if staged else None,
    )
    _await(query)
    discard(spark, checkpoint, stage, *([] if ready else [topic.path]))
    return {name: sink.read(spark) for name, sink in sinks.items()}


def stream_cdc_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table: the batch needs no sharing."""
    route = Route("quantitative_table_with_status", QUANTITATIVE_ROUTE_WITH_STATUS)
    return _run_route(spark, sf_dir, (route,))[route.name]


def fanout_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables from one staged batch."""
    tables = _run_route(spark, sf_dir, staged=True)
    parts = [tables[r.name].withColumn("sink", F.lit(r.name)) for r in DEFAULT_ROUTES]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


ORDER_CHANGE_FIELDS = ("o_orderkey", "o_orderstatus", "o_orderpriority")


def append_keeps_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = orders.withColumn("op", F.explode(change_ops(F.col("o_orderstatus") == "F")))
    after = F.struct(
        _s("o_orderkey").alias("o_orderkey"),
        F.col("o_orderstatus"),
        F.when(F.col("op") == "u", F.lit("1-URGENT")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    topic = TopicConfig("orders_changes", path=fresh_dir(spark, "topic-orders"))
    write_topic(rows.select(_s("o_orderkey").alias("key"), envelope(after, F.col("op")).alias("value")), topic)
    sink = FileTableSink(fresh_dir(spark, "table-orders"))
    records = change_records(read_topic_stream(spark, topic), string_struct(ORDER_CHANGE_FIELDS))
    checkpoint = fresh_dir(spark, "ckpt-orders")
    run_available(records, single_sink(sink), checkpoint)
    discard(spark, topic.path, checkpoint)
    return sink.read(spark, string_struct(ORDER_CHANGE_FIELDS))


RESUME_SPLIT = "2024-01-16 00:00:00"


def checkpoint_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two publishes and three runs of one query on one checkpoint: every
    change lands exactly once."""
    events = table(spark, sf_dir, "events")
    after = F.struct(_s("event_id").alias("event_id"), F.col("event_type"), _s("user_id").alias("user_id"))
    messages = events.select("ts", _s("event_id").alias("key"), envelope(after, F.lit("c")).alias("value"))
    early = F.coalesce(F.col("ts") < F.lit(RESUME_SPLIT).cast("timestamp_ntz"), F.lit(False))
    topic = TopicConfig("events_changes", path=fresh_dir(spark, "topic-events"))
    sink = FileTableSink(fresh_dir(spark, "table-events"))
    checkpoint = fresh_dir(spark, "ckpt-events")
    schema = string_struct(DELETE_SCHEMA_FIELDS)

    def run() -> None:
        run_available(change_records(read_topic_stream(spark, topic), schema), single_sink(sink), checkpoint)

    write_topic(messages.where(early).drop("ts"), topic)
    run()
    write_topic(messages.where(~early).drop("ts"), topic)
    run()
    run()  # nothing new: no batch, no duplicate
    discard(spark, topic.path, checkpoint)
    return sink.read(spark, schema)


QUERIES: dict[str, Query] = {
    "raw_line_scan": raw_line_scan,
    "raw_line_scan_by_position": raw_line_scan_by_position,
    "publish_keyed_lines": publish_keyed_lines,
    "publish_blank_lines": publish_blank_lines,
    "kafka_row_decode": kafka_row_decode,
    "split_positional_projection": split_positional_projection,
    "split_projection_32": split_projection_32,
    "split_missing_tail_null": split_missing_tail_null,
    "split_blank_line": split_blank_line,
    "split_embedded_comma_shift": split_embedded_comma_shift,
    "json_path_extract": json_path_extract,
    "cdc_payload_after": cdc_payload_after,
    "from_json_fixed_schema": from_json_fixed_schema,
    "struct_star_expand": struct_star_expand,
    "cdc_unwrap": cdc_unwrap,
    "cdc_unwrap_three_step": cdc_unwrap_three_step,
    "cdc_delete_null_row": cdc_delete_null_row,
    "cdc_unwrap_shapes": cdc_unwrap_shapes,
    "lenient_cast_int": lenient_cast_int,
    "lenient_cast_int_edges": lenient_cast_int_edges,
    "lenient_cast_timestamp": lenient_cast_timestamp,
    "route_quantitative": route_quantitative,
    "route_qualitative": route_qualitative,
    "route_quantitative_with_status": route_quantitative_with_status,
    "stream_ingest_lines": stream_ingest_lines,
    "stream_two_topics_one_table": stream_two_topics_one_table,
    "stream_cdc_route": stream_cdc_route,
    "fanout_two_sinks": fanout_two_sinks,
    "append_keeps_updates": append_keeps_updates,
    "checkpoint_resume": checkpoint_resume,
}


# ================================================================ oracles

_DUCK_LINE = accident_line_sql("duck")

_ACC_CTE = (
    "acc_lines AS (SELECT l_returnflag, l_linestatus, l_linenumber, "
    f"{_DUCK_LINE} AS line FROM lineitem), "
    "acc_split AS (SELECT *, string_split(replace(line, '\"', ''), ',') AS f FROM acc_lines), "
    "acc AS (SELECT l_returnflag, l_linestatus, l_linenumber, "
    + ", ".join(f"f[{i + 1}] AS {n}" for i, n in enumerate(INGEST_FIELDS))
    + " FROM acc_split)"
)


def _change_select(override: dict[str, str] | None = None, all_null: bool = False) -> str:
    cols = []
    for n in CHANGE_FIELDS:
        if all_null or n not in INGEST_FIELDS:
            cols.append(f"CAST(NULL AS VARCHAR) AS {n}")
        elif override and n in override:
            cols.append(f"{override[n]} AS {n}")
        else:
            cols.append(n)
    return ", ".join(cols)


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_CHANGES_CTE = (
    _ACC_CTE
    + ", changes AS ("
    + f"SELECT {_change_select()} FROM acc "
    + f"UNION ALL SELECT {_change_select({'injury_severity': _lit('Fatal(1)')})} FROM acc WHERE l_returnflag = 'R' "
    + f"UNION ALL SELECT {_change_select(all_null=True)} FROM acc WHERE l_linestatus = 'F' AND l_linenumber = 7)"
)


def _duck_lenient_int(x: str) -> str:
    """The legacy text -> int cast in DuckDB SQL: blanks and control
    characters trimmed, optional sign, digits, optional '.' and digits,
    fraction cut off ('.5' -> 0), anything else or overflow NULL."""
    t = f"regexp_replace({x}, '^[\\x00-\\x20\\x7f]+|[\\x00-\\x20\\x7f]+$', '', 'g')"
    return (
        f"CASE WHEN regexp_full_match({t}, '[+-]?[0-9]*(\\.[0-9]*)?') AND {t} NOT IN ('', '+', '-') "
        f"THEN CASE WHEN regexp_matches({t}, '^[+-]?[0-9]') "
        f"THEN TRY_CAST(regexp_extract({t}, '^[+-]?[0-9]*', 0) AS INTEGER) ELSE 0 END END"
    )


def _duck_cast(name: str, type_name: str) -> str:
    if type_name == "int":
        return f"{_duck_lenient_int(name)} AS {name}"
    if type_name == "timestamp":
        return f"TRY_CAST({name} AS TIMESTAMP) AS {name}"
    return name


def _route_sql(route) -> str:
    return ", ".join(_duck_cast(n, t) for n, t in route)


def _split_select(names) -> str:
    return ", ".join(f"f[{i + 1}] AS {n}" for i, n in enumerate(names))


_STRIPPED_SPLIT = (
    f"(SELECT string_split(replace({_DUCK_LINE}, '\"', ''), ',') AS f FROM lineitem)"
)

_EV_AFTER_JSON = (
    "to_json(struct_pack(event_id := CAST(event_id AS VARCHAR), event_type := event_type, "
    "user_id := CAST(user_id AS VARCHAR), value := CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), "
    "props := props))"
)

_ROUTE_UNION = (
    f"SELECT {_route_sql(QUANTITATIVE_ROUTE)}, 'quantitative_table' AS sink FROM changes "
    f"UNION ALL BY NAME SELECT {_route_sql(QUALITATIVE_ROUTE)}, 'qualitative_table' AS sink FROM changes"
)

ORACLES: dict[str, str] = {
    "raw_line_scan": (
        f"SELECT {_DUCK_LINE} AS value FROM lineitem UNION ALL SELECT {_lit(CSV_HEADER)} AS value FROM nation"
    ),
    "raw_line_scan_by_position": (
        "SELECT CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus AS value FROM orders "
        "WHERE o_orderstatus IN ('F', 'O')"
    ),
    "publish_keyed_lines": (
        f"SELECT split_part(line, ',', 1) AS key, replace(line, '\"', '') AS value, {_lit(LINE_TOPIC)} AS topic "
        f"FROM (SELECT {_DUCK_LINE} AS line FROM lineitem)"
    ),
    "publish_blank_lines": (
        f"SELECT split_part(line, ',', 1) AS key, line AS value, {_lit(LINE_TOPIC)} AS topic FROM "
        "(SELECT CASE o_orderstatus WHEN 'P' THEN '' WHEN 'F' THEN '   ' "
        "ELSE concat_ws(',', CAST(o_orderkey AS VARCHAR), o_orderstatus, o_orderpriority) END AS line FROM orders)"
    ),
    "kafka_row_decode": (
        "SELECT CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS key, "
        "props AS value, 'events' AS topic FROM events"
    ),
    "split_positional_projection": f"SELECT {_split_select(INGEST_FIELDS)} FROM {_STRIPPED_SPLIT}",
    "split_projection_32": f"SELECT {_split_select(LINE_FIELDS)} FROM {_STRIPPED_SPLIT}",
    "split_missing_tail_null": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
        "CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_orderstatus END AS o_orderstatus, "
        "CASE WHEN o_orderkey % 3 = 2 THEN '' END AS extra_field FROM orders"
    ),
    "split_blank_line": (
        "SELECT CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS key, "
        "CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS o_orderkey, "
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus, "
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders"
    ),
    "split_embedded_comma_shift": (
        "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, "
        "CASE WHEN c_custkey % 4 = 1 THEN CAST(c_nationkey AS VARCHAR) ELSE c_name END AS c_name, "
        "CASE WHEN c_custkey % 4 = 0 THEN ' ' || c_mktsegment "
        "WHEN c_custkey % 4 = 1 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) "
        "ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey, "
        "CASE WHEN c_custkey % 4 = 0 THEN CAST(c_nationkey AS VARCHAR) "
        "WHEN c_custkey % 4 = 1 THEN NULL "
        "ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS c_acctbal FROM customer"
    ),
    "json_path_extract": (
        "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$') AS props_json, "
        "json_extract_string(props, '$.missing') AS missing FROM events"
    ),
    "cdc_payload_after": (
        f"SELECT CASE WHEN event_type = 'error' THEN NULL ELSE CAST({_EV_AFTER_JSON} AS VARCHAR) END AS after FROM events"
    ),
    "from_json_fixed_schema": (
        "SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, "
        "CAST(user_id AS VARCHAR) AS user_id, CAST(json(props) AS VARCHAR) AS props, "
        "CAST(NULL AS VARCHAR) AS missing_field FROM events"
    ),
    "struct_star_expand": (
        "SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id, "
        "CASE WHEN event_type <> 'error' THEN event_type END AS event_type, "
        "CASE WHEN event_type <> 'error' THEN value END AS value FROM events"
    ),
    "cdc_unwrap": f"WITH {_CHANGES_CTE} SELECT * FROM changes",
    "cdc_unwrap_three_step": f"WITH {_CHANGES_CTE} SELECT * FROM changes",
    "cdc_delete_null_row": (
        "SELECT CASE WHEN event_type IN ('click', 'purchase') THEN CAST(event_id AS VARCHAR) END AS event_id, "
        "CASE WHEN event_type IN ('click', 'purchase') THEN event_type END AS event_type, "
        "CASE WHEN event_type IN ('click', 'purchase') THEN CAST(user_id AS VARCHAR) END AS user_id FROM events"
    ),
    "cdc_unwrap_shapes": (
        "SELECT CASE WHEN event_id % 8 < 6 THEN CAST(event_id AS VARCHAR) END AS event_id, "
        "CASE WHEN event_id % 8 = 3 THEN event_type || chr(9) || 'x' WHEN event_id % 8 < 6 THEN event_type END AS event_type, "
        "CASE WHEN event_id % 8 < 6 THEN CAST(user_id AS VARCHAR) END AS user_id FROM events"
    ),
    "lenient_cast_int": (
        "WITH r AS (SELECT event_id, user_id, value, CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN ' In' "
        "WHEN 2 THEN ' ' || CAST(user_id AS VARCHAR) || ' ' WHEN 3 THEN CAST(user_id AS VARCHAR) "
        "WHEN 4 THEN NULL WHEN 5 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) "
        "WHEN 6 THEN '-' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) "
        "ELSE CAST(user_id AS VARCHAR) || '99999999999' END AS raw FROM events) "
        "SELECT event_id, raw, CASE event_id % 8 WHEN 2 THEN CAST(user_id AS INTEGER) "
        "WHEN 3 THEN CAST(user_id AS INTEGER) WHEN 5 THEN CAST(trunc(CAST(value AS DECIMAL(18,2))) AS INTEGER) "
        "WHEN 6 THEN -CAST(trunc(CAST(value AS DECIMAL(18,2))) AS INTEGER) END AS as_int FROM r"
    ),
    "lenient_cast_int_edges": (
        "WITH r AS (SELECT event_id, user_id, value, CASE event_id % 9 "
        "WHEN 0 THEN '.' || CAST(user_id AS VARCHAR) "
        "WHEN 1 THEN CAST(user_id AS VARCHAR) || '.' "
        "WHEN 2 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || 'x' "
        "WHEN 3 THEN CAST(user_id AS VARCHAR) || '.' || CAST(event_id AS VARCHAR) || '.5' "
        "WHEN 4 THEN '+' "
        "WHEN 5 THEN chr(9) || CAST(user_id AS VARCHAR) || chr(10) "
        "WHEN 6 THEN '-.' || CAST(user_id AS VARCHAR) "
        "WHEN 7 THEN CAST(user_id AS VARCHAR) || ' .5' "
        "ELSE '+' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS raw FROM events) "
        "SELECT event_id, raw, CASE event_id % 9 WHEN 0 THEN 0 WHEN 1 THEN CAST(user_id AS INTEGER) "
        "WHEN 5 THEN CAST(user_id AS INTEGER) WHEN 6 THEN 0 "
        "WHEN 8 THEN CAST(trunc(CAST(value AS DECIMAL(18,2))) AS INTEGER) END AS as_int FROM r"
    ),
    "lenient_cast_timestamp": (
        "WITH r AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') "
        "WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 12:34:56' WHEN 2 THEN '' WHEN 3 THEN 'n/a' "
        "WHEN 4 THEN strftime(o_orderdate, '%d-%m-%Y') ELSE NULL END AS raw FROM orders) "
        "SELECT o_orderkey, raw, TRY_CAST(raw AS TIMESTAMP) AS as_ts FROM r"
    ),
    "route_quantitative": f"WITH {_CHANGES_CTE} SELECT {_route_sql(QUANTITATIVE_ROUTE)} FROM changes",
    "route_qualitative": f"WITH {_CHANGES_CTE} SELECT {_route_sql(QUALITATIVE_ROUTE)} FROM changes",
    "route_quantitative_with_status": (
        f"WITH {_CHANGES_CTE} SELECT {_route_sql(QUANTITATIVE_ROUTE_WITH_STATUS)} FROM changes"
    ),
    "stream_ingest_lines": f"SELECT {_split_select(INGEST_FIELDS)} FROM {_STRIPPED_SPLIT}",
    "stream_two_topics_one_table": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders"
    ),
    "stream_cdc_route": f"WITH {_CHANGES_CTE} SELECT {_route_sql(QUANTITATIVE_ROUTE_WITH_STATUS)} FROM changes",
    "fanout_two_sinks": f"WITH {_CHANGES_CTE} {_ROUTE_UNION}",
    "append_keeps_updates": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders "
        "UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus, '1-URGENT' FROM orders "
        "WHERE o_orderstatus = 'F'"
    ),
    "checkpoint_resume": (
        "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id FROM events"
    ),
}

assert set(ORACLES) == set(QUERIES)
