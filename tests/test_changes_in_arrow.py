"""The Arrow reader of change messages gives what the column expressions give."""

import contextlib
import io
import json

from pyspark.sql import functions as F

from ferryline.operators import unwrap_after, unwrap_after_in_arrow
from ferryline.plans.jobs import change_records
from ferryline.schemas import string_struct

SCHEMA = string_struct(("a", "b", "c"))

PLAIN = [
    None,
    "{}",
    '{"payload":null}',
    '{"payload":{}}',
    '{"payload":{"before":null,"after":null,"op":"d"}}',
    '{"payload":{"after":{}}}',
    '{"payload":{"before":{"a":"0"},"after":{"a":"1","b":null,"x":[1,{"y":2}]},"op":"u","ts_ms":1.50}}',
    ' {"payload":{"after":{"a":"blank in front"}}} '.strip(),
    '{ "payload" : { "after" : { "c" : "zé中\U0001f600", "a" : "" } } }',
]
ODD = [
    "", " ", "null", "[]", "7", "not json", "{", "}", '{"payload":{"after":{"a":"cut',
    ' {"payload":{"after":{"a":"blanks"}}} ', '{"payload":{"after":{"a":"tail"}}}x}', '{}{}', '{"payload":{"after":{"a":"1"}}}{}',
    '{"a":{}', '{"a":', '{}}', '{"a":"}', '{"}',
    '{"payload":"{\\"after\\":{\\"a\\":\\"text\\"}}"}', '{"payload":{"after":"{\\"a\\":\\"text\\"}"}}',
    "{\"payload\":\"{'after':{'a':'single'}}\"}", "{'payload':{'after':{'a':'single'}}}",
    '{"payload":{"after":{"a":"raw\tcontrol","b":"new\nline"}}}', '{"payload":{"after":{"a":"e\\u0041\\n\\"q"}}}',
    '{"payload":{"after":{"a":"\\ud800"}}}', '{"p\\u0061yload":{"after":{"a":"escaped key"}}}',
    '{"payload":{"x":1},"payload":{"after":{"a":"second"}}}', '{"payload":null,"payload":{"after":{"a":"second"}}}',
    '{"payload":{"after":{"a":"1"},"after":{"a":"2"}}}', '{"payload":{"after":{"a":"1","a":"2"}}}',
    '{"payload":{"after":{"a":"1","a":null}}}',
    '{"payload":{"after":{"a":1.10,"b":-0,"c":1e400}}}', '{"payload":{"after":{"a":true,"b":{"x": 1},"c":[1, 2.50]}}}',
    '{"payload":{"after":{"a":NaN,"b":"x"}}}', '{"payload":{"after":{"a":"x"},"n":NaN}}', '{"payload":{"after":{"a":"x"},"n":01}}',
    '{"payload":{"after":{"a":"x"},"n":-Infinity}}', '{"payload":{"after":{"a":"x"},"n":[Inf]}}', '{"payload":{"after":{"a":"to, Inf"}}}',
    '{"payload":{"after":{"a":"x",}}}', '{"payload":{"after":[{"a":"x"}]}}', '[{"payload":{"after":{"a":"x"}}}]',
    '{"payload":{"after":7}}', '{"payload":[1]}', '{"Payload":{"After":{"A":"case"}}}', '{"payload":{"after":{"A":"case"}}}',
    '{"payload":{"after":{"a":"deep"},"n":' + "[" * 1100 + "]" * 1100 + "}}",
    '{"payload":{"after":{"a":"digits"},"n":' + "9" * 1100 + "}}",
    '{"payload":{"after":{"a":"' + "long" * 1000 + '"}}}', '{"payload":{"after":{"a":"x","' + "k" * 60_000 + '":"name"}}}',
]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _both(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)
    return _rows(unwrap_after_in_arrow(df, SCHEMA)), _rows(unwrap_after(df, SCHEMA))


def _row_by_row(spark, values):
    """Each message as a batch of its own."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        return _both(spark, values)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_odd_messages_alone_and_among_plain_ones(spark):
    for run in (_row_by_row, _both):
        found, expected = run(spark, [*PLAIN, *ODD])
        assert found == expected
    many = [json.dumps({"payload": {"after": {"a": str(i), "b": None}}}) for i in range(700)]
    found, expected = _both(spark, many[:300] + ODD + PLAIN + many[300:] + ODD[:5])
    assert found == expected


def test_pieces_that_together_hold_as_many_objects_as_messages(spark):
    found, expected = _both(spark, ['{"payload":{"after":', '{"a":"1"}}}', '{}{}', '{"a":"}', '{"}', "{}"])
    assert found == expected


def test_text_that_is_not_utf8(spark):
    raw = b'{"payload":{"after":{"a":"x\xff\xc3(","b":"\xed\xa0\x80"}}}'
    df = spark.createDataFrame([(raw,), (b'{"payload":{"after":{"a":"y"}}}',)], "value binary")
    df = df.select(F.col("value").cast("string").alias("value"))
    assert _rows(unwrap_after_in_arrow(df, SCHEMA)) == _rows(unwrap_after(df, SCHEMA))


def test_the_streaming_jobs_read_messages_in_arrow(spark):
    df = spark.createDataFrame([(None, bytearray(b"{}"))], "key binary, value binary")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        change_records(df, SCHEMA).explain()
    assert "MapInArrow" in out.getvalue()
