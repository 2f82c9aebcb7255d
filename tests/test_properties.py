"""Property test: the line path equals plain string operations on any line."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ferryline.operators import keyed_messages, split_fields

NAMES = [f"f{i}" for i in range(6)]

line_text = st.text(alphabet=st.sampled_from(list('ab ,"\\.-7')), max_size=24)


def expected(line):
    fields = line.replace('"', "").split(",")
    return tuple((fields[i] if i < len(fields) else None) for i in range(len(NAMES)))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(line_text, min_size=1, max_size=20))
def test_split_matches_python(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    msgs = keyed_messages(df, "t").collect()
    assert [m.key for m in msgs] == [x.split(",")[0] for x in lines]
    got = [tuple(r) for r in split_fields(df.select(df.value), NAMES).collect()]
    got_stripped = [tuple(r) for r in split_fields(keyed_messages(df, "t"), NAMES).collect()]
    assert got_stripped == [expected(x) for x in lines]
    assert got == [tuple((x.split(",") + [None] * 6)[:6]) for x in lines]


number_text = st.text(alphabet=st.sampled_from(list("0123456789.+- \t\x01xe")), max_size=12)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(number_text, min_size=1, max_size=40))
def test_lenient_int_equals_legacy_cast(spark, texts):
    """With ANSI on, ``lenient_int`` gives what the non-ANSI cast the original
    pipeline ran on gives (Spark keeps that cast when ANSI is off)."""
    from pyspark.sql import functions as F

    from ferryline.functions import lenient_int

    df = spark.createDataFrame([(t,) for t in texts], "v string")
    ours = [r[0] for r in df.select(lenient_int("v")).collect()]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = [r[0] for r in df.select(F.col("v").cast("int")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert ours == legacy, [(t, a, b) for t, a, b in zip(texts, ours, legacy) if a != b]


date_text = st.text(alphabet=st.sampled_from(list("0123456789--:: T.+Z")), max_size=22)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(date_text, min_size=1, max_size=40))
def test_lenient_timestamp_equals_legacy_cast(spark, texts):
    from pyspark.sql import functions as F

    from ferryline.functions import lenient_timestamp

    df = spark.createDataFrame([(t,) for t in texts], "v string")
    # compared as text: years outside 1..9999 have no Python datetime
    ours = [r[0] for r in df.select(lenient_timestamp("v").cast("string")).collect()]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = [r[0] for r in df.select(F.col("v").cast("timestamp").cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert ours == legacy, [(t, a, b) for t, a, b in zip(texts, ours, legacy) if a != b]


def test_unwrap_equals_the_three_steps_on_mutated_envelopes(spark):
    import json
    import random

    from ferryline.operators.changes import unwrap_after, unwrap_after_three_step
    from ferryline.schemas import string_struct

    r = random.Random(4)
    names = ("event_id", "make", "model")
    odd = ["", "x", 'q"uote', "tab\there", "back\\slash", "null", "{}", "é", "1"]
    values = [None, "", "[]", "{}", "not json", '{"payload":null}', '{"payload":{"after":null}}', '{"payload":7}']
    for _ in range(600):
        after = {n: r.choice(odd + [None, 3, {"k": 1}]) for n in r.sample(names, r.randint(0, 3))}
        text = json.dumps(after, ensure_ascii=r.random() < 0.5)
        if r.random() < 0.2:
            text = text.replace("\\t", "\t")  # a raw control character
        if r.random() < 0.2:
            text = json.dumps(text)  # JSON text instead of an object
        parts = [f'"after":{text}'] + ['"before":null'] * r.randint(0, 1) + [f'"after":{{"make":"again{r.random()}"}}'] * (r.random() < 0.2)
        r.shuffle(parts)
        payload = "{" + ",".join(parts) + "}"
        if r.random() < 0.15:
            payload = json.dumps(payload)
        parts = [f'"payload":{payload}'] + ['"payload":{"op":"c"}'] * (r.random() < 0.2) + ['"schema":{"payload":1}'] * r.randint(0, 1)
        r.shuffle(parts)
        value = "{" + ",".join(parts) + "}"
        values.append(value[: r.randint(0, len(value))] if r.random() < 0.2 else value)
    df = spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)
    schema = string_struct(names)
    assert unwrap_after(df, schema).collect() == unwrap_after_three_step(df, schema).collect()
    narrowed = string_struct(names[:1])
    assert [x.event_id for x in unwrap_after(df, narrowed).collect()] == [
        x.event_id for x in unwrap_after_three_step(df, schema).collect()
    ]
