"""Failure and rate-limit behaviour of the streaming jobs."""

import json

import pytest

from ferryline.config import TopicConfig
from ferryline.operators import Route
from ferryline.plans.jobs import route_changes
from ferryline.sinks import FileTableSink, write_topic
from ferryline.sources import read_topic_stream
from ferryline.workspace import fresh_dir


def _env(i):
    return json.dumps({"payload": {"after": {"event_id": str(i), "make": f"M{i}"}, "op": "c"}})


ROUTE_A = Route("a", (("event_id", "string"),))
ROUTE_B = Route("b", (("event_id", "string"), ("make", "string")))


class CrashOnce:
    """Writes like its target, but the first write of ``batch`` fails
    after the data is written (a crash between commit and acknowledgement)."""

    def __init__(self, target, batch, flag):
        self.target, self.batch, self.flag = target, batch, flag

    def write(self, df, batch_id=None):
        self.target.write(df, batch_id)
        if batch_id == self.batch and not self.flag:
            self.flag.append(True)
            raise RuntimeError("simulated crash between the two sink writes")


def test_crash_between_sinks_then_restart_has_no_duplicates(spark):
    topic = TopicConfig("c", path=fresh_dir(spark, "topic"))
    write_topic(spark.createDataFrame([(None, _env(i)) for i in range(30)], "key string, value string"), topic)
    a, b = FileTableSink(fresh_dir(spark, "a")), FileTableSink(fresh_dir(spark, "b"))
    ckpt = fresh_dir(spark, "ck")
    flag = []
    q = route_changes(spark, topic, [(ROUTE_A, CrashOnce(a, 0, flag)), (ROUTE_B, b)], ckpt,
                      trigger={"availableNow": True})
    with pytest.raises(Exception):
        q.awaitTermination()
    assert a.read(spark).count() == 30  # first table written, second not, batch not committed
    q = route_changes(spark, topic, [(ROUTE_A, a), (ROUTE_B, b)], ckpt, trigger={"availableNow": True})
    q.awaitTermination()
    assert a.read(spark).count() == 30 and b.read(spark).count() == 30  # replayed once, no duplicate


def test_rate_limit_splits_into_micro_batches(spark):
    topic = TopicConfig("c", path=fresh_dir(spark, "topic"), max_files_per_trigger=1)
    for part in range(3):
        rows = [(None, _env(i)) for i in range(part * 10, part * 10 + 10)]
        write_topic(spark.createDataFrame(rows, "key string, value string").coalesce(1), topic)
    sink = FileTableSink(fresh_dir(spark, "t"))
    q = route_changes(spark, topic, [(ROUTE_B, sink)], fresh_dir(spark, "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    batches = sink.read(spark).selectExpr("regexp_extract(_metadata.file_path, 'batch-[0-9]+', 0) AS batch")
    assert batches.count() == 30 and batches.distinct().count() == 3


def test_kafka_branch_uses_kafka_source(spark):
    cfg = TopicConfig("csv_to_mysql", servers="localhost:1")
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic_stream(spark, cfg)


def test_crash_between_sinks_with_staged_batch(spark):
    topic = TopicConfig("c", path=fresh_dir(spark, "topic"))
    write_topic(spark.createDataFrame([(None, _env(i)) for i in range(30)], "key string, value string"), topic)
    a, b = FileTableSink(fresh_dir(spark, "a")), FileTableSink(fresh_dir(spark, "b"))
    ckpt, stage = fresh_dir(spark, "ck"), fresh_dir(spark, "stage")
    flag = []
    q = route_changes(spark, topic, [(ROUTE_A, CrashOnce(a, 0, flag)), (ROUTE_B, b)], ckpt,
                      trigger={"availableNow": True}, stage_dir=stage)
    with pytest.raises(Exception):
        q.awaitTermination()
    q = route_changes(spark, topic, [(ROUTE_A, a), (ROUTE_B, b)], ckpt, trigger={"availableNow": True},
                      stage_dir=stage)
    q.awaitTermination()
    assert a.read(spark).count() == 30 and b.read(spark).count() == 30
    assert sorted(r.make for r in b.read(spark).collect()) == sorted(f"M{i}" for i in range(30))
