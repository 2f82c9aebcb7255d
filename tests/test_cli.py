"""Job entry points on file-backed topics and file tables."""

import os
import uuid

from ferryline.__main__ import main
from ferryline.sinks import FileTableSink
from tests.golden import EXPECTED, LINES


def test_publish_then_ingest(spark, tmp_root):
    src = os.path.join(tmp_root, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("\n".join(["Event.Id,Investigation.Type"] + LINES))
    topic = f"lines-{uuid.uuid4().hex[:8]}"
    main(["publish", "--lines", src, "--topic", topic])
    tables = os.path.join(tmp_root, "tables")
    main(["ingest", "--topic", topic, "--available-now", "--table-root", tables,
          "--checkpoint", os.path.join(tmp_root, "ck")])
    rows = FileTableSink(os.path.join(tables, "aviation_data")).read(spark).collect()
    assert sorted(tuple(r) for r in rows) == sorted(EXPECTED)


def test_route_stages_batches_next_to_checkpoint(spark, tmp_root):
    import json

    from ferryline.config import TopicConfig
    from ferryline.sinks import write_topic
    from ferryline.workspace import shared_root

    topic = f"changes-{uuid.uuid4().hex[:8]}"
    envs = [json.dumps({"payload": {"after": {"event_id": str(i), "make": f"M{i}", "total_uninjured": str(i)}}})
            for i in range(20)]
    cfg = TopicConfig(topic, path=f"{shared_root(spark)}/topics/{topic}")
    write_topic(spark.createDataFrame([(None, v) for v in envs], "key string, value string"), cfg)
    tables, ck = os.path.join(tmp_root, "tables"), os.path.join(tmp_root, "ck")
    main(["route", "--topic", topic, "--available-now", "--table-root", tables, "--checkpoint", ck, "--stage-batches"])
    quant = FileTableSink(os.path.join(tables, "quantitative_table")).read(spark)
    qual = FileTableSink(os.path.join(tables, "qualitative_table")).read(spark)
    assert sorted(r.total_uninjured for r in quant.collect()) == list(range(20))
    assert sorted(r.make for r in qual.collect()) == sorted(f"M{i}" for i in range(20))
    assert os.listdir(ck + "-staging") == ["slot=0"]


def test_two_topics_have_two_checkpoints_and_one_table(spark, tmp_root):
    from ferryline.workspace import shared_root

    topics = [f"lines-{uuid.uuid4().hex[:8]}" for _ in range(2)]
    tables = os.path.join(tmp_root, "tables")
    for k, topic in enumerate(topics):
        src = os.path.join(tmp_root, topic)
        os.makedirs(src)
        with open(os.path.join(src, "a.csv"), "w") as f:
            f.write("\n".join(["header", *LINES[k::2]]))
        main(["publish", "--lines", src, "--topic", topic])
        main(["ingest", "--topic", topic, "--available-now", "--table-root", tables])
    root = shared_root(spark).replace("file:", "")
    assert all(os.path.isdir(f"{root}/checkpoints/ingest/{t}/offsets") for t in topics)
    rows = FileTableSink(os.path.join(tables, "aviation_data")).read(spark).collect()
    assert sorted(tuple(r) for r in rows) == sorted(EXPECTED)
    # a new checkpoint reads the topic again; nothing that was there goes
    main(["ingest", "--topic", topics[0], "--available-now", "--table-root", tables,
          "--checkpoint", os.path.join(tmp_root, "new")])
    assert FileTableSink(os.path.join(tables, "aviation_data")).read(spark).count() == len(LINES) + len(LINES[0::2])
