"""Sources and sinks: raw lines, topics, file tables, JDBC/Kafka options, preview."""

import os

import pytest

from ferryline.config import JdbcConfig, TopicConfig
from ferryline.operators import decode_messages, keyed_messages
from ferryline.sinks import FileTableSink, jdbc_write_options, preview_handler, topic_rows, write_topic
from ferryline.sources import jdbc_read_options, kafka_source_options, raw_lines, read_topic
from ferryline.sources.text_lines import write_lines
from ferryline.workspace import fresh_dir, shared_root
from tests.golden import LINES


def test_raw_lines_drops_header_of_every_file(spark, tmp_root):
    for i, part in enumerate((LINES[:2], LINES[2:])):
        with open(os.path.join(tmp_root, f"part{i}.csv"), "w") as f:
            f.write("\n".join(["Event.Id,Investigation.Type"] + part))
    got = sorted(r.value for r in raw_lines(spark, tmp_root).collect())
    assert got == sorted(LINES)  # quotes intact, no header rows
    by_position = sorted(r.value for r in raw_lines(spark, tmp_root, keep_blank_lines=False).collect())
    assert by_position == sorted(LINES)


def test_raw_lines_by_position_for_files_with_different_headers(spark, tmp_root):
    for i, part in enumerate((LINES[:2], LINES[2:])):
        with open(os.path.join(tmp_root, f"part{i}.csv"), "w") as f:
            f.write("\n".join([f"Header{i}"] + part))
    got = sorted(r.value for r in raw_lines(spark, tmp_root, keep_blank_lines=False).collect())
    assert got == sorted(LINES)


def test_raw_lines_keeps_quotes_backslashes_blanks(spark, tmp_root):
    text = ['a,"b, c",d', " lead", 'back\\slash,"x"', "trail "]
    with open(os.path.join(tmp_root, "f.csv"), "w") as f:
        f.write("\n".join(["h"] + text) + "\n")
    assert sorted(r.value for r in raw_lines(spark, tmp_root).collect()) == sorted(text)


def test_write_lines_roundtrip_with_header(spark):
    path = fresh_dir(spark, "lines")
    df = spark.createDataFrame([(x,) for x in LINES], "value string").repartition(3)
    write_lines(df, path, header="A,B")
    assert sorted(r.value for r in raw_lines(spark, path).collect()) == sorted(LINES)


def test_file_topic_roundtrip_and_key_partitioning(spark):
    cfg = TopicConfig("t", path=fresh_dir(spark, "topic"), num_partitions=3)
    msgs = keyed_messages(spark.createDataFrame([(x,) for x in LINES], "value string"), "t")
    write_topic(msgs, cfg)
    raw = read_topic(spark, cfg)
    assert raw.columns == ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]
    rows = raw.collect()
    assert {r.partition for r in rows} <= {0, 1, 2}
    again = {r.key.decode(): r.partition for r in topic_rows(msgs, cfg).collect()}
    assert {r.key.decode(): r.partition for r in rows} == again  # same key, same partition
    assert sorted(tuple(r) for r in decode_messages(raw).collect()) == sorted(tuple(r) for r in msgs.collect())


def test_pinned_partition_kept(spark):
    msgs = keyed_messages(spark.createDataFrame([(x,) for x in LINES], "value string"), "t", partition=1)
    assert {r.partition for r in topic_rows(msgs, TopicConfig("t")).collect()} == {1}


def test_file_table_sink_replay_is_idempotent(spark):
    path = fresh_dir(spark, "table")
    sink, other = FileTableSink(path, query_id="a"), FileTableSink(path, query_id="b")
    df = spark.createDataFrame([(1, 7), (2, 8)], "x int, batch_id int")
    sink.write(df, 0)
    sink.write(df, 0)  # replay of batch 0 after a crash
    sink.write(df, 1)
    assert sorted(r.x for r in sink.read(spark).collect()) == [1, 1, 2, 2]
    assert sink.read(spark).columns == ["x", "batch_id"]
    other.write(df, 0)  # another query's batch 0
    sink.write(df)  # a batch append
    assert sorted(r.x for r in other.read(spark, df.schema).collect()) == [1, 1, 1, 1, 2, 2, 2, 2]
    with pytest.raises(RuntimeError, match="query"):
        FileTableSink(path).write(df, 0)


def test_empty_file_table_is_read_with_a_schema(spark, tmp_root):
    assert FileTableSink(tmp_root).read(spark, "x int").count() == 0


def test_kafka_source_options():
    cfg = TopicConfig("csv_to_mysql", servers="broker:9092", max_offsets_per_trigger=1000, min_partitions=64)
    assert kafka_source_options(cfg) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "csv_to_mysql",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }
    assert "maxOffsetsPerTrigger" not in kafka_source_options(cfg, streaming=False)


def test_jdbc_options():
    cfg = JdbcConfig("jdbc:postgresql://db/test", user="u", password="p", driver="org.postgresql.Driver",
                     batch_size=5000, num_partitions=8)
    w = jdbc_write_options(cfg, "quantitative_table")
    assert w["dbtable"] == "quantitative_table" and w["batchsize"] == "5000" and w["numPartitions"] == "8"
    r = jdbc_read_options(cfg, "aviation_data", partition_column="id", lower_bound=0, upper_bound=100,
                          num_partitions=4)
    assert (r["partitionColumn"], r["lowerBound"], r["upperBound"], r["numPartitions"]) == ("id", "0", "100", "4")
    with pytest.raises(ValueError):
        jdbc_read_options(cfg, "t", partition_column="id")


def test_jdbc_config_from_spark_conf(spark):
    spark.conf.set("spark.ferrytest.jdbc.url", "jdbc:postgresql://db/x")
    spark.conf.set("spark.ferrytest.jdbc.user", "reader")
    cfg = JdbcConfig.from_spark_conf(spark, "spark.ferrytest.jdbc")
    assert cfg.url == "jdbc:postgresql://db/x" and cfg.user == "reader" and cfg.password is None


def test_preview_is_bounded(spark):
    out = []
    preview_handler(num_rows=3, out=out.append)(spark.range(100).toDF("x"), 7)
    assert out[0].startswith("-- batch 7: 3 row") and len(out) == 4


def test_shared_root_reads_session(spark):
    root = shared_root(spark)
    assert root and fresh_dir(spark, "a") != fresh_dir(spark, "a")


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self.registered = master, _Conf(conf), None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self.registered

    def setCheckpointDir(self, path):
        self.registered = path


class _Session:
    def __init__(self, master, conf=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, conf or {})


def test_shared_root_on_a_cluster_needs_checkpoint_dir():
    assert shared_root(_Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ck/"})) == "hdfs://nn/ck"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_Session("spark://master:7077"))
    local = _Session("local[2]")
    root = shared_root(local)
    assert os.path.isdir(root) and local.sparkContext.registered == root


def test_raw_lines_crlf_and_blank_lines(spark, tmp_root):
    with open(os.path.join(tmp_root, "f.csv"), "w", newline="") as f:
        f.write("H1,H2\r\na,b\r\n\r\nc,d\r\n")
    assert sorted(r.value for r in raw_lines(spark, tmp_root, keep_blank_lines=False).collect()) == ["a,b", "c,d"]
    assert sorted(r.value for r in raw_lines(spark, tmp_root).collect()) == ["", "a,b", "c,d"]
    assert raw_lines(spark, tmp_root, header=False).count() == 4


def test_one_batch_limit_everywhere():
    opts = kafka_source_options(TopicConfig("t", servers="b:9092"))
    assert opts["maxOffsetsPerTrigger"] == "10000000" and "minPartitions" not in opts
    assert TopicConfig("t").max_files_per_trigger == 1000
    own = TopicConfig("t", servers="b:9092", max_offsets_per_trigger=None, options={"kafka.security.protocol": "SSL"})
    opts = kafka_source_options(own)
    assert "maxOffsetsPerTrigger" not in opts and opts["kafka.security.protocol"] == "SSL"


def test_jdbc_config_reads_every_field(spark):
    from ferryline.config import JdbcConfig
    from ferryline.sinks.jdbc import jdbc_write_options

    conf = {
        "url": "jdbc:mysql://h/db", "user": "u", "password": "p", "driver": "D", "batch_size": "500",
        "num_partitions": "8", "isolation_level": "READ_COMMITTED", "options.truncate": "true",
    }
    for k, v in conf.items():
        spark.conf.set(f"spark.ferryline.test.{k}", v)
    cfg = JdbcConfig.from_spark_conf(spark, "spark.ferryline.test")
    assert jdbc_write_options(cfg, "t") == {
        "url": "jdbc:mysql://h/db", "dbtable": "t", "user": "u", "password": "p", "driver": "D", "batchsize": "500",
        "numPartitions": "8", "isolationLevel": "READ_COMMITTED", "truncate": "true",
    }
    with pytest.raises(ValueError, match="url"):
        JdbcConfig.from_spark_conf(spark, "spark.ferryline.other")


def test_hot_key_is_not_read_by_one_task(spark):
    """A key holding 40 % of all messages stays in one topic partition (per-key
    order), but reading the topic does not hand that load to one task."""
    from pyspark.sql import functions as F

    lines = spark.range(4000).select(
        F.when(F.col("id") % 5 < 2, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k")
    ).select(F.concat_ws(",", "k", F.lit("x")).alias("value"))
    cfg = TopicConfig("t", path=fresh_dir(spark, "topic"), num_partitions=3)
    write_topic(keyed_messages(lines.repartition(4), "t"), cfg)
    raw = read_topic(spark, cfg)
    hot = raw.where(F.col("key") == F.lit(b"HOT"))
    assert hot.count() == 1600 and hot.select("partition").distinct().count() == 1
    per_task = [r[0] for r in raw.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(per_task) >= 4 and max(per_task) <= 0.3 * sum(per_task)


def test_raw_lines_keep_control_characters_whole(spark, tmp_root):
    text = ["a\u0001b,\"q\",c", "last\u0001\u0001", "tab\there\u0002"]
    with open(os.path.join(tmp_root, "f.csv"), "w") as f:
        f.write("\n".join(["h"] + text) + "\n")
    assert sorted(r.value for r in raw_lines(spark, tmp_root).collect()) == sorted(text)
    assert sorted(r.value for r in raw_lines(spark, tmp_root, keep_blank_lines=False).collect()) == sorted(text)
    out = fresh_dir(spark, "lines")
    write_lines(spark.createDataFrame([(x,) for x in text], "value string"), out, header="h")
    assert sorted(r.value for r in raw_lines(spark, out).collect()) == sorted(text)


def test_raw_lines_from_a_file_cut_into_many_splits(spark, tmp_root):
    text = [f'{i},"City {i}, ST",x{i}' for i in range(5000)]
    with open(os.path.join(tmp_root, "big.csv"), "w") as f:
        f.write("\n".join(["H1,H2,H3"] + text) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        for keep_blank_lines in (True, False):
            df = raw_lines(spark, tmp_root, keep_blank_lines=keep_blank_lines)
            assert df.rdd.getNumPartitions() > 4  # the file is read by many tasks
            got = [r.value for r in df.collect()]
            assert sorted(got) == sorted(text)  # header dropped once, no line lost or doubled at a cut
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_header_with_byte_order_mark_is_dropped(spark, tmp_root):
    with open(os.path.join(tmp_root, "f.csv"), "w", encoding="utf-8-sig") as f:
        f.write("H1,H2\na,b\n\nc\n")
    assert sorted(r.value for r in raw_lines(spark, tmp_root).collect()) == ["", "a,b", "c"]


def test_raw_lines_of_empty_input(spark, tmp_root):
    empty_dir = os.path.join(tmp_root, "none")
    os.makedirs(empty_dir)
    open(os.path.join(empty_dir, "empty.csv"), "w").close()
    assert raw_lines(spark, empty_dir).count() == 0
    assert raw_lines(spark, empty_dir, keep_blank_lines=False).count() == 0


def test_write_lines_keeps_empty_and_blank_lines(spark):
    text = ["a,b", "", "   ", "c", '"q"']
    out = fresh_dir(spark, "lines")
    write_lines(spark.createDataFrame([(x,) for x in text], "value string").repartition(3), out, header="H")
    import glob

    files = [f for f in glob.glob(out.replace("file:", "") + "/part-*") if os.path.getsize(f) > 0]
    assert files and all(open(f).read().startswith("H\n") for f in files)  # every file opens with the header
    assert sorted(r.value for r in raw_lines(spark, out).collect()) == sorted(text)


@pytest.mark.parametrize("split", ["8k", "128m"])
def test_header_is_line_one_of_each_file_and_nothing_else(spark, tmp_root, split):
    """Plain and compressed files, a blank first line, headers that differ, a
    header repeated as data at once and far on, many files in one task."""
    import gzip

    expected = []
    for i in range(24):
        first = ["H1,H2", "", "A,B", "C;D"][i % 4]
        text = ["H1,H2", ""] + [f"{i},x{j}" for j in range(40 if i % 6 else 1500)] + [first, "H1,H2", f"tail{i}"]
        expected += text
        name, opened = (f"{i}.csv.gz", gzip.open) if i % 3 == 0 else (f"{i}.csv", open)
        with opened(os.path.join(tmp_root, name), "wt") as f:
            f.write("\n".join([first, *text]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = sorted(r.value for r in raw_lines(spark, tmp_root).collect())
        dense = sorted(r.value for r in raw_lines(spark, tmp_root, keep_blank_lines=False).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == sorted(expected)
    assert dense == sorted(x for x in expected if x)


def test_write_lines_rolls_compressed_files_each_with_its_header(spark):
    import glob

    text = [["a,b", "", "H", None, f'{i},"x"'][i % 5] for i in range(230)]
    out = fresh_dir(spark, "lines")
    df = spark.createDataFrame([(x,) for x in text], "value string").coalesce(1)
    write_lines(df, out, header="H", compression="lz4", lines_per_file=100)
    assert len(glob.glob(out.replace("file:", "") + "/part-*.lz4")) == 3
    assert sorted(r.value for r in raw_lines(spark, out).collect()) == sorted(x or "" for x in text)


def test_published_lines_and_messages_are_stored_compressed(spark, tmp_path):
    """The bytes that publish_keyed_lines and stream_ingest_lines write stay
    well under those of the lines and messages themselves."""
    import datetime as dt

    from ferryline.plans import catalog

    rows = [(i, i * 7 % 900, i % 90, i % 7 + 1, i % 50 + 0.5, i % 10 / 100, i % 8 / 100, "ANR"[i % 3], "FO"[i % 2],
             dt.datetime(1995, 1, 1) + dt.timedelta(i % 900)) for i in range(4000)]
    schema = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    )
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    plain = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
    plain = sum(len(r.value) for r in catalog.accident_lines(plain).collect())

    def stored(path):
        return sum(e.stat().st_size for e in os.scandir(path.replace("file:", "")))

    csv = catalog._accident_csv(spark, str(tmp_path))
    assert stored(csv) < plain / 2
    messages = catalog.publish_keyed_lines(spark, str(tmp_path))
    assert messages.count() == len(rows)
    topic = os.path.dirname(messages.inputFiles()[0].replace("file://", "").replace("file:", ""))
    assert stored(topic) < plain / 5
