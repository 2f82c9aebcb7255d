"""Command-line entry points for the three jobs.

    spark-submit --py-files ferryline.zip ferryline/__main__.py publish --lines data/*.csv --servers broker:9092
    spark-submit --py-files ferryline.zip ferryline/__main__.py ingest --servers broker:9092 --jdbc-conf spark.ferryline.mysql
    spark-submit --py-files ferryline.zip ferryline/__main__.py route --servers broker:9092 --jdbc-conf spark.ferryline.postgres

(``python -m ferryline ...`` works the same for a local run.)

Without ``--servers`` topics are file-backed folders under the shared root.
Each streaming job gets its own checkpoint folder for each topic
(``--checkpoint`` or ``<shared root>/checkpoints/<job>/<topic>``), so no two
share offsets. The JDBC connection is read from Spark conf keys under
``--jdbc-conf`` (``<prefix>.url``, ``.user``, ``.password``, ``.driver``,
``.batch_size``, ``.num_partitions``, ``.isolation_level`` and
``.options.<name>``).
"""

from __future__ import annotations

import argparse

from ferryline.config import MAX_FILES_PER_TRIGGER, MAX_OFFSETS_PER_TRIGGER, JdbcConfig, TopicConfig
from ferryline.plans.jobs import DEFAULT_ROUTES, ingest_lines, publish_lines, route_changes
from ferryline.schemas import CHANGE_TOPIC, INGEST_TABLE, LINE_TOPIC
from ferryline.session import build_session
from ferryline.sinks.jdbc import JdbcSink
from ferryline.sinks.tables import FileTableSink
from ferryline.workspace import shared_root


def _topic(args, default_name: str, root: str) -> TopicConfig:
    name = args.topic or default_name
    return TopicConfig(
        name,
        servers=args.servers,
        path=None if args.servers else f"{root}/topics/{name}",
        starting_offsets=args.starting_offsets,
        max_offsets_per_trigger=args.max_offsets_per_trigger,
        max_files_per_trigger=args.max_files_per_trigger,
        min_partitions=args.min_partitions,
        options=dict(pair.split("=", 1) for pair in args.kafka_option),
    )


def _sink(spark, args, table: str, root: str):
    if args.jdbc_conf:
        return JdbcSink(JdbcConfig.from_spark_conf(spark, args.jdbc_conf), table)
    return FileTableSink(f"{args.table_root or root + '/tables'}/{table}")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="ferryline")
    p.add_argument("job", choices=["publish", "ingest", "route"])
    p.add_argument("--lines", help="publish: input text file(s) with a header line")
    p.add_argument("--servers", help="Kafka bootstrap servers; omit for file-backed topics")
    p.add_argument("--topic")
    p.add_argument("--partition", type=int, help="publish: pin every message to one partition")
    p.add_argument(
        "--skip-blank-lines",
        action="store_true",
        help="publish: skip blank lines (default: they are messages too); line 1 of each file is dropped either way",
    )
    p.add_argument("--starting-offsets", default="earliest")
    p.add_argument("--max-offsets-per-trigger", type=int, default=MAX_OFFSETS_PER_TRIGGER, help="default: %(default)s")
    p.add_argument("--max-files-per-trigger", type=int, default=MAX_FILES_PER_TRIGGER, help="default: %(default)s")
    p.add_argument("--min-partitions", type=int, help="Kafka: read each batch in at least so many tasks")
    p.add_argument(
        "--kafka-option", action="append", default=[], metavar="KEY=VALUE", help="any Kafka source or sink option"
    )
    p.add_argument("--jdbc-conf", help="Spark conf prefix holding the JDBC url/user/password/driver")
    p.add_argument("--table-root", help="folder for file tables when no JDBC sink is given")
    p.add_argument("--checkpoint")
    p.add_argument(
        "--stage-batches",
        action="store_true",
        help="route: share each batch between sinks through a table in the shared folder, which cuts the lineage "
        "back to the topic (default: an executor cache)",
    )
    p.add_argument("--available-now", action="store_true", help="drain what is there, then stop")
    args = p.parse_args(argv)

    spark = build_session(f"ferryline-{args.job}")
    root = shared_root(spark)
    trigger = {"availableNow": True} if args.available_now else None
    default_topic = CHANGE_TOPIC if args.job == "route" else LINE_TOPIC
    checkpoint = args.checkpoint or f"{root}/checkpoints/{args.job}/{args.topic or default_topic}"

    if args.job == "publish":
        if not args.lines:
            p.error("publish needs --lines")
        publish_lines(
            spark,
            args.lines,
            _topic(args, LINE_TOPIC, root),
            partition=args.partition,
            keep_blank_lines=not args.skip_blank_lines,
        )
        return
    source = _topic(args, default_topic, root)
    if args.job == "ingest":
        query = ingest_lines(spark, source, _sink(spark, args, INGEST_TABLE, root), checkpoint, trigger=trigger)
    else:
        sinks = [(r, _sink(spark, args, r.name, root)) for r in DEFAULT_ROUTES]
        # one staging folder per query, next to its checkpoint
        stage_dir = f"{checkpoint.rstrip('/')}-staging" if args.stage_batches else None
        query = route_changes(spark, source, sinks, checkpoint, trigger=trigger, stage_dir=stage_dir)
    query.awaitTermination()


if __name__ == "__main__":
    main()
