"""Plan shape of the registered batch queries (from ``explain``).

Every operator here is a projection, so a plan may hold no shuffle, join,
aggregate or sort, and no Python evaluation; scans read only the columns used, and a
route parses only its own fields.
"""

import contextlib
import io
import json
import re

import pytest

from ferryline.operators import Route, route_records
from ferryline.plans.catalog import QUERIES
from ferryline.plans.derive import LINE_SOURCE_COLUMNS
from ferryline.schemas import CHANGE_SCHEMA, QUANTITATIVE_ROUTE
from tests.conftest import SF0001

# queries that run a stream or publish a topic first; their result is a
# plain scan of what was written
WRITES_FIRST = ("publish_", "stream_", "fanout_", "append_", "checkpoint_", "raw_line_scan")
BATCH = sorted(n for n in QUERIES if not n.startswith(WRITES_FIRST))

FORBIDDEN = ("Join", "Aggregate", "Sort (", "Window", "EvalPython", "InPandas", "InArrow")


def plan_text(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def narrow_problems(plan: str) -> list[str]:
    """What keeps a formatted plan from being scan -> project -> output."""
    problems = [op for op in FORBIDDEN if op in plan]
    exchanges = re.findall(r"^\(\d+\) (?:Exchange|ShuffleExchange)\b", plan, flags=re.M)
    if exchanges:
        problems.append(f"{len(exchanges)} exchanges")
    return problems


def test_plan_check_catches_a_shuffle(spark):
    df = spark.range(100)
    assert narrow_problems(plan_text(df.select("id"))) == []
    assert narrow_problems(plan_text(df.groupBy((df.id % 3).alias("k")).count())) != []
    assert narrow_problems(plan_text(df.repartition(4, "id"))) != []
    assert narrow_problems(plan_text(df.repartition(4))) != []


@pytest.mark.parametrize("name", BATCH)
def test_batch_query_plan_is_narrow(spark, name):
    assert narrow_problems(plan_text(QUERIES[name](spark, SF0001))) == []


def test_lineitem_scan_reads_only_used_columns(spark):
    plan = plan_text(QUERIES["route_quantitative"](spark, SF0001))
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert len(schemas) == 1
    read = {f.split(":")[0] for f in schemas[0].split(",")}
    assert read == set(LINE_SOURCE_COLUMNS)


def test_route_parses_only_its_fields(spark):
    env = json.dumps({"payload": {"after": {"event_id": "1", "event_date": "2001-02-03"}}})
    df = spark.createDataFrame([(env,)], "value string")
    plan = plan_text(route_records(df, Route("q", QUANTITATIVE_ROUTE), CHANGE_SCHEMA))
    parsed = set(re.findall(r"StructField\((\w+),StringType", plan))
    assert parsed == {name for name, _ in QUANTITATIVE_ROUTE}
    assert "accident_number" not in parsed and len(parsed) < len(CHANGE_SCHEMA.fields)
