"""Per-query stage summary from a Spark event log (written by bench.py when
``BENCH_EVENT_LOG_DIR`` is set).

Usage: python tools/stage_skew.py <event-log-file-or-dir>

For each query (the bench's job group; jobs a streaming query runs on its
own thread are counted with the group that started them), prints the
number of stages and tasks, the bytes shuffled, and the worst task-time
spread of any stage with at least four tasks: max task run time divided
by the median. A spread near 1 means the work is evenly cut; a hot key or
an unsplittable input shows up as a large spread.
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys
from collections import defaultdict


def _event_files(path: str) -> list[str]:
    if os.path.isfile(path):
        return [path]
    found = []
    for root, _, names in os.walk(path):
        found += [os.path.join(root, n) for n in names if n.startswith(("events_", "local-", "app-"))]
    return sorted(found)


def _events(path: str):
    for name in _event_files(path):
        with open(name, "rb") as raw:
            if name.endswith(".zstd"):
                import zstandard

                raw = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            for line in io.TextIOWrapper(raw, encoding="utf-8"):
                if line.strip():
                    yield json.loads(line)


def summarize(path: str) -> dict[str, dict]:
    stage_group: dict[int, str] = {}
    group = "(none)"
    runs: dict[int, list[int]] = defaultdict(list)
    shuffle_write: dict[int, int] = defaultdict(int)
    for ev in _events(path):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            props = ev.get("Properties") or {}
            gid = props.get("spark.jobGroup.id")
            if gid and gid == props.get("spark.job.description", gid) and not props.get("sql.streaming.queryId"):
                group = gid
            for sid in ev.get("Stage IDs", []):
                stage_group.setdefault(sid, group)
        elif kind == "SparkListenerTaskEnd":
            sid = ev["Stage ID"]
            metrics = ev.get("Task Metrics") or {}
            runs[sid].append(int(metrics.get("Executor Run Time", 0)))
            shuffle_write[sid] += int((metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0))
    out: dict[str, dict] = {}
    for sid, times in runs.items():
        q = out.setdefault(
            stage_group.get(sid, "(none)"),
            {"stages": 0, "tasks": 0, "shuffle_mb": 0.0, "worst_spread": 1.0, "task_ms": 0},
        )
        q["stages"] += 1
        q["tasks"] += len(times)
        q["task_ms"] += sum(times)
        q["shuffle_mb"] = round(q["shuffle_mb"] + shuffle_write[sid] / 2**20, 1)
        if len(times) >= 4:
            med = statistics.median(times)
            if med > 0:
                q["worst_spread"] = round(max(q["worst_spread"], max(times) / med), 2)
    return out


def main() -> None:
    if len(sys.argv) != 2:
        sys.exit(__doc__)
    for name, q in summarize(sys.argv[1]).items():
        print(
            f"{name:32s} stages {q['stages']:3d}  tasks {q['tasks']:4d}  task-sec {q['task_ms'] / 1000:7.1f}  "
            f"shuffle {q['shuffle_mb']:8.1f} MB  worst max/median {q['worst_spread']:5.2f}"
        )


if __name__ == "__main__":
    main()
