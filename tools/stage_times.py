"""Summarise a Spark event log: jobs, stages, tasks and busy time per job group.

    python tools/stage_times.py <event-log file or eventlog_v2_* directory>
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events_")]
             if os.path.isdir(path) else [path])
    for f in files:
        if f.endswith(".zstd"):
            import zstandard

            with open(f, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        else:
            with open(f, encoding="utf-8") as fh:
                yield from fh


def main(path: str) -> None:
    stage_group = {}
    stats = defaultdict(lambda: {"jobs": 0, "stages": 0, "tasks": 0, "task_sec": 0.0, "max_task_sec": 0.0})
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            props = ev.get("Properties") or {}
            group = props.get("spark.jobGroup.id", "-")
            stats[group]["jobs"] += 1
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerStageCompleted":
            sid = ev["Stage Info"]["Stage ID"]
            stats[stage_group.get(sid, "-")]["stages"] += 1
        elif kind == "SparkListenerTaskEnd":
            info = ev["Task Info"]
            sec = (info["Finish Time"] - info["Launch Time"]) / 1000.0
            s = stats[stage_group.get(ev["Stage ID"], "-")]
            s["tasks"] += 1
            s["task_sec"] += sec
            s["max_task_sec"] = max(s["max_task_sec"], sec)
    print(f"{'group':28s} {'jobs':>5s} {'stages':>6s} {'tasks':>6s} {'task_sec':>9s} {'max_task':>9s}")
    for g, s in sorted(stats.items(), key=lambda kv: -kv[1]["task_sec"]):
        print(f"{g:28s} {s['jobs']:5d} {s['stages']:6d} {s['tasks']:6d} {s['task_sec']:9.2f} {s['max_task_sec']:9.2f}")


if __name__ == "__main__":
    main(sys.argv[1])
