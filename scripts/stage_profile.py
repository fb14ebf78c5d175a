"""Summarise a Spark event log per job group (bench query): jobs, stages,
tasks, summed task time and shuffle bytes.

usage: python scripts/stage_profile.py <event-log file or directory>
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event log: a plain / zstd file, or a v2 rolling directory."""
    if os.path.isdir(path):
        files = sorted(f for f in os.listdir(path) if f.startswith("events_"))
        for f in files:
            yield from _lines(os.path.join(path, f))
        return
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
        return
    with open(path) as fh:
        yield from fh


def main(path: str) -> None:
    job_group, stage_job = {}, {}
    acc = defaultdict(lambda: {"jobs": 0, "stages": set(), "tasks": 0, "task_ms": 0, "shuffle_w": 0,
                               "shuffle_r": 0, "wall_ms": 0})
    job_start = {}
    if True:
        for line in _lines(path):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id", "-")
                job_group[e["Job ID"]] = g
                job_start[e["Job ID"]] = e.get("Submission Time", 0)
                acc[g]["jobs"] += 1
                for sid in e.get("Stage IDs", []):
                    stage_job[sid] = e["Job ID"]
            elif ev == "SparkListenerJobEnd":
                g = job_group.get(e["Job ID"], "-")
                acc[g]["wall_ms"] += e.get("Completion Time", 0) - job_start.get(e["Job ID"], 0)
            elif ev == "SparkListenerTaskEnd":
                g = job_group.get(stage_job.get(e["Stage ID"]), "-")
                a = acc[g]
                a["stages"].add(e["Stage ID"])
                a["tasks"] += 1
                info = e.get("Task Info", {})
                a["task_ms"] += info.get("Finish Time", 0) - info.get("Launch Time", 0)
                m = e.get("Task Metrics") or {}
                a["shuffle_w"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                a["shuffle_r"] += (m.get("Shuffle Read Metrics") or {}).get("Remote Bytes Read", 0) + \
                    (m.get("Shuffle Read Metrics") or {}).get("Local Bytes Read", 0)
    print(f"{'query':28s} {'jobs':>4s} {'stages':>6s} {'tasks':>6s} {'task_s':>7s} {'job_s':>6s} {'shufW_MB':>8s}")
    for g, a in sorted(acc.items(), key=lambda kv: -kv[1]["wall_ms"]):
        print(f"{g:28s} {a['jobs']:4d} {len(a['stages']):6d} {a['tasks']:6d} {a['task_ms'] / 1000:7.1f} "
              f"{a['wall_ms'] / 1000:6.1f} {a['shuffle_w'] / 1e6:8.2f}")


if __name__ == "__main__":
    arg = sys.argv[1]
    if os.path.isdir(arg) and not any(f.startswith("events_") for f in os.listdir(arg)):
        arg = os.path.join(arg, sorted(os.listdir(arg))[0])    # the bench scratch folder itself
    main(arg)
