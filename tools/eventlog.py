"""Summaries from Spark's event log (no UI, no REST server).

``job_group_metrics(log_dir, group)`` reads the event log files a session
wrote to ``log_dir`` (plain or zstd-compressed JSON lines) and sums, over the
stages of the jobs tagged with ``group``: shuffle bytes written, spilled bytes, task count, and the worst stage skew (max / median task
duration, stages with at least 4 tasks).
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics


def _lines(path: str):
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def _events(log_dir: str):
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isfile(path) and "appstatus" not in os.path.basename(path):
            for line in _lines(path):
                try:
                    yield json.loads(line)
                except ValueError:
                    continue


def job_group_metrics(log_dir: str, group: str) -> dict:
    stages: set[int] = set()
    tasks: dict[int, list[int]] = {}
    totals = {"shuffle_write_bytes": 0, "spill_bytes": 0, "tasks": 0}
    events = list(_events(log_dir))
    for e in events:
        if e.get("Event") == "SparkListenerJobStart":
            if (e.get("Properties") or {}).get("spark.jobGroup.id") == group:
                stages.update(e.get("Stage IDs", []))
    for e in events:
        if e.get("Event") != "SparkListenerTaskEnd" or e.get("Stage ID") not in stages:
            continue
        m = e.get("Task Metrics") or {}
        info = e.get("Task Info") or {}
        totals["tasks"] += 1
        totals["shuffle_write_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
        totals["spill_bytes"] += m.get("Disk Bytes Spilled", 0)
        tasks.setdefault(e["Stage ID"], []).append(info.get("Finish Time", 0) - info.get("Launch Time", 0))
    skews = [max(d) / max(statistics.median(d), 1) for d in tasks.values() if len(d) >= 4]
    totals["stages"] = len(tasks)
    totals["max_stage_task_skew"] = round(max(skews), 2) if skews else None
    return totals
