"""Slowest stages of a run, from a Spark event log (``spark.eventLog.dir``).

    python scripts/stage_times.py <event-log-file> [top]
"""

from __future__ import annotations

import json
import os
import sys
from collections import defaultdict


def lines(path):
    """One event log file, or a rolling event-log directory (Spark 4)."""
    files = [path] if os.path.isfile(path) else sorted(
        os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    for fp in files:
        if fp.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
            import io

            import zstandard
            with open(fp, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def main():
    path, top = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, job_of_stage, job_desc = [], {}, {}
    task_time = defaultdict(int)
    for line in lines(path):
        if line.strip():
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                props = e.get("Properties") or {}
                desc = props.get("spark.job.description") or props.get("callSite.short") or ""
                for sid in e.get("Stage IDs", []):
                    job_of_stage[sid] = e["Job ID"]
                job_desc[e["Job ID"]] = desc
            elif ev == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                task_time[e["Stage ID"]] += m.get("Executor Run Time", 0)
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                if "Submission Time" in si and "Completion Time" in si:
                    stages.append((si["Completion Time"] - si["Submission Time"], si["Stage ID"], si["Number of Tasks"],
                                   job_desc.get(job_of_stage.get(si["Stage ID"], -1), "")[:40] or si["Stage Name"][:40]))
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.1f}s summed stage wall time")
    per_job = defaultdict(int)
    for wall, sid, _, name in stages:
        per_job[name] += wall
    print("by job description:", ", ".join(f"{k}={v / 1000:.1f}s" for k, v in sorted(per_job.items(), key=lambda x: -x[1])[:12]))
    print("wall_ms  stage  tasks  task_ms  job  name")
    for wall, sid, ntasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{wall:7d}  {sid:5d}  {ntasks:5d}  {task_time[sid]:7d}  {job_of_stage.get(sid, -1):4d}  {name}")


if __name__ == "__main__":
    main()
