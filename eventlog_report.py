"""Summarise a Spark event log (no UI needed): jobs, stages, task time.

    python eventlog_report.py <event log dir or file> [top_n]

Prints the slowest stages with task count, summed task time, shuffle
read/write and spill, so a benchmark run can be profiled after the fact.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(f: str):
    if f.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
        import zstandard

        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def events(path: str):
    files = [path] if os.path.isfile(path) else sorted(
        f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True)
        if os.path.isfile(f) and os.path.basename(f).startswith("events_"))
    for f in files:
        for line in _lines(f):
            line = line.strip()
            if line:
                yield json.loads(line)


def main(path: str, top: int = 25) -> None:
    stages = {}
    stage_job = {}
    per_desc = {}
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerJobStart":
            desc = (e.get("Properties") or {}).get("spark.job.description", "")
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = desc
        if kind == "SparkListenerTaskEnd":
            sid = e["Stage ID"]
            m = e.get("Task Metrics") or {}
            st = stages.setdefault(sid, {"tasks": 0, "task_ms": 0, "shuffle_w": 0, "shuffle_r": 0,
                                         "spill": 0, "name": "", "wall_ms": 0})
            st["tasks"] += 1
            st["task_ms"] += m.get("Executor Run Time", 0)
            st["shuffle_w"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            sr = m.get("Shuffle Read Metrics") or {}
            st["shuffle_r"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
            st["spill"] += m.get("Disk Bytes Spilled", 0)
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            st = stages.setdefault(info["Stage ID"], {"tasks": 0, "task_ms": 0, "shuffle_w": 0,
                                                       "shuffle_r": 0, "spill": 0})
            st["name"] = info.get("Stage Name", "")[:60]
            st["wall_ms"] = info.get("Completion Time", 0) - info.get("Submission Time", 0)
    rows = sorted(stages.items(), key=lambda kv: -kv[1].get("wall_ms", 0))[:top]
    print(f"{'stage':>5} {'wall_ms':>8} {'tasks':>5} {'task_ms':>8} {'shufW_MB':>8} {'shufR_MB':>8} "
          f"{'spill_MB':>8}  name")
    for sid, s in rows:
        print(f"{sid:>5} {s.get('wall_ms', 0):>8} {s['tasks']:>5} {s['task_ms']:>8} "
              f"{s['shuffle_w'] / 1e6:>8.1f} {s['shuffle_r'] / 1e6:>8.1f} {s['spill'] / 1e6:>8.1f}  "
              f"{s.get('name', '')}")
    for sid, st in stages.items():
        d = stage_job.get(sid, "") or "(untagged)"
        agg = per_desc.setdefault(d, [0, 0, 0])
        agg[0] += st.get("wall_ms", 0)
        agg[1] += st["tasks"]
        agg[2] += 1
    print("\nper job description (e.g. bench query): stage wall ms / tasks / stages")
    for d, (ms, t, n) in sorted(per_desc.items(), key=lambda kv: -kv[1][0]):
        print(f"  {d:28s} {ms:>8} {t:>6} {n:>5}")
    total = sum(s.get("wall_ms", 0) for s in stages.values())
    print(f"{len(stages)} stages, {total / 1000:.1f} s summed stage wall time")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 25)
