"""Summarise stage times from a Spark event log (no UI, no server).

    python tools/stage_times.py <event-log-file-or-dir> [top_n]

Prints one line per completed stage: duration, task count, shuffle read and
write bytes, and the stage name, sorted by duration.
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def _files(path: str):
    if not os.path.isdir(path):
        yield path
        return
    for root, _, names in os.walk(path):
        for name in sorted(names):
            if name.startswith("events_") or name.startswith("local-") or name.startswith("app"):
                yield os.path.join(root, name)


def stages(path: str):
    for f in _files(path):
        for line in _lines(f):
            ev = json.loads(line)
            if ev.get("Event") != "SparkListenerStageCompleted":
                continue
            info = ev["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start is None or end is None:
                continue
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            yield {
                "stage": info["Stage ID"],
                "sec": (end - start) / 1000.0,
                "tasks": info["Number of Tasks"],
                "shuffle_read": int(acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0)
                + int(acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0),
                "shuffle_write": int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0),
                "name": info["Stage Name"],
            }


def main(argv):
    top = int(argv[2]) if len(argv) > 2 else 20
    rows = sorted(stages(argv[1]), key=lambda r: -r["sec"])
    total = sum(r["sec"] for r in rows)
    print(f"{len(rows)} stages, {total:.2f} s in stages")
    for r in rows[:top]:
        print(f"{r['sec']:7.3f}s  tasks={r['tasks']:<4} shuffle_r={r['shuffle_read']:>10} "
              f"shuffle_w={r['shuffle_write']:>10}  #{r['stage']} {r['name'][:70]}")


if __name__ == "__main__":
    main(sys.argv)
