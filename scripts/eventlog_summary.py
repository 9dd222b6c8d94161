"""Sum shuffle bytes and spill per job group from a Spark event log.

    python scripts/eventlog_summary.py <event-log-file-or-rolled-dir>
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path), key=lambda n: (len(n), n))
              if f.startswith("events_")] if os.path.isdir(path) else [path])
    for name in files:
        with open(name, "rb") as raw:
            if name.endswith(".zstd"):
                import zstandard
                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(raw, encoding="utf-8")
            yield from stream


def summarize(path: str) -> dict[str, dict[str, int]]:
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "-")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
                out[group]["jobs"] += 1
            elif kind == "SparkListenerTaskEnd":
                m = ev.get("Task Metrics") or {}
                g = out[stage_group.get(ev.get("Stage ID"), "-")]
                g["tasks"] += 1
                g["shuffle_write_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                sr = m.get("Shuffle Read Metrics") or {}
                g["shuffle_read_bytes"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                g["memory_spill_bytes"] += m.get("Memory Bytes Spilled", 0)
                g["disk_spill_bytes"] += m.get("Disk Bytes Spilled", 0)
                g["input_bytes"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
    return {k: dict(v) for k, v in out.items()}


if __name__ == "__main__":
    print(json.dumps(summarize(sys.argv[1]), indent=1))
