"""

    python scripts/baseline_table.py <bench.json> <event-log-dir>
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventlog_summary import summarize  # noqa: E402


def main() -> None:
    bench = json.loads(open(sys.argv[1]).read().strip().splitlines()[-1])
    ev = summarize(sys.argv[2])
    print("| Key | sf | seconds | cores | shuffle write | spill (disk) | jobs |")
    print("|---|---|---|---|---|---|---|")
    for key, sec in bench["queries"].items():
        m = ev.get(key, {})
        print(f"| {key} | {bench['sf']} | {sec:.2f} | {bench.get('cpus', '')} | "
              f"{m.get('shuffle_write_bytes', 0) / 1e6:.2f} MB | {m.get('disk_spill_bytes', 0)} B | {m.get('jobs', 0)} |")
    print(f"| **total** | {bench['sf']} | {bench['value']:.2f} | {bench.get('cpus', '')} | | | |")


if __name__ == "__main__":
    main()
