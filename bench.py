"""Headline-query benchmark.

Runs the main operators on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line. Each query is executed
fully (``noop`` sink: every row computed, nothing collected), once to warm
up and then ``$BENCH_REPS`` times; the median is reported. No run uses what an
earlier one stored: each of ``dashboard_totals`` and ``drops_by_activation``
includes the gate whose audit it reports on.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from haltgate.plans import catalog  # noqa: E402
from haltgate.session import build_session  # noqa: E402

HEADLINE = [
    "risk_signals",          # windowed per-account signals (events)
    "kill_commands",         # breaches -> commands
    "book_risk_signals",     # signals over lineitem ⋈ orders ⋈ part
    "state_snapshot",        # command log -> latest state per scope
    "kill_intervals",        # status changes -> KILLED periods
    "gate_audit",            # as-of gate of every event order
    "book_gate_audit",       # as-of gate of every book order
    "drops_by_activation",   # kill activation attribution (range join)
    "dashboard_totals",      # audit report
    "multi_window_commands", # three windows in one pass
    "stream_risk_signals",   # streaming detector, file source, availableNow
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, "haltgate-bench")
    qs = catalog.queries()
    times = {}
    for name in HEADLINE:
        runs = []
        for i in range(reps + 1):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None}))


if __name__ == "__main__":
    main()
