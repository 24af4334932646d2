"""Running several streaming queries: wait for any to end (cluster), or poll
and restart failed queries (local runs)."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery


def supervise(starters: dict[str, Callable[[], StreamingQuery]], poll_s: float = 10.0,
              max_restarts: int = 3, run_for_s: float | None = None) -> dict[str, int]:
    """Starts every query, then polls: a query that stopped with an error
    is reported and started again by its starter (from its checkpoint) up to
    ``max_restarts`` times. Returns restart counts; raises ``RuntimeError``
    at the end if a query failed for good."""
    queries = {n: s() for n, s in starters.items()}
    restarts = {n: 0 for n in starters}
    failed: dict[str, object] = {}
    t0 = time.time()
    while run_for_s is None or time.time() - t0 < run_for_s:
        live = False
        for name, q in list(queries.items()):
            if q.isActive:
                live = True
                continue
            err = q.exception()
            if err is None or name in failed:
                continue
            print(f"query {name} failed: {err}")
            if restarts[name] < max_restarts:
                restarts[name] += 1
                queries[name] = starters[name]()
                live = True
            else:
                failed[name] = err
        if not live:
            break
        time.sleep(poll_s)
    if failed:
        raise RuntimeError(f"queries failed after {max_restarts} restarts: {', '.join(sorted(failed))}")
    return restarts
