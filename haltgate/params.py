"""Detection parameters. Window width and thresholds are always parameters."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

_UNIT_SECONDS = {
    "second": 1, "seconds": 1, "sec": 1, "s": 1,
    "minute": 60, "minutes": 60, "min": 60, "m": 60,
    "hour": 3600, "hours": 3600, "h": 3600,
    "day": 86400, "days": 86400, "d": 86400,
}


def interval_seconds(spec: str) -> int:
    """'60 seconds' -> 60, '5 minutes' -> 300, '1 day' -> 86400."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", spec)
    if not m or m.group(2).lower() not in _UNIT_SECONDS:
        raise ValueError(f"unsupported interval: {spec!r}")
    return int(m.group(1)) * _UNIT_SECONDS[m.group(2).lower()]


@dataclass(frozen=True)
class RiskParams:
    """Thresholds of the detector; the defaults are the reference's defaults.

    Breaches are strict ``>`` comparisons. ``min_orders`` is an extra guard for
    the concentration breach (default 1 keeps parity: a single-order window
    has share 1.0 and breaches).
    """

    window: str = "60 seconds"
    max_orders: int = 100
    max_notional: float = 1_000_000.0
    max_share: float = 0.7
    min_orders: int = 1
    watermark: str = "60 seconds"

    @property
    def window_seconds(self) -> int:
        return interval_seconds(self.window)

    @property
    def window_ms(self) -> int:
        return self.window_seconds * 1000

    @property
    def window_label(self) -> str:
        """Text used in reasons and metric names: '60s' for the default."""
        return f"{self.window_seconds}s"

    def with_(self, **kw) -> "RiskParams":
        return replace(self, **kw)


DEFAULT_PARAMS = RiskParams()

# Parameters used by the registered queries on the supplied tables: the event
# table holds at most a couple of orders per account and minute, so a day
# window and small thresholds are needed for breaches to occur.
EVENT_PARAMS = RiskParams(window="1 day", max_orders=3, max_notional=5000.0,
                          max_share=0.7, min_orders=3, watermark="1 day")
BOOK_PARAMS = RiskParams(window="1 day", max_orders=8, max_notional=300000.0,
                         max_share=0.7, min_orders=4, watermark="1 day")

# Extension parameters used by the registered queries.
SYMBOL_PARAMS = RiskParams(window="1 hour", max_orders=6, max_notional=15000.0,
                           max_share=0.5, min_orders=4, watermark="1 hour")
STRATEGY_PARAMS = RiskParams(window="1 hour", max_orders=12, max_notional=30000.0,
                             max_share=0.6, min_orders=5, watermark="1 hour")
MULTI_WINDOW_SPECS = [
    RiskParams(window="1 hour", max_orders=2, max_notional=4000.0, max_share=0.9, min_orders=3),
    RiskParams(window="6 hours", max_orders=3, max_notional=6000.0, max_share=0.8, min_orders=3),
    RiskParams(window="1 day", max_orders=4, max_notional=9000.0, max_share=0.7, min_orders=4),
]
THROTTLE_RATE_PER_SECOND = 2
DUPLICATE_MEMORY_MS = 3_600_000
AUTO_UNKILL_COOLDOWN_MS = 2 * 86_400_000

# The period of the supplied commands (January 2024, 30 days), into which the
# book of orders is replayed; and how much later each line of an order repeats it.
REPLAY_START_MS = 1_704_067_200_000
REPLAY_SPAN_MS = 30 * 86_400_000
RESEND_STEP_MS = 25 * 60_000
