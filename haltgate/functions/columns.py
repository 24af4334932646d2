"""Scalar column expressions shared by batch and streaming operators.

Everything here is a built-in Spark expression (JVM side, inside whole-stage
codegen); no Python UDF is used anywhere in the hot path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These strings must equal the reference's for identical output.
# ---------------------------------------------------------------------------
SCOPE_GLOBAL = "GLOBAL"
ACCOUNT_PREFIX = "ACCOUNT:"
SYMBOL_PREFIX = "SYMBOL:"
STRATEGY_PREFIX = "STRATEGY:"
ACTION_KILL = "KILL"
ACTION_UNKILL = "UNKILL"
STATUS_KILLED = "KILLED"
STATUS_ACTIVE = "ACTIVE"
STATUS_UNKNOWN = "UNKNOWN"
DECISION_ALLOW = "ALLOW"
DECISION_DROP = "DROP"
TRIGGERED_BY_DETECTOR = "spark"
METRIC_RATE = "order_rate"  # with the window: order_rate_60s
METRIC_NOTIONAL = "notional"  # with the window: notional_60s
METRIC_CONCENTRATION = "symbol_concentration"
REASON_KILL_DEFAULT = "Kill switch active"
REASON_NO_KILL = "No kill switch active"
REASON_OPERATOR_DEFAULT = "Manual operator action"
OPERATOR_DEFAULT = "api"
UPDATED_BY_DEFAULT = "unknown"
ROUTER_SERVICE = "order_router"
ERR_SCOPE_MISSING = "Missing required field: scope"
ERR_SCOPE_INVALID = "Invalid scope format. Use GLOBAL, ACCOUNT:<id>, or SYMBOL:<symbol>"
AUDIT_TTL_DAYS = 30
STATE_TTL_DAYS = 7
DASH = "-"
ERR_PATH_UNKNOWN = "Not found. Available endpoints: POST /kill, POST /unkill, GET /health"
ACTION_THROTTLE = "THROTTLE"
STATUS_THROTTLED = "THROTTLED"
DECISION_THROTTLED = "THROTTLED"
DECISION_DUPLICATE = "DUPLICATE"
# ---------------------------------------------------------------------------


def c(name_or_col) -> Column:
    return F.col(name_or_col) if isinstance(name_or_col, str) else name_or_col


def to_epoch_ms(ts) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ -> epoch milliseconds (session time zone UTC)."""
    return F.unix_millis(c(ts).cast("timestamp"))


def event_time(ts_ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP, keeping the millisecond fraction."""
    return F.timestamp_millis(c(ts_ms))


def notional_amount(qty, price) -> Column:
    """qty * price as a decimal of eight places, enough for sub-cent prices.

    Money is summed as decimals so totals are exact and independent of how
    rows are partitioned: a recomputed partition after executor loss yields
    the same command values and the same deterministic ids. Null where the
    amount is no such number (too large, infinite, not a number).
    """
    return (c(qty) * c(price)).try_cast("decimal(26,8)")


def account_scope(account_id) -> Column:
    return F.concat(F.lit(ACCOUNT_PREFIX), c(account_id))


def symbol_scope(symbol) -> Column:
    return F.concat(F.lit(SYMBOL_PREFIX), c(symbol))


def strategy_scope(strategy) -> Column:
    return F.concat(F.lit(STRATEGY_PREFIX), c(strategy))


def stable_id(*parts) -> Column:
    """Deterministic 64-hex id from parts (sha-256 of the '|'-joined text).

    Re-running a query (restart, replay, task retry) produces the same ids, so
    sinks can be idempotent.
    """
    return F.sha2(F.concat_ws("|", *[c(p).cast("string") for p in parts]), 256)


def money_text(amount) -> Column:
    """Two fixed decimals, e.g. 1234567.5 -> '1234567.50'."""
    return F.format_string("%.2f", c(amount))


def percent_text(num, den) -> Column:
    """100*num/den with two decimals, rounded half up in exact integer arithmetic."""
    basis = (c(num).cast("bigint") * F.lit(20000) + c(den)).cast("bigint") / (F.lit(2) * c(den))
    bp = F.floor(basis).cast("bigint")
    return F.concat(F.floor(bp / 100).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((bp % 100).cast("string"), 2, "0"))


def status_of(action) -> Column:
    """KILL -> KILLED, UNKILL -> ACTIVE, THROTTLE -> THROTTLED, anything else -> null (dropped)."""
    a = c(action)
    return (F.when(a == ACTION_KILL, F.lit(STATUS_KILLED))
            .when(a == ACTION_UNKILL, F.lit(STATUS_ACTIVE))
            .when(a == ACTION_THROTTLE, F.lit(STATUS_THROTTLED)))


def scope_error(scope, include_strategy: bool = False) -> Column:
    """Validation message for an operator scope; null when the scope is valid.

    Only the prefix is checked, so 'ACCOUNT:' alone is accepted. STRATEGY
    scopes are accepted where the router gates on them.
    """
    s = c(scope)
    strategy = s.startswith(STRATEGY_PREFIX) if include_strategy else F.lit(False)
    return (F.when(s.isNull() | (s == ""), F.lit(ERR_SCOPE_MISSING))
            .when((s == SCOPE_GLOBAL) | s.startswith(ACCOUNT_PREFIX) | s.startswith(SYMBOL_PREFIX) | strategy,
                  F.lit(None).cast("string"))
            .otherwise(F.lit(ERR_SCOPE_INVALID)))


def ttl_epoch_seconds(ts_ms, days: int) -> Column:
    """Expiry in epoch seconds: the record time + ``days``."""
    return F.floor(c(ts_ms) / 1000).cast("bigint") + F.lit(86400 * days)


def normalise_epoch_ms(ts) -> Column:
    """Values above 1e12 are milliseconds, smaller ones seconds; null stays null."""
    t = c(ts)
    return F.when(t > F.lit(10 ** 12), t).otherwise(t * 1000).cast("bigint")


def short_id(col, n: int = 8) -> Column:
    return F.coalesce(F.substring(c(col), 1, n), F.lit(DASH))


def first_true(*pairs) -> Column:
    """CASE over (condition, value) pairs, first match wins."""
    expr = None
    for cond, val in pairs:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr
