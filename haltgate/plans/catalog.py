"""Registered queries: one per operator of the inventory, each paired with its
DuckDB oracle statement. Every query reads the supplied tables in full."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle_sql as O
from ..functions.columns import (AUDIT_TTL_DAYS, ACTION_THROTTLE, ACTION_UNKILL, DECISION_DUPLICATE, DECISION_THROTTLED, STATUS_ACTIVE,
                                 STATUS_THROTTLED, stable_id, to_epoch_ms)
from ..operators import extensions as X
from ..operators import reports as R
from ..operators import state as S
from ..operators.breaches import breaches as _breaches
from ..operators.breaches import kill_commands
from ..operators.gate import gate_asof, gate_snapshot, gated_orders
from ..operators.signals import risk_signals
from ..params import (interval_seconds, AUTO_UNKILL_COOLDOWN_MS, BOOK_PARAMS, DUPLICATE_MEMORY_MS, EVENT_PARAMS,
                      MULTI_WINDOW_SPECS, STRATEGY_PARAMS, SYMBOL_PARAMS,
                      RESEND_STEP_MS, THROTTLE_RATE_PER_SECOND)
from ..plans.world import World
from ..schemas import STATE_SCHEMA
from ..sources import commands as C
from ..sources.orders import (ROUTER_ORDER_FIELDS, book_orders, decode_orders, event_orders,
                              split_valid_orders, to_keyed_json)
from ..sources.tables import Tables
from ..streaming import control as SC
from ..streaming import stateful as SS
from ..streaming.detector import detector_streams, multi_window_stream, start_update_detector
from ..streaming.io import (ORDERS_TOPIC, STATE_TOPIC, compact_dates, expire_dates, feed, file_stream, new_run_dir, period_cuts,
                            read_dated, split_topics, state_store, stored, without_empty_batches)

QueryFn = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Oracle-friendly output: timestamps as wall-clock UTC (NTZ), string
    arrays as comma-joined text. Names and values are unchanged otherwise."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            cols.append(F.concat_ws(",", F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# -- shared derivations ------------------------------------------------------

def ev_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_orders(Tables(spark, sf_dir).events)


def bk_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return book_orders(t.lineitem, t.orders, t.part)


def ev_signals(spark, sf_dir):
    return risk_signals(ev_orders(spark, sf_dir), EVENT_PARAMS)


def ev_commands(spark, sf_dir):
    return kill_commands(ev_signals(spark, sf_dir), EVENT_PARAMS)


# -- registry ----------------------------------------------------------------

_REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = (lambda spark, sf_dir: comparable(fn(spark, sf_dir)), sql)
        return fn
    return deco


@register("event_orders", O.EVENT_ORDERS)
def q_event_orders(spark, sf_dir):
    """SRC-1 / PRJ-1,2: the order stream view over ``events``."""
    return ev_orders(spark, sf_dir)


@register("book_orders", O.BOOK_ORDERS)
def q_book_orders(spark, sf_dir):
    """Order volume view: lineitem ⋈ orders ⋈ part."""
    return bk_orders(spark, sf_dir)


@register("risk_signals", O.EVENT_SIGNALS)
def q_risk_signals(spark, sf_dir):
    """AGG-1..8: windowed per-account signals."""
    return ev_signals(spark, sf_dir)


@register("kill_commands", O.EVENT_COMMANDS)
def q_kill_commands(spark, sf_dir):
    """PRJ-7..14: breaches -> KILL commands."""
    return ev_commands(spark, sf_dir)


@register("book_risk_signals", O.BOOK_SIGNALS)
def q_book_signals(spark, sf_dir):
    return risk_signals(bk_orders(spark, sf_dir), BOOK_PARAMS)


@register("book_kill_commands", O.BOOK_COMMANDS)
def q_book_commands(spark, sf_dir):
    return kill_commands(risk_signals(bk_orders(spark, sf_dir), BOOK_PARAMS), BOOK_PARAMS)


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _REGISTRY.items() if v[1] is not None}


# -- control plane -----------------------------------------------------------



@register("command_log", O.COMMAND_LOG)
def q_command_log(spark, sf_dir):
    """SRC-3: detector KILLs + operator commands + console commands."""
    return World(spark, sf_dir).commands()


@register("operator_commands", O.CONSOLE_COMMANDS)
def q_operator_commands(spark, sf_dir):
    """PRJ-17/18: validated console requests -> commands with defaults."""
    return C.operator_commands(World(spark, sf_dir).requests())


@register("operator_rejects", O.CONSOLE_REJECTS)
def q_operator_rejects(spark, sf_dir):
    """PRJ-17: missing / malformed scope (400) and unknown path (404)."""
    return C.rejected_requests(World(spark, sf_dir).requests())


@register("state_history", O.STATE_RECORDS)
def q_state_history(spark, sf_dir):
    """PRJ-15/16: one state record per known command, defaults applied."""
    return World(spark, sf_dir).states()


@register("state_snapshot", O.SNAPSHOT)
def q_state_snapshot(spark, sf_dir):
    """WIN-1 / KEY-4 (all scopes): latest state per scope."""
    return World(spark, sf_dir).snapshot()


@register("compacted_state_log", f"SELECT scope AS key, status, updated_ts, last_cmd_id FROM ({O.SNAPSHOT})")
def q_compacted(spark, sf_dir):
    """WIN-2: compaction of the keyed state changelog (JSON values)."""
    st = World(spark, sf_dir).states()
    log = st.select(F.col("scope").alias("key"), "updated_ts", "last_cmd_id",
                    F.to_json(F.struct(*st.columns)).alias("value"))
    comp = S.compact(log, "key", ["updated_ts", "last_cmd_id"], "value")
    v = F.from_json("value", "status string, updated_ts bigint, last_cmd_id string")
    return comp.select("key", v.alias("v")).select("key", "v.status", "v.updated_ts", "v.last_cmd_id")


@register("status_changes", O.STATUS_CHANGES)
def q_status_changes(spark, sf_dir):
    """WIN-3: status transitions per scope."""
    return S.status_changes(World(spark, sf_dir).states())


@register("kill_intervals", O.KILL_INTERVALS)
def q_kill_intervals(spark, sf_dir):
    """WIN-4: KILLED periods with duration."""
    return S.kill_intervals(World(spark, sf_dir).states())


@register("reset_all", f"""
SELECT sha256(concat_ws('|', 'reset', scope, last_cmd_id)) AS cmd_id, updated_ts + 1 AS ts, scope,
       'UNKILL' AS action, 'Dashboard cleanup' AS reason, 'dashboard' AS triggered_by,
       CAST(NULL AS VARCHAR) AS metric, CAST(NULL AS DOUBLE) AS value,
       sha256(concat_ws('|', 'resetcorr', scope, last_cmd_id)) AS corr_id
FROM ({O.SNAPSHOT}) WHERE status = 'KILLED'""")
def q_reset_all(spark, sf_dir):
    """SET-2: UNKILL for every KILLED scope."""
    return S.reset_all_commands(World(spark, sf_dir).snapshot())


_WATCHED_SQL = ", ".join(f"('{s}')" for s in S.WATCHED_SCOPES)
_WATCHED_IN = ", ".join(f"'{s}'" for s in S.WATCHED_SCOPES)


@register("scope_board", f"""
WITH snap AS ({O.SNAPSHOT}),
scopes AS (SELECT scope FROM (VALUES {_WATCHED_SQL}) v(scope) UNION SELECT scope FROM snap)
SELECT s.scope, coalesce(n.status, 'UNKNOWN') AS status, n.reason, n.updated_ts, n.updated_by,
       s.scope IN ({_WATCHED_IN}) AS watched
FROM scopes s LEFT JOIN snap n ON s.scope = n.scope""")
def q_scope_board(spark, sf_dir):
    """JOIN-6 / SET-1 / PRJ-22: watched ∪ known scopes with status."""
    return S.scope_board(World(spark, sf_dir).snapshot())


@register("active_kills", f"""
SELECT count(*) FILTER (WHERE status = 'KILLED') AS active_kills, count(*) AS known_scopes FROM ({O.SNAPSHOT})""")
def q_active_kills(spark, sf_dir):
    """AGG-12."""
    return S.active_kill_count(World(spark, sf_dir).snapshot())


@register("state_cache", f"""
SELECT *, updated_ts // 1000 + {86400 * 7} AS expires_at FROM ({O.SNAPSHOT})
WHERE status <> 'ACTIVE'
   OR updated_ts // 1000 + {86400 * 7} > (SELECT max(updated_ts) FROM ({O.STATE_RECORDS})) // 1000""")
def q_state_cache(spark, sf_dir):
    """SNK-8 / PRJ-19: snapshot with 7-day TTL on ACTIVE rows, as of the log end."""
    w = World(spark, sf_dir)
    now = w.states().agg(F.max("updated_ts")).first()[0]
    return S.state_cache(w.snapshot(), now)


# -- gate ----------------------------------------------------------------------

@register("gate_audit", O.AUDIT)
def q_gate_audit(spark, sf_dir):
    """JOIN-1..5: every order gated against the state as of its time."""
    return World(spark, sf_dir).audit()


@register("gate_snapshot", O.AUDIT_SNAPSHOT)
def q_gate_snapshot(spark, sf_dir):
    """JOIN-1 / SRC-5: orders against the bootstrapped (final) snapshot."""
    w = World(spark, sf_dir)
    return gate_snapshot(w.orders(), w.snapshot())


@register("gated_orders", f"""
SELECT order_id, ts, account_id, symbol, side, qty, price, strategy FROM ({O.AUDIT})
WHERE decision = 'ALLOW'""")
def q_gated_orders(spark, sf_dir):
    """SNK-5: orders forwarded downstream."""
    return gated_orders(World(spark, sf_dir).audit())


@register("book_gate_audit", O.BOOK_AUDIT)
def q_book_gate_audit(spark, sf_dir):
    """Gate at volume: book orders against the same state history."""
    return World(spark, sf_dir).book_audit()


# -- reports -------------------------------------------------------------------



def _bin_sql(width_ms: int) -> str:
    return f"epoch_ms(ts - (((ts % {width_ms}) + {width_ms}) % {width_ms}))"


_REQUIRED_NULL = "order_id IS NULL OR ts IS NULL OR account_id IS NULL OR symbol IS NULL OR qty IS NULL OR price IS NULL"


@register("router_counters", f"""
SELECT (SELECT count(*) FROM ({O.AUDIT})) AS orders_processed,
       (SELECT count(*) FILTER (WHERE decision = 'ALLOW') FROM ({O.AUDIT})) AS orders_allowed,
       (SELECT count(*) FILTER (WHERE decision = 'DROP') FROM ({O.AUDIT})) AS orders_dropped,
       (SELECT count(*) FROM ({O.EVENT_ORDERS}) WHERE {_REQUIRED_NULL}) AS errors,
       (SELECT count(*) FROM ({O.SNAPSHOT})) AS kill_state_scopes""")
def q_router_counters(spark, sf_dir):
    """AGG-9."""
    w = World(spark, sf_dir)
    _, bad = split_valid_orders(w.orders())
    return R.router_counters(w.reported_audit(), bad, w.snapshot())


@register("aggregator_counters", f"""
SELECT count(*) FILTER (WHERE NOT (cmd_id IS NULL OR scope IS NULL OR action IS NULL)) AS commands_processed,
       count(*) FILTER (WHERE cmd_id IS NULL OR scope IS NULL OR action IS NULL) AS errors,
       count(*) FILTER (WHERE NOT (cmd_id IS NULL OR scope IS NULL OR action IS NULL)
                AND action NOT IN ('KILL', 'UNKILL')) AS ignored_actions
FROM ({O.COMMAND_LOG})""")
def q_aggregator_counters(spark, sf_dir):
    """AGG-10."""
    return R.aggregator_counters(World(spark, sf_dir).commands())


@register("dashboard_totals", f"""
SELECT count(DISTINCT order_id) AS total_orders, count(*) FILTER (WHERE decision = 'ALLOW') AS allowed,
       count(*) FILTER (WHERE decision = 'DROP') AS dropped FROM ({O.AUDIT})""")
def q_dashboard_totals(spark, sf_dir):
    """AGG-11."""
    return R.dashboard_totals(World(spark, sf_dir).reported_audit())


@register("drops_by_reason", f"""
SELECT reason, count(*) AS drops FROM ({O.AUDIT}) WHERE decision = 'DROP' GROUP BY reason""")
def q_drops_by_reason(spark, sf_dir):
    """AGG-13."""
    return R.drops_by_reason(World(spark, sf_dir).reported_audit())


@register("commands_by_scope_action", f"""
SELECT scope, action, count(*) AS commands FROM ({O.COMMAND_LOG}) GROUP BY scope, action""")
def q_commands_by_scope_action(spark, sf_dir):
    """AGG-14."""
    return R.commands_by_scope_action(World(spark, sf_dir).commands())


@register("orders_per_5min", f"""
SELECT {_bin_sql(300000)} AS bin_start, count(*) AS orders FROM ({O.AUDIT}) GROUP BY 1""")
def q_orders_per_bin(spark, sf_dir):
    """AGG-15."""
    return R.orders_per_bin(World(spark, sf_dir).reported_audit(), "5 minutes")


@register("decisions_per_minute", f"""
SELECT decision, {_bin_sql(60000)} AS bin_start, count(*) AS orders FROM ({O.AUDIT}) GROUP BY 1, 2""")
def q_decisions_per_minute(spark, sf_dir):
    """AGG-16."""
    return R.decisions_per_bin(World(spark, sf_dir).reported_audit(), "1 minute")


@register("drop_age_stats", f"""
SELECT {_bin_sql(300000)} AS bin_start, avg(CAST(ts - kill_ts AS DOUBLE)) AS avg_ms,
       max(CAST(ts - kill_ts AS DOUBLE)) AS max_ms,
       quantile_disc(CAST(ts - kill_ts AS DOUBLE), 0.99) AS p99_ms, count(*) AS drops
FROM ({O.AUDIT}) WHERE decision = 'DROP' GROUP BY 1""")
def q_drop_age_stats(spark, sf_dir):
    """AGG-17."""
    return R.drop_age_stats(World(spark, sf_dir).reported_audit(), "5 minutes")


@register("record_counts", f"""
SELECT 'audit' AS "table", count(*) AS records FROM ({O.AUDIT})
UNION ALL SELECT 'state_history', count(*) FROM ({O.STATE_RECORDS})
UNION ALL SELECT 'state_snapshot', count(*) FROM ({O.SNAPSHOT})
UNION ALL SELECT 'commands', count(*) FROM ({O.COMMAND_LOG})""")
def q_record_counts(spark, sf_dir):
    """AGG-18."""
    w = World(spark, sf_dir)
    return R.record_counts(w.reported_audit(), w.states(), w.snapshot(), w.commands())


@register("recent_audit", f"""
SELECT * FROM ({O.AUDIT}) ORDER BY ts DESC, order_id DESC LIMIT 50""")
def q_recent_audit(spark, sf_dir):
    """TOP-1: newest 50 decisions."""
    return R.recent_audit(World(spark, sf_dir).reported_audit(), 50)


@register("audit_feed", f"""
WITH l AS (SELECT * FROM (
  SELECT order_id, ts, account_id, symbol, side, qty, decision, reason,
         row_number() OVER (PARTITION BY order_id ORDER BY ts DESC) AS rn FROM ({O.AUDIT})) WHERE rn = 1)
SELECT CASE WHEN ts > 1000000000000 THEN ts ELSE ts * 1000 END AS ts_ms,
       coalesce(substr(order_id, 1, 8), '-') AS order_short, order_id,
       coalesce(account_id, '-') AS account_id, coalesce(symbol, '-') AS symbol,
       coalesce(side, '-') AS side, coalesce(CAST(qty AS VARCHAR), '-') AS qty, decision, reason
FROM l ORDER BY ts DESC, order_id DESC LIMIT 200""")
def q_audit_feed(spark, sf_dir):
    """TOP-2 / PRJ-20,21: feed without repeated orders, newest 200."""
    return R.audit_feed(World(spark, sf_dir).reported_audit(), 200)


@register("recent_drops", f"""
SELECT * FROM ({O.AUDIT}) WHERE decision = 'DROP' ORDER BY ts DESC, order_id DESC LIMIT 20""")
def q_recent_drops(spark, sf_dir):
    """TOP-3: newest 20 drops."""
    return R.recent_drops(World(spark, sf_dir).reported_audit(), 20)


@register("audit_for_order", f"SELECT * FROM ({O.AUDIT}) WHERE order_id = '4242'")
def q_audit_for_order(spark, sf_dir):
    """KEY-1: point lookup of one order's audit rows."""
    return R.audit_for_order(World(spark, sf_dir).audit_of(order_id="4242"), "4242")


@register("audit_for_account", f"SELECT * FROM ({O.AUDIT}) WHERE account_id = '42'")
def q_audit_for_account(spark, sf_dir):
    """KEY-2: one account's audit rows, time-ordered."""
    return R.audit_for_account(World(spark, sf_dir).audit_of(account_id="42"), "42")


@register("dropped_orders", f"""
SELECT * FROM ({O.AUDIT}) WHERE decision = 'DROP' ORDER BY ts, order_id LIMIT 100""")
def q_dropped_orders(spark, sf_dir):
    """KEY-3: dropped orders, first 100."""
    return R.dropped_orders(World(spark, sf_dir).reported_audit(), 100)


@register("state_for_scope", f"SELECT * FROM ({O.SNAPSHOT}) WHERE scope = 'GLOBAL'")
def q_state_for_scope(spark, sf_dir):
    """KEY-4: one scope's state."""
    return R.state_for_scope(World(spark, sf_dir).snapshot(), "GLOBAL")


@register("drop_log_reasons", f"""
SELECT reason, count(*) AS drops FROM ({O.AUDIT}) WHERE decision = 'DROP' GROUP BY reason""")
def q_drop_log_reasons(spark, sf_dir):
    """PRJ-23: render router log lines, filter and parse them, count by reason."""
    return R.parse_drop_lines(R.router_log_lines(World(spark, sf_dir).reported_audit()))


@register("correlation_trace", f"""
WITH d AS (SELECT kill_cmd_id AS cmd_id, count(*) AS orders_dropped, min(ts) AS first_drop_ts,
                  max(ts) AS last_drop_ts FROM ({O.AUDIT}) WHERE decision = 'DROP' GROUP BY 1),
s AS (SELECT last_cmd_id AS cmd_id, status AS state_status, corr_id AS state_corr_id FROM ({O.SNAPSHOT}))
SELECT c.cmd_id, c.ts, c.scope, c.action, c.corr_id, s.state_status, s.state_corr_id,
       coalesce(d.orders_dropped, 0) AS orders_dropped, d.first_drop_ts, d.last_drop_ts
FROM ({O.COMMAND_LOG}) c LEFT JOIN s ON c.cmd_id = s.cmd_id LEFT JOIN d ON c.cmd_id = d.cmd_id""")
def q_correlation_trace(spark, sf_dir):
    """JOIN-7: command -> state -> dropped orders."""
    w = World(spark, sf_dir)
    return R.correlation_trace(w.commands(), w.snapshot(), w.reported_audit())


_ACTIVATIONS_SQL = f"""
WITH k AS ({O.KILL_INTERVALS}),
d AS (SELECT k.kill_cmd_id, count(*) AS orders_dropped
      FROM ({O.AUDIT}) a JOIN k ON a.kill_scope = k.scope AND a.ts >= k.kill_ts
           AND (k.unkill_ts IS NULL OR a.ts < k.unkill_ts)
      WHERE a.decision = 'DROP' GROUP BY 1)
SELECT k.scope, k.kill_ts, k.unkill_ts, k.duration_ms, k.reason, k.kill_cmd_id,
       coalesce(d.orders_dropped, 0) AS orders_dropped
FROM k LEFT JOIN d ON k.kill_cmd_id = d.kill_cmd_id"""


def _activations(spark, sf_dir):
    w = World(spark, sf_dir)
    return R.drops_by_activation(w.reported_audit(), S.kill_intervals(w.states()))


@register("drops_by_activation", _ACTIVATIONS_SQL)
def q_drops_by_activation(spark, sf_dir):
    """JOIN-8: which orders each kill activation dropped."""
    return _activations(spark, sf_dir)


@register("daily_kill_report", f"""
SELECT CAST(epoch_ms(kill_ts) AS DATE) AS day, scope, reason, count(*) AS activations,
       CAST(sum(orders_dropped) AS BIGINT) AS orders_dropped, CAST(sum(duration_ms) AS BIGINT) AS killed_ms
FROM ({_ACTIVATIONS_SQL}) GROUP BY 1, 2, 3""")
def q_daily_kill_report(spark, sf_dir):
    """EXT-7: activations, drops and killed time by day, scope and reason."""
    return R.daily_kill_report(_activations(spark, sf_dir))


# -- extensions ------------------------------------------------------------------

_SYM_SIGNALS = O.signals_sql(O.EVENT_ORDERS, SYMBOL_PARAMS, ("symbol",), "account_id", "account")
_STRAT_SIGNALS = O.signals_sql(O.EVENT_ORDERS, STRATEGY_PARAMS, ("strategy",), "symbol", "symbol")
_STRAT_COMMANDS = O.commands_sql(_STRAT_SIGNALS, STRATEGY_PARAMS, "'STRATEGY:' || strategy")


@register("symbol_signals", _SYM_SIGNALS)
def q_symbol_signals(spark, sf_dir):
    """EXT-1: per (window, symbol) flow; concentration over accounts."""
    return X.symbol_signals(ev_orders(spark, sf_dir), SYMBOL_PARAMS)


@register("symbol_kill_commands", O.commands_sql(_SYM_SIGNALS, SYMBOL_PARAMS, "'SYMBOL:' || symbol", "account"))
def q_symbol_kill_commands(spark, sf_dir):
    """EXT-1: symbol-level breaches -> SYMBOL:<s> kills."""
    return X.symbol_kill_commands(ev_orders(spark, sf_dir), SYMBOL_PARAMS)


@register("strategy_kill_commands", _STRAT_COMMANDS)
def q_strategy_kill_commands(spark, sf_dir):
    """EXT-6: strategy-level breaches -> STRATEGY:<name> kills."""
    return X.strategy_kill_commands(ev_orders(spark, sf_dir), STRATEGY_PARAMS)


_STRAT_STATES = f"""
SELECT * FROM ({O.STATE_RECORDS})
UNION ALL SELECT * FROM ({O.state_records_sql(
    f"SELECT cmd_id, ts, scope, action, reason, triggered_by, metric, value, corr_id FROM ({_STRAT_COMMANDS})")})"""


@register("strategy_gate_audit", O.gate_sql(O.EVENT_ORDERS, O.intervals_sql(_STRAT_STATES), strategy=True))
def q_strategy_gate_audit(spark, sf_dir):
    """EXT-6: gate with a fourth level STRATEGY:<name>."""
    w = World(spark, sf_dir)
    strat = S.state_records(X.strategy_kill_commands(w.orders(), STRATEGY_PARAMS))
    states = w.states().unionByName(strat)
    return gate_asof(w.orders(), states, include_strategy=True)


def _multi_sql() -> str:
    parts = []
    for i, p in enumerate(MULTI_WINDOW_SPECS):
        wl = p.window_label
        sig = O.signals_sql(O.EVENT_ORDERS, p)
        parts.append(f"""
SELECT *, {i} AS spec, '{wl}' AS wl,
       order_count > {p.max_orders} AS r,
       coalesce(total_notional > {float(p.max_notional)}, false) AS nb,
       (top_symbol_share > {float(p.max_share)}) AND (order_count >= {p.min_orders}) AS cb
FROM ({sig})""")
    union = " UNION ALL ".join(parts)
    return f"""
WITH b AS (SELECT *, 'ACCOUNT:' || account_id AS scope,
                  CASE WHEN r THEN 'order_rate_' || wl WHEN nb THEN 'notional_' || wl
                       ELSE 'symbol_concentration_' || wl END AS metric
           FROM ({union}) WHERE r OR nb OR cb)
SELECT sha256(concat_ws('|', 'KILL', scope, CAST(epoch_ms(window_start) AS VARCHAR), metric)) AS cmd_id,
       ts, scope, 'KILL' AS action,
       CASE WHEN r THEN 'Order rate breach: ' || CAST(order_count AS VARCHAR) || ' orders in ' || wl
            WHEN nb THEN 'Notional breach: $' || printf('%.2f', total_notional) || ' in ' || wl
            ELSE 'Symbol concentration breach: ' || {O.percent_sql('top_count', 'symbol_orders')}
                 || '% in ' || top_symbol END AS reason,
       'spark' AS triggered_by, metric,
       CASE WHEN r THEN CAST(order_count AS DOUBLE) WHEN nb THEN total_notional
            ELSE top_symbol_share END AS value,
       sha256(concat_ws('|', 'corr', scope, CAST(epoch_ms(window_start) AS VARCHAR), wl)) AS corr_id,
       wl AS window_label
FROM b"""


@register("multi_window_commands", _multi_sql())
def q_multi_window_commands(spark, sf_dir):
    """EXT-4: 1h / 6h / 1d windows with their own thresholds in one pass."""
    return X.multi_window_commands(ev_orders(spark, sf_dir), MULTI_WINDOW_SPECS)


@register("throttle_decisions", f"""
WITH o AS ({O.BOOK_ORDERS}),
pol AS (SELECT DISTINCT scope, {THROTTLE_RATE_PER_SECOND} AS max_rate_per_second FROM ({O.BOOK_COMMANDS})),
j AS (SELECT o.*, pol.max_rate_per_second,
             row_number() OVER (PARTITION BY o.account_id, o.ts // 1000 ORDER BY o.ts, o.order_id) AS rn
      FROM o LEFT JOIN pol ON pol.scope = 'ACCOUNT:' || o.account_id)
SELECT order_id, ts, account_id, symbol, max_rate_per_second,
       CASE WHEN max_rate_per_second IS NULL OR rn <= max_rate_per_second THEN 'ALLOW'
            ELSE 'THROTTLED' END AS decision
FROM j""")
def q_throttle(spark, sf_dir):
    """EXT-2: THROTTLED accounts (the book detector's kills) pass at most n orders a second."""
    w = World(spark, sf_dir)
    book = w.book_orders()
    policy = (kill_commands(risk_signals(book, BOOK_PARAMS), BOOK_PARAMS)
              .select("scope").distinct()
              .withColumn("max_rate_per_second", F.lit(THROTTLE_RATE_PER_SECOND)))
    return X.throttle_decisions(book, policy)


_THROTTLED_SQL = f"""
WITH o AS ({O.BOOK_ORDERS}),
j AS (SELECT o.*, row_number() OVER (PARTITION BY o.account_id, o.ts // 1000 ORDER BY o.ts, o.order_id) AS rn
      FROM o WHERE 'ACCOUNT:' || o.account_id IN (SELECT scope FROM ({O.BOOK_COMMANDS})))
SELECT ts, 'THROTTLED' AS decision, order_id, account_id, symbol, 'ACCOUNT:' || account_id AS scope_matches,
       'THROTTLED' AS killswitch_status, 'Rate limit exceeded' AS reason, sha256(concat_ws('|', 'audit', order_id)) AS corr_id,
       'order_router' AS service
FROM j WHERE rn > {THROTTLE_RATE_PER_SECOND}"""


@register("throttle_audit", _THROTTLED_SQL)
def q_throttle_audit(spark, sf_dir):
    """EXT-2: THROTTLE commands -> THROTTLED scopes with their rate -> audit rows."""
    w = World(spark, sf_dir)
    kills = kill_commands(risk_signals(w.book_orders(), BOOK_PARAMS), BOOK_PARAMS)
    commands = (kills.withColumn("action", F.lit(ACTION_THROTTLE))
                .withColumn("value", F.lit(float(THROTTLE_RATE_PER_SECOND))))
    decided = X.throttle_decisions(w.book_orders(), X.throttle_policy(commands))
    return X.decision_audit(decided, DECISION_THROTTLED, X.REASON_THROTTLED, STATUS_THROTTLED)


_DUPLICATES_SQL = f"""
WITH RECURSIVE b AS (
  SELECT order_id, split_part(order_id, '-', 1) AS client_order_id, account_id,
         ts + (CAST(split_part(order_id, '-', 2) AS BIGINT) - 1) * {RESEND_STEP_MS} AS ts
  FROM ({O.BOOK_ORDERS})),
t AS (SELECT DISTINCT client_order_id, ts FROM b),
op AS (
  SELECT client_order_id, min(ts) AS ts FROM t GROUP BY client_order_id
  UNION ALL
  SELECT op.client_order_id, min(t.ts) AS ts FROM op JOIN t ON t.client_order_id = op.client_order_id
     AND t.ts >= op.ts + {DUPLICATE_MEMORY_MS} GROUP BY op.client_order_id, op.ts),
r AS (SELECT b.*, op.ts AS seen, row_number() OVER (PARTITION BY b.client_order_id, b.ts ORDER BY b.order_id) AS k
      FROM b ASOF JOIN op ON b.client_order_id = op.client_order_id AND b.ts >= op.ts)
SELECT order_id, client_order_id, ts, account_id,
       CASE WHEN NOT (seen = ts AND k = 1) THEN seen END AS prev_seen_ts,
       CASE WHEN seen = ts AND k = 1 THEN 'NEW' ELSE 'DUPLICATE' END AS decision
FROM r"""


@register("duplicate_orders", _DUPLICATES_SQL)
def q_duplicates(spark, sf_dir):
    """EXT-3: client order ids repeated within an hour of the first -> DUPLICATE.
    The lines of a book order are taken as repeats of it, 25 minutes apart."""
    return X.duplicate_decisions(resent_orders(spark, sf_dir), "client_order_id", DUPLICATE_MEMORY_MS)


def resent_orders(spark, sf_dir) -> DataFrame:
    part = F.split("order_id", "-")
    return (bk_orders(spark, sf_dir).withColumn("client_order_id", part.getItem(0))
            .withColumn("ts", F.col("ts") + (part.getItem(1).cast("bigint") - 1) * RESEND_STEP_MS))


@register("duplicate_audit", f"""
SELECT ts, decision, order_id, account_id, b.symbol, 'ACCOUNT:' || account_id AS scope_matches, 'ACTIVE' AS killswitch_status,
       'Duplicate order id' AS reason, sha256(concat_ws('|', 'audit', order_id)) AS corr_id, 'order_router' AS service
FROM ({_DUPLICATES_SQL}) d JOIN (SELECT DISTINCT order_id, symbol FROM ({O.BOOK_ORDERS})) b USING (order_id) WHERE decision = 'DUPLICATE'""")
def q_duplicate_audit(spark, sf_dir):
    """EXT-3: the audit records of duplicates."""
    orders = resent_orders(spark, sf_dir)
    return X.decision_audit(X.duplicate_decisions(orders, "client_order_id", DUPLICATE_MEMORY_MS, keep=("symbol",)),
                            DECISION_DUPLICATE, X.REASON_DUPLICATE, STATUS_ACTIVE)


# Every 7th record of the log is cut short and every 11th has no account.
_BROKEN = "event_id % 7 = 3"
_NO_ACCOUNT = "event_id % 11 = 5"


@register("router_json_log", f"""
WITH o AS (SELECT *, CAST(order_id AS BIGINT) AS event_id FROM ({O.EVENT_ORDERS})),
a AS (SELECT decision, order_id FROM ({O.gate_sql(O.EVENT_ORDERS, O.SNAPSHOT, asof=False)}))
SELECT CASE WHEN {_BROKEN} OR {_NO_ACCOUNT} THEN 'REJECT' ELSE a.decision END AS outcome,
       CASE WHEN {_BROKEN} THEN 'order_id,account_id,symbol' WHEN {_NO_ACCOUNT} THEN 'account_id' END AS missing_fields,
       count(*) AS orders
FROM o JOIN a USING (order_id) GROUP BY ALL""")
def q_router_json_log(spark, sf_dir):
    """SRC-1 / PRJ-3,4 / SNK-3 / AGG-9: orders written as keyed JSON, some lines
    broken, decoded by the router's required fields, gated or rejected."""
    w = World(spark, sf_dir)
    event_id = F.col("order_id").cast("bigint")
    log = to_keyed_json(w.orders().withColumn("account_id", F.when(event_id % 11 != 5, F.col("account_id"))),
                        "order_id")
    cut = F.when(F.col("key").cast("bigint") % 7 == 3, F.substring("value", 1, 9)).otherwise(F.col("value"))
    good, bad = decode_orders(log.select(cut.alias("value")), required=ROUTER_ORDER_FIELDS)
    outcomes = (gate_snapshot(good, w.snapshot())
                .select(F.col("decision").alias("outcome"), F.lit(None).cast("string").alias("missing_fields"))
                .unionByName(bad.select(F.lit("REJECT").alias("outcome"), "missing_fields")))
    return outcomes.groupBy("outcome", "missing_fields").agg(F.count(F.lit(1)).alias("orders"))


_AUTO_UNKILL_SQL = f"""
WITH bw AS (SELECT substr(scope, 9) AS account_id, ts - {EVENT_PARAMS.window_ms} AS w_start, ts AS w_end
            FROM ({O.EVENT_COMMANDS})),
nx AS (SELECT *, lead(w_start) OVER (PARTITION BY account_id ORDER BY w_start) AS nxs FROM bw),
mk AS (SELECT *, CASE WHEN nxs IS NULL OR nxs - w_end >= {AUTO_UNKILL_COOLDOWN_MS} THEN w_end END AS end_mark
       FROM nx),
ep AS (SELECT 'ACCOUNT:' || account_id AS scope, w_end AS kill_ts,
              min(end_mark) OVER (PARTITION BY account_id ORDER BY w_start
                                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS episode_end
       FROM mk),
j AS (SELECT k.*, ep.episode_end FROM ({O.KILL_INTERVALS}) k JOIN ep ON k.scope = ep.scope AND k.kill_ts = ep.kill_ts
      WHERE k.updated_by = 'spark')
SELECT sha256(concat_ws('|', 'auto', kill_cmd_id)) AS cmd_id, episode_end + {AUTO_UNKILL_COOLDOWN_MS} AS ts,
       scope, 'UNKILL' AS action, 'Auto unkill after cooldown' AS reason, 'spark' AS triggered_by,
       CAST(NULL AS VARCHAR) AS metric, CAST(NULL AS DOUBLE) AS value,
       sha256(concat_ws('|', 'autocorr', kill_cmd_id)) AS corr_id
FROM j WHERE unkill_ts IS NULL OR unkill_ts >= episode_end + {AUTO_UNKILL_COOLDOWN_MS}"""


@register("auto_unkill_commands", _AUTO_UNKILL_SQL)
def q_auto_unkill(spark, sf_dir):
    """EXT-5: release detector kills after a calm cooldown unless an operator acted."""
    w = World(spark, sf_dir)
    b = _breaches(w.signals(), EVENT_PARAMS)
    return X.auto_unkill_commands(b, S.kill_intervals(w.states()), AUTO_UNKILL_COOLDOWN_MS)


# Operators hold some accounts (no automatic release) and let go of others.
_HOLDS = f"""
SELECT sha256(concat_ws('|', 'hold', CAST(event_id AS VARCHAR))) AS cmd_id, epoch_us(ts) // 1000 AS ts,
       'ACCOUNT:' || CAST(user_id AS VARCHAR) AS scope, CASE WHEN k >= 60 THEN 'HOLD' ELSE 'UNHOLD' END AS action,
       'ops-console' AS triggered_by
FROM ({O.EVENTS_K}) WHERE event_type = 'purchase' AND (k >= 60 OR k < 10)"""


def holds(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    return events.filter((F.col("event_type") == "purchase") & ((k >= 60) | (k < 10))).select(
        stable_id(F.lit("hold"), "event_id").alias("cmd_id"), to_epoch_ms("ts").alias("ts"),
        F.concat(F.lit("ACCOUNT:"), F.col("user_id").cast("string")).alias("scope"),
        F.when(k >= 60, F.lit(SS.ACTION_HOLD)).otherwise(F.lit(SS.ACTION_UNHOLD)).alias("action"), F.lit("ops-console").alias("triggered_by"))


@register("auto_unkill_held", f"""
SELECT * FROM ({_AUTO_UNKILL_SQL}) WHERE scope NOT IN (
  SELECT scope FROM (SELECT scope, max_by(action, ts) AS action FROM ({_HOLDS}) GROUP BY scope) WHERE action = 'HOLD')""")
def q_auto_unkill_held(spark, sf_dir):
    """EXT-5: scopes that an operator holds are not released."""
    w = World(spark, sf_dir)
    held = holds(w.t.events).groupBy("scope").agg(F.max_by("action", "ts").alias("action")).filter(F.col("action") == SS.ACTION_HOLD)
    return X.auto_unkill_commands(_breaches(w.signals(), EVENT_PARAMS), S.kill_intervals(w.states()), AUTO_UNKILL_COOLDOWN_MS, held=held)


# -- streaming drivers (file source, availableNow) ---------------------------------




#: The supplied events reach the streaming drivers in so many turns, periods of equal length: state is
#: carried over batches and changes between them.
TURNS = 4


def _turns(spark, sf_dir, run: str, start: Callable[[DataFrame], object]) -> None:
    """Replays the events; in every turn ``start`` gets the stream of all there is so far and
    starts its queries (one, or several that run one after another)."""
    _replay_stored(Tables(spark, sf_dir).events, to_epoch_ms("ts"), run, start)


def _replay(table: DataFrame, ts: Column, run: str, start: Callable[[DataFrame], object]) -> None:
    """Replays a table that a plan derives: it is worked out and written once, and each turn
    reads its period of what was written."""
    with stored(table, f"{run}/table") as rows:
        _replay_stored(rows, ts, run, start)


def _replay_stored(table: DataFrame, ts: Column, run: str, start: Callable[[DataFrame], object]) -> None:
    def turn() -> None:
        for q in start(file_stream(table.sparkSession, f"{run}/in", table.schema)):
            q().awaitTermination()

    feed(table, ts, period_cuts(table, ts, TURNS), f"{run}/in", turn)


def _to_files(df: DataFrame, run: str, mode: str = "append"):
    return lambda: (df.writeStream.format("parquet").outputMode(mode).option("path", f"{run}/out")
                    .option("checkpointLocation", f"{run}/ck").trigger(availableNow=True).start())


def _stateful_to_files(df: DataFrame, run: str):
    def start() -> object:
        with state_store(df.sparkSession):
            return _to_files(df, run)()
    return start


def _cut_sql(k: int) -> str:
    return f"(SELECT min(t) + (max(t) - min(t)) * {k} // {TURNS} FROM (SELECT epoch_us(ts) // 1000 AS t FROM events))"


def _until(sql: str, column: str, hi: str | None, lo: str | None = None) -> str:
    """Rows of a period; those without a time are in the first."""
    conds = [f"({column} < {hi}{'' if lo else f' OR {column} IS NULL'})" if hi else "true", f"{column} >= {lo}" if lo else "true"]
    return f"SELECT * FROM ({sql}) WHERE {' AND '.join(conds)}"


_EDGES = [None, *[_cut_sql(k) for k in range(1, TURNS)], None]


_CLOSED = (f"epoch_ms(window_end) <= (SELECT max(epoch_us(ts) // 1000) FROM events) "
           f"- {EVENT_PARAMS.window_ms}")


@register("stream_risk_signals", f"SELECT * FROM ({O.EVENT_SIGNALS}) WHERE {_CLOSED}")
def q_stream_signals(spark, sf_dir):
    """SRC-1 / STR-1..3 / SNK-1: streaming signals, append mode with watermark."""
    run = new_run_dir(spark, "stream-signals")
    _turns(spark, sf_dir, run, lambda ev: [_to_files(detector_streams(event_orders(ev), EVENT_PARAMS)[0], run)])
    return spark.read.parquet(f"{run}/out")


@register("stream_kill_commands", f"""
SELECT * FROM ({O.EVENT_COMMANDS}) WHERE ts <= (SELECT max(epoch_us(ts) // 1000) FROM events) - {EVENT_PARAMS.window_ms}""")
def q_stream_commands(spark, sf_dir):
    """SNK-2 / STR-4: streaming kill commands (one per closed breached window)."""
    run = new_run_dir(spark, "stream-commands")
    _turns(spark, sf_dir, run, lambda ev: [_to_files(detector_streams(event_orders(ev), EVENT_PARAMS)[1], run)])
    return spark.read.parquet(f"{run}/out")


_OP_SNAPSHOT = f"""
SELECT scope, status, updated_ts, updated_by, reason, last_cmd_id, corr_id FROM (
  SELECT *, row_number() OVER (PARTITION BY scope ORDER BY updated_ts DESC, last_cmd_id DESC) AS rn
  FROM ({O.state_records_sql(O.OPERATOR_EVENT_COMMANDS)})) WHERE rn = 1"""


def _stream_state(spark, sf_dir) -> str:
    run = new_run_dir(spark, "stream-state")
    _turns(spark, sf_dir, run, lambda ev: [_aggregator(C.event_commands(ev), run)])
    return run


def _aggregator(commands: DataFrame, run: str):
    return lambda: SC.start_aggregator(commands, f"{run}/state", f"{run}/ck-agg", {"availableNow": True},
                                       {"format": "json", "path": f"{run}/state-log"})


@register("stream_state_snapshot", _OP_SNAPSHOT)
def q_stream_state(spark, sf_dir):
    """SRC-3 / WIN-1 / SNK-8 / STR-5,6: foreachBatch state aggregator."""
    run = _stream_state(spark, sf_dir)
    return SC.latest_snapshot(spark, f"{run}/state")


@register("stream_state_log", _OP_SNAPSHOT)
def q_stream_state_log(spark, sf_dir):
    """SRC-5 / SNK-8 / WIN-2: state rebuilt from the published state records."""
    run = _stream_state(spark, sf_dir)
    return SC.snapshot_from_log(spark, f"{run}/state-log")


def _turns_sql() -> str:
    """Orders of each period against the state at the period's end."""
    parts = []
    for lo, hi in zip(_EDGES[:-1], _EDGES[1:]):
        commands = _until(O.OPERATOR_EVENT_COMMANDS, "ts", hi)
        snapshot = f"""SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY scope ORDER BY updated_ts DESC, last_cmd_id DESC) AS rn
          FROM ({O.state_records_sql(commands)})) WHERE rn = 1"""
        parts.append(f"({O.gate_sql(_until(O.EVENT_ORDERS, 'ts', hi, lo), snapshot, asof=False)})")
    return " UNION ALL ".join(parts)


def _stream_routed(spark, sf_dir) -> str:
    """Aggregator and router take turns, a period each: the state that the router
    knows from the published records changes between its batches."""
    run = new_run_dir(spark, "stream-route")
    sinks = {k: {"format": "json", "path": f"{run}/{k}-log"} for k in ("gated", "audit")}
    _turns(spark, sf_dir, run, lambda ev: [_aggregator(C.event_commands(ev), run), lambda: SC.start_router(
        event_orders(ev), f"{run}/state", f"{run}/routed", f"{run}/ck-router", {"availableNow": True}, state_log=f"{run}/state-log", sinks=sinks)])
    return run


@register("stream_router_audit", _turns_sql())
def q_stream_router(spark, sf_dir):
    """SRC-4,5 / SNK-6,7: foreachBatch router fed by the published state, which
    changes between its batches."""
    return SC.read_batches(spark, f"{_stream_routed(spark, sf_dir)}/routed/audit").drop("batch_id")


@register("stream_published_orders", f"""
SELECT account_id AS key, order_id, symbol, qty FROM ({_turns_sql()}) WHERE decision = 'ALLOW'""")
def q_stream_published(spark, sf_dir):
    """SNK-5: allowed orders as the keyed JSON records that the router publishes."""
    log = spark.read.schema("key string, value string").json(f"{_stream_routed(spark, sf_dir)}/gated-log")
    return log.select("key", *[F.get_json_object("value", f"$.{c}").cast(t).alias(c)
                               for c, t in (("order_id", "string"), ("symbol", "string"), ("qty", "int"))])


@register("stream_published_audit", f"""
SELECT order_id AS key, account_id, decision, kill_cmd_id FROM ({_turns_sql()})""")
def q_stream_published_audit(spark, sf_dir):
    """SNK-6: audit records as published, keyed by order."""
    log = spark.read.schema("key string, value string").json(f"{_stream_routed(spark, sf_dir)}/audit-log")
    return log.select("key", *[F.get_json_object("value", f"$.{c}").alias(c) for c in ("account_id", "decision", "kill_cmd_id")])


@register("stream_audit_index", f"""
SELECT CAST(epoch_ms(ts) AS DATE) AS date, decision, count(*) AS orders FROM ({_turns_sql()}) GROUP BY ALL""")
def q_stream_audit_index(spark, sf_dir):
    """SNK-7: the audit index, a folder for each date."""
    index = spark.read.parquet(f"{_stream_routed(spark, sf_dir)}/routed/audit_index")
    return index.groupBy("date", "decision").agg(F.count(F.lit(1)).alias("orders"))




# The index as of ten days after its newest order: dates below the retention are gone.
_INDEX_LAG_DAYS = 10


@register("stream_audit_index_kept", f"""
SELECT CAST(epoch_ms(ts) AS DATE) AS date, decision, count(*) AS orders FROM ({_turns_sql()})
WHERE CAST(epoch_ms(ts) AS DATE) >= (SELECT CAST(max(ts) AS DATE) + {_INDEX_LAG_DAYS - AUDIT_TTL_DAYS} FROM events) GROUP BY ALL""")
def q_stream_index_kept(spark, sf_dir):
    """SNK-7 / PRJ-19: the index after maintenance: closed dates compacted, expired ones gone."""
    path = f"{_stream_routed(spark, sf_dir)}/routed/audit_index"
    newest = spark.read.parquet(path).agg(F.max("date")).first()[0]
    if newest is not None:
        compact_dates(spark, path, newest)
        expire_dates(spark, path, newest + datetime.timedelta(days=_INDEX_LAG_DAYS), AUDIT_TTL_DAYS)
    return read_dated(spark, path).groupBy("date", "decision").agg(F.count(F.lit(1)).alias("orders"))


def _update_run(spark, sf_dir, first_only: bool) -> str:
    run = new_run_dir(spark, "stream-update")
    _turns(spark, sf_dir, run, lambda ev: [lambda: start_update_detector(
        event_orders(ev), EVENT_PARAMS, f"{run}/out", f"{run}/ck", {"availableNow": True}, first_breach_only=first_only)])
    return run


@register("stream_update_signals", O.EVENT_SIGNALS)
def q_stream_update_signals(spark, sf_dir):
    """STR-4 (update mode): signals of every touched window, open ones included;
    of a window that several batches touched, the newest version."""
    run = _update_run(spark, sf_dir, False)
    rows = SC.read_batches(spark, f"{run}/out/signals")
    newest = rows.groupBy("window_start", "account_id").agg(F.max("batch_id").alias("batch_id"))
    return rows.join(newest, ["window_start", "account_id", "batch_id"]).drop("batch_id").select(
        *[c for c in rows.columns if c != "batch_id"])


def _first_breach_sql() -> str:
    """Commands as each period's end sees the windows; the first one of a window."""
    parts = [f"SELECT {k} AS turn, * FROM ({O.commands_sql(O.signals_sql(_until(O.EVENT_ORDERS, 'ts', hi), EVENT_PARAMS), EVENT_PARAMS)})"
             for k, hi in enumerate(_EDGES[1:])]
    return f"""
SELECT * EXCLUDE (turn, k) FROM (
  SELECT *, row_number() OVER (PARTITION BY corr_id ORDER BY turn) AS k FROM ({' UNION ALL '.join(parts)})) WHERE k = 1"""


@register("stream_first_breach_commands", _first_breach_sql())
def q_stream_first_breach(spark, sf_dir):
    """STR-4 ("first breach only"): a window's command is written once."""
    run = _update_run(spark, sf_dir, True)
    return SC.read_batches(spark, f"{run}/out/commands").drop("batch_id")


# -- stateful streams ------------------------------------------------------------

@register("stream_multi_window_commands", f"""
SELECT * FROM ({_multi_sql()}) WHERE ts <= (SELECT max(epoch_us(ts) // 1000) FROM events) - {interval_seconds(MULTI_WINDOW_SPECS[0].watermark) * 1000}""")
def q_stream_multi_window(spark, sf_dir):
    """EXT-4 as a stream: the commands of closed windows of three widths."""
    run = new_run_dir(spark, "stream-windows")
    _turns(spark, sf_dir, run, lambda ev: [_to_files(multi_window_stream(event_orders(ev), MULTI_WINDOW_SPECS), run)])
    return spark.read.parquet(f"{run}/out")


@register("stream_duplicate_orders", _DUPLICATES_SQL)
def q_stream_duplicates(spark, sf_dir):
    """EXT-3 as a stream: the memory is carried over batches and restarts."""
    run = new_run_dir(spark, "stream-duplicates")
    orders = resent_orders(spark, sf_dir).select("order_id", "client_order_id", "ts", "account_id")

    def start(o: DataFrame) -> list:
        with_expiry = _stateful_to_files(SS.duplicate_stream(o, "client_order_id", DUPLICATE_MEMORY_MS), run)

        def run_() -> object:
            with without_empty_batches(spark):
                return with_expiry()
        return [run_]

    _replay(orders, F.col("ts"), run, start)
    return spark.read.parquet(f"{run}/out")


# A THROTTLE for every kill of the book's detector, lifted after a while for some accounts.
THROTTLE_DAYS = 90
_THROTTLE_LOG = f"""
SELECT cmd_id, ts, scope, 'THROTTLE' AS action, {float(THROTTLE_RATE_PER_SECOND)} AS value FROM ({O.BOOK_COMMANDS})
UNION ALL SELECT sha256(concat_ws('|', 'lift', cmd_id)), ts + {THROTTLE_DAYS * 86_400_000}, scope, 'UNKILL', NULL FROM ({O.BOOK_COMMANDS})
WHERE CAST(substr(scope, 9) AS BIGINT) % 3 = 0"""


def throttle_log(spark, sf_dir) -> DataFrame:
    kills = kill_commands(risk_signals(bk_orders(spark, sf_dir), BOOK_PARAMS), BOOK_PARAMS)
    put = F.struct("cmd_id", "ts", "scope", F.lit(ACTION_THROTTLE).alias("action"), F.lit(float(THROTTLE_RATE_PER_SECOND)).alias("value"))
    lift = F.struct(stable_id(F.lit("lift"), "cmd_id").alias("cmd_id"), (F.col("ts") + THROTTLE_DAYS * 86_400_000).alias("ts"), "scope",
                    F.lit(ACTION_UNKILL).alias("action"), F.lit(None).cast("double").alias("value"))
    some = F.substring("scope", 9, 20).cast("bigint") % 3 == 0
    return kills.select(F.inline(F.when(some, F.array(put, lift)).otherwise(F.array(put))))


@register("stream_throttle_decisions", f"""
WITH p AS (SELECT scope, ts, max_by(CASE WHEN action = 'THROTTLE' THEN CAST(value AS INTEGER) END, cmd_id) FILTER (WHERE cmd_id = last) AS rate
           FROM (SELECT *, max(cmd_id) OVER (PARTITION BY scope, ts) AS last FROM ({_THROTTLE_LOG})) GROUP BY scope, ts),
o AS (SELECT o.*, p.rate AS max_rate_per_second FROM (SELECT *, 'ACCOUNT:' || account_id AS scope FROM ({O.BOOK_ORDERS})) o
      ASOF LEFT JOIN p ON p.scope = o.scope AND o.ts >= p.ts)
SELECT order_id, ts, account_id, symbol, max_rate_per_second,
       CASE WHEN max_rate_per_second IS NULL
              OR row_number() OVER (PARTITION BY account_id, ts // 1000 ORDER BY ts, order_id) <= max_rate_per_second
            THEN 'ALLOW' ELSE 'THROTTLED' END AS decision
FROM o""")
def q_stream_throttle(spark, sf_dir):
    """EXT-2 as a stream: orders and THROTTLE / UNKILL commands in one tagged input."""
    run = new_run_dir(spark, "stream-throttle")
    tagged = SS.throttle_input(bk_orders(spark, sf_dir), throttle_log(spark, sf_dir))
    _replay(tagged, F.col("ts"), run, lambda t: [_stateful_to_files(SS.throttle_stream(t), run)])
    return spark.read.parquet(f"{run}/out")


_FOLLOWED = f"""
SELECT cmd_id, ts, scope, action, triggered_by FROM ({O.COMMAND_LOG}) WHERE scope IS NOT NULL AND ts IS NOT NULL
UNION ALL SELECT * FROM ({_HOLDS})"""
# Commands are worked off up to a window before the watermark, an hour behind the newest.
_COOLDOWN_WATERMARK = "1 hour"
_WORKED_OFF = f"((SELECT max(ts) FROM ({_FOLLOWED})) - {interval_seconds(_COOLDOWN_WATERMARK) * 1000 + EVENT_PARAMS.window_ms})"
_RELEASES = f"""
WITH RECURSIVE c AS ({_FOLLOWED}),
bw AS (SELECT scope, ts AS w_end, lead(ts - {EVENT_PARAMS.window_ms}) OVER (PARTITION BY scope ORDER BY ts) AS nxs
       FROM (SELECT DISTINCT scope, ts FROM c WHERE action = 'KILL' AND triggered_by = 'spark')),
ev AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY ts, kind, cmd_id) AS k FROM (
  SELECT scope, ts, 1 AS kind, cmd_id, action, triggered_by FROM c
  UNION ALL SELECT scope, w_end + {AUTO_UNKILL_COOLDOWN_MS}, 0, '', 'RELEASE', NULL FROM bw
  WHERE nxs IS NULL OR nxs - w_end >= {AUTO_UNKILL_COOLDOWN_MS}) WHERE ts <= {_WORKED_OFF}),
m AS (
  SELECT DISTINCT scope, CAST(0 AS BIGINT) AS k, false AS killed, CAST(NULL AS VARCHAR) AS who, CAST(NULL AS VARCHAR) AS cmd, false AS held,
         CAST(NULL AS BIGINT) AS released_at FROM ev
  UNION ALL
  SELECT m.scope, ev.k, CASE ev.action WHEN 'KILL' THEN true WHEN 'UNKILL' THEN false
                             WHEN 'RELEASE' THEN m.killed AND (m.who IS DISTINCT FROM 'spark' OR m.held) ELSE m.killed END,
         CASE WHEN ev.action = 'KILL' AND NOT m.killed THEN ev.triggered_by ELSE m.who END,
         CASE WHEN ev.action = 'KILL' AND NOT m.killed THEN ev.cmd_id ELSE m.cmd END,
         CASE ev.action WHEN 'HOLD' THEN true WHEN 'UNHOLD' THEN false ELSE m.held END,
         CASE WHEN ev.action = 'RELEASE' AND m.killed AND m.who = 'spark' AND NOT m.held THEN ev.ts END
  FROM m JOIN ev ON ev.scope = m.scope AND ev.k = m.k + 1)
SELECT sha256(concat_ws('|', 'auto', cmd)) AS cmd_id, released_at AS ts, scope, 'UNKILL' AS action, 'Auto unkill after cooldown' AS reason,
       'spark' AS triggered_by, CAST(NULL AS VARCHAR) AS metric, CAST(NULL AS DOUBLE) AS value, sha256(concat_ws('|', 'autocorr', cmd)) AS corr_id
FROM m WHERE released_at IS NOT NULL"""


def _release_run(spark, sf_dir) -> str:
    """Command log -> releases -> command log -> state, a period at a time."""
    run = new_run_dir(spark, "stream-release")
    w = World(spark, sf_dir)
    log = w.commands().unionByName(holds(w.t.events), allowMissingColumns=True)

    def start(commands: DataFrame) -> list:
        releases = SS.release_stream(commands, AUTO_UNKILL_COOLDOWN_MS, EVENT_PARAMS.window_ms, _COOLDOWN_WATERMARK)
        return [_stateful_to_files(releases, run), lambda: _aggregator(commands.unionByName(
            file_stream(spark, f"{run}/out", releases.schema)), run)()]

    _replay(log, F.col("ts"), run, start)
    return run


@register("stream_auto_unkill", _RELEASES)
def q_stream_auto_unkill(spark, sf_dir):
    """EXT-5 as a stream: releases after the cooldown, with held scopes and operator overrides."""
    return spark.read.parquet(f"{_release_run(spark, sf_dir)}/out")


@register("stream_released_state", f"""
SELECT scope, status, updated_ts, updated_by, reason, last_cmd_id, corr_id FROM (
  SELECT *, row_number() OVER (PARTITION BY scope ORDER BY updated_ts DESC, last_cmd_id DESC) AS rn
  FROM ({O.state_records_sql(f"SELECT * FROM ({O.COMMAND_LOG}) UNION ALL SELECT * FROM ({_RELEASES})")})) WHERE rn = 1""")
def q_stream_released_state(spark, sf_dir):
    """EXT-5: the releases enter the command log and the state."""
    return SC.latest_snapshot(spark, f"{_release_run(spark, sf_dir)}/state")


@register("stream_interleaved_audit", O.gate_sql(O.EVENT_ORDERS, O.intervals_sql(O.state_records_sql(O.OPERATOR_EVENT_COMMANDS))))
def q_stream_interleaved(spark, sf_dir):
    """SRC-4: orders and state records in one subscription, each order decided by the state
    that came before it."""
    run = new_run_dir(spark, "stream-interleaved")
    events = Tables(spark, sf_dir).events
    states = S.state_records(C.event_commands(events))
    orders = event_orders(events)
    log = (to_keyed_json(orders, "account_id").select(F.lit(ORDERS_TOPIC).alias("topic"), "key", "value", F.get_json_object("value", "$.ts").cast("bigint").alias("at"))
           .unionByName(to_keyed_json(states, "scope").select(F.lit(STATE_TOPIC).alias("topic"), "key", "value",
                                                              F.get_json_object("value", "$.updated_ts").cast("bigint").alias("at"))))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def start(records: DataFrame) -> list:
        parts = split_topics(records, [ORDERS_TOPIC, STATE_TOPIC])
        good, _ = decode_orders(parts[ORDERS_TOPIC], required=ROUTER_ORDER_FIELDS)
        changes = parts[STATE_TOPIC].select(F.from_json("value", STATE_SCHEMA).alias("s")).select("s.*")
        return [_stateful_to_files(SS.interleaved_gate(SS.tagged_records(good, changes, buckets)), run)]

    _replay(log, F.col("at"), run, start)
    return spark.read.parquet(f"{run}/out")
