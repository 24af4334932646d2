"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each statement runs on the supplied parquet tables registered as views. The
fragments mirror the Spark derivations: same mapping of tables to orders and
commands, same deterministic ids (sha-256 of '|'-joined parts), same fixed
number formats.
"""

from __future__ import annotations

from ..params import BOOK_PARAMS, EVENT_PARAMS, REPLAY_SPAN_MS, REPLAY_START_MS, RiskParams

EVENT_ORDERS = """
SELECT CAST(event_id AS VARCHAR) AS order_id,
       epoch_us(ts) // 1000 AS ts,
       CAST(user_id AS VARCHAR) AS account_id,
       upper(event_type) AS symbol,
       CASE WHEN ((TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 2) + 2) % 2 = 0
            THEN 'BUY' ELSE 'SELL' END AS side,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS qty,
       value AS price,
       CASE ((user_id % 4) + 4) % 4 WHEN 0 THEN 'ALGO_X' WHEN 1 THEN 'ALGO_Y'
            WHEN 2 THEN 'MANUAL' ELSE 'SMART_ROUTER' END AS strategy
FROM events
"""

BOOK_ORDERS = """
SELECT concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
                 CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR)) AS order_id,
       epoch_us(o.o_orderdate) // 1000 AS ts,
       CAST(o.o_custkey AS VARCHAR) AS account_id,
       p.p_brand AS symbol,
       CASE WHEN l.l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side,
       CAST(l.l_quantity AS INTEGER) AS qty,
       l.l_extendedprice / l.l_quantity AS price,
       o.o_orderpriority AS strategy
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
"""


def _metrics(orders_cte: str, window_ms: int) -> str:
    return f"""
SELECT *, CAST(qty * price AS DECIMAL(26,8)) AS notional,
       ts - (((ts % {window_ms}) + {window_ms}) % {window_ms}) AS wstart
FROM ({orders_cte})
"""


def signals_sql(orders_cte: str, p: RiskParams, keys: tuple[str, ...] = ("account_id",),
                inner: str = "symbol", label: str = "symbol") -> str:
    """Two-level signal aggregation; ``wstart`` is epoch ms of the window start."""
    w = p.window_ms
    k = ", ".join(keys)
    kj = " AND ".join(f"r.{x} IS NOT DISTINCT FROM t.{x}" for x in keys)
    return f"""
WITH m AS (SELECT *, {inner} AS _inner FROM ({_metrics(orders_cte, w)})),
s AS (SELECT wstart, {k}, _inner, count(*) AS n, count(notional) AS n_priced,
             sum(notional) AS amount
      FROM m WHERE ts IS NOT NULL GROUP BY wstart, {k}, _inner),
r AS (SELECT wstart, {k}, CAST(sum(n) AS BIGINT) AS order_count,
             CAST(sum(n_priced) AS BIGINT) AS priced_count,
             sum(amount) AS amount,
             count(_inner) AS unique_inner, max(_inner) AS max_inner,
             max(CASE WHEN _inner IS NOT NULL THEN n END) AS top_count,
             CAST(coalesce(sum(CASE WHEN _inner IS NOT NULL THEN n END), 0) AS BIGINT) AS inner_orders
      FROM s GROUP BY wstart, {k}),
t AS (SELECT wstart, {k}, _inner AS top_inner FROM (
        SELECT *, row_number() OVER (PARTITION BY wstart, {k} ORDER BY n DESC, _inner DESC) AS rn
        FROM s WHERE _inner IS NOT NULL) WHERE rn = 1)
SELECT {', '.join(f'r.{x} AS {x}' for x in keys)},
       r.order_count,
       CAST(r.amount AS DOUBLE) AS total_notional,
       CASE WHEN r.priced_count > 0
            THEN CAST(r.amount AS DOUBLE) / r.priced_count END AS avg_notional,
       r.unique_inner AS unique_{label}s, r.max_inner AS max_{label},
       CASE WHEN r.top_count IS NOT NULL THEN t.top_inner END AS top_{label},
       CASE WHEN r.inner_orders > 0 THEN CAST(r.top_count AS DOUBLE) / r.inner_orders
            ELSE 0.0 END AS top_{label}_share,
       coalesce(r.top_count, 0) AS top_count, r.inner_orders AS {label}_orders,
       epoch_ms(r.wstart) AS window_start, epoch_ms(r.wstart + {w}) AS window_end,
       r.wstart + {w} AS ts
FROM r LEFT JOIN t ON r.wstart = t.wstart AND {kj}
"""


def percent_sql(num: str, den: str) -> str:
    bp = f"(({num}) * 20000 + ({den})) // (2 * ({den}))"
    return (f"CAST(({bp}) // 100 AS VARCHAR) || '.' || "
            f"lpad(CAST(({bp}) % 100 AS VARCHAR), 2, '0')")


def commands_sql(signals_cte: str, p: RiskParams, scope_expr: str = "'ACCOUNT:' || account_id",
                 label: str = "symbol") -> str:
    wl = f"{p.window_seconds}s"
    return f"""
WITH f AS (
  SELECT *, order_count > {p.max_orders} AS order_rate_breach,
         coalesce(total_notional > {float(p.max_notional)}, false) AS notional_breach,
         (top_{label}_share > {float(p.max_share)}) AND (order_count >= {p.min_orders}) AS concentration_breach,
         {scope_expr} AS scope
  FROM ({signals_cte})),
b AS (
  SELECT *, CASE WHEN order_rate_breach THEN 'order_rate_{wl}'
                 WHEN notional_breach THEN 'notional_{wl}'
                 WHEN concentration_breach THEN 'symbol_concentration' END AS metric
  FROM f WHERE order_rate_breach OR notional_breach OR concentration_breach)
SELECT sha256(concat_ws('|', 'KILL', scope, CAST(epoch_ms(window_start) AS VARCHAR), '{wl}', metric)) AS cmd_id,
       ts, scope, 'KILL' AS action,
       CASE WHEN order_rate_breach
              THEN 'Order rate breach: ' || CAST(order_count AS VARCHAR) || ' orders in {wl}'
            WHEN notional_breach
              THEN 'Notional breach: $' || printf('%.2f', total_notional) || ' in {wl}'
            WHEN concentration_breach
              THEN 'Symbol concentration breach: ' || {percent_sql('top_count', f'{label}_orders')}
                   || '% in ' || top_{label} END AS reason,
       'spark' AS triggered_by, metric,
       CASE WHEN order_rate_breach THEN CAST(order_count AS DOUBLE)
            WHEN notional_breach THEN total_notional
            WHEN concentration_breach THEN top_{label}_share END AS value,
       sha256(concat_ws('|', 'corr', scope, CAST(epoch_ms(window_start) AS VARCHAR), '{wl}')) AS corr_id,
       concat_ws(',', CASE WHEN order_rate_breach THEN 'order_rate_{wl}' END,
                 CASE WHEN notional_breach THEN 'notional_{wl}' END,
                 CASE WHEN concentration_breach THEN 'symbol_concentration' END) AS breached_metrics
FROM b
"""


EVENT_SIGNALS = signals_sql(EVENT_ORDERS, EVENT_PARAMS)
EVENT_COMMANDS = commands_sql(EVENT_SIGNALS, EVENT_PARAMS)
BOOK_SIGNALS = signals_sql(BOOK_ORDERS, BOOK_PARAMS)
BOOK_COMMANDS = commands_sql(BOOK_SIGNALS, BOOK_PARAMS)


# -- control plane ------------------------------------------------------------

EVENTS_K = """
SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
"""

OPERATOR_EVENT_COMMANDS = f"""
SELECT sha256(concat_ws('|', 'cmd', CAST(event_id AS VARCHAR))) AS cmd_id,
       epoch_us(ts) // 1000 AS ts,
       CASE WHEN ((event_id % 1000) + 1000) % 1000 = 7 THEN 'GLOBAL'
            WHEN ((event_id % 40) + 40) % 40 = 3 THEN 'SYMBOL:' ||
                 CASE ((k % 5) + 5) % 5 WHEN 0 THEN 'CLICK' WHEN 1 THEN 'ERROR'
                      WHEN 2 THEN 'PURCHASE' WHEN 3 THEN 'SIGNUP' WHEN 4 THEN 'VIEW' END
            ELSE 'ACCOUNT:' || CAST(user_id AS VARCHAR) END AS scope,
       action,
       CASE WHEN ((k % 10) + 10) % 10 = 0 THEN ''
            WHEN action = 'KILL' THEN 'Operator kill after error event ' || CAST(event_id AS VARCHAR)
            WHEN action = 'UNKILL' THEN 'Operator release after signup event ' || CAST(event_id AS VARCHAR)
            ELSE 'Operator pause request' END AS reason,
       CASE WHEN ((k % 13) + 13) % 13 = 0 THEN NULL ELSE 'ops-console' END AS triggered_by,
       CAST(NULL AS VARCHAR) AS metric, CAST(NULL AS DOUBLE) AS value,
       CASE WHEN ((k % 11) + 11) % 11 = 0 THEN NULL
            ELSE sha256(concat_ws('|', 'corr', CAST(event_id AS VARCHAR))) END AS corr_id
FROM (SELECT *, CASE WHEN event_type = 'error' THEN 'KILL'
                     WHEN event_type = 'signup' THEN 'UNKILL'
                     WHEN event_type = 'click' AND k >= 99 THEN 'PAUSE' END AS action
      FROM ({EVENTS_K}))
WHERE action IS NOT NULL
"""

CONSOLE_REQUESTS = f"""
SELECT CAST(event_id AS VARCHAR) AS request_id, epoch_us(ts) // 1000 AS ts,
       CASE WHEN event_type = 'view' THEN '/unkill' WHEN event_type = 'click' THEN '/pause'
            ELSE '/kill' END AS path,
       CASE WHEN k = 96 THEN NULL WHEN k = 97 THEN ''
            WHEN k = 98 THEN 'account:' || CAST(user_id AS VARCHAR)
            WHEN ((event_id % 9) + 9) % 9 = 0 THEN 'GLOBAL'
            WHEN ((event_id % 9) + 9) % 9 = 1 THEN 'ACCOUNT:'
            ELSE 'ACCOUNT:' || CAST(user_id AS VARCHAR) END AS scope,
       CASE WHEN ((event_id % 2) + 2) % 2 = 0 THEN NULL
            ELSE 'Console request ' || CAST(event_id AS VARCHAR) END AS reason,
       CASE WHEN ((user_id % 3) + 3) % 3 = 0 THEN NULL
            ELSE 'op-' || CAST(((user_id % 3) + 3) % 3 AS VARCHAR) END AS operator
FROM ({EVENTS_K}) WHERE k >= 96
"""

VALIDATED_REQUESTS = f"""
SELECT *, CASE WHEN serr IS NOT NULL THEN 400 WHEN path NOT IN ('/kill', '/unkill') THEN 404
               ELSE 200 END AS status_code,
       coalesce(serr, CASE WHEN path NOT IN ('/kill', '/unkill')
                 THEN 'Not found. Available endpoints: POST /kill, POST /unkill, GET /health' END) AS error
FROM (SELECT *, CASE WHEN scope IS NULL OR scope = '' THEN 'Missing required field: scope'
                     WHEN scope = 'GLOBAL' OR starts_with(scope, 'ACCOUNT:')
                          OR starts_with(scope, 'SYMBOL:') THEN NULL
                     ELSE 'Invalid scope format. Use GLOBAL, ACCOUNT:<id>, or SYMBOL:<symbol>' END AS serr
      FROM ({CONSOLE_REQUESTS}))
"""

CONSOLE_COMMANDS = f"""
SELECT sha256(concat_ws('|', 'op', request_id)) AS cmd_id, ts, scope,
       CASE WHEN path = '/kill' THEN 'KILL' ELSE 'UNKILL' END AS action,
       coalesce(reason, 'Manual operator action') AS reason,
       coalesce(operator, 'api') AS triggered_by,
       CAST(NULL AS VARCHAR) AS metric, CAST(NULL AS DOUBLE) AS value,
       sha256(concat_ws('|', 'opcorr', request_id)) AS corr_id
FROM ({VALIDATED_REQUESTS}) WHERE status_code = 200
"""

CONSOLE_REJECTS = f"""
SELECT request_id, ts, path, scope, status_code, error
FROM ({VALIDATED_REQUESTS}) WHERE status_code <> 200
"""

COMMAND_LOG = f"""
SELECT cmd_id, ts, scope, action, reason, triggered_by, metric, value, corr_id FROM ({EVENT_COMMANDS})
UNION ALL SELECT * FROM ({OPERATOR_EVENT_COMMANDS})
UNION ALL SELECT * FROM ({CONSOLE_COMMANDS})
"""

STATE_RECORDS = f"""
SELECT scope,
       CASE action WHEN 'KILL' THEN 'KILLED' WHEN 'UNKILL' THEN 'ACTIVE' END AS status,
       ts AS updated_ts, coalesce(triggered_by, 'unknown') AS updated_by,
       coalesce(reason, '') AS reason, cmd_id AS last_cmd_id,
       coalesce(corr_id, sha256(concat_ws('|', 'corr', cmd_id))) AS corr_id
FROM ({COMMAND_LOG})
WHERE action IN ('KILL', 'UNKILL') AND scope IS NOT NULL
"""

SNAPSHOT = f"""
SELECT scope, status, updated_ts, updated_by, reason, last_cmd_id, corr_id FROM (
  SELECT *, row_number() OVER (PARTITION BY scope ORDER BY updated_ts DESC, last_cmd_id DESC) AS rn
  FROM ({STATE_RECORDS})) WHERE rn = 1
"""

def intervals_sql(state_cte: str) -> str:
    return f"""
SELECT * FROM (
  SELECT *, updated_ts AS valid_from,
         lead(updated_ts) OVER (PARTITION BY scope ORDER BY updated_ts, last_cmd_id) AS valid_to
  FROM ({state_cte}))
WHERE valid_to IS NULL OR valid_to > valid_from
"""


def state_records_sql(command_cte: str) -> str:
    return f"""
SELECT scope,
       CASE action WHEN 'KILL' THEN 'KILLED' WHEN 'UNKILL' THEN 'ACTIVE' END AS status,
       ts AS updated_ts, coalesce(triggered_by, 'unknown') AS updated_by,
       coalesce(reason, '') AS reason, cmd_id AS last_cmd_id,
       coalesce(corr_id, sha256(concat_ws('|', 'corr', cmd_id))) AS corr_id
FROM ({command_cte})
WHERE action IN ('KILL', 'UNKILL') AND scope IS NOT NULL
"""


INTERVALS = intervals_sql(STATE_RECORDS)

STATUS_CHANGES = f"""
SELECT scope, status, updated_ts, updated_by, reason, last_cmd_id, corr_id, prev_status FROM (
  SELECT *, lag(status) OVER (PARTITION BY scope ORDER BY updated_ts, last_cmd_id) AS prev_status
  FROM ({STATE_RECORDS}))
WHERE prev_status IS NULL OR prev_status <> status
"""

KILL_INTERVALS = f"""
SELECT scope, updated_ts AS kill_ts, next_ts AS unkill_ts, next_ts - updated_ts AS duration_ms,
       reason, updated_by, last_cmd_id AS kill_cmd_id, next_cmd AS unkill_cmd_id
FROM (SELECT *, lead(updated_ts) OVER w AS next_ts, lead(last_cmd_id) OVER w AS next_cmd
      FROM ({STATUS_CHANGES})
      WINDOW w AS (PARTITION BY scope ORDER BY updated_ts, last_cmd_id))
WHERE status = 'KILLED'
"""


def gate_sql(orders_cte: str, state_cte: str = INTERVALS, asof: bool = True,
             strategy: bool = False) -> str:
    levels = [("g", "'GLOBAL'"), ("a", "'ACCOUNT:' || o.account_id"), ("s", "'SYMBOL:' || o.symbol")]
    if strategy:
        levels.append(("t", "'STRATEGY:' || o.strategy"))
    joins = []
    for p, key in levels:
        cond = f"{p}.scope = {key}"
        if asof:
            cond += f" AND {p}.valid_from <= o.ts AND ({p}.valid_to IS NULL OR o.ts < {p}.valid_to)"
        joins.append(f"LEFT JOIN ({state_cte}) {p} ON {cond}")
    killed = {p: f"coalesce({p}.status = 'KILLED', false)" for p, _ in levels}
    matches, earlier, kl = [], "false", []
    for p, key in levels:
        matches.append(f"CASE WHEN {p}.status IS NOT NULL AND NOT ({earlier}) THEN {key} END")
        kl.append(f"WHEN {killed[p]} AND NOT ({earlier}) THEN '{p}'")
        earlier = f"({earlier} OR {killed[p]})"

    def pick(field):
        return "CASE " + " ".join(f"WHEN kill_level = '{p}' THEN {p}_{field}" for p, _ in levels) + " END"

    def pick_scope():
        return "CASE " + " ".join(f"WHEN kill_level = '{p}' THEN {p}_scope" for p, _ in levels) + " END"

    sel_state = ", ".join(f"{p}.{f} AS {p}_{f}" for p, _ in levels
                          for f in ("status", "reason", "updated_ts", "last_cmd_id", "corr_id"))
    sel_scope = ", ".join(f"{key} AS {p}_scope" for p, key in levels)
    return f"""
WITH j AS (
  SELECT o.*, {sel_state}, {sel_scope},
         CASE {' '.join(kl)} END AS kill_level,
         concat_ws(',', {', '.join(matches)}) AS scope_matches
  FROM ({orders_cte}) o {' '.join(joins)})
SELECT ts, CASE WHEN kill_level IS NOT NULL THEN 'DROP' ELSE 'ALLOW' END AS decision,
       order_id, account_id, symbol, scope_matches,
       CASE WHEN kill_level IS NOT NULL THEN 'KILLED' ELSE 'ACTIVE' END AS killswitch_status,
       CASE WHEN kill_level IS NULL THEN 'No kill switch active'
            WHEN {pick('reason')} IS NULL THEN 'Kill switch active'
            WHEN {pick('reason')} = '' THEN 'No kill switch active'
            ELSE {pick('reason')} END AS reason,
       sha256(concat_ws('|', 'audit', order_id)) AS corr_id, 'order_router' AS service,
       side, qty, price, strategy,
       {pick_scope()} AS kill_scope, {pick('last_cmd_id')} AS kill_cmd_id,
       {pick('corr_id')} AS kill_corr_id, {pick('updated_ts')} AS kill_ts
FROM j
"""


AUDIT = gate_sql(EVENT_ORDERS)
AUDIT_SNAPSHOT = gate_sql(EVENT_ORDERS, SNAPSHOT, asof=False)
REPLAYED_BOOK = f"""
SELECT * REPLACE ({REPLAY_START_MS} + (ts + CAST(split_part(order_id, '-', 2) AS BIGINT) * 10800000)
                  % {REPLAY_SPAN_MS} AS ts) FROM ({BOOK_ORDERS})
"""
BOOK_AUDIT = gate_sql(REPLAYED_BOOK)
