"""Stateful streaming operators: duplicate orders, throttling, automatic release, and a
gate that reads orders and state changes from one subscription.

Each takes a stream and gives a stream, keeps what it knows per key in the state
store and so goes on after a restart. Inputs of several kinds reach one operator as
rows of one tagged stream. Within a micro-batch the rows of a key are taken in
event-time order; a row of an earlier batch came earlier. Rows that need no state
(without key or time) do not pass the operator.

Keys are kept in buckets by their hash. A worker gets the rows of a bucket with the
bucket's state beside them (Spark's ``applyInPandasWithState``) and gives both back at
once, so that a key costs no call to the state store; the gate, whose buckets look up
scopes, is on ``transformWithState``.

Spark also loads the gate's processor in a process of its own beside the driver, which has neither
the driver's ``sys.path`` nor files added to the context. So the processors of this module are
sent by value, and what their methods call stays in it. Queries are started within
``io.state_store``.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.columns import (ACTION_THROTTLE, ACTION_UNKILL, DECISION_ALLOW, DECISION_DUPLICATE, DECISION_THROTTLED,
                                 TRIGGERED_BY_DETECTOR, account_scope, stable_id)
from ..operators.extensions import DECISION_NEW, REASON_AUTO_UNKILL
from ..operators.gate import STATE_FIELDS, audit_rows, decide, scope_levels
from ..schemas import COMMAND_COLUMNS, ORDER_COLUMNS

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _frame(rows: list[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    if rows:
        yield pd.DataFrame(rows, columns=columns, dtype=object)


#: Whole-number columns, which pandas holds as floats where some are missing.
WHOLE = {"ts", "at", "kind", "updated_ts", "qty"}


def _tuples(frames: Iterator[pd.DataFrame], columns: list[str]) -> list[tuple]:
    """The rows of a key, or of a bucket of keys, in this micro-batch; missing values are None."""
    out: list[tuple] = []
    for frame in frames:
        values = []
        for c in columns:
            column = frame[c]
            gone = column.isna()
            if gone.any():
                values.append([None if g else int(v) if c in WHOLE else v for v, g in zip(column.tolist(), gone.tolist())])
            else:
                values.append([int(v) for v in column.tolist()] if c in WHOLE and column.dtype.kind != "i" else column.tolist())
        out.extend(zip(*values))
    return out


def _by_key(frames: Iterator[pd.DataFrame], key: str, columns: list[str]) -> dict[str, list[tuple]]:
    """The rows of each key of a bucket in this micro-batch."""
    out: dict[str, list[tuple]] = {}
    for k, *row in _tuples(frames, [key, *columns]):
        if k in out:
            out[k].append(row)
        else:
            out[k] = [row]
    return out


def _lists(rows: list[tuple], n: int) -> tuple[list, ...]:
    """The columns of a list of rows."""
    return tuple(list(c) for c in zip(*rows)) if rows else tuple([] for _ in range(n))


#: Buckets of keys. A micro-batch reads and writes the state of each bucket that it meets, so more of
#: them suit small batches over a large state; the number stays as it is for the life of a query.
BUCKETS = 4096


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _first(time) -> tuple:
    """Sorts a missing time before all others."""
    return (time is not None, time or 0)


def _with_state(keyed: DataFrame, processor, schema: str, timeout: str) -> DataFrame:
    """Applies a processor to the rows and the state of each bucket."""
    return keyed.groupBy("bucket").applyInPandasWithState(lambda key, frames, state: processor(key, frames, state), schema, processor.STATE, "append", timeout)


# -- duplicates --------------------------------------------------------------------

DUPLICATES = "order_id string, client_order_id string, ts bigint, account_id string, prev_seen_ts bigint, decision string"


class DuplicateProcessor:
    """Remembers, for each id of a bucket, the time of the order that put it in memory. An
    id goes ``ttl_ms`` of processing time after that order was seen."""

    STATE = "ids array<string>, seen array<bigint>, until array<bigint>"

    def __init__(self, memory_ms: int, ttl_ms: int):
        self.memory_ms, self.ttl_ms = memory_ms, ttl_ms

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = state.getCurrentProcessingTimeMs()
        memory = {id_: (ts, until) for id_, ts, until in zip(*state.get) if until > now} if state.exists else {}
        out = []
        for id_, rows in _by_key(frames, "client_order_id", ["ts", "order_id", "account_id"]).items():
            known = memory.get(id_)
            seen = before = known[0] if known is not None else None
            if len(rows) > 1:
                rows.sort(key=lambda r: (r[0], r[1] or ""))
            for ts, order, account in rows:
                # an order that comes late, with a time before the remembered one, is a repeat too
                new = seen is None or ts - seen >= self.memory_ms
                out.append((order, id_, ts, account, None if new else seen, DECISION_NEW if new else DECISION_DUPLICATE))
                seen = ts if new else seen
            if seen != before:
                memory[id_] = (seen, now + self.ttl_ms)
        state.update(_lists([(id_, *known) for id_, known in memory.items()], 3))
        state.setTimeoutDuration(max(until for _, until in memory.values()) - now)
        yield from _frame(out, ["order_id", "client_order_id", "ts", "account_id", "prev_seen_ts", "decision"])


def duplicate_stream(orders: DataFrame, id_col: str, memory_ms: int = 3_600_000, ttl_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Streaming twin of ``extensions.duplicate_decisions``: the same rows where orders
    arrive in event-time order. ``ttl_ms`` (twice the memory by default) bounds the state:
    an id is forgotten after that much processing time (see ``io.without_empty_batches`` for
    queries that stop). Orders without id or time are NEW."""
    known = F.col(id_col).isNotNull() & F.col("ts").isNotNull()
    keyed = orders.filter(known).select(_bucket(F.col(id_col).cast("string"), buckets).alias("bucket"),
                                        F.col(id_col).cast("string").alias("client_order_id"), "ts", "order_id", "account_id")
    decided = _with_state(keyed, DuplicateProcessor(memory_ms, ttl_ms or 2 * memory_ms), DUPLICATES, GroupStateTimeout.ProcessingTimeTimeout)
    rest = orders.filter(~known).select("order_id", F.col(id_col).cast("string").alias("client_order_id"), "ts", "account_id",
                                        F.lit(None).cast("bigint").alias("prev_seen_ts"), F.lit(DECISION_NEW).alias("decision"))
    return decided.unionByName(rest)


# -- throttling ----------------------------------------------------------------------

THROTTLED = "order_id string, ts bigint, account_id string, symbol string, max_rate_per_second int, decision string"
_THROTTLE_IN = ["ts", "kind", "id", "account_id", "symbol", "action", "value"]


def throttle_input(orders: DataFrame, commands: DataFrame) -> DataFrame:
    """One tagged table of orders (kind 1) and THROTTLE / UNKILL / KILL commands (kind 0)."""
    null = F.lit(None).cast("string")
    return (orders.select(account_scope("account_id").alias("scope"), "ts", F.lit(1).alias("kind"), F.col("order_id").alias("id"), "account_id", "symbol",
                          null.alias("action"), F.lit(None).cast("double").alias("value"))
            .unionByName(commands.select("scope", "ts", F.lit(0).alias("kind"), F.col("cmd_id").alias("id"), null.alias("account_id"), null.alias("symbol"),
                                         "action", F.col("value").cast("double").alias("value"))))


class ThrottleProcessor:
    """Keeps the rate of each scope of a bucket, and how many of its orders passed in the current event second."""

    STATE = "scopes array<string>, rate array<int>, second array<bigint>, passed array<bigint>"

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        scopes = {scope: known for scope, *known in zip(*state.get)} if state.exists else {}
        out = []
        for scope, rows in _by_key(frames, "scope", _THROTTLE_IN).items():
            rate, second, passed = scopes.get(scope, (None, None, 0))
            for ts, kind, id_, account, symbol, action, value in sorted(rows, key=lambda r: (_first(r[0]), r[1], r[2] or "")):
                if kind == 0:  # the newest command decides; any but a THROTTLE ends throttling
                    rate = int(value) if action == ACTION_THROTTLE and value is not None else None
                    continue
                now = None if ts is None else ts // 1000
                if now != second:
                    second, passed = now, 0
                allowed = rate is None or passed < rate
                passed += allowed
                out.append((id_, ts, account, symbol, rate, DECISION_ALLOW if allowed else DECISION_THROTTLED))
            scopes[scope] = (rate, second, passed)
        state.update(_lists([(scope, *known) for scope, known in scopes.items()], 4))
        yield from _frame(out, ["order_id", "ts", "account_id", "symbol", "max_rate_per_second", "decision"])


def throttle_stream(tagged: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Streaming twin of ``extensions.throttle_decisions`` over ``throttle_input`` rows: an
    order passes while fewer than the rate in force at its time passed in the same
    second. A command takes effect on orders of its own instant. Orders without an
    account pass."""
    keyed = tagged.filter("scope is not null").select(_bucket(F.col("scope"), buckets).alias("bucket"), "scope", *_THROTTLE_IN)
    decided = _with_state(keyed, ThrottleProcessor(), THROTTLED, GroupStateTimeout.NoTimeout)
    rest = tagged.filter("scope is null and kind = 1").select(F.col("id").alias("order_id"), "ts", "account_id", "symbol",
                                                              F.lit(None).cast("int").alias("max_rate_per_second"), F.lit(DECISION_ALLOW).alias("decision"))
    return decided.unionByName(rest)


# -- automatic release -----------------------------------------------------------------

RELEASES = "scope string, ts bigint, kill_cmd_id string"
_COOLDOWN_IN = ["ts", "cmd_id", "action", "triggered_by"]
ACTION_HOLD, ACTION_UNHOLD = "HOLD", "UNHOLD"


class CooldownProcessor:
    """Follows the commands of a bucket's scopes in event-time order and releases detector kills.

    Commands wait in the state until the watermark is a window past them: only then is it
    known whether a breach that began before the end of the cooldown extends the
    episode (its command comes at the window's end). A timeout for the first of what waits
    and of the releases due makes the operator go on without input."""

    # the commands that wait, and of each scope the open activation, by whom and by which command; when its cooldown ends; whether an operator holds the scope
    STATE = ("waiting array<string>, ts array<bigint>, cmd_id array<string>, action array<string>, triggered_by array<string>, "
             "scopes array<string>, killed array<boolean>, by array<string>, kill_cmd_id array<string>, due array<bigint>, held array<boolean>")

    def __init__(self, cooldown_ms: int, window_ms: int):
        self.cooldown_ms, self.window_ms = cooldown_ms, window_ms

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        until = state.getCurrentWatermarkMs() - self.window_ms
        waiting, scopes = _by_key(frames, "scope", _COOLDOWN_IN), {}
        if state.exists:
            columns = state.get
            for scope, *row in zip(*columns[:5]):
                waiting.setdefault(scope, []).append(row)
            scopes = {scope: known for scope, *known in zip(*columns[5:])}
        out, left, times = [], [], []
        # all that the watermark allows
        for scope in {**waiting, **scopes}:
            rows, known = waiting.get(scope, []), scopes.get(scope)
            if any(r[0] <= until for r in rows) or known and known[3] is not None and known[3] <= until:
                rows, known = self.follow(scope, rows, known or (False, None, None, None, False), until, out)
                scopes[scope] = known
            left.extend((scope, *r) for r in rows)
            times.extend(r[0] for r in rows)
            if known and known[3] is not None:
                times.append(known[3])
        state.update((*_lists(left, 5), *_lists([(scope, *known) for scope, known in scopes.items()], 6)))
        if times:  # the timeout passes when the watermark is later, not equal
            state.setTimeoutTimestamp(max(min(times) + self.window_ms - 1, 1))
        yield from _frame(out, ["scope", "ts", "kill_cmd_id"])

    def follow(self, scope: str, rows: list, known: tuple, until: int, out: list) -> tuple[list, tuple]:
        """Works off the commands of a scope up to ``until``; the others, and the state then."""
        killed, by, cmd, due, held = known
        rows = sorted(rows, key=lambda r: (r[0], r[1] or "", r[2] or "", r[3] or ""))
        # an episode grows by each breach whose window began before the cooldown's end
        breaches = [r[0] for r in rows if r[2] == "KILL" and r[3] == TRIGGERED_BY_DETECTOR]

        def release(before: int) -> None:
            nonlocal killed, due
            while due is not None and due <= before:
                more = bisect_right(breaches, due - self.cooldown_ms)
                if more < len(breaches) and breaches[more] - self.window_ms < due:
                    due = breaches[more] + self.cooldown_ms
                    continue
                if killed and by == TRIGGERED_BY_DETECTOR and not held:
                    out.append((scope, due, cmd))
                    killed = False
                due = None

        left = len(rows)
        for k, (ts, id_, action, who) in enumerate(rows):
            if ts > until:
                left = k
                break
            release(ts)
            if action == "KILL":
                if not killed:
                    killed, by, cmd = True, who, id_
                if who == TRIGGERED_BY_DETECTOR:
                    due = ts + self.cooldown_ms
            elif action == ACTION_UNKILL:
                killed = False
            elif action in (ACTION_HOLD, ACTION_UNHOLD):
                held = action == ACTION_HOLD
        release(until)
        return rows[left:], (killed, by, cmd, due, held)


def release_stream(commands: DataFrame, cooldown_ms: int, window_ms: int, watermark: str, buckets: int = BUCKETS) -> DataFrame:
    """A stream of commands (the detector's, the operators', HOLD and UNHOLD) -> UNKILL
    commands for detector kills whose scope has been calm for ``cooldown_ms``.

    Windows in breach that begin before the cooldown of the one before ends form an
    episode; the release falls at its end plus the cooldown, if the activation is
    still that of the detector, no operator released the scope before and none
    holds it then. Releases take effect here too: a kill after one is a new
    activation. The rows are for the command log. Commands without scope or time
    cannot be followed."""
    timed = (commands.filter("scope is not null and ts is not null").select(_bucket(F.col("scope"), buckets).alias("bucket"), "scope", *_COOLDOWN_IN)
             .withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", watermark))
    found = _with_state(timed, CooldownProcessor(cooldown_ms, window_ms), RELEASES, GroupStateTimeout.EventTimeTimeout)
    return found.select(stable_id(F.lit("auto"), "kill_cmd_id").alias("cmd_id"), "ts", "scope", F.lit(ACTION_UNKILL).alias("action"),
                        F.lit(REASON_AUTO_UNKILL).alias("reason"), F.lit(TRIGGERED_BY_DETECTOR).alias("triggered_by"),
                        F.lit(None).cast("string").alias("metric"), F.lit(None).cast("double").alias("value"),
                        stable_id(F.lit("autocorr"), "kill_cmd_id").alias("corr_id")).select(*COMMAND_COLUMNS)


# -- orders and state in one subscription -----------------------------------------------

def tagged_records(orders: DataFrame, states: DataFrame, buckets: int) -> DataFrame:
    """Orders (kind 1) and state records (kind 0) for ``interleaved_gate``, each in the bucket
    of its account. What concerns every account (GLOBAL, symbols, strategies) goes to
    every bucket."""
    def bucket(account):
        return F.pmod(F.xxhash64(account), F.lit(buckets)).cast("int")

    account = F.when(F.col("scope").startswith("ACCOUNT:"), F.col("scope").substr(F.lit(9), F.length("scope")))
    where = F.when(account.isNotNull(), F.array(bucket(account))).otherwise(F.sequence(F.lit(0), F.lit(buckets - 1)))
    nulls = lambda names: [F.lit(None).cast(t).alias(n) for n, t in names]
    as_orders, as_states = orders.select(*ORDER_COLUMNS).dtypes, states.select("scope", *STATE_FIELDS).dtypes
    return (orders.select(bucket(F.coalesce("account_id", F.lit(""))).alias("bucket"), F.lit(1).alias("kind"), F.col("ts").alias("at"), *ORDER_COLUMNS, *nulls(as_states))
            .unionByName(states.select(F.explode(where).alias("bucket"), F.lit(0).alias("kind"), F.col("updated_ts").alias("at"), *nulls(as_orders), "scope", *STATE_FIELDS)))


class GateProcessor(StatefulProcessor):
    """The state of every scope that the bucket's orders can meet; attaches to each order,
    for each level, the state as the order arrives."""

    def __init__(self, levels: list[str], columns: list[str]):
        self.levels, self.columns = levels, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("scopes", "scope string", "status string, reason string, updated_ts bigint, last_cmd_id string, corr_id string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fields = ["at", "kind", *ORDER_COLUMNS, "scope", *STATE_FIELDS]
        n, cache, changed, out = len(ORDER_COLUMNS), {}, set(), []
        none = (None,) * len(STATE_FIELDS)

        def state(scope: str | None) -> tuple:
            if scope is None:
                return none
            if scope not in cache:
                cache[scope] = tuple(self.known.getValue((scope,))) if self.known.containsKey((scope,)) else none
            return cache[scope]

        def key_of(level: str, order: dict) -> str | None:
            value = {"a": order["account_id"], "s": order["symbol"], "t": order["strategy"]}.get(level)
            prefix = {"a": "ACCOUNT:", "s": "SYMBOL:", "t": "STRATEGY:"}.get(level)
            return "GLOBAL" if level == "g" else None if value is None else prefix + value

        # a state change applies to orders of its own instant; of two at one instant the larger command id stays
        last = fields.index("last_cmd_id")
        for row in sorted(_tuples(rows, fields), key=lambda r: (_first(r[0]), r[1], r[last] or "", r[2] or "")):
            if row[1] == 0:
                scope, values = row[2 + n], row[3 + n:]
                old = state(scope)
                if old[2] is None or (old[2], old[3] or "") <= (values[2], values[3] or ""):
                    cache[scope] = values
                    changed.add(scope)
                continue
            order = dict(zip(ORDER_COLUMNS, row[2 : 2 + n]))
            out.append((*row[2 : 2 + n], *[v for level in self.levels for v in state(key_of(level, order))]))
        for scope in changed:
            self.known.updateValue((scope,), cache[scope])
        yield from _frame(out, self.columns)

    def close(self) -> None:
        pass


def interleaved_gate(tagged: DataFrame, include_strategy: bool = False) -> DataFrame:
    """Audit rows of a stream of ``tagged_records``: every order decided by the state that has
    arrived by then, as one subscription of orders and state gives it. Equal to
    ``gate.gate_asof`` where records arrive in event-time order."""
    levels = [p for p, _ in scope_levels(include_strategy)]
    types = dict(tagged.dtypes)
    fields = [(c, types[c]) for c in ORDER_COLUMNS] + [(f"{p}_{f}", types[f]) for p in levels for f in STATE_FIELDS]
    attached = tagged.groupBy("bucket").transformWithStateInPandas(
        GateProcessor(levels, [n for n, _ in fields]), ", ".join(f"{n} {t}" for n, t in fields), "append", "None")
    return audit_rows(decide(attached, include_strategy))
