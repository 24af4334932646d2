"""Order gating against kill state (hierarchical GLOBAL -> ACCOUNT -> SYMBOL).

Two modes:

* ``gate_asof``: every order sees the state *as of its own time* (exact
  replay of the router's interleaved loop; a state change at the same instant
  applies before the order). State history becomes validity intervals
  [valid_from, valid_to) per scope; the order side joins them per scope level
  on (scope, leaf) with the range condition, through ``IntervalIndex``: a tree of
  ``FANOUT`` per node over each scope's intervals in time order, descended by joins. An
  interval is one row whatever its length, so a scope that was killed once is one row
  however long ago that was, and an order is compared with at most ``FANOUT``
  intervals of its scope, however many changes a hot scope has in whatever time.
  The interval table is written once (checkpoint) and broadcast only when its
  measured bytes are under ``MAX_BROADCAST_BYTES``; otherwise the level joins
  shuffle on (scope, leaf).
* ``gate_snapshot``: every order against one snapshot (a router bootstrapped
  from the compacted state), three equi-joins on the scope key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (DECISION_ALLOW, DECISION_DROP, REASON_KILL_DEFAULT,
                                 REASON_NO_KILL, ROUTER_SERVICE, SCOPE_GLOBAL, STATUS_ACTIVE,
                                 STATUS_KILLED, account_scope, stable_id, strategy_scope,
                                 symbol_scope)
from ..schemas import AUDIT_COLUMNS
from .sequence import SEQ_BUCKET_MS, day_bucket, neighbour_in_key, number_in_key

# Broadcast bound for state-side tables, in bytes of their rows as measured.
MAX_BROADCAST_BYTES = 64 << 20
STATE_FIELDS = ["status", "reason", "updated_ts", "last_cmd_id", "corr_id"]
# Intervals of a leaf, and children of any other node, of the interval index.
FANOUT = 32


# Scope-key prefix of each level (GLOBAL is a whole key).
LEVEL_MATCH = {"g": (SCOPE_GLOBAL, True), "a": ("ACCOUNT:", False), "s": ("SYMBOL:", False),
               "t": ("STRATEGY:", False)}


def level_of(scope: Column) -> Column:
    """Level prefix ('g', 'a', 's', 't') of a scope key; null for others."""
    expr = None
    for p, (text, whole) in LEVEL_MATCH.items():
        cond = (scope == text) if whole else scope.startswith(text)
        expr = F.when(cond, F.lit(p)) if expr is None else expr.when(cond, F.lit(p))
    return expr


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: its texts as they are, eight for any other value, and as much for
    where each lies. Floats and longs are what a broadcast holds of them."""
    size = F.lit(16 * len(df.columns) + 16)
    for name, kind in df.dtypes:
        if kind == "string":
            size = size + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    return size.cast("bigint")


def split_by_level(side: DataFrame, max_bytes: int) -> dict[str, DataFrame]:
    """A materialised state-side table (one row per scope) for each level's
    join. One grouped pass measures every level: under ``max_bytes`` in total
    it is broadcast once and shared; otherwise each level's part is
    broadcast only if its own bytes are under the bound."""
    sizes = {r["_level"]: r["n"] for r in
             side.groupBy(level_of(F.col("scope")).alias("_level"))
             .agg(F.sum(row_bytes(side)).alias("n")).collect()}
    if sum(sizes.values()) <= max_bytes:
        shared = F.broadcast(side)
        return {p: shared for p in LEVEL_MATCH}
    parts = {}
    for p in LEVEL_MATCH:
        part = side.filter(level_of(F.col("scope")) == p)
        parts[p] = F.broadcast(part) if sizes.get(p, 0) <= max_bytes else part
    return parts


def scope_levels(include_strategy: bool = False) -> list[tuple[str, Column]]:
    """(prefix, scope key of the order) in precedence order."""
    levels = [("g", F.lit(SCOPE_GLOBAL)), ("a", account_scope("account_id")),
              ("s", symbol_scope("symbol"))]
    if include_strategy:
        levels.append(("t", strategy_scope("strategy")))
    return levels


def state_intervals(states: DataFrame, bucket_ms: int = SEQ_BUCKET_MS) -> DataFrame:
    """State history -> validity intervals per scope. Same-instant records of
    a scope: the larger cmd id wins, the other gets an empty interval and is
    dropped."""
    nx = neighbour_in_key(states, "scope", ["updated_ts", "last_cmd_id"],
                          F.floor(F.col("updated_ts") / bucket_ms).cast("bigint"),
                          ["updated_ts"], "next", "_next")
    return (nx.withColumn("valid_from", F.col("updated_ts"))
            .withColumn("valid_to", F.col("_next.updated_ts")).drop("_next")
            .filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))


class IntervalIndex:
    """Validity intervals of scopes as a tree, ready for a range join per scope level.

    ``intervals``: ``scope``, ``valid_from``, ``valid_to``, payload; those of a scope do not
    overlap. Numbered by time within its scope, interval r lies in leaf r div ``fanout``,
    leaf n in node n div ``fanout`` of the level above, and so on to one node. A level's
    table has a row for each node of the scopes that have several there: its start and the
    start of the next. A probe descends: at each level it meets, by equality of scope
    and parent, at most ``fanout`` nodes, one of which covers its time. Scopes of a
    single leaf need no level. So n intervals are n rows, and the levels n / ``fanout``,
    n / ``fanout``^2 and so on, whatever the times.

    Broadcast: if the whole side is under ``max_bytes`` it is broadcast once
    and shared by every level's join; otherwise each scope level's part is
    broadcast only if its own bytes are under the bound, and shuffled on
    (scope, leaf) otherwise (AQE splits a skewed partition)."""

    def __init__(self, intervals: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES, fanout: int = FANOUT):
        self.max_bytes = max_bytes
        numbered = number_in_key(intervals, "scope", ["valid_from"], day_bucket("valid_from"), "_r")
        self.table = numbered.withColumn("leaf", _div(F.col("_r"), fanout)).drop("_r").checkpoint()
        self.bytes = self._bytes(self.table)
        self.nodes: list[tuple[DataFrame, dict[str, int]]] = []
        # a level's nodes are the first interval of each leaf, then every fanout-th of those
        below = (self.table.groupBy("scope", F.col("leaf").alias("node")).agg(F.min("valid_from").alias("start")))
        while True:
            several = below.filter("node = 1").select("scope")
            mine = below.join(several, "scope", "left_semi")
            after = mine.select("scope", (F.col("node") - 1).alias("node"), F.col("start").alias("end"))
            level = mine.join(after, ["scope", "node"], "left").withColumn("parent", _div(F.col("node"), fanout)).checkpoint()
            size = self._bytes(level)
            if not size:
                return
            self.nodes.append((level, size))
            below = level.filter(F.pmod(F.col("node"), F.lit(fanout)) == 0).select("scope", _div(F.col("node"), fanout).alias("node"), "start")

    @staticmethod
    def _bytes(df: DataFrame) -> dict[str, int]:
        rows = df.groupBy(level_of(F.col("scope")).alias("_level")).agg(F.sum(row_bytes(df)).alias("bytes")).collect()
        return {r["_level"]: int(r["bytes"]) for r in rows}

    def _part(self, df: DataFrame, size: dict[str, int], level: str | None) -> DataFrame:
        whole = sum(size.values())
        if level is None or whole <= self.max_bytes:
            return F.broadcast(df) if whole <= self.max_bytes else df
        part = df.filter(level_of(F.col("scope")) == level)
        return F.broadcast(part) if size.get(level, 0) <= self.max_bytes else part

    def is_broadcast(self, level: str) -> bool:
        """Whether the interval rows for ``level`` are broadcast."""
        return sum(self.bytes.values()) <= self.max_bytes or self.bytes.get(level, 0) <= self.max_bytes

    def side(self, level: str | None = None) -> DataFrame:
        """The interval rows for ``level`` (all levels when None), with a
        broadcast hint only behind the measured size bound."""
        return self._part(self.table, self.bytes, level)

    def with_leaf(self, df: DataFrame, key: Column, ts: Column, out: str, level: str | None = None) -> DataFrame:
        """Adds the leaf (``out``) of each probe row whose scope key is ``key`` at time ``ts``."""
        # a probe without a time is in no leaf
        d = df.withColumn(out, F.when(ts.isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("bigint"))
        for nodes, size in reversed(self.nodes):
            if level is not None and not size.get(level):
                continue
            n = self._part(nodes, size, level).select(*[F.col(c).alias(f"_n_{c}") for c in ("scope", "parent", "node", "start", "end")])
            cond = ((key == F.col("_n_scope")) & (F.col(out) == F.col("_n_parent")) & (F.col("_n_start") <= ts)
                    & (F.col("_n_end").isNull() | (ts < F.col("_n_end"))))
            d = (d.join(n, cond, "left").withColumn("_next", F.coalesce("_n_node", F.least(F.col(out), F.lit(0).cast("bigint"))))
                 .drop(out, "_n_scope", "_n_parent", "_n_node", "_n_start", "_n_end").withColumnRenamed("_next", out))
        return d


def _div(n: Column, k: int) -> Column:
    return F.floor(n / F.lit(k)).cast("bigint")


def sized_broadcast(df: DataFrame, max_bytes: int) -> DataFrame:
    """Broadcast hint only behind a measured size bound; ``df`` should be
    materialised (checkpointed) so the pass does not recompute its lineage."""
    return F.broadcast(df) if (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= max_bytes else df


def _lookup_level(orders: DataFrame, index: IntervalIndex, prefix: str, key: Column) -> DataFrame:
    o = index.with_leaf(orders.withColumn(f"_{prefix}_key", key), F.col(f"_{prefix}_key"), F.col("ts"), "_leaf", prefix)
    side = index.side(prefix).select(
        F.col("scope").alias(f"_{prefix}_scope"), F.col("leaf").alias(f"_{prefix}_leaf"),
        F.col("valid_from").alias(f"_{prefix}_from"),
        F.col("valid_to").alias(f"_{prefix}_to"),
        *[F.col(x).alias(f"{prefix}_{x}") for x in STATE_FIELDS])
    cond = ((F.col(f"_{prefix}_key") == F.col(f"_{prefix}_scope"))
            & (F.col("_leaf") == F.col(f"_{prefix}_leaf"))
            & (F.col(f"_{prefix}_from") <= F.col("ts"))
            & (F.col(f"_{prefix}_to").isNull() | (F.col("ts") < F.col(f"_{prefix}_to"))))
    j = o.join(side, cond, "left")
    return j.drop(f"_{prefix}_key", "_leaf", f"_{prefix}_scope", f"_{prefix}_leaf", f"_{prefix}_from", f"_{prefix}_to")


def attach_state_asof(orders: DataFrame, states: DataFrame, include_strategy: bool = False,
                      max_broadcast_bytes: int = MAX_BROADCAST_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Adds ``<p>_status``, ``<p>_reason``, ... per scope level as of each order, through an
    ``IntervalIndex`` that the level joins share."""
    iv = state_intervals(states).select("scope", *STATE_FIELDS, "valid_from", "valid_to")
    index = IntervalIndex(iv, max_broadcast_bytes, fanout)
    out = orders
    # levels that shuffle the orders come first, before the fields of the others make the rows long
    for prefix, key in sorted(scope_levels(include_strategy), key=lambda level: index.is_broadcast(level[0])):
        out = _lookup_level(out, index, prefix, key)
    return out


def attach_state_snapshot(orders: DataFrame, snapshot: DataFrame,
                          include_strategy: bool = False,
                          max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    parts = split_by_level(snapshot.checkpoint(), max_broadcast_bytes)
    out = orders
    for prefix, key in scope_levels(include_strategy):
        side = parts[prefix].select(F.col("scope").alias(f"_{prefix}_scope"),
                               *[F.col(x).alias(f"{prefix}_{x}") for x in STATE_FIELDS])
        out = (out.withColumn(f"_{prefix}_key", key)
               .join(side, F.col(f"_{prefix}_key") == F.col(f"_{prefix}_scope"), "left")
               .drop(f"_{prefix}_key", f"_{prefix}_scope"))
    return out


# Scope key of each level as a SQL expression over the order columns.
_LEVEL_KEY_SQL = {"g": f"'{SCOPE_GLOBAL}'", "a": "concat('ACCOUNT:', account_id)",
                  "s": "concat('SYMBOL:', symbol)", "t": "concat('STRATEGY:', strategy)"}


def decide(with_state: DataFrame, include_strategy: bool = False) -> DataFrame:
    """Applies the precedence rule: the first KILLED level decides.

    ``scope_matches`` lists levels that have any state, in order, cut after
    the first KILLED one. Reason: the killing state's reason ('Kill switch
    active' if absent); allowed orders, and kills with an empty reason, read
    'No kill switch active'. The expressions are written as SQL text: one
    parsed expression per column keeps plan construction cheap.
    """
    prefixes = [p for p, _ in scope_levels(include_strategy)]
    killed = {p: f"coalesce({p}_status = '{STATUS_KILLED}', false)" for p in prefixes}
    level = "CASE " + " ".join(f"WHEN {killed[p]} THEN '{p}'" for p in prefixes) + " END"
    matches = []
    for i, p in enumerate(prefixes):
        before = " OR ".join(killed[q] for q in prefixes[:i]) or "false"
        matches.append(f"CASE WHEN {p}_status IS NOT NULL AND NOT ({before}) "
                       f"THEN {_LEVEL_KEY_SQL[p]} END")

    def pick(field: str) -> str:
        return "CASE " + " ".join(f"WHEN _kill_level = '{p}' THEN {p}_{field}"
                                  for p in prefixes) + " END"

    key = "CASE " + " ".join(f"WHEN _kill_level = '{p}' THEN {_LEVEL_KEY_SQL[p]}"
                             for p in prefixes) + " END"
    reason = (f"CASE WHEN _kill_level IS NULL THEN '{REASON_NO_KILL}' "
              f"WHEN {pick('reason')} IS NULL THEN '{REASON_KILL_DEFAULT}' "
              f"WHEN {pick('reason')} = '' THEN '{REASON_NO_KILL}' ELSE {pick('reason')} END")
    d = with_state.withColumn("_kill_level", F.expr(level))
    return d.withColumns({
        "decision": F.expr(f"CASE WHEN _kill_level IS NULL THEN '{DECISION_ALLOW}' "
                           f"ELSE '{DECISION_DROP}' END"),
        "scope_matches": F.expr(f"array_compact(array({', '.join(matches)}))"),
        "killswitch_status": F.expr(f"CASE WHEN _kill_level IS NULL THEN '{STATUS_ACTIVE}' "
                                    f"ELSE '{STATUS_KILLED}' END"),
        "reason": F.expr(reason),
        "kill_scope": F.expr(key),
        "kill_cmd_id": F.expr(pick("last_cmd_id")),
        "kill_corr_id": F.expr(pick("corr_id")),
        "kill_ts": F.expr(pick("updated_ts")),
    })


def audit_rows(decided: DataFrame) -> DataFrame:
    """Reference audit record (+ order side/qty/price/strategy and the
    killing scope/command for tracing). ``ts`` is the order's event time and
    ``corr_id`` a deterministic per-order id."""
    return decided.select(
        F.col("ts"), "decision", "order_id", "account_id", "symbol", "scope_matches",
        "killswitch_status", "reason",
        stable_id(F.lit("audit"), "order_id").alias("corr_id"),
        F.lit(ROUTER_SERVICE).alias("service"),
        "side", "qty", "price", "strategy", "kill_scope", "kill_cmd_id", "kill_corr_id", "kill_ts")


def gate_asof(orders: DataFrame, states: DataFrame, include_strategy: bool = False,
              max_broadcast_bytes: int = MAX_BROADCAST_BYTES, fanout: int = FANOUT) -> DataFrame:
    """orders + state history -> audit rows (exact as-of decisions)."""
    return audit_rows(decide(attach_state_asof(orders, states, include_strategy, max_broadcast_bytes, fanout), include_strategy))


def gate_snapshot(orders: DataFrame, snapshot: DataFrame, include_strategy: bool = False) -> DataFrame:
    """orders + one state snapshot -> audit rows."""
    return audit_rows(decide(attach_state_snapshot(orders, snapshot, include_strategy),
                             include_strategy))


def gated_orders(audit: DataFrame) -> DataFrame:
    """Orders forwarded downstream (decision ALLOW), order schema."""
    return (audit.filter(F.col("decision") == DECISION_ALLOW)
            .select("order_id", "ts", "account_id", "symbol", "side", "qty", "price", "strategy"))

