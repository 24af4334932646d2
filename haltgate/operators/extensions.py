"""Documented extensions: symbol- and strategy-level kills, throttling,
duplicate detection, multi-window detection and cooldown auto-unkill."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (ACTION_KILL, ACTION_THROTTLE, ACTION_UNKILL, DECISION_ALLOW,
                                 DECISION_DUPLICATE, DECISION_THROTTLED, ROUTER_SERVICE, first_true,
                                 money_text, percent_text, stable_id, status_of, strategy_scope, symbol_scope,
                                 TRIGGERED_BY_DETECTOR, account_scope)
from ..params import RiskParams
from ..schemas import COMMAND_COLUMNS
from ..session import state_dir
from ..sources.orders import with_order_metrics
from .breaches import breaches, commands_from_breaches
from .gate import MAX_BROADCAST_BYTES, row_bytes, sized_broadcast
from .sequence import nearest_non_null_in_key, neighbour_in_key, next_non_null_in_key
from .signals import group_signals, rollup_signals

DECISION_NEW = "NEW"
REASON_THROTTLED = "Rate limit exceeded"
REASON_DUPLICATE = "Duplicate order id"
REASON_AUTO_UNKILL = "Auto unkill after cooldown"


# -- EXT-1 / EXT-6: other scope levels -----------------------------------------

def symbol_signals(orders: DataFrame, params: RiskParams) -> DataFrame:
    """Per (window, symbol): flow over all accounts; concentration is the top
    account's share of the symbol's orders."""
    return group_signals(orders, params, "symbol", "account_id", "account")


def symbol_kill_commands(orders: DataFrame, params: RiskParams) -> DataFrame:
    """EXT-1: symbol-level breaches -> KILL on ``SYMBOL:<s>``."""
    b = breaches(symbol_signals(orders, params), params, "account")
    return commands_from_breaches(b, params, scope=symbol_scope("symbol"), key_col="symbol",
                                  label="account")


def strategy_signals(orders: DataFrame, params: RiskParams) -> DataFrame:
    return group_signals(orders, params, "strategy", "symbol", "symbol")


def strategy_kill_commands(orders: DataFrame, params: RiskParams) -> DataFrame:
    """EXT-6: a misbehaving strategy -> KILL on ``STRATEGY:<name>``."""
    b = breaches(strategy_signals(orders, params), params, "symbol")
    return commands_from_breaches(b, params, scope=strategy_scope("strategy"),
                                  key_col="strategy", label="symbol")


# -- EXT-4: several windows in one pass ------------------------------------------

def multi_window_signals(orders: DataFrame, specs: list[RiskParams]) -> DataFrame:
    """Signals for several window widths in one aggregation: each order is
    replicated once per spec (``explode``), so the table is scanned once and
    the (spec, window, account) groups share one shuffle."""
    o = with_order_metrics(orders)
    spec_arr = F.array(*[F.struct(F.lit(i).alias("spec"), F.lit(p.window_ms).alias("width"))
                         for i, p in enumerate(specs)])
    e = o.select("account_id", "symbol", "ts", "notional", F.explode(spec_arr).alias("_s"))
    start = F.col("ts") - F.pmod(F.col("ts"), F.col("_s.width"))
    e = e.select(F.col("_s.spec").alias("spec"), "account_id", "symbol", "notional",
                 F.struct(F.timestamp_millis(start).alias("start"),
                          F.timestamp_millis(start + F.col("_s.width")).alias("end")).alias("window"))
    per = (e.groupBy("spec", "window", "account_id", F.col("symbol").alias("_inner"))
           .agg(F.count(F.lit(1)).alias("n"), F.count("notional").alias("n_priced"),
                F.sum("notional").alias("amount")))
    return rollup_signals(per, ("spec", "account_id"))


def _by_spec(specs: list[RiskParams], f) -> Column:
    return first_true(*[(F.col("spec") == i, F.lit(f(p))) for i, p in enumerate(specs)])


def multi_window_commands(orders: DataFrame, specs: list[RiskParams]) -> DataFrame:
    """EXT-4: per-window thresholds; any breached window kills the account.
    Metric names carry the window (``order_rate_3600s``) so the ids of
    different windows never collide."""
    return commands_of_windows(multi_window_signals(orders, specs), specs)


def commands_of_windows(s: DataFrame, specs: list[RiskParams]) -> DataFrame:
    """Kill commands of signals that name their window spec (column ``spec``)."""
    rate = F.col("order_count") > _by_spec(specs, lambda p: p.max_orders)
    notional = F.coalesce(F.col("total_notional") > _by_spec(specs, lambda p: float(p.max_notional)),
                          F.lit(False))
    conc = ((F.col("top_symbol_share") > _by_spec(specs, lambda p: float(p.max_share)))
            & (F.col("order_count") >= _by_spec(specs, lambda p: p.min_orders)))
    wl = _by_spec(specs, lambda p: p.window_label)
    b = (s.withColumn("r", rate).withColumn("nb", notional).withColumn("cb", conc)
         .filter(F.col("r") | F.col("nb") | F.col("cb")))
    r, nb, cb = F.col("r"), F.col("nb"), F.col("cb")
    metric = first_true((r, F.concat(F.lit("order_rate_"), wl)),
                        (nb, F.concat(F.lit("notional_"), wl)),
                        (cb, F.concat(F.lit("symbol_concentration_"), wl)))
    reason = first_true(
        (r, F.concat(F.lit("Order rate breach: "), F.col("order_count").cast("string"),
                     F.lit(" orders in "), wl)),
        (nb, F.concat(F.lit("Notional breach: $"), money_text("total_notional"), F.lit(" in "), wl)),
        (cb, F.concat(F.lit("Symbol concentration breach: "),
                      percent_text("top_count", "symbol_orders"), F.lit("% in "),
                      F.col("top_symbol"))))
    value = first_true((r, F.col("order_count").cast("double")), (nb, F.col("total_notional")),
                       (cb, F.col("top_symbol_share")))
    start_ms = F.unix_millis("window_start")
    return (b.withColumn("scope", account_scope("account_id"))
            .withColumn("metric", metric)
            .select(stable_id(F.lit(ACTION_KILL), "scope", start_ms, "metric").alias("cmd_id"),
                    "ts", "scope", F.lit(ACTION_KILL).alias("action"), reason.alias("reason"),
                    F.lit(TRIGGERED_BY_DETECTOR).alias("triggered_by"), "metric",
                    value.alias("value"),
                    stable_id(F.lit("corr"), "scope", start_ms, wl).alias("corr_id"),
                    wl.alias("window_label")))


def decision_audit(decisions: DataFrame, decision: str, reason: str, status: str) -> DataFrame:
    """Audit records of the orders that throttling or duplicate detection
    stopped, in the columns of the gate's audit."""
    return (decisions.filter(F.col("decision") == decision)
            .select("ts", "decision", "order_id", "account_id", "symbol",
                    F.array(account_scope("account_id")).alias("scope_matches"),
                    F.lit(status).alias("killswitch_status"), F.lit(reason).alias("reason"),
                    stable_id(F.lit("audit"), "order_id").alias("corr_id"),
                    F.lit(ROUTER_SERVICE).alias("service")))


def throttle_policy(commands: DataFrame) -> DataFrame:
    """(scope, max_rate_per_second) of the scopes that are THROTTLED now: those
    whose newest command is a THROTTLE, with its value as the rate."""
    latest = (commands.filter(status_of("action").isNotNull() & F.col("scope").isNotNull()).groupBy("scope")
              .agg(F.max_by(F.struct("action", "value"), F.struct("ts", "cmd_id")).alias("c")))
    return (latest.filter((F.col("c.action") == ACTION_THROTTLE) & F.col("c.value").isNotNull())
            .select("scope", F.col("c.value").cast("int").alias("max_rate_per_second")))


# -- EXT-2: throttling ---------------------------------------------------------------

def throttle_decisions(orders: DataFrame, policy: DataFrame,
                       max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Orders of a THROTTLED account scope pass only while fewer than
    ``max_rate_per_second`` earlier orders of that scope fell in the same
    second (order: ts, order id); the rest are THROTTLED.

    The first-n selection is ``row_number() <= n`` with a literal bound, which
    Spark executes as a partial per-task group limit before the shuffle, so a
    hot (scope, second) ships at most n rows per task. Orders are then
    compared with the per-second cut-off (the n-th passing order): through a
    broadcast of the cut-off table when its measured size is under
    ``max_broadcast_bytes`` (one pass over the orders), else by a shuffle of
    the throttled scopes' orders only.
    """
    pol = sized_broadcast(policy.select("scope", "max_rate_per_second").checkpoint(),
                          max_broadcast_bytes)
    bound = pol.agg(F.max("max_rate_per_second")).first()[0] or 0
    o = (orders.withColumn("_scope", account_scope("account_id"))
         .withColumn("_sec", F.floor(F.col("ts") / 1000).cast("bigint"))
         .join(pol, F.col("_scope") == pol.scope, "left").drop("scope"))
    out_cols = ["order_id", "ts", "account_id", "symbol", "max_rate_per_second"]
    limited = o.filter(F.col("max_rate_per_second").isNotNull())
    w = Window.partitionBy("_scope", "_sec").orderBy("ts", "order_id")
    passing = (limited.withColumn("_rn", F.row_number().over(w))
               .filter(F.col("_rn") <= F.lit(int(bound)))
               .filter(F.col("_rn") <= F.col("max_rate_per_second")))
    # One row per throttled (scope, second) that has orders, written once.
    cut = (passing.groupBy("_scope", "_sec")
           .agg(F.max(F.struct("ts", "order_id")).alias("_cut"))).checkpoint()
    mine = F.struct("ts", "order_id")
    passes = F.col("_cut").isNotNull() & (mine <= F.col("_cut"))
    flat = cut.select("_scope", "_sec", "_cut.ts", "_cut.order_id")
    if (flat.agg(F.sum(row_bytes(flat))).first()[0] or 0) <= max_broadcast_bytes:
        # Small cut-off table: every order is decided in one pass, no shuffle.
        return (o.join(F.broadcast(cut), ["_scope", "_sec"], "left")
                .select(*out_cols, F.when(F.col("max_rate_per_second").isNull() | passes,
                                          F.lit(DECISION_ALLOW))
                        .otherwise(F.lit(DECISION_THROTTLED)).alias("decision")))
    # Large: orders of unthrottled scopes pass without any shuffle; only the
    # throttled scopes' orders meet the cut-off table.
    free = (o.filter(F.col("max_rate_per_second").isNull())
            .select(*out_cols, F.lit(DECISION_ALLOW).alias("decision")))
    decided = (limited.join(cut, ["_scope", "_sec"], "left")
               .select(*out_cols, F.when(passes, F.lit(DECISION_ALLOW))
                       .otherwise(F.lit(DECISION_THROTTLED)).alias("decision")))
    return free.unionByName(decided)


# -- EXT-3: duplicates -----------------------------------------------------------------

#: Orders of an id up to which its memory is followed in a window of the id.
SHORT = 64


def duplicate_decisions(orders: DataFrame, id_col: str, memory_ms: int = 3_600_000, keep: tuple[str, ...] = ()) -> DataFrame:
    """An id is remembered for ``memory_ms`` from the order that put it in
    memory: a conditional write with an expiry. An order is DUPLICATE while
    its id is remembered; the first one after the expiry is NEW and is
    remembered in turn. Ties at one instant are ordered by order id.
    ``prev_seen_ts`` is the time of the order that is remembered. An order
    without an id cannot be recognised and is NEW; one without a time is
    NEW and remembers nothing.

    The orders are written once, only what the result needs of them. Ids of at most
    ``SHORT`` orders are decided in a window of the id: one shuffle of the orders. No
    task holds an id that repeats more often (see ``_decided_by_times``)."""
    out = ["order_id", "client_order_id", "ts", "account_id", *keep]
    spark, path = orders.sparkSession, state_dir(orders.sparkSession, f"duplicates-{uuid.uuid4().hex[:12]}")
    needed = orders.select("order_id", F.col(id_col).alias("client_order_id"), "ts", "account_id", *keep)
    needed.write.parquet(path)
    rows = spark.read.schema(needed.schema).parquet(path)
    is_known = F.col("client_order_id").isNotNull() & F.col("ts").isNotNull()
    known, rest = rows.filter(is_known), rows.filter(~is_known)
    often = (known.groupBy("client_order_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHORT).select("client_order_id")).checkpoint()
    if often.isEmpty():
        decided = _decided_in_window(known, memory_ms)
    else:
        often = sized_broadcast(often, MAX_BROADCAST_BYTES)
        decided = (_decided_in_window(known.join(often, "client_order_id", "left_anti"), memory_ms)
                   .unionByName(_decided_by_times(known.join(often, "client_order_id", "left_semi"), memory_ms)))
    named = decided.select(*out, F.when(~F.col("_new"), F.col("_seen")).alias("prev_seen_ts"),
                           F.when(F.col("_new"), F.lit(DECISION_NEW)).otherwise(F.lit(DECISION_DUPLICATE)).alias("decision"))
    return named.unionByName(rest.select(*out, F.lit(None).cast("bigint").alias("prev_seen_ts"), F.lit(DECISION_NEW).alias("decision")))


def _decided_in_window(known: DataFrame, memory_ms: int) -> DataFrame:
    """Adds ``_seen``, the time that an order's id is remembered from, and ``_new``: each
    order goes through the times of its id, of which there are few."""
    mine = Window.partitionBy("client_order_id").orderBy("ts", F.asc_nulls_last("order_id"))
    whole = mine.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = known.withColumns({"_times": F.array_sort(F.collect_set(F.col("ts").cast("bigint")).over(whole)), "_before": F.lag("ts").over(mine)})
    seen = F.aggregate("_times", F.lit(None).cast("bigint"), lambda start, t: F.when(
        (t <= F.col("ts")) & (start.isNull() | (t - start >= memory_ms)), t).otherwise(start))
    first = F.col("_before").isNull() | (F.col("_before") != F.col("ts"))
    return d.withColumn("_seen", seen).withColumn("_new", first & (F.col("_seen") == F.col("ts"))).drop("_times", "_before")


def _decided_by_times(known: DataFrame, memory_ms: int) -> DataFrame:
    """``_decided_in_window`` for ids that repeat often.

    Decided are the distinct times of each id, in windows of (id, memory-wide
    bucket): no task holds an id, however often it repeats. A time
    ``memory_ms`` or more after the one before always opens a memory. Where an id
    repeats without such a pause, the openers are the times that ``_openers`` reaches
    by pointer jumping. Orders then meet their time's opener by (id, time)."""
    bucket = F.floor(F.col("ts") / F.lit(memory_ms)).cast("bigint")
    times = (known.groupBy(F.col("client_order_id").alias("id"), "ts").agg(F.min("order_id").alias("first"))).checkpoint()
    d = neighbour_in_key(times, "id", ["ts"], bucket, ["ts"], "prev", "_before")
    pause = F.col("_before.ts").isNull() | (F.col("ts") - F.col("_before.ts") >= memory_ms)
    d = d.withColumn("_opens", F.when(pause, F.col("ts"))).drop("_before")
    d = nearest_non_null_in_key(d, "id", ["ts"], bucket, "_opens", "_start", "prev").checkpoint()
    late = d.filter(F.col("ts") - F.col("_start") >= memory_ms)
    if not late.isEmpty():
        found = _openers(late, memory_ms)
        d = (d.join(found.select("id", F.col("t").alias("ts"), F.lit(True).alias("_jumped")), ["id", "ts"], "left")
             .withColumn("_opens", F.when(F.col("_jumped"), F.col("ts")).otherwise(F.col("_opens"))).drop("_jumped", "_start"))
        d = nearest_non_null_in_key(d, "id", ["ts"], bucket, "_opens", "_start", "prev")
    seen = d.select(F.col("id").alias("_id"), F.col("ts").alias("_ts"), "first", F.col("_start").alias("_seen"))
    j = known.join(seen, (F.col("client_order_id") == F.col("_id")) & (F.col("ts") == F.col("_ts")))
    # at an opener's time the order with the least id is new; of equal rows, one
    may_open = (F.col("_seen") == F.col("ts")) & F.col("order_id").eqNullSafe(F.col("first"))
    rank = F.row_number().over(Window.partitionBy("_id", "_ts").orderBy("order_id"))
    heads = j.filter(may_open).withColumn("_new", rank == 1)
    return heads.unionByName(j.filter(~may_open).withColumn("_new", F.lit(False))).drop("_id", "_ts", "first")


def _openers(late: DataFrame, memory_ms: int) -> DataFrame:
    """(id, t): the openers of runs without a pause, from their late times (id, ts, _start).

    Each time points to the first of its id at least ``memory_ms`` on; the openers are
    what a run's start leads to. Pointers double each round, so the rounds grow with
    the logarithm of the longest run; every round is written. Rows meet by (id, time)."""
    nodes = late.select("id", F.col("ts").alias("t")).unionByName(late.select("id", F.col("_start").alias("t")).distinct())
    probes = nodes.select("id", (F.col("t") + memory_ms).alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("time"), "t")
    times = late.select("id", F.col("ts").alias("at"), F.lit(1).alias("kind"), F.col("ts").alias("time"), F.lit(None).cast("bigint").alias("t"))
    ahead = next_non_null_in_key(probes.unionByName(times), "id", ["at", "kind"], F.floor(F.col("at") / F.lit(memory_ms)).cast("bigint"), "time", "next")
    jumps = ahead.filter("kind = 0 and next is not null").select("id", "t", "next").checkpoint()
    found = late.select("id", F.col("_start").alias("t")).distinct().checkpoint()
    known = found.count()
    while True:
        reached = found.join(jumps, ["id", "t"]).select("id", F.col("next").alias("t"))
        found = found.unionByName(reached).distinct().checkpoint()
        before, known = known, found.count()
        if known == before:
            return found
        further = jumps.select("id", F.col("t").alias("next"), F.col("next").alias("far"))
        jumps = jumps.join(further, ["id", "next"]).select("id", "t", F.col("far").alias("next")).checkpoint()


# -- EXT-5: automatic unkill after a calm period ----------------------------------------

def auto_unkill_commands(breach_signals: DataFrame, activations: DataFrame,
                         cooldown_ms: int, bucket_ms: int = 86_400_000,
                         held: DataFrame | None = None) -> DataFrame:
    """UNKILL for a detector kill once its account has been calm for
    ``cooldown_ms``: breach windows closer than the cooldown form one
    episode; the unkill falls at episode end + cooldown. An activation that
    ended earlier (operator action) is not auto-released (override), nor is
    any of a scope in ``held`` (column ``scope``): there an operator decides."""
    bw = breach_signals.select("account_id", F.unix_millis("window_start").alias("w_start"),
                               F.unix_millis("window_end").alias("w_end"))
    nxt = neighbour_in_key(bw, "account_id", ["w_start"],
                           F.floor(F.col("w_start") / bucket_ms).cast("bigint"),
                           ["w_start"], "next", "_nx")
    marked = nxt.withColumn("_end_mark", F.when(
        F.col("_nx.w_start").isNull() | (F.col("_nx.w_start") - F.col("w_end") >= cooldown_ms),
        F.col("w_end")))
    ep = next_non_null_in_key(marked, "account_id", ["w_start"],
                              F.floor(F.col("w_start") / bucket_ms).cast("bigint"),
                              "_end_mark", "episode_end")
    ep = ep.select(F.concat(F.lit("ACCOUNT:"), F.col("account_id")).alias("scope"),
                   F.col("w_end").alias("kill_ts"), "episode_end")
    act = activations.filter(F.col("updated_by") == TRIGGERED_BY_DETECTOR)
    j = act.join(ep, ["scope", "kill_ts"], "inner")
    if held is not None:
        j = j.join(held.select("scope").distinct(), "scope", "left_anti")
    release = F.col("episode_end") + F.lit(cooldown_ms)
    j = j.filter(F.col("unkill_ts").isNull() | (F.col("unkill_ts") >= release))
    return j.select(stable_id(F.lit("auto"), "kill_cmd_id").alias("cmd_id"),
                    release.alias("ts"), "scope", F.lit(ACTION_UNKILL).alias("action"),
                    F.lit(REASON_AUTO_UNKILL).alias("reason"),
                    F.lit(TRIGGERED_BY_DETECTOR).alias("triggered_by"),
                    F.lit(None).cast("string").alias("metric"),
                    F.lit(None).cast("double").alias("value"),
                    stable_id(F.lit("autocorr"), "kill_cmd_id").alias("corr_id")
                    ).select(*COMMAND_COLUMNS)
