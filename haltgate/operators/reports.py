"""Reports over the audit trail, the command log and the state snapshot:
counters, per-bin counts, drop statistics, recent rows, key lookups, log-line
parsing, correlation traces and kill-activation attribution.

All aggregations are algebraic (count / count_if / sum / max) or a
bounded quantile sketch; top-n reports sort globally and take n rows (Spark plans
``TakeOrderedAndProject``: a per-task top-n, then a merge of n-row lists).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import DECISION_ALLOW, DECISION_DROP, normalise_epoch_ms, short_id
from .gate import FANOUT, MAX_BROADCAST_BYTES, IntervalIndex
from .state import latest_by_key


def _window_start(ts_ms: str, width: str) -> Column:
    return F.window(F.timestamp_millis(F.col(ts_ms)), width).start


def router_counters(audit: DataFrame, rejected_orders: DataFrame, snapshot: DataFrame) -> DataFrame:
    """AGG-9: processed / allowed / dropped / errors / known scopes, in one
    aggregation over the three inputs tagged and unioned (no join)."""
    kind = F.col("kind")
    rows = (audit.select(F.col("decision").alias("kind"))
            .unionByName(rejected_orders.select(F.lit("ERROR").alias("kind")))
            .unionByName(snapshot.select(F.lit("SCOPE").alias("kind"))))
    return rows.agg(
        F.count_if(kind.isin(DECISION_ALLOW, DECISION_DROP)).alias("orders_processed"),
        F.count_if(kind == DECISION_ALLOW).alias("orders_allowed"),
        F.count_if(kind == DECISION_DROP).alias("orders_dropped"),
        F.count_if(kind == "ERROR").alias("errors"),
        F.count_if(kind == "SCOPE").alias("kill_state_scopes"))


def aggregator_counters(commands: DataFrame) -> DataFrame:
    """AGG-10: commands processed (including ignored unknown actions) and
    errors (records missing a required field)."""
    bad = F.col("cmd_id").isNull() | F.col("scope").isNull() | F.col("action").isNull()
    return commands.agg(
        F.count_if(~bad).alias("commands_processed"),
        F.count_if(bad).alias("errors"),
        F.count_if(~bad & ~F.col("action").isin("KILL", "UNKILL")).alias("ignored_actions"))


def dashboard_totals(audit: DataFrame) -> DataFrame:
    """AGG-11: distinct orders, allowed and dropped, over the same rows."""
    return audit.agg(F.count_distinct("order_id").alias("total_orders"),
                     F.count_if(F.col("decision") == DECISION_ALLOW).alias("allowed"),
                     F.count_if(F.col("decision") == DECISION_DROP).alias("dropped"))


def drops_by_reason(audit: DataFrame) -> DataFrame:
    """AGG-13."""
    return (audit.filter(F.col("decision") == DECISION_DROP)
            .groupBy("reason").agg(F.count(F.lit(1)).alias("drops")))


def commands_by_scope_action(commands: DataFrame) -> DataFrame:
    """AGG-14: kill-switch activations by scope and action."""
    return commands.groupBy("scope", "action").agg(F.count(F.lit(1)).alias("commands"))


def orders_per_bin(audit: DataFrame, width: str = "5 minutes") -> DataFrame:
    """AGG-15: orders per time bin."""
    return (audit.groupBy(_window_start("ts", width).alias("bin_start"))
            .agg(F.count(F.lit(1)).alias("orders")))


def decisions_per_bin(audit: DataFrame, width: str = "1 minute") -> DataFrame:
    """AGG-16: decisions per bin."""
    return (audit.groupBy("decision", _window_start("ts", width).alias("bin_start"))
            .agg(F.count(F.lit(1)).alias("orders")))


def drop_age_stats(audit: DataFrame, width: str = "5 minutes", accuracy: int = 10_000) -> DataFrame:
    """AGG-17 (re-aimed): per bin, avg / max / p99 of the time from the kill
    to each order it dropped (ms).

    p99 is ``percentile_approx``: a mergeable quantile sketch whose memory
    per bin is bounded by ``accuracy`` whatever the bin's size (an exact
    percentile would hold every distinct value of a hot bin in one task). It
    returns an observed value with rank error at most n / ``accuracy``, and
    is exact while a bin holds fewer than about ``accuracy`` / 2 values."""
    d = (audit.filter(F.col("decision") == DECISION_DROP)
         .withColumn("age_ms", (F.col("ts") - F.col("kill_ts")).cast("double")))
    return (d.groupBy(_window_start("ts", width).alias("bin_start"))
            .agg(F.avg("age_ms").alias("avg_ms"), F.max("age_ms").alias("max_ms"),
                 F.percentile_approx("age_ms", 0.99, accuracy).alias("p99_ms"),
                 F.count(F.lit(1)).alias("drops")))


def record_counts(audit: DataFrame, states: DataFrame, snapshot: DataFrame,
                  commands: DataFrame) -> DataFrame:
    """AGG-18: one row per table with its record count."""
    def cnt(df, name):
        return df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table"), "records")
    return (cnt(audit, "audit").unionByName(cnt(states, "state_history"))
            .unionByName(cnt(snapshot, "state_snapshot")).unionByName(cnt(commands, "commands")))


def recent_audit(audit: DataFrame, n: int = 50) -> DataFrame:
    """TOP-1: newest n audit rows (ties by order id)."""
    return audit.orderBy(F.col("ts").desc(), F.col("order_id").desc()).limit(n)


def newest_distinct(df: DataFrame, key: str, n: int) -> DataFrame:
    """The newest row of each of the ``n`` keys with the latest ``ts`` (ties:
    larger key; of rows of one key at one instant, the greatest by their
    other columns).

    A cut-off time is found first: the keys' newest times are counted per
    minute, newest minute first, until ``n`` keys are covered. Only rows from
    that minute on are kept and reduced exactly."""
    minute = F.floor(F.col("ts") / 60_000)
    newest = df.groupBy(key).agg(F.max("ts").alias("ts"))
    per_minute = newest.groupBy(minute.alias("m")).agg(F.count(F.lit(1)).alias("k"))
    # at most n minutes are needed: each counted one holds a key
    top = per_minute.orderBy(F.col("m").desc_nulls_last()).limit(n)
    covered = F.sum("k").over(Window.orderBy(F.col("m").desc_nulls_last()))
    cut = (top.withColumn("_c", covered).filter(F.col("_c") - F.col("k") < n)
           .agg(F.min("m").alias("m"), F.count_if(F.col("m").isNull()).alias("nulls")).first())
    late = df if cut.m is None or cut.nulls else df.filter(F.col("ts") >= int(cut.m) * 60_000)
    others = [x for x in df.columns if x not in (key, "ts")]
    return (latest_by_key(late, key, ["ts", *others])
            .orderBy(F.col("ts").desc(), F.col(key).desc()).limit(n).select(*df.columns))


def audit_feed(audit: DataFrame, n: int = 200) -> DataFrame:
    """TOP-2 / PRJ-20,21: newest n orders without repeated order ids,
    rendered for the feed (normalised epoch ms, short id, dashes)."""
    top = newest_distinct(audit.select("order_id", "ts", "account_id", "symbol", "side", "qty",
                                       "decision", "reason"), "order_id", n)
    return top.select(
        normalise_epoch_ms("ts").alias("ts_ms"),
        short_id("order_id").alias("order_short"),
        "order_id",
        F.coalesce(F.col("account_id"), F.lit("-")).alias("account_id"),
        F.coalesce(F.col("symbol"), F.lit("-")).alias("symbol"),
        F.coalesce(F.col("side"), F.lit("-")).alias("side"),
        F.coalesce(F.col("qty").cast("string"), F.lit("-")).alias("qty"),
        "decision", "reason")


def recent_drops(audit: DataFrame, n: int = 20) -> DataFrame:
    """TOP-3: newest n dropped orders."""
    return recent_audit(audit.filter(F.col("decision") == DECISION_DROP), n)


def audit_for_order(audit: DataFrame, order_id: str) -> DataFrame:
    """KEY-1."""
    return audit.filter(F.col("order_id") == order_id)


def audit_for_account(audit: DataFrame, account_id: str) -> DataFrame:
    """KEY-2: time-ordered rows of one account."""
    return audit.filter(F.col("account_id") == account_id).orderBy("ts", "order_id")


def dropped_orders(audit: DataFrame, n: int = 100) -> DataFrame:
    """KEY-3: dropped orders, first n in (ts, order id) order."""
    return audit.filter(F.col("decision") == DECISION_DROP).orderBy("ts", "order_id").limit(n)


def state_for_scope(snapshot: DataFrame, scope: str) -> DataFrame:
    """KEY-4."""
    return snapshot.filter(F.col("scope") == scope)


def router_log_lines(audit: DataFrame) -> DataFrame:
    """Router log lines as the reference prints them."""
    return audit.select(
        "ts",
        F.when(F.col("decision") == DECISION_DROP,
               F.concat(F.lit("DROPPED order "), F.col("order_id"), F.lit(": "), F.col("reason")))
         .otherwise(F.concat(F.lit("decision: "), F.col("decision"), F.lit(" order "),
                             F.col("order_id"))).alias("message"))


def parse_drop_lines(lines: DataFrame) -> DataFrame:
    """PRJ-23: ``filter like /DROPPED/ | parse 'DROPPED order * : *'`` then
    count by reason."""
    pat = r"(?s)^DROPPED order (\S+) ?: (.*)$"  # a reason may span lines
    return (lines.filter(F.col("message").rlike(pat))
            .select(F.regexp_extract("message", pat, 1).alias("order_id"),
                    F.regexp_extract("message", pat, 2).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("drops")))


def correlation_trace(commands: DataFrame, snapshot: DataFrame, audit: DataFrame) -> DataFrame:
    """JOIN-7: command -> current state it produced -> orders it dropped."""
    drops = (audit.filter(F.col("decision") == DECISION_DROP)
             .groupBy(F.col("kill_cmd_id").alias("cmd_id"))
             .agg(F.count(F.lit(1)).alias("orders_dropped"), F.min("ts").alias("first_drop_ts"),
                  F.max("ts").alias("last_drop_ts")))
    st = snapshot.select(F.col("last_cmd_id").alias("cmd_id"), F.col("status").alias("state_status"),
                         F.col("corr_id").alias("state_corr_id"))
    return (commands.select("cmd_id", "ts", "scope", "action", "corr_id")
            .join(st, "cmd_id", "left").join(drops, "cmd_id", "left")
            .withColumn("orders_dropped", F.coalesce(F.col("orders_dropped"), F.lit(0))))


def drops_by_activation(audit: DataFrame, intervals: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                        fanout: int = FANOUT) -> DataFrame:
    """JOIN-8: dropped orders attributed to the kill activation whose
    [kill_ts, unkill_ts) contains them, on the killing scope.

    A drop names the state record that killed it (``kill_scope``, record
    time ``kill_ts``): the newest record of that scope at or before the
    order, so it lies in the same activation as the order. Drops are
    counted per killing record first (map-side partial counts: a hot kill
    is pre-combined per task, at most one row per state record leaves the
    order side); only those counts meet the activations, in a range join
    through ``IntervalIndex`` with a size-checked broadcast. Activations
    without drops get 0."""
    per_record = (audit.filter(F.col("decision") == DECISION_DROP)
                  .groupBy("kill_scope", F.col("kill_ts").alias("rec_ts"))
                  .agg(F.count(F.lit(1)).alias("_n")))
    intervals = intervals.checkpoint()  # read twice below
    iv = intervals.select("scope", "kill_cmd_id", F.col("kill_ts").alias("valid_from"),
                          F.col("unkill_ts").alias("valid_to"))
    index = IntervalIndex(iv, max_broadcast_bytes, fanout)
    side = index.side()
    d = index.with_leaf(per_record, F.col("kill_scope"), F.col("rec_ts"), "_leaf")
    cond = ((d.kill_scope == side.scope) & (d._leaf == side.leaf)
            & (side.valid_from <= d.rec_ts)
            & (side.valid_to.isNull() | (d.rec_ts < side.valid_to)))
    per = (d.join(side, cond, "inner").groupBy("kill_cmd_id")
           .agg(F.sum("_n").alias("orders_dropped")))
    return (intervals.select("scope", "kill_ts", "unkill_ts", "duration_ms", "reason", "kill_cmd_id")
            .join(per, "kill_cmd_id", "left")
            .withColumn("orders_dropped", F.coalesce(F.col("orders_dropped"), F.lit(0))))


def daily_kill_report(activations: DataFrame) -> DataFrame:
    """EXT-7: per day, scope and reason: activations, dropped orders and total
    KILLED duration (open activations count as still running: null)."""
    return (activations
            .groupBy(F.to_date(F.timestamp_millis("kill_ts")).alias("day"), "scope", "reason")
            .agg(F.count(F.lit(1)).alias("activations"),
                 F.sum("orders_dropped").alias("orders_dropped"),
                 F.sum("duration_ms").alias("killed_ms")))
