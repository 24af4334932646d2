"""Threshold breaches and kill commands (pure projections / filters)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (ACTION_KILL, METRIC_CONCENTRATION, METRIC_NOTIONAL, METRIC_RATE,
                                 TRIGGERED_BY_DETECTOR, account_scope, first_true, money_text,
                                 percent_text, stable_id)
from ..params import DEFAULT_PARAMS, RiskParams

BREACH_FLAGS = ["order_rate_breach", "notional_breach", "concentration_breach"]


def flag_breaches(signals: DataFrame, params: RiskParams = DEFAULT_PARAMS,
                  label: str = "symbol") -> DataFrame:
    """Adds the three strict ``>`` breach flags."""
    return signals.withColumns({
        "order_rate_breach": F.col("order_count") > F.lit(params.max_orders),
        "notional_breach": F.coalesce(F.col("total_notional") > F.lit(float(params.max_notional)),
                                      F.lit(False)),
        "concentration_breach": (F.col(f"top_{label}_share") > F.lit(float(params.max_share)))
                                & (F.col("order_count") >= F.lit(params.min_orders)),
    })


def breaches(signals: DataFrame, params: RiskParams = DEFAULT_PARAMS,
             label: str = "symbol") -> DataFrame:
    """Signal rows with at least one breach."""
    f = flag_breaches(signals, params, label)
    return f.filter(F.col("order_rate_breach") | F.col("notional_breach")
                    | F.col("concentration_breach"))


def commands_from_breaches(breach_rows: DataFrame, params: RiskParams = DEFAULT_PARAMS,
                           scope=None, key_col: str = "account_id",
                           label: str = "symbol") -> DataFrame:
    """Breach rows -> KILL commands.

    Precedence rate > notional > concentration for reason, metric and value.
    Ids are deterministic (scope, window start, width, metric) so a replayed
    window yields the same command and detectors of different widths never
    collide; ``corr_id`` names the (scope, window start, width) alone.
    Rate and notional metrics carry the width (``order_rate_60s``).
    ``breached_metrics`` lists every breached metric.
    """
    rate, notional, conc = (F.col(x) for x in BREACH_FLAGS)
    scope_col = account_scope(key_col) if scope is None else scope
    wlabel = params.window_label
    reason = first_true(
        (rate, F.concat(F.lit("Order rate breach: "), F.col("order_count").cast("string"),
                        F.lit(f" orders in {wlabel}"))),
        (notional, F.concat(F.lit("Notional breach: $"), money_text("total_notional"),
                            F.lit(f" in {wlabel}"))),
        (conc, F.concat(F.lit("Symbol concentration breach: "),
                        percent_text("top_count", f"{label}_orders"), F.lit("% in "),
                        F.col(f"top_{label}"))),
    )
    rate_metric, notional_metric = (F.lit(f"{m}_{wlabel}") for m in (METRIC_RATE, METRIC_NOTIONAL))
    metric = first_true((rate, rate_metric), (notional, notional_metric),
                        (conc, F.lit(METRIC_CONCENTRATION)))
    value = first_true((rate, F.col("order_count").cast("double")),
                       (notional, F.col("total_notional").cast("double")),
                       (conc, F.col(f"top_{label}_share").cast("double")))
    start_ms = F.unix_millis(F.col("window_start"))
    out = breach_rows.withColumns({"scope": scope_col, "metric": metric})
    return out.select(
        stable_id(F.lit(ACTION_KILL), F.col("scope"), start_ms, F.lit(wlabel), F.col("metric")).alias("cmd_id"),
        F.col("ts"), F.col("scope"), F.lit(ACTION_KILL).alias("action"), reason.alias("reason"),
        F.lit(TRIGGERED_BY_DETECTOR).alias("triggered_by"), F.col("metric"), value.alias("value"),
        stable_id(F.lit("corr"), F.col("scope"), start_ms, F.lit(wlabel)).alias("corr_id"),
        F.array_compact(F.array(
            F.when(rate, rate_metric), F.when(notional, notional_metric),
            F.when(conc, F.lit(METRIC_CONCENTRATION)))).alias("breached_metrics"))


def kill_commands(signals: DataFrame, params: RiskParams = DEFAULT_PARAMS) -> DataFrame:
    """signals -> breaches -> KILL commands on ``ACCOUNT:<id>``."""
    return commands_from_breaches(breaches(signals, params), params)
