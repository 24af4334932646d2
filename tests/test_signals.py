from pyspark.sql import functions as F

from conftest import ms, orders_df
from haltgate.operators.breaches import breaches, flag_breaches, kill_commands
from haltgate.operators.signals import risk_signals
from haltgate.params import RiskParams


def test_three_rows_give_two_windows(spark):
    o = orders_df(spark, [
        ("a", ms(10, 0, 0), "1", "AAPL", "BUY", 10, 100.0, "ALGO_X"),
        ("b", ms(10, 0, 30), "1", "AAPL", "BUY", 10, 100.0, "ALGO_X"),
        ("c", ms(10, 1, 30), "1", "MSFT", "BUY", 10, 100.0, "ALGO_X"),
    ])
    rows = risk_signals(o).orderBy("window_start").collect()
    assert [r.order_count for r in rows] == [2, 1]
    assert rows[0].total_notional == 2000.0 and rows[0].avg_notional == 1000.0


def test_top_symbol_is_most_frequent_and_max_symbol_alphabetical(spark):
    o = orders_df(spark, [
        ("a", ms(10, 0, 1), "1", "AAPL", "BUY", 1, 1.0, "X"),
        ("b", ms(10, 0, 2), "1", "AAPL", "BUY", 1, 1.0, "X"),
        ("c", ms(10, 0, 3), "1", "MSFT", "BUY", 1, 1.0, "X"),
        ("d", ms(10, 0, 4), "1", "AAPL", "BUY", 1, 1.0, "X"),
    ])
    r = risk_signals(o).first()
    assert r.top_symbol == "AAPL" and r.max_symbol == "MSFT"
    assert r.top_symbol_share == 0.75 and r.unique_symbols == 2


def test_top_symbol_tie_prefers_larger_name(spark):
    o = orders_df(spark, [
        ("a", ms(10, 0, 1), "1", "AAPL", "BUY", 1, 1.0, "X"),
        ("b", ms(10, 0, 2), "1", "TSLA", "BUY", 1, 1.0, "X"),
    ])
    assert risk_signals(o).first().top_symbol == "TSLA"


def _sig(spark, count, notional, top, sym_orders):
    return spark.createDataFrame(
        [("1", count, float(notional), top / sym_orders, top, sym_orders)],
        "account_id string, order_count bigint, total_notional double, top_symbol_share double, "
        "top_count bigint, symbol_orders bigint")


def test_strict_thresholds(spark):
    p = RiskParams()
    f = lambda df: flag_breaches(df, p).first()
    assert not f(_sig(spark, 100, 1, 1, 100)).order_rate_breach
    assert f(_sig(spark, 101, 1, 1, 101)).order_rate_breach
    assert not f(_sig(spark, 1, 1_000_000.0, 1, 10)).notional_breach
    assert f(_sig(spark, 1, 1_000_000.01, 1, 10)).notional_breach
    assert not f(_sig(spark, 10, 1, 7, 10)).concentration_breach
    assert f(_sig(spark, 4, 1, 3, 4)).concentration_breach


def test_precedence_and_reason_text(spark):
    p = RiskParams(max_orders=2, max_notional=100.0)
    o = orders_df(spark, [(str(i), ms(10, 0, i), "7", "AAPL", "BUY", 10, 50.0, "X") for i in range(3)])
    c = kill_commands(risk_signals(o, p), p).first()
    assert c.metric == "order_rate_60s" and c.value == 3.0
    assert c.reason == "Order rate breach: 3 orders in 60s"
    assert c.scope == "ACCOUNT:7" and c.action == "KILL" and c.triggered_by == "spark"
    assert sorted(c.breached_metrics) == ["notional_60s", "order_rate_60s", "symbol_concentration"]


def test_concentration_reason_uses_exact_percent(spark):
    p = RiskParams(max_orders=100, max_notional=1e12, max_share=0.6)
    rows = [(str(i), ms(10, 0, i), "7", "AAPL" if i < 2 else "MSFT", "BUY", 1, 1.0, "X") for i in range(3)]
    c = kill_commands(risk_signals(orders_df(spark, rows), p), p).first()
    assert c.reason == "Symbol concentration breach: 66.67% in AAPL"


def test_single_order_window_breaches_by_default_and_min_orders_guards(spark):
    o = orders_df(spark, [("a", ms(10, 0, 0), "1", "AAPL", "BUY", 1, 1.0, "X")])
    assert breaches(risk_signals(o)).count() == 1
    p = RiskParams(min_orders=2)
    assert breaches(risk_signals(o, p), p).count() == 0


def test_command_ids_are_deterministic(spark):
    p = RiskParams(max_orders=0)
    o = orders_df(spark, [("a", ms(10, 0, 0), "1", "AAPL", "BUY", 1, 1.0, "X")])
    a = kill_commands(risk_signals(o, p), p).first()
    b = kill_commands(risk_signals(o.repartition(3), p), p).first()
    assert a.cmd_id == b.cmd_id and len(a.cmd_id) == 64


def test_burst_rate_breach_kills_then_drops(spark):
    from haltgate.operators.gate import gate_asof
    from haltgate.operators.state import state_records
    burst = [(f"b{i}", ms(10, 0, 0, i * 20), "12345", "AAPL", "BUY", 600, 150.0, "ALGO_X")
             for i in range(3000)]  # 50 per second for 60 s
    later = [("after", ms(10, 2, 0), "12345", "AAPL", "BUY", 1, 1.0, "ALGO_X"),
             ("other", ms(10, 2, 0), "67890", "AAPL", "BUY", 1, 1.0, "ALGO_X")]
    o = orders_df(spark, burst + later)
    cmds = kill_commands(risk_signals(o))
    assert cmds.filter(F.col("metric") == "order_rate_60s").count() == 1
    audit = gate_asof(o.filter(F.col("order_id").isin("after", "other")),
                      state_records(cmds.drop("breached_metrics")))
    got = {r.order_id: r.decision for r in audit.collect()}
    assert got == {"after": "DROP", "other": "ALLOW"}


def test_notional_of_sub_cent_prices_is_exact(spark):
    o = orders_df(spark, [(str(i), ms(10, 0, 1), "1", "A", "BUY", 1, 0.004, "X") for i in range(1000)])
    s = risk_signals(o, RiskParams()).first()
    assert s.total_notional == 4.0 and s.avg_notional == 0.004
    c = kill_commands(risk_signals(o, RiskParams()), RiskParams(max_orders=10**6, max_notional=3.5, max_share=1.0)).collect()
    assert [x.metric for x in c] == ["notional_60s"]


def test_ids_and_metrics_carry_the_window(spark):
    o = orders_df(spark, [("a", ms(0, 0, 0), "1", "A", "BUY", 1, 1.0, "X")])
    cmds = [kill_commands(risk_signals(o, p), p).first() for p in (RiskParams(max_orders=0), RiskParams(window="1 day", max_orders=0))]
    assert [c.metric for c in cmds] == ["order_rate_60s", "order_rate_86400s"]
    assert cmds[0].cmd_id != cmds[1].cmd_id and cmds[0].corr_id != cmds[1].corr_id
