from pyspark.sql import functions as F

from conftest import ms, orders_df
from haltgate.operators.extensions import (duplicate_decisions, multi_window_commands,
                                           symbol_kill_commands, throttle_decisions)
from haltgate.params import RiskParams


def test_symbol_kill(spark):
    p = RiskParams(max_orders=3, max_notional=1e12, max_share=1.0)
    o = orders_df(spark, [(str(i), ms(10, 0, i), str(i), "AAPL", "BUY", 1, 1.0, "X") for i in range(4)])
    c = symbol_kill_commands(o, p).first()
    assert c.scope == "SYMBOL:AAPL" and c.metric == "order_rate_60s"


def test_throttle_first_n_per_second(spark):
    o = orders_df(spark, [(f"o{i}", 1000 + i, "1", "A", "BUY", 1, 1.0, "X") for i in range(5)]
                  + [("p", 1000, "2", "A", "BUY", 1, 1.0, "X")])
    pol = spark.createDataFrame([("ACCOUNT:1", 2)], "scope string, max_rate_per_second int")
    got = {r.order_id: r.decision for r in throttle_decisions(o, pol).collect()}
    assert got == {"o0": "ALLOW", "o1": "ALLOW", "o2": "THROTTLED", "o3": "THROTTLED",
                   "o4": "THROTTLED", "p": "ALLOW"}


def test_throttle_broadcast_and_shuffled_cutoffs_agree(spark):
    import random
    rnd = random.Random(4)
    rows = [(f"o{i:04d}", rnd.randrange(0, 20_000), str(rnd.randrange(6)), "A", "BUY", 1, 1.0, "X")
            for i in range(2000)]
    o = orders_df(spark, rows)
    pol = spark.createDataFrame([("ACCOUNT:0", 3), ("ACCOUNT:1", 1), ("ACCOUNT:2", 50)],
                                "scope string, max_rate_per_second int")
    small = {r.order_id: r.decision for r in throttle_decisions(o, pol).collect()}
    large = {r.order_id: r.decision for r in throttle_decisions(o, pol, max_broadcast_bytes=0).collect()}
    limits = {"0": 3, "1": 1, "2": 50}
    exp, seen = {}, {}
    for oid, ts, acct, *_ in sorted(rows, key=lambda r: (r[1], r[0])):
        key = (acct, ts // 1000)
        seen[key] = seen.get(key, 0) + 1
        exp[oid] = "ALLOW" if acct not in limits or seen[key] <= limits[acct] else "THROTTLED"
    assert small == exp and large == exp


def test_duplicates_within_memory(spark):
    o = orders_df(spark, [("a", 0, "1", "A", "BUY", 1, 1.0, "X"), ("a", 10, "1", "A", "BUY", 1, 1.0, "X"),
                          ("a", 3_700_000, "1", "A", "BUY", 1, 1.0, "X")])
    got = [r.decision for r in duplicate_decisions(o.withColumn("cid", F.col("order_id")), "cid")
           .orderBy("ts").collect()]
    assert got == ["NEW", "DUPLICATE", "NEW"]


def test_duplicate_memory_is_fixed_from_the_first_sight(spark):
    """Against the fold it stands for; ids repeated without a pause, ties, nulls."""
    import random
    rnd = random.Random(5)
    minute = 60_000
    rows = [("x", t * minute) for t in (0, 50, 100, 101, 160, 161, 161)] + [(None, 0), (None, 5), ("y", None)]
    rows += [(f"id{rnd.randrange(5)}", rnd.randrange(600) * minute) for _ in range(300)]
    o = spark.createDataFrame([(f"o{i:04d}", c, t, "1") for i, (c, t) in enumerate(rows)],
                              "order_id string, cid string, ts bigint, account_id string")
    exp, memory = {}, {}
    for i, (c, t) in sorted(enumerate(rows), key=lambda r: (r[1][1] is None, r[1][1] or 0, r[0])):
        if c is None or t is None or c not in memory or t - memory[c] >= 3_600_000:
            exp[f"o{i:04d}"] = ("NEW", None)
            if c is not None and t is not None:
                memory[c] = t
        else:
            exp[f"o{i:04d}"] = ("DUPLICATE", memory[c])
    got = {r.order_id: (r.decision, r.prev_seen_ts) for r in duplicate_decisions(o, "cid").collect()}
    assert got == exp and [exp[f"o000{i}"][0] for i in range(3)] == ["NEW", "DUPLICATE", "NEW"]


def test_multi_window_any_breach_kills(spark):
    specs = [RiskParams(window="60 seconds", max_orders=5, max_notional=1e12, max_share=1.0),
             RiskParams(window="5 minutes", max_orders=2, max_notional=1e12, max_share=1.0)]
    o = orders_df(spark, [(str(i), ms(10, i, 0), "1", "A", "BUY", 1, 1.0, "X") for i in range(3)])
    got = {r.metric for r in multi_window_commands(o, specs).collect()}
    assert got == {"order_rate_300s"}


def test_throttle_commands_make_a_policy_and_audit_rows(spark):
    from conftest import commands_df
    from haltgate.operators import extensions as X
    cmds = commands_df(spark, [("1", 1, "ACCOUNT:1", "THROTTLE", "r", "op", None, 1.0, "c"),
                               ("2", 2, "ACCOUNT:2", "THROTTLE", "r", "op", None, 5.0, "c"),
                               ("3", 3, "ACCOUNT:2", "UNKILL", "r", "op", None, None, "c")])
    policy = X.throttle_policy(cmds)
    assert [tuple(r) for r in policy.collect()] == [("ACCOUNT:1", 1)]
    o = orders_df(spark, [(f"o{i}", i, a, "A", "BUY", 1, 1.0, "X") for i, a in enumerate("1122")])
    audit = X.decision_audit(X.throttle_decisions(o, policy), "THROTTLED", X.REASON_THROTTLED, "THROTTLED").collect()
    assert [(r.order_id, r.killswitch_status, r.scope_matches) for r in audit] == [("o1", "THROTTLED", ["ACCOUNT:1"])]


def test_throttled_scope_passes_the_gate_and_ends_a_kill(spark):
    from conftest import commands_df
    from haltgate.operators.gate import gate_snapshot
    from haltgate.operators.state import fold_state, kill_intervals, state_records
    states = state_records(commands_df(spark, [("1", 1, "ACCOUNT:1", "KILL", "r", "op", None, None, "c"),
                                               ("2", 9, "ACCOUNT:1", "THROTTLE", "r", "op", None, 1.0, "c")]))
    assert [(r.kill_ts, r.unkill_ts) for r in kill_intervals(states).collect()] == [(1, 9)]
    o = orders_df(spark, [("o", 20, "1", "A", "BUY", 1, 1.0, "X")])
    assert gate_snapshot(o, fold_state(states)).first().decision == "ALLOW"


def test_strategy_scope_is_valid_where_the_router_gates_on_it(spark):
    from haltgate.sources.commands import validate_requests
    df = spark.createDataFrame([("1", 1, "/kill", "STRATEGY:X", None, None)],
                               "request_id string, ts bigint, path string, scope string, reason string, operator string")
    assert [validate_requests(df, s).first().status_code for s in (False, True)] == [400, 200]


def test_duplicates_of_short_and_long_ids_agree(spark, monkeypatch):
    """Ids decided in a window and by their times, with ties, equal rows and nulls."""
    import random
    from haltgate.operators import extensions as X
    rnd = random.Random(11)
    rows = [(f"o{rnd.randrange(60):02d}" if k % 17 else None, f"id{rnd.randrange(12)}" if k % 29 else None,
             rnd.randrange(-200, 400) * 60_000 if k % 31 else None, "1") for k in range(500)]
    o = spark.createDataFrame(rows, "order_id string, cid string, ts bigint, account_id string")
    got = {}
    for short in (10_000, 40, 0):  # all in windows, some, none
        monkeypatch.setattr(X, "SHORT", short)
        got[short] = sorted(map(tuple, duplicate_decisions(o, "cid").collect()), key=str)
    assert got[10_000] == got[40] == got[0] and len(got[0]) == 500


def test_duplicates_shuffle_the_orders_once(spark):
    """Ids that repeat a few times: the orders are written and then dealt by id, nothing else."""
    o = spark.createDataFrame([(f"o{k}", f"c{k // 4}", k * 1_500_000, "1") for k in range(200)], "order_id string, cid string, ts bigint, account_id string")
    plan = duplicate_decisions(o, "cid")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
