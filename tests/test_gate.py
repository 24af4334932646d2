import random

from conftest import commands_df, orders_df
from haltgate.operators.gate import gate_asof, gate_snapshot
from haltgate.operators.state import fold_state, state_records


def _cmd(cid, ts, scope, action, reason="r"):
    return (cid, ts, scope, action, reason, "op", None, None, "corr" + cid)


def test_account_kill_hits_only_that_account(spark):
    snap = fold_state(state_records(commands_df(spark, [_cmd("1", 0, "ACCOUNT:12345", "KILL", "risk")])))
    o = orders_df(spark, [("o1", 10, "12345", "AAPL", "BUY", 1, 1.0, "X"),
                          ("o2", 10, "67890", "AAPL", "BUY", 1, 1.0, "X")])
    got = {r.order_id: r for r in gate_snapshot(o, snap).collect()}
    assert got["o1"].decision == "DROP" and got["o1"].scope_matches == ["ACCOUNT:12345"]
    assert got["o1"].reason == "risk" and got["o1"].killswitch_status == "KILLED"
    assert got["o2"].decision == "ALLOW" and got["o2"].scope_matches == []
    assert got["o2"].reason == "No kill switch active"


def test_scope_order_cuts_after_first_kill(spark):
    st = state_records(commands_df(spark, [_cmd("1", 0, "GLOBAL", "UNKILL"),
                                           _cmd("2", 0, "ACCOUNT:1", "KILL", "acct"),
                                           _cmd("3", 0, "SYMBOL:AAPL", "KILL", "sym")]))
    o = orders_df(spark, [("o", 5, "1", "AAPL", "BUY", 1, 1.0, "X")])
    r = gate_asof(o, st).first()
    assert r.scope_matches == ["GLOBAL", "ACCOUNT:1"] and r.reason == "acct"
    assert r.kill_scope == "ACCOUNT:1" and r.kill_cmd_id == "2"


def test_empty_reason_reads_no_kill_switch(spark):
    st = state_records(commands_df(spark, [_cmd("1", 0, "GLOBAL", "KILL", "")]))
    r = gate_asof(orders_df(spark, [("o", 5, "1", "A", "BUY", 1, 1.0, "X")]), st).first()
    assert r.decision == "DROP" and r.reason == "No kill switch active"


def test_state_change_at_same_instant_applies_first(spark):
    st = state_records(commands_df(spark, [_cmd("1", 100, "ACCOUNT:1", "KILL")]))
    o = orders_df(spark, [("before", 99, "1", "A", "BUY", 1, 1.0, "X"),
                          ("same", 100, "1", "A", "BUY", 1, 1.0, "X")])
    got = {r.order_id: r.decision for r in gate_asof(o, st).collect()}
    assert got == {"before": "ALLOW", "same": "DROP"}


def _brute(orders, cmds):
    """Replay of the router loop: state updates and orders in time order."""
    events = sorted([(c[1], 0, c) for c in cmds] + [(o[1], 1, o) for o in orders],
                    key=lambda e: (e[0], e[1], e[2][0]))
    state, out = {}, {}
    for _, kind, rec in events:
        if kind == 0:
            if rec[3] in ("KILL", "UNKILL"):
                state[rec[2]] = ("KILLED" if rec[3] == "KILL" else "ACTIVE", rec[4])
            continue
        matches, decision, reason = [], "ALLOW", "No kill switch active"
        for sc in ("GLOBAL", f"ACCOUNT:{rec[2]}", f"SYMBOL:{rec[3]}"):
            if sc in state:
                matches.append(sc)
                if state[sc][0] == "KILLED":
                    decision, reason = "DROP", state[sc][1] or "No kill switch active"
                    break
        out[rec[0]] = (decision, matches, reason)
    return out


def test_asof_gate_matches_replay_of_router_loop(spark):
    rnd = random.Random(7)
    scopes = ["GLOBAL"] + [f"ACCOUNT:{i}" for i in range(4)] + [f"SYMBOL:S{i}" for i in range(3)]
    day = 86_400_000
    cmds = [_cmd(f"c{i:03d}", rnd.randrange(0, 5 * day), rnd.choice(scopes),
                 rnd.choice(["KILL", "UNKILL", "PAUSE"]), rnd.choice(["", "why"]))
            for i in range(60)]
    # distinct instants per scope so arrival order and (ts, id) order agree
    seen, uniq = set(), []
    for c in cmds:
        if (c[1], c[2]) not in seen:
            seen.add((c[1], c[2]))
            uniq.append(c)
    orders = [(f"o{i:04d}", rnd.randrange(0, 5 * day), str(rnd.randrange(4)), f"S{rnd.randrange(3)}",
               "BUY", 1, 1.0, "X") for i in range(400)]
    audit = gate_asof(orders_df(spark, orders), state_records(commands_df(spark, uniq)))
    got = {r.order_id: (r.decision, r.scope_matches, r.reason) for r in audit.collect()}
    assert got == _brute(orders, uniq)


def test_asof_gate_without_broadcast_uses_bucketed_join(spark):
    st = state_records(commands_df(spark, [_cmd("1", 0, "GLOBAL", "KILL"), _cmd("2", 50, "GLOBAL", "UNKILL")]))
    o = orders_df(spark, [("a", 10, "1", "A", "BUY", 1, 1.0, "X"), ("b", 60, "1", "A", "BUY", 1, 1.0, "X")])
    from haltgate.operators.gate import attach_state_asof, decide, audit_rows
    a = audit_rows(decide(attach_state_asof(o, st, max_broadcast_bytes=0)))
    assert {r.order_id: r.decision for r in a.collect()} == {"a": "DROP", "b": "ALLOW"}


def test_stored_audit_takes_lookups_to_the_files(spark):
    import tempfile

    from haltgate.operators.reports import audit_for_account
    from haltgate.plans.world import read_audit, store_audit
    path = tempfile.mkdtemp(prefix="audit-") + "/a"
    rows = spark.range(1000).selectExpr("id * 3600000 as ts", "cast(id as string) as order_id", "cast(id % 50 as string) as account_id")
    store_audit(rows, path)
    got = audit_for_account(read_audit(spark, path), "42")
    assert [r.order_id for r in got.collect()] == [str(i) for i in range(42, 1000, 50)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(account_id,42)" in plan
    assert any(f.startswith("date=") for f in __import__("os").listdir(path))


def test_reports_see_orders_appended_since_the_last_report(spark, tmp_path):
    from haltgate.plans import catalog
    from haltgate.plans.world import World
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "events.parquet"))
    q, d = catalog.queries(), str(tmp_path)
    before = q["dashboard_totals"](spark, d).first()
    path = World(spark, d).save_audit()
    events.withColumn("event_id", events.event_id + 10**9).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    after = q["dashboard_totals"](spark, d).first()
    assert before.total_orders > 0 and after.total_orders == 2 * before.total_orders
    assert after.allowed + after.dropped == World(spark, d).audit().count()
    assert World(spark, d, audit_path=path).stored_audit().count() == before.allowed + before.dropped


def test_levels_that_shuffle_the_orders_come_first(spark):
    """While the rows are short; the decisions do not depend on it."""
    from haltgate.operators.gate import attach_state_asof, audit_rows, decide
    commands = [(f"c{k:03d}", k, f"ACCOUNT:{k % 40}", "KILL" if k % 3 else "UNKILL", "r", "op", None, None, "x") for k in range(400)]
    commands += [("g1", 50, "GLOBAL", "KILL", "r", "op", None, None, "x"), ("g2", 60, "GLOBAL", "UNKILL", "r", "op", None, None, "x")]
    states = state_records(commands_df(spark, commands))
    orders = orders_df(spark, [(f"o{k:03d}", k, str(k % 50), "A", "BUY", 1, 1.0, "X") for k in range(420)])
    small, large = attach_state_asof(orders, states, max_broadcast_bytes=5000), attach_state_asof(orders, states)
    place = small.columns.index
    assert place("a_status") < place("g_status") < place("s_status")
    rows = [sorted(map(str, audit_rows(decide(x)).collect())) for x in (small, large)]
    assert rows[0] == rows[1] and len(rows[0]) == 420
