"""Hot keys: one scope / account holding a third of all rows."""

import random
import re

from conftest import commands_df, orders_df
from haltgate.operators.gate import attach_state_asof, audit_rows, decide
from haltgate.operators.signals import risk_signals
from haltgate.operators.state import kill_intervals, state_records, status_changes

HOUR = 3_600_000


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_commands(n=300, seed=3):
    rnd = random.Random(seed)
    rows, used = [], set()
    for i in range(n):
        scope = "GLOBAL" if i % 3 == 0 else f"ACCOUNT:{rnd.randrange(20)}"
        ts = rnd.randrange(0, 72 * HOUR)
        if (scope, ts) in used:
            continue
        used.add((scope, ts))
        rows.append((f"c{i:04d}", ts, scope, rnd.choice(["KILL", "UNKILL"]), "r", "op", None, None, "x"))
    return rows


def _brute_changes(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        by.setdefault(r[2], []).append(r)
    changes, intervals = [], []
    for scope, rs in by.items():
        prev = None
        ch = []
        for r in rs:
            st = "KILLED" if r[3] == "KILL" else "ACTIVE"
            if prev != st:
                ch.append((scope, r[1], st))
            prev = st
        changes += ch
        for i, (s, ts, st) in enumerate(ch):
            if st == "KILLED":
                intervals.append((s, ts, ch[i + 1][1] if i + 1 < len(ch) else None))
    return sorted(changes), sorted(intervals, key=lambda x: (x[0], x[1]))


def test_hot_scope_changes_and_intervals_match_brute_force(spark):
    rows = _hot_commands()
    st = state_records(commands_df(spark, rows))
    exp_ch, exp_iv = _brute_changes(rows)
    ch = status_changes(st)
    got_ch = sorted((r.scope, r.updated_ts, r.status) for r in ch.collect())
    assert got_ch == exp_ch
    iv = kill_intervals(st)
    got_iv = sorted(((r.scope, r.kill_ts, r.unkill_ts) for r in iv.collect()), key=lambda x: (x[0], x[1]))
    assert got_iv == exp_iv
    # The raw rows are exchanged on (scope, bucket); an exchange on the scope
    # alone only feeds the per-bucket summary (one row per scope and bucket),
    # which sits below an aggregate on (scope, bucket).
    plan = _plan(ch)
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any("scope" in k and "_bk" in k for k in keys)
    assert all("_bk" in k or k.count(",") == 1 for k in keys)


def test_hot_global_gate_with_shuffle_join(spark):
    rnd = random.Random(5)
    cmds = [(f"g{i:03d}", i * 2 * HOUR, "GLOBAL", "KILL" if i % 2 == 0 else "UNKILL", "hot", "op", None, None, "x")
            for i in range(30)]
    orders = [(f"o{i:05d}", rnd.randrange(0, 60 * HOUR), str(rnd.randrange(5)), "S", "BUY", 1, 1.0, "X")
              for i in range(3000)]
    a = audit_rows(decide(attach_state_asof(orders_df(spark, orders), state_records(commands_df(spark, cmds)), max_broadcast_bytes=0)))
    plan = _plan(a)
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    got = {r.order_id: r.decision for r in a.collect()}
    for oid, ts, *_ in orders:
        k = ts // (2 * HOUR)
        assert got[oid] == ("DROP" if k % 2 == 0 else "ALLOW")


def test_hot_account_signals_pre_aggregate_before_shuffle(spark):
    rows = [(f"h{i}", 1000 + i, "HOT", "AAPL" if i % 4 else "MSFT", "BUY", 1, 1.0, "X") for i in range(3000)]
    rows += [(f"c{i}", 1000 + i, str(i % 50), "AAPL", "BUY", 1, 1.0, "X") for i in range(6000)]
    s = risk_signals(orders_df(spark, rows))
    plan = _plan(s)
    assert "partial_count" in plan and "partial_sum" in plan
    hot = [r for r in s.collect() if r.account_id == "HOT"]
    assert len(hot) == 1 and hot[0].order_count == 3000 and hot[0].top_symbol == "AAPL"
    assert hot[0].top_symbol_share == 0.75


def test_levels_are_size_checked_separately(spark):
    # Many ACCOUNT intervals, one GLOBAL interval: with a bound of 1000 bytes the
    # ACCOUNT lookup shuffles while GLOBAL and SYMBOL stay broadcast.
    cmds = [(f"a{i:03d}", i, f"ACCOUNT:{i}", "KILL", "acct", "op", None, None, "x") for i in range(40)]
    cmds.append(("g", 0, "GLOBAL", "UNKILL", "", "op", None, None, "x"))
    orders = [(f"o{i}", 100, str(i), "S", "BUY", 1, 1.0, "X") for i in range(60)]
    a = audit_rows(decide(attach_state_asof(orders_df(spark, orders), state_records(commands_df(spark, cmds)),
                                            max_broadcast_bytes=1000)))
    plan = _plan(a)
    assert "BroadcastHashJoin" in plan and ("SortMergeJoin" in plan or "ShuffledHashJoin" in plan)
    got = {r.order_id: (r.decision, r.scope_matches) for r in a.collect()}
    assert got["o3"] == ("DROP", ["GLOBAL", "ACCOUNT:3"]) and got["o50"] == ("ALLOW", ["GLOBAL"])


def test_newest_distinct_matches_brute_force(spark):
    from haltgate.operators.reports import newest_distinct
    rnd = random.Random(11)
    rows = [(f"id{rnd.randrange(300)}", rnd.randrange(5000), rnd.random()) for _ in range(4000)]
    df = spark.createDataFrame(rows, "order_id string, ts bigint, v double").repartition(6)
    got = [(r.order_id, r.ts) for r in newest_distinct(df, "order_id", 25).collect()]
    best = {}
    for oid, ts, _ in rows:
        best[oid] = max(best.get(oid, -1), ts)
    exp = sorted(best.items(), key=lambda kv: (kv[1], kv[0]), reverse=True)[:25]
    assert sorted(got) == sorted(exp)
    # built-in functions only, and nulls and ties have a defined place
    plan = _plan(newest_distinct(spark.range(100).selectExpr("cast(id % 7 as string) as order_id",
                                                             "id as ts"), "order_id", 3))
    assert "Python" not in plan and "MapIn" not in plan
    odd = spark.createDataFrame([("a", 5, 1.0), ("a", 5, 2.0), ("b", None, 1.0)], "order_id string, ts bigint, v double")
    assert [tuple(r) for r in newest_distinct(odd, "order_id", 5).collect()] == [("a", 5, 2.0), ("b", None, 1.0)]


def test_kill_intervals_of_a_busy_scope_are_linear(spark):
    """One scope with a record in each of 200,000 minutes: the window frames grow
    row by row, so this takes seconds."""
    import time

    from haltgate.operators.state import kill_intervals
    n = 200_000
    states = spark.range(n).selectExpr(
        "'GLOBAL' as scope", "if(id % 4 < 2, 'KILLED', 'ACTIVE') as status", "id * 60000 as updated_ts",
        "'op' as updated_by", "'r' as reason", "lpad(id, 8, '0') as last_cmd_id", "'c' as corr_id")
    t0 = time.time()
    got = kill_intervals(states).selectExpr("count(*) as n", "count_if(duration_ms = 120000) as two").first()
    assert (got.n, got.two) == (n // 4, n // 4) and time.time() - t0 < 90


def _brute_asof(cmds, ts):
    prev = [c for c in sorted(cmds, key=lambda c: (c[1], c[0])) if c[1] <= ts]
    if not prev or prev[-1][3] == "UNKILL":
        return ("ALLOW", "No kill switch active")
    return ("DROP", prev[-1][4])


def test_dense_global_day_is_descended(spark):
    # 400 GLOBAL changes in one day, four a node: each order is compared only with
    # its leaf's intervals, and the decisions equal a brute-force as-of replay, broadcast or shuffled.
    from haltgate.operators.gate import IntervalIndex, state_intervals
    rnd = random.Random(7)
    cmds = [(f"g{i:04d}", rnd.randrange(0, 24 * HOUR), "GLOBAL", rnd.choice(["KILL", "UNKILL"]),
             f"r{i}", "op", None, None, "x") for i in range(400)]
    orders = [(f"o{i:05d}", rnd.randrange(0, 30 * HOUR), "1", "S", "BUY", 1, 1.0, "X") for i in range(1500)]
    st = state_records(commands_df(spark, cmds))
    idx = IntervalIndex(state_intervals(st), fanout=4)
    assert len(idx.nodes) == 4 and idx.table.count() == state_intervals(st).count()
    assert idx.table.groupBy("scope", "leaf").count().agg({"count": "max"}).first()[0] == 4
    assert idx.nodes[0][0].groupBy("parent").count().agg({"count": "max"}).first()[0] == 4
    for bound in (10 ** 8, 0):
        a = audit_rows(decide(attach_state_asof(orders_df(spark, orders), st,
                                                max_broadcast_bytes=bound, fanout=4)))
        got = {r.order_id: (r.decision, r.reason) for r in a.collect()}
        assert all(got[o[0]] == _brute_asof(cmds, o[1]) for o in orders)


def test_dense_activation_cells_attribute_drops_exactly(spark):
    from haltgate.operators.reports import drops_by_activation
    from haltgate.operators.gate import gate_asof
    rnd = random.Random(9)
    cmds = [(f"g{i:04d}", 10 * i * 60_000 + rnd.randrange(60_000), "GLOBAL",
             "KILL" if i % 2 == 0 else "UNKILL", "hot", "op", None, None, "x") for i in range(200)]
    orders = [(f"o{i:05d}", rnd.randrange(0, 2000 * 60_000), "1", "S", "BUY", 1, 1.0, "X")
              for i in range(2000)]
    st = state_records(commands_df(spark, cmds))
    audit = gate_asof(orders_df(spark, orders), st, fanout=4)
    iv = kill_intervals(st)
    got = {r.kill_cmd_id: r.orders_dropped
           for r in drops_by_activation(audit, iv, fanout=4).collect()}
    ks = sorted(c for c in cmds if c[3] == "KILL")
    for k in ks:
        nxt = [c[1] for c in cmds if c[3] == "UNKILL" and c[1] > k[1]]
        end = min(nxt) if nxt else None
        exp = sum(1 for o in orders if o[1] >= k[1] and (end is None or o[1] < end))
        assert got[k[0]] == exp


def test_drops_follow_repeated_kills_to_their_activation(spark):
    # Random KILL / UNKILL with repeats (a KILL on a KILLED scope extends
    # the activation; its record, not the opening one, drops later orders).
    # Each drop must count for the activation of its killing scope that
    # contains the order: the latest KILLED status change at or before it.
    from haltgate.operators.reports import drops_by_activation
    from haltgate.operators.gate import gate_asof
    rows = _hot_commands(n=400, seed=13)
    rows += rows[::17]  # commands replayed into the log (exact duplicates)
    rnd = random.Random(17)
    orders = [(f"o{i:05d}", rnd.randrange(0, 72 * HOUR), str(rnd.randrange(20)), "S", "BUY", 1, 1.0, "X")
              for i in range(3000)]
    st = state_records(commands_df(spark, rows))
    audit = gate_asof(orders_df(spark, orders), st)
    got = {r.kill_cmd_id: r.orders_dropped
           for r in drops_by_activation(audit, kill_intervals(st), fanout=4).collect()}
    changes = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        st_ = "KILLED" if r[3] == "KILL" else "ACTIVE"
        ch = changes.setdefault(r[2], [])
        if not ch or ch[-1][1] != st_:
            ch.append((r[1], st_, r[0]))
    exp = {c[2]: 0 for ch in changes.values() for c in ch if c[1] == "KILLED"}
    drops = [(r.kill_scope, r.ts) for r in audit.filter("decision = 'DROP'").collect()]
    assert drops
    for scope, ts in drops:
        opened = [c for c in changes[scope] if c[0] <= ts][-1]
        assert opened[1] == "KILLED"
        exp[opened[2]] += 1
    assert got == exp


def test_index_does_not_grow_with_horizon_times_idle_scopes(spark):
    # 10,000 scopes killed once and open ever since, over ten years, and a few that
    # change often, one in a burst: a row an interval, decisions as by brute force.
    from haltgate.operators.gate import IntervalIndex, state_intervals
    rnd = random.Random(21)
    day, years = 24 * HOUR, 3650
    idle = [(f"i{k:05d}", rnd.randrange(years * day), f"ACCOUNT:{k}", "KILL", "idle", "op", None, None, "x") for k in range(10_000)]
    busy = [(f"b{k:05d}", rnd.randrange(years * day), f"ACCOUNT:{20_000 + k % 3}", rnd.choice(["KILL", "UNKILL"]), f"r{k}", "op", None, None, "x")
            for k in range(600)]
    busy += [(f"m{k:05d}", 100 * day + k * 60_000, "GLOBAL", ["KILL", "UNKILL"][k % 2], f"g{k}", "op", None, None, "x") for k in range(300)]
    st = state_records(commands_df(spark, idle + busy))
    intervals = state_intervals(st).checkpoint()
    idx = IntervalIndex(intervals)
    assert idx.table.count() == intervals.count()  # a row each, and the nodes above
    assert sum(level.count() for level, _ in idx.nodes) < intervals.count() / 16
    assert idx.table.groupBy("scope", "leaf").count().agg({"count": "max"}).first()[0] <= 32
    orders = [(f"o{k:05d}", rnd.choice([rnd.randrange(years * day), 100 * day + rnd.randrange(6 * HOUR)]),
               str(rnd.choice([rnd.randrange(10_000), 20_000 + rnd.randrange(3)])), "S", "BUY", 1, 1.0, "X") for k in range(2000)]
    a = audit_rows(decide(attach_state_asof(orders_df(spark, orders), st)))
    by = {}
    for c in idle + busy:
        by.setdefault(c[2], []).append(c)
    for r in a.collect():
        state = [_brute_asof(by.get(s, []), r.ts) for s in ("GLOBAL", f"ACCOUNT:{r.account_id}")]
        exp = next((s for s in state if s[0] == "DROP"), ("ALLOW", "No kill switch active"))
        assert (r.decision, r.reason) == exp


def test_hot_client_order_id_is_spread_over_tasks(spark):
    # One id holds over a third of all orders, repeated every minute or so without
    # a pause for a year, others now and then: as by a plain fold, and no task sorts an id.
    from haltgate.operators.extensions import duplicate_decisions
    rnd = random.Random(31)
    rows = [("HOT", k * 61_000 + rnd.randrange(60_000)) for k in range(6000)] + [("HOT", 61_000 * 77)] * 3
    rows += [(f"id{rnd.randrange(300)}", rnd.randrange(400 * HOUR)) for _ in range(9000)]
    o = spark.createDataFrame([(f"o{k:05d}", c, t, "1") for k, (c, t) in enumerate(rows)],
                              "order_id string, cid string, ts bigint, account_id string")
    df = duplicate_decisions(o, "cid")
    seen, exp = {}, {}
    for k, (c, t) in sorted(enumerate(rows), key=lambda r: (r[1][1], f"o{r[0]:05d}")):
        new = c not in seen or t - seen[c] >= HOUR
        exp[f"o{k:05d}"] = (None if new else seen[c], "NEW" if new else "DUPLICATE")
        seen[c] = t if new else seen[c]
    got = {r.order_id: (r.prev_seen_ts, r.decision) for r in df.collect()}
    assert got == exp
    assert sum(1 for v in exp.values() if v[1] == "NEW") > 90


def test_equal_rows_of_an_id_are_new_once(spark):
    from haltgate.operators.extensions import duplicate_decisions
    o = spark.createDataFrame([("a", "x", 5, "1")] * 4 + [("a", "y", 5, "1")], "order_id string, cid string, ts bigint, account_id string")
    got = sorted((r.client_order_id, r.decision) for r in duplicate_decisions(o, "cid").collect())
    assert got == [("x", "DUPLICATE")] * 3 + [("x", "NEW"), ("y", "NEW")]
