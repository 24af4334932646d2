from conftest import commands_df
from haltgate.operators.state import (compact, fold_state, kill_intervals, reset_all_commands,
                                      scope_board, state_cache, state_records, status_changes)
from haltgate.sources.commands import operator_commands, rejected_requests, validate_requests


def _cmd(cid, ts, scope, action, reason="r", by="spark", corr="c"):
    return (cid, ts, scope, action, reason, by, None, None, corr)


def test_compaction_history_and_latest(spark):
    cmds = commands_df(spark, [_cmd("1", 100, "ACCOUNT:123", "KILL"),
                               _cmd("2", 200, "ACCOUNT:123", "UNKILL"),
                               _cmd("3", 300, "ACCOUNT:123", "KILL")])
    st = state_records(cmds)
    assert st.count() == 3
    snap = fold_state(st).collect()
    assert len(snap) == 1 and snap[0].status == "KILLED" and snap[0].updated_ts == 300


def test_unknown_action_makes_no_state(spark):
    cmds = commands_df(spark, [_cmd("1", 100, "ACCOUNT:1", "PAUSE")])
    assert state_records(cmds).count() == 0


def test_defaults_for_missing_fields(spark):
    cmds = commands_df(spark, [("9", 5, "GLOBAL", "KILL", None, None, None, None, None)])
    r = state_records(cmds).first()
    assert r.updated_by == "unknown" and r.reason == "" and len(r.corr_id) == 64


def test_same_instant_larger_cmd_id_wins(spark):
    cmds = commands_df(spark, [_cmd("a", 100, "GLOBAL", "KILL"), _cmd("b", 100, "GLOBAL", "UNKILL")])
    assert fold_state(state_records(cmds)).first().status == "ACTIVE"


def test_compact_drops_tombstones(spark):
    log = spark.createDataFrame([("k", 1, "v1"), ("k", 2, None), ("j", 1, "x")],
                                "key string, off bigint, value string")
    got = {r.key: r.value for r in compact(log, "key", ["off"], "value").collect()}
    assert got == {"j": "x"}


def test_status_changes_and_kill_intervals(spark):
    cmds = commands_df(spark, [_cmd("1", 100, "ACCOUNT:1", "KILL"), _cmd("2", 150, "ACCOUNT:1", "KILL"),
                               _cmd("3", 200, "ACCOUNT:1", "UNKILL"), _cmd("4", 300, "ACCOUNT:1", "KILL")])
    st = state_records(cmds)
    ch = [(r.updated_ts, r.status, r.prev_status) for r in status_changes(st).orderBy("updated_ts").collect()]
    assert ch == [(100, "KILLED", None), (200, "ACTIVE", "KILLED"), (300, "KILLED", "ACTIVE")]
    iv = [(r.kill_ts, r.unkill_ts, r.duration_ms) for r in kill_intervals(st).orderBy("kill_ts").collect()]
    assert iv == [(100, 200, 100), (300, None, None)]


def test_sequence_helper_crosses_bucket_edges(spark):
    # One hot scope spread over many buckets: the previous status must be
    # found across bucket boundaries and across empty buckets.
    rows = [_cmd(f"{i:04d}", i * 3_600_000, "GLOBAL", "KILL" if i % 3 else "UNKILL") for i in range(0, 200, 7)]
    st = state_records(commands_df(spark, rows))
    got = [(r.updated_ts, r.prev_status) for r in
           status_changes(st, bucket_ms=86_400_000).orderBy("updated_ts").collect()]
    exp, prev = [], None
    for _, ts, _, action, *_ in rows:
        status = "KILLED" if action == "KILL" else "ACTIVE"
        if prev is None or prev != status:
            exp.append((ts, prev))
        prev = status
    assert got == exp


def test_reset_all_and_board(spark):
    cmds = commands_df(spark, [_cmd("1", 100, "ACCOUNT:1", "KILL"), _cmd("2", 100, "SYMBOL:AAPL", "UNKILL")])
    snap = fold_state(state_records(cmds))
    r = reset_all_commands(snap).collect()
    assert [(x.scope, x.action) for x in r] == [("ACCOUNT:1", "UNKILL")]
    board = {x.scope: x.status for x in scope_board(snap).collect()}
    assert board["GLOBAL"] == "UNKNOWN" and board["ACCOUNT:1"] == "KILLED"
    assert board["SYMBOL:AAPL"] == "ACTIVE"


def test_state_cache_ttl_only_expires_active(spark):
    day = 86_400_000
    cmds = commands_df(spark, [_cmd("1", 0, "ACCOUNT:1", "KILL"), _cmd("2", 0, "ACCOUNT:2", "UNKILL")])
    kept = {r.scope for r in state_cache(fold_state(state_records(cmds)), 30 * day).collect()}
    assert kept == {"ACCOUNT:1"}


def test_scope_validation(spark):
    req = spark.createDataFrame(
        [("1", 1, "/kill", None, None, None), ("2", 1, "/kill", "", None, None),
         ("3", 1, "/kill", "account:1", None, None), ("4", 1, "/kill", "ACCOUNT:", None, None),
         ("5", 1, "/pause", "GLOBAL", None, None)],
        "request_id string, ts bigint, path string, scope string, reason string, operator string")
    v = {r.request_id: (r.status_code, r.error) for r in validate_requests(req).collect()}
    assert v["1"] == (400, "Missing required field: scope")
    assert v["2"] == (400, "Missing required field: scope")
    assert v["3"][0] == 400 and v["3"][1].startswith("Invalid scope format")
    assert v["4"] == (200, None)
    assert v["5"][0] == 404
    cmd = operator_commands(req).first()
    assert (cmd.scope, cmd.reason, cmd.triggered_by) == ("ACCOUNT:", "Manual operator action", "api")
    assert rejected_requests(req).count() == 4


def test_state_bootstrap_from_compacted_log(spark):
    import json as _json
    from haltgate.operators.state import state_from_log

    def rec(scope, status, off):
        v = None if status is None else _json.dumps(
            {"scope": scope, "status": status, "updated_ts": off, "updated_by": "x", "reason": "",
             "last_cmd_id": str(off), "corr_id": "c"})
        return (scope, v, 0, off)
    log = spark.createDataFrame(
        [rec("ACCOUNT:1", "KILLED", 1), rec("ACCOUNT:1", "ACTIVE", 2), rec("GLOBAL", "KILLED", 3),
         rec("SYMBOL:A", "KILLED", 4), rec("SYMBOL:A", None, 5)],
        "key string, value string, partition int, offset bigint")
    got = {r.scope: r.status for r in state_from_log(log).collect()}
    assert got == {"ACCOUNT:1": "ACTIVE", "GLOBAL": "KILLED"}


def test_reset_without_a_kill_releases_the_default_scopes(spark):
    from haltgate.operators.state import reset_all_commands
    cols = "scope string, status string, updated_ts bigint, updated_by string, reason string, last_cmd_id string, corr_id string"
    for rows in ([("ACCOUNT:1", "ACTIVE", 5, "op", "", "c1", "x")], []):
        got = reset_all_commands(spark.createDataFrame(rows, cols)).collect()
        assert sorted(r.scope for r in got) == ["ACCOUNT:99999", "GLOBAL", "SYMBOL:AAPL"]
        assert {r.reason for r in got} == {"Dashboard cleanup"} and len({r.cmd_id for r in got}) == 3


def test_drop_lines_with_line_breaks(spark):
    from haltgate.operators.reports import parse_drop_lines
    lines = spark.createDataFrame([("DROPPED order a: one\ntwo",), ("DROPPED order b: x",), ("not a DROPPED line",)], "message string")
    assert sorted(tuple(r) for r in parse_drop_lines(lines).collect()) == [("one\ntwo", 1), ("x", 1)]
