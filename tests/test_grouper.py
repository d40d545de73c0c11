"""Runs, parts, boundaries and pinned filters of document streams."""

import pytest

from logweave.streaming.grouper import Grouper, effect, token_time


def change(n, key=None, coll="orders", op="insert", **more):
    return {"op": op, "database": "app", "collection": coll, "document_key": {"_id": 1}, "full_document": {"a": n}, "txn_key": key, "resume_token": f"t{n}", "cluster_time": {"t": 1, "i": n}} | more


def run(changes, **how):
    made = Grouper(**how)
    return [c for x in changes for c in (made.boundary(x) if isinstance(x, str) else made.push(x))]


def shape(commit):
    return len(commit["rows"]), commit["part"] and (commit["part"]["number"], commit["part"]["last"])


def test_runs_end_with_their_key():
    got = run([change(1, "a"), change(2, "a"), change(3, "b"), change(4), change(5), change(6, "a"), "t9"])
    assert [shape(c)[0] for c in got] == [2, 1, 1, 1, 1]
    assert got[0]["position"] == {"adapter": "mongo", "at": {"resume_token": "t1", "cluster_time": {"t": 1, "i": 1}}, "after": {"resume_token": "t2", "cluster_time": {"t": 1, "i": 2}}}
    assert got[-1]["position"]["after"] == {"resume_token": "t9"}


def test_idle_batches_move_the_position_once():
    token = "82" + "0000000a" + "0000000b"
    got = run([change(1), "t1", token, token])
    assert [shape(c)[0] for c in got] == [1, 0]
    assert got[1]["position"]["after"] == {"resume_token": token, "cluster_time": {"t": 10, "i": 11}}
    assert token_time({"_data": token}) == {"t": 10, "i": 11} and token_time("82zz") is None


@pytest.mark.parametrize(("n", "want"), [(3, [(3, None)]), (4, [(3, (1, False)), (1, (2, True))]), (7, [(3, (1, False)), (3, (2, False)), (1, (3, True))])])
def test_parts_by_rows(n, want):
    got = run([change(k, "a") for k in range(n)] + [change(99)], max_rows=3)
    assert [shape(c) for c in got[:-1]] == want
    assert [c["position"]["after"] == {} for c in got[:-1]] == [True] * (len(want) - 1) + [False]


def test_parts_by_bytes():
    # op and insert, after and a, and 8 for the number
    assert [shape(c)[0] for c in run([change(k, "a") for k in range(5)] + ["z"], max_bytes=30)] == [2, 2, 1]


def test_an_unlisted_change_sends_a_full_part_and_leaves_an_empty_last_one():
    got = run([change(1, "a"), change(2, "a"), change(3, "a", "noise"), "z"], max_rows=2, include=lambda: frozenset({"app.orders"}))
    assert [shape(c) for c in got] == [(2, (1, False)), (0, (2, True))]
    got = run([change(1, "a", "noise")] * 5 + ["z"], max_rows=2, include=lambda: frozenset({"app.orders"}))
    assert [shape(c) for c in got] == [(0, None)]


def test_filters_are_pinned_and_controls_stop():
    only = frozenset({"app.orders"})
    made = Grouper(include=lambda: only, max_rows=1, seed_time={"t": 5, "i": 1})
    made.push(change(1, "a"))
    only = frozenset()
    part = made.push(change(2, "a", op="drop"))[0]
    assert shape(part) == (1, (1, False)) and not part["control"] and not part["stop"]
    last = made.boundary("z")[0]
    assert last["stop"] and last["control"] == [{"kind": "dropped", "subject": {"database": "app", "table": "orders"}}] and last["position"]["after"]["seed_cluster_time"] == {"t": 5, "i": 1}
    assert shape(made.push(change(3))[0]) == (0, None)


def test_effects():
    only = frozenset({"app.orders"})
    assert effect(change(1, coll="system.x"))[0] == "filtered" and effect(change(1, coll="system.x", op="delete"))[0] == "row"
    assert effect(change(1, full_document=None))[0] == "filtered" and effect(change(1, full_document=None), "signal")[1]["data"] == {"op": "insert", "signal": True}
    assert effect(change(1, op="replace"))[1]["op"] == "update" and effect(change(1, op="delete"))[1]["data"] == {"op": "delete", "before": {"_id": 1}}
    assert effect(change(1, op="rename"), only=only)[1]["renamed_to"] == {"database": "app", "table": ""}
    assert effect(change(1, coll="x", op="drop"), only=only)[0] == "filtered" and effect(change(1, coll=None, op="invalidate"), only=only)[0] == "control" and effect(change(1, op="other"))[0] == "filtered"
