"""Dependent deletes against a plain loop over the commands in order."""

import random

import pytest
from flowlake.operators import deletes

TABLES = {
    "processors": "id string, group_id string, run_status string, version long",
    "connections": "id string, group_id string, source_id string, destination_id string",
    "groups": "id string, parent_id string",
    "ports": "id string, group_id string, kind string, run_status string",
    "queue": "connection_id string, flowfile_uuid string",
}


def loop(commands, processors=(), connections=(), groups=(), ports=(), queue=()):
    """Every command on the state that the ones before it left; commands of one seq see the same state."""
    port_kind = {"INPUT_PORT": "input_port"}
    state = {("processor", p[0]): (p[3], p[1]) for p in processors}
    state |= {(port_kind.get(p[2], "output_port"), p[0]): (0, p[1]) for p in ports}
    state |= {("connection", c[0]): (0, c[1]) for c in connections}
    state |= {("group", g[0]): (0, g[1]) for g in groups}
    status = {("processor", p[0]): p[2] for p in processors} | {(port_kind.get(p[2], "output_port"), p[0]): p[3] for p in ports}
    ends = {c[0]: c[2:4] for c in connections}
    queued = {q[0] for q in queue}
    out = {}
    by_seq = {}
    for c in commands:
        by_seq.setdefault(c[0], []).append(c)
    for seq in sorted(by_seq):
        gone = []
        for c in by_seq[seq]:
            _, kind, target, version = c
            key = (kind, target)
            if target is None:
                result = ("no_target", [])
            elif kind not in deletes.KINDS:
                result = ("invalid_kind", [])
            elif key not in state:
                result = ("not_found", [])
            elif version != state[key][0]:
                result = ("conflict", [])
            else:
                reasons = []
                if kind == "group":
                    inside = [k for k, (_, parent) in state.items() if parent == target]
                    if any(status.get(k) == "RUNNING" for k in inside):
                        reasons.append("not_stopped")
                    if inside:
                        reasons.append("not_empty")
                elif kind == "connection":
                    if target in queued:
                        reasons.append("queue_not_empty")
                else:
                    if status[key] != "STOPPED":
                        reasons.append("not_stopped")
                    if any(k[0] == "connection" and target in ends[k[1]] for k in state):
                        reasons.append("connected")
                result = ("blocked", reasons) if reasons else ("deleted", [])
                if not reasons:
                    gone.append(key)
            out[c] = result
        for key in gone:
            state.pop(key, None)
    return out


def applied(spark, commands, **tables):
    frames = {name: spark.createDataFrame(list(tables.get(name, ())), schema) for name, schema in TABLES.items()}
    cmds = spark.createDataFrame(commands, "seq long, kind string, target_id string, expected_version long").repartition(3)
    return deletes.delete_apply(cmds, **frames)


def same(spark, commands, **tables):
    got = {(r.seq, r.kind, r.target_id, r.expected_version): (r.outcome, list(r.reasons))
           for r in applied(spark, commands, **tables).collect()}
    want = loop(commands, **tables)
    assert got == want
    return want


@pytest.mark.parametrize("depth", [1, 2, 7, 50])
def test_chains_of_dependent_deletes(spark, depth):
    """A chain of groups, a stopped pair of processors in the innermost, deleted from the inside out."""
    groups = [(f"g{i}", f"g{i - 1}" if i else None) for i in range(depth)]
    last = f"g{depth - 1}"
    tables = {"groups": groups, "processors": [("a", last, "STOPPED", 3), ("b", last, "STOPPED", 0)],
              "connections": [("c", last, "a", "b")]}
    order = [("connection", "c", 0), ("processor", "b", 0), ("processor", "a", 3)]
    order += [("group", f"g{i}", 0) for i in reversed(range(depth))]
    commands = [(10 * i, *c) for i, c in enumerate(order)]
    assert {o for o, _ in same(spark, commands, **tables).values()} == {"deleted"}
    if depth > 7:
        return
    # one step out of order: what follows it up the chain is blocked
    at = len(commands) // 2
    late = commands[:at] + [(commands[at][0] + 15, *commands[at][1:])] + commands[at + 1:]
    same(spark, late, **tables)


@pytest.mark.parametrize("seed", range(4))
def test_random_batches_equal_the_loop(spark, seed):
    rnd = random.Random(seed)
    n = 30
    groups = [("g0", None)] + [(f"g{i}", f"g{rnd.randrange(i)}") for i in range(1, n)]
    processors = [(f"p{i}", f"g{rnd.randrange(n)}", rnd.choice(["STOPPED"] * 6 + ["RUNNING", None]), rnd.randrange(2)) for i in range(25)]
    ports = [(f"q{i}", f"g{rnd.randrange(n)}", rnd.choice(["INPUT_PORT", "OUTPUT_PORT"]), rnd.choice(["STOPPED", "STOPPED", "RUNNING"]))
             for i in range(8)]
    pieces = [p[0] for p in processors + ports]
    connections = [(f"c{i}", f"g{rnd.randrange(n)}", rnd.choice(pieces + [None, ""]), rnd.choice(pieces)) for i in range(25)]
    queue = [(f"c{i}", "f") for i in (1, 1, 5)]
    kinds = ([("connection", c[0]) for c in connections] * 2 + [("processor", p[0]) for p in processors] * 2
             + [("input_port", p[0]) for p in ports] + [("output_port", p[0]) for p in ports]
             + [("group", g[0]) for g in groups] * 3 + [("processor", "none"), ("widget", "p1"), (None, "p1"), ("group", None)])
    order = {"connection": 0, "processor": 40, "input_port": 40, "output_port": 40, "group": 80}
    depth = {"g0": 0}
    for g, parent in groups[1:]:
        depth[g] = depth[parent] + 1
    commands = set()
    for kind, target in kinds:
        seq = order.get(kind, 0) + rnd.randrange(60) + (10 * (8 - depth.get(target, 0)) if kind == "group" else 0)
        commands.add((seq, kind, target, rnd.choice([0, 0, 0, 1, None])))
    want = same(spark, sorted(commands, key=str), groups=groups, processors=processors, ports=ports, connections=connections, queue=queue)
    assert {o for o, _ in want.values()} == {"deleted", "blocked", "not_found", "conflict", "invalid_kind", "no_target"}
    assert sum(o == "deleted" for o, _ in want.values()) > 20


def test_edge_rows(spark):
    assert applied(spark, []).count() == 0
    twice = [(1, "processor", "a", 0), (1, "processor", "a", 0), (2, "processor", "a", 0), (None, "processor", "b", 0)]
    rows = applied(spark, twice, processors=[("a", "g", "STOPPED", 0), ("a", "g", None, 0), (None, "g", "STOPPED", 0), ("b", "g", "STOPPED", 0)])
    assert sorted((r.seq or 0, r.outcome) for r in rows.collect()) == [(0, "deleted"), (1, "deleted"), (1, "deleted"), (2, "not_found")]
    circle = applied(spark, [(1, "group", "x", 0), (2, "group", "y", 0)], groups=[("x", "y"), ("y", "x")])
    assert {r.outcome for r in circle.collect()} == {"blocked"}


def test_tables_after_the_batch(spark):
    processors = spark.createDataFrame([("a", "g"), ("b", "g")], "id string, group_id string")
    outcomes = spark.createDataFrame([("processor", "a", "deleted"), ("processor", "b", "blocked"), ("group", "b", "deleted")],
                                     "kind string, target_id string, outcome string")
    assert [r.id for r in deletes.without_deleted(processors, outcomes, "processor").collect()] == ["b"]
