"""Seeded random inputs: distributed operators against ten-line Python loops.

The inputs put one hot key over a third or more of the rows and use many
partitions, so keys are cut across partition boundaries.
"""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from flowlake.functions.ranking import position_within
from flowlake.operators import tree
from flowlake.operators.versioned import step, versioned_apply, versioned_table


def _reference_fold(cmds, initial):
    state = dict(initial)
    out = {}
    for seq, t, op, e in sorted(cmds, key=lambda c: (c[1], c[0])):
        present, version = (True, state[t]) if t in state else (False, None)
        o, present, version = step(op, e, present, version)
        out[seq] = (o, present, version)
        if present:
            state[t] = version
        else:
            state.pop(t, None)
    return out, state


def _random_commands(rng, n, n_keys, hot_share):
    cmds = []
    for seq in range(n):
        t = "hot" if rng.random() < hot_share else f"k{rng.randrange(n_keys)}"
        op = rng.choice(["CREATE", "UPDATE", "UPDATE", "DELETE", "NOOP"])
        e = rng.choice([0, 1, 2, 3, None]) if op != "CREATE" else None
        cmds.append((seq, t, op, e))
    rng.shuffle(cmds)
    return cmds


@pytest.mark.parametrize("seed,parts,hot", [(1, 7, 0.34), (2, 16, 0.9), (3, 3, 0.0), (4, 32, 0.5)])
def test_versioned_matches_loop(spark, seed, parts, hot):
    rng = random.Random(seed)
    cmds = _random_commands(rng, 3000, 40, hot)
    initial = {f"k{i}": rng.choice([0, 1, 2]) for i in range(0, 40, 2)}
    initial["hot"] = 0
    cdf = spark.createDataFrame(cmds, "seq bigint, target_id string, op string, expected_version bigint")
    idf = spark.createDataFrame(list(initial.items()), "id string, version bigint")
    got = versioned_apply(cdf, idf, num_partitions=parts)
    want, final = _reference_fold(cmds, initial)
    rows = got.collect()
    assert len(rows) == len(cmds)
    for r in rows:
        assert (r["outcome"], r["present_after"], r["version_after"]) == want[r["seq"]], r
    table = {r["id"]: r["version"] for r in versioned_table(got, idf).collect()}
    assert table == final


def test_versioned_hot_key_spans_partitions(spark):
    # one entity only: every partition boundary falls inside it
    cmds = [(i, "x", "UPDATE", i - 1) if i else (0, "x", "CREATE", None) for i in range(500)]
    cdf = spark.createDataFrame(cmds, "seq bigint, target_id string, op string, expected_version bigint")
    idf = spark.createDataFrame([], "id string, version bigint")
    got = Counter(r["outcome"] for r in versioned_apply(cdf, idf, num_partitions=12).collect())
    want = Counter(o for o, _, _ in _reference_fold(cmds, {})[0].values())
    assert got == want


@pytest.mark.parametrize("seed,parts", [(5, 9), (6, 24)])
def test_position_within_matches_row_number(spark, seed, parts):
    rng = random.Random(seed)
    rows = []
    for i in range(4000):
        k = "hot" if rng.random() < 0.4 else (None if rng.random() < 0.02 else f"c{rng.randrange(30)}")
        rows.append((k, rng.randrange(50), f"u{i}"))
    df = spark.createDataFrame(rows, "k string, t int, u string")
    got = {r["u"]: r["pos"] for r in position_within(df, ["k"], ["t", "u"], "pos", num_partitions=parts).collect()}
    groups = defaultdict(list)
    for k, t, u in rows:
        groups[k].append((t, u))
    want = {}
    for k, lst in groups.items():
        for i, (_, u) in enumerate(sorted(lst), 1):
            want[u] = i
    assert got == want


def test_closure_matches_loop(spark):
    rng = random.Random(7)
    parent = {"n0": None}
    for i in range(1, 300):
        parent[f"n{i}"] = f"n{rng.randrange(i)}"
    groups = spark.createDataFrame(list(parent.items()), "id string, parent_id string")
    got = {(r[0], r[1], r[2]) for r in tree.group_closure(groups).collect()}
    want = set()
    for n in parent:
        d, cur = 0, n
        while cur is not None:
            want.add((cur, n, d))
            cur, d = parent[cur], d + 1
    assert got == want


def test_versioned_summary_runs_stay_small(spark):
    from flowlake.operators.versioned import _Summary
    s = _Summary()
    for v in range(10000):
        s.feed("UPDATE", v)
    absent_end, runs = s.result()
    assert absent_end == "absent" and runs == [[0, 9999, 10000]] and not s.const


def test_versioned_long_update_chain_across_partitions(spark):
    cmds = [(0, "x", "CREATE", None)] + [(i, "x", "UPDATE", i - 1) for i in range(1, 3000)]
    cmds += [(3000 + i, "y", "UPDATE", 5) for i in range(50)]
    cdf = spark.createDataFrame(cmds, "seq bigint, target_id string, op string, expected_version bigint")
    idf = spark.createDataFrame([("y", 5)], "id string, version bigint")
    got = {r["seq"]: (r["outcome"], r["present_after"], r["version_after"])
           for r in versioned_apply(cdf, idf, num_partitions=20).collect()}
    want, _ = _reference_fold(cmds, {"y": 5})
    assert got == want


def test_versioned_duplicate_initial_rows(spark):
    # two INIT rows for one entity (the later one wins in sort order is not
    # defined), so use equal versions: state must be that version whatever the split
    cmds = [(i, "x", "UPDATE", 3 + i) for i in range(200)]
    cdf = spark.createDataFrame(cmds, "seq bigint, target_id string, op string, expected_version bigint")
    idf = spark.createDataFrame([("x", 3)] * 50, "id string, version bigint")
    got = Counter(r["outcome"] for r in versioned_apply(cdf, idf, num_partitions=9).collect())
    assert got == Counter({"updated": 200})


def test_versioned_strict_ops(spark):
    cmds = [(1, "a", "UPDATE", 0), (2, "a", "DELETE", 0), (3, "b", "DELETE", 0), (4, "b", "UPDATE", 0)]
    cdf = spark.createDataFrame(cmds, "seq bigint, target_id string, op string, expected_version bigint")
    idf = spark.createDataFrame([], "id string, version bigint")
    got = {r["seq"]: r["outcome"] for r in versioned_apply(cdf, idf, strict_ops=["update"]).collect()}
    assert got == {1: "error", 2: "not_found", 3: "not_found", 4: "error"}


def _lint_loop(groups, procs, conns):
    """Per group, the reference's three passes over its processor list."""
    from flowlake.functions import text as T
    out = set()
    for g in groups:
        ps = [p for p in procs if p[1] == g]
        cs = [c for c in conns if c[1] == g]
        if not ps:
            out.add((g, "no_processors", None, T.MSG_NO_PROCESSORS, None, None))
            continue
        connected = {x for c in cs for x in (c[2], c[3]) if x}
        n, m = len(ps), len(cs)
        for pid, _, name, status, errs in ps:
            nm = name if name is not None else "Unknown"
            if pid not in connected:
                out.add((g, "disconnected", pid, T.MSG_DISCONNECTED % (nm, pid), n, m))
            if (status or "UNKNOWN") == "STOPPED":
                out.add((g, "stopped", pid, T.MSG_STOPPED % nm, n, m))
            if errs:
                out.add((g, "invalid", pid, T.MSG_INVALID % (nm, ", ".join(errs)), n, m))
    return out


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_lint_report_matches_loop(spark, seed):
    from flowlake.operators.lint import lint_report
    rng = random.Random(seed)
    groups = [f"g{i}" for i in range(8)]
    procs = []
    for i in range(120):
        g = rng.choice(groups[:6])  # g6, g7 stay empty
        procs.append((f"p{i}", g, rng.choice([f"n{i}", None]), rng.choice(["STOPPED", "RUNNING", None, "stopped"]),
                      rng.choice([None, [], ["e1"], ["e1", "e2"]])))
    ids = [p[0] for p in procs]
    conns = []
    for i in range(150):
        g = rng.choice(groups)
        conns.append((f"c{i}", g, rng.choice(ids + [None, ""]), rng.choice(ids + [None])))
    gdf = spark.createDataFrame([(g,) for g in groups], "id string")
    pdf = spark.createDataFrame(procs, "id string, group_id string, name string, run_status string, "
                                       "validation_errors array<string>")
    cdf = spark.createDataFrame(conns, "id string, group_id string, source_id string, destination_id string")
    got = {(r["group_id"], r["rule"], r["processor_id"], r["suggestion"], r["processor_count"],
            r["connection_count"]) for r in lint_report(gdf, pdf, cdf).collect()}
    assert got == _lint_loop(groups, procs, conns)
    assert lint_report(gdf, pdf, cdf).count() == len(got)

    # the per-document form over the same estate nested into flow documents
    from flowlake.operators.lint import lint_documents
    from flowlake.sources.flowdocs import build_flow_docs
    g2 = spark.createDataFrame([(g, None, g) for g in groups], "id string, parent_id string, name string")
    ports = spark.createDataFrame([], "id string, group_id string, kind string, name string, run_status string")
    c2 = cdf.withColumn("bp_objects", F.lit(None).cast("bigint")).withColumn("bp_size", F.lit(None).cast("string")) \
        .withColumn("expiration", F.lit(None).cast("string"))
    p2 = pdf.withColumn("type", F.lit("T")).withColumn("version", F.lit(0).cast("bigint"))
    docs = build_flow_docs(g2, p2, c2, ports)
    got_docs = [(r["group_id"], r["rule"], r["processor_id"], r["suggestion"], r["processor_count"],
                 r["connection_count"]) for r in lint_documents(docs).collect()]
    assert len(got_docs) == len(got) and set(got_docs) == got


def test_versioned_stale_versions_that_never_converge(spark):
    """Many start versions end differently: every partition's summary has many runs."""
    rng = random.Random(21)
    cmds = [(0, "hot", "CREATE", None)]
    for i in range(1, 1500):
        op = rng.choice(["UPDATE", "UPDATE", "DELETE", "CREATE"])
        cmds.append((i, "hot", op, rng.randrange(0, 40) if op != "CREATE" else None))
    cmds += [(2000 + i, f"k{i % 7}", "UPDATE", 0) for i in range(60)]
    cdf = spark.createDataFrame(cmds, "seq bigint, target_id string, op string, expected_version bigint")
    idf = spark.createDataFrame([("k1", 0), ("k3", 2)], "id string, version bigint")
    want, _ = _reference_fold(cmds, {"k1": 0, "k3": 2})
    for parts in (1, 11, 40):
        got = {r["seq"]: (r["outcome"], r["present_after"], r["version_after"])
               for r in versioned_apply(cdf, idf, num_partitions=parts).collect()}
        assert got == want


@pytest.mark.parametrize("parts", [1, 6, 13])
def test_versioned_null_targets_large_seq_and_clashing_ops(spark, parts):
    base = 2 ** 53
    cmds = [(base + 1 + 2 * i, "hot", "UPDATE", base + i) for i in range(60)]
    cmds += [(base + 500 + i, None, op, 0) for i, op in enumerate(["UPDATE", "CREATE", "DELETE"])]
    cmds += [(base + 2000, "a", "__init__", 7), (base + 2001, "a", "UPDATE", 7), (base + 2002, "b", "create", None)]
    cdf = spark.createDataFrame(cmds, "seq bigint, target_id string, op string, expected_version bigint")
    idf = spark.createDataFrame([("hot", base), ("a", 1), (None, 4)], "id string, version bigint")
    got = {r["seq"]: (r["target_id"], r["outcome"], r["version_after"])
           for r in versioned_apply(cdf, idf, num_partitions=parts).collect()}
    assert len(got) == len(cmds)
    assert all(got[base + 1 + 2 * i] == ("hot", "updated", base + i + 1) for i in range(60))
    assert {got[base + 500 + i] for i in range(3)} == {(None, "no_target", None)}
    assert [got[base + 2000 + i][1] for i in range(3)] == ["invalid_op", "conflict", "created"]


def test_versioned_payload_is_written(spark):
    cmds = [(1, "a", "UPDATE", 0, "x", None), (2, "a", "UPDATE", 1, None, 5), (3, "a", "UPDATE", 9, "lost", 9),
            (4, "b", "DELETE", 0, "gone", 1), (5, "b", "CREATE", None, None, 2), (6, "c", "CREATE", None, "new", None),
            (7, "d", "DELETE", 0, None, None)]
    cdf = spark.createDataFrame(
        cmds, "seq bigint, target_id string, op string, expected_version bigint, name string, x int")
    idf = spark.createDataFrame([("a", 0, "old", 1), ("b", 0, "b", 1), ("d", 0, "d", 1), ("e", 3, "e", 4)],
                                "id string, version bigint, name string, x int")
    out = versioned_apply(cdf, idf, payload=["name", "x"])
    got = {tuple(r) for r in versioned_table(out, idf, payload=["name", "x"]).collect()}
    assert got == {("a", 2, "x", 5), ("b", 0, None, 2), ("c", 0, "new", None), ("e", 3, "e", 4)}


def test_position_of_large_integers_and_nulls(spark):
    big = 2 ** 53
    rows = [(k, big + i, i) for k in (big, big + 1, None) for i in range(20)]
    df = spark.createDataFrame(rows, "k bigint, size bigint, t int")
    got = {(r["k"], r["size"]): r["pos"]
           for r in position_within(df, ["k"], ["size"], "pos", num_partitions=7).collect()}
    assert got == {(k, s): t + 1 for k, s, t in rows}


def test_closure_of_a_deep_chain_and_a_cycle(spark):
    from flowlake.operators import tree
    groups = spark.createDataFrame([(f"g{i}", f"g{i - 1}" if i else None, f"n{i}") for i in range(131)],
                                   "id string, parent_id string, name string")
    closure = tree.group_closure(groups)
    assert closure.count() == 131 * 132 // 2
    assert closure.where("descendant = 'g130' and ancestor = 'g0'").collect()[0]["distance"] == 130
    deep = {r["id"]: r for r in tree.pipeline_tree(groups).collect()}
    assert len(deep) == 131 and deep["g130"]["depth"] == 130 and deep["g130"]["parent"] == "n129"
    assert deep["g2"]["path"] == "n0/n1/n2"
    ring = spark.createDataFrame([(f"g{i}", f"g{(i + 1) % 5}") for i in range(5)], "id string, parent_id string")
    with pytest.raises(ValueError, match="cycle"):
        tree.group_closure(ring)


def test_ordered_operators_with_empty_partitions(spark):
    rows = [("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")]
    df = spark.createDataFrame(rows, "k string, t int, u string")
    got = {r["u"]: r["pos"] for r in position_within(df, ["k"], ["t", "u"], "pos", num_partitions=64).collect()}
    assert got == {"y": 1, "x": 2, "z": 1}
    cmds = [(1, "a", "CREATE", None), (2, "a", "UPDATE", 0), (3, "b", "DELETE", 0)]
    cdf = spark.createDataFrame(cmds, "seq bigint, target_id string, op string, expected_version bigint")
    idf = spark.createDataFrame([("b", 0)], "id string, version bigint")
    got = {r["seq"]: r["outcome"] for r in versioned_apply(cdf, idf, num_partitions=64).collect()}
    assert got == {1: "created", 2: "updated", 3: "deleted"}
    empty = spark.createDataFrame([], "seq bigint, target_id string, op string, expected_version bigint")
    assert versioned_apply(empty, spark.createDataFrame([], "id string, version bigint")).count() == 0


def test_ordered_operators_inside_a_union(spark):
    """Partition numbers come with the rows: neither a union before them nor merged partitions change a result."""
    import random
    rnd = random.Random(11)
    rows = [(i, rnd.choice(["hot", "hot", "a", "b"]), rnd.choice(["UPDATE", "DELETE", "CREATE"]), rnd.randrange(3))
            for i in range(400)]
    cmds = spark.createDataFrame(rows, "seq long, target_id string, op string, expected_version long")
    initial = spark.createDataFrame([("hot", 0), ("a", 1)], "id string, version long")
    runs = [versioned_apply(cmds, initial, num_partitions=n) for n in (3, 9, 6)]
    want = sorted(map(tuple, runs[0].collect()), key=str)
    both = runs[0].withColumn("run", F.lit(0))
    for k, df in enumerate(runs[1:], 1):
        both = both.unionByName(df.withColumn("run", F.lit(k)))
    for got in (both, both.coalesce(2)):
        found = got.collect()
        for k in range(3):
            assert sorted((tuple(r)[:-1] for r in found if r.run == k), key=str) == want
    positions = [position_within(cmds, ["target_id"], ["seq"], "pos", num_partitions=n) for n in (4, 7)]
    want = {(r.target_id, r.seq): r.pos for r in positions[0].collect()}
    assert len(want) == 400
    assert {(r.target_id, r.seq): r.pos for r in positions[0].union(positions[1]).coalesce(3).collect()} == want
    assert positions[0].union(positions[1]).distinct().count() == 400
