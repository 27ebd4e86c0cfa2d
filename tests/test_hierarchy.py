"""Subtree sums and nearest definitions against plain loops over the parents."""

import random

import pytest
from flowlake.operators import tree

GROUPS = "id string, parent_id string"


def parents_of(kind, n, rnd):
    if kind == "chain":
        return {f"g{i}": f"g{i - 1}" if i else None for i in range(n)}
    if kind == "star":
        return {f"g{i}": "g0" if i else None for i in range(n)}
    if kind == "forest":  # several roots, and parents that are no groups
        return {f"g{i}": rnd.choice([None, "gone", f"g{rnd.randrange(i)}"]) if i else None for i in range(n)}
    return {f"g{i}": f"g{rnd.randrange(i)}" if i else None for i in range(n)}


def sums_by_loop(parent, own):
    total = {g: own.get(g, 0) for g in parent}
    for g in reversed(list(parent)):  # parents come before their children
        if parent[g] in total:
            total[parent[g]] += total[g]
    return total


@pytest.mark.parametrize("kind, n", [("random", 400), ("forest", 300), ("star", 200), ("chain", 100_000), ("random", 100_000)])
def test_subtree_sums(spark, kind, n):
    rnd = random.Random(n)
    parent = parents_of(kind, n, rnd)
    own = {g: rnd.choice([0, 1, 2 ** 40]) for g in parent if rnd.random() < 0.8}
    groups = spark.createDataFrame(list(parent.items()), GROUPS).repartition(4)
    values = spark.createDataFrame([(g, v) for g, v in own.items()], "id string, v long")
    got = {r.id: r.v for r in tree.subtree_sums(groups, values, ["v"]).collect()}
    assert got == sums_by_loop(parent, own)


def effective_by_loop(parent, definitions):
    by_group = {}
    for g, name, value in definitions:
        if g in parent:
            own = by_group.setdefault(g, {})
            own[name] = min(own[name], value) if name in own else value
    out = set()
    for g in parent:
        seen, at, far = set(), g, 0
        while at in parent:
            for name, value in by_group.get(at, {}).items():
                if name not in seen:
                    out.add((g, name, value, at, far))
                    seen.add(name)
            at, far = parent[at], far + 1
    return out


@pytest.mark.parametrize("kind, n, share", [("random", 300, 0.3), ("random", 300, 0.02), ("chain", 200, 0.2), ("forest", 200, 0.2), ("star", 100, 1.0)])
def test_effective_parameters(spark, kind, n, share):
    rnd = random.Random(n)
    parent = parents_of(kind, n, rnd)
    definitions = [(g, rnd.choice("abc"), rnd.choice("xyz")) for g in [*parent, "nobody"] for _ in range(3) if rnd.random() < share]
    got = tree.effective_parameters(spark.createDataFrame(list(parent.items()), GROUPS),
                                    spark.createDataFrame(definitions, "group_id string, name string, value string"))
    assert {tuple(r) for r in got.collect()} == effective_by_loop(parent, definitions)


def test_parameters_of_a_deep_chain(spark):
    """100,000 levels; the closure would have 5 billion rows."""
    n = 100_000
    groups = spark.createDataFrame([(f"g{i}", f"g{i - 1}" if i else None) for i in range(n)], GROUPS)
    marks = [0, 70_000, 99_998]
    found = tree.effective_parameters(groups, spark.createDataFrame(
        [(f"g{i}", "a", str(i)) for i in marks] + [("g5", "b", "five")], "group_id string, name string, value string"))
    got = {(r.group_id, r.name): (r.value, r.distance) for r in found.collect()}
    assert len(got) == n + n - 5
    for i in (0, 4, 5, 69_999, 70_000, 99_997, 99_999):
        near = max(m for m in marks if m <= i)
        assert got[f"g{i}", "a"] == (str(near), i - near)
        assert got.get((f"g{i}", "b")) == (("five", i - 5) if i >= 5 else None)


def test_empty_tables_and_cycles(spark):
    none = spark.createDataFrame([], GROUPS)
    definitions = spark.createDataFrame([("x", "a", "1")], "group_id string, name string, value string")
    assert tree.subtree_sums(none, spark.createDataFrame([], "id string, v long"), ["v"]).count() == 0
    assert tree.effective_parameters(none, definitions).count() == 0
    ring = spark.createDataFrame([(f"g{i}", f"g{(i + 1) % 5}") for i in range(5)], GROUPS)
    with pytest.raises(ValueError, match="cycle"):
        tree.subtree_sums(ring, spark.createDataFrame([("g1", 1)], "id string, v long"), ["v"])
    with pytest.raises(ValueError, match="cycle"):
        tree.effective_parameters(ring, spark.createDataFrame([("g1", "a", "1")], "group_id string, name string, value string"))
