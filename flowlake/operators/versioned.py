"""H2: apply ordered commands to a versioned table with optimistic locking.

Per entity, commands run in ``seq`` order against the state (present, version):

* ``CREATE``: absent → present at version 0 (``created``); present → ``exists``;
* ``UPDATE``/``DELETE``: absent → ``not_found``; version differs from the
  command's expected version → ``conflict``; else ``updated`` (version + 1) or
  ``deleted`` (absent);
* any other op → ``invalid_op``;
* ops listed in ``strict_ops`` report a missing entity as ``error`` instead of
  ``not_found`` (an update of a connection that does not exist is an error,
  a delete of one is not).

* a command without a target → ``no_target``, whatever its op.

Commands of one entity depend on each other, so this is an ordered fold.  It is
distributed without gathering an entity into one task: the commands, together
with one initial row per entity of the initial table (marked by a column of its
own and sorted ahead of the entity's commands), are range-partitioned on
``(target_id, seq)`` (a hot entity is cut across partitions; the commands
shuffle once, with no join) and checkpointed; pass A computes, for the entity a
partition starts with, its end state for every start state that can matter
(absent, each expected version in the segment, anything else = unchanged), with
converging trajectories merged and start versions that share an end state
written as one run; a second job walks each entity's runs in partition order,
every entity by itself and holding one state only, and so finds the true start
state of each partition; pass B folds every row once with that state.  Rows
stay Arrow batches, so no integer passes through a float.

``scope`` (for example ``["snapshot_id"]``, without nulls) names columns of both
tables: entities of one id in different snapshots are different entities.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.ranking import PART, part_of, sorted_checkpoint

CREATE, UPDATE, DELETE = "CREATE", "UPDATE", "DELETE"
ABSENT = "absent"  # key of the absent state in a summary

OUTCOME_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("target_id", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("expected_version", T.LongType()),
    T.StructField("outcome", T.StringType()),
    T.StructField("present_after", T.BooleanType()),
    T.StructField("version_after", T.LongType()),
])


def step(op, expected, present, version, strict_ops=()):
    """One command against (present, version) → (outcome, present, version)."""
    if op == CREATE:
        return ("exists", present, version) if present else ("created", True, 0)
    if op not in (UPDATE, DELETE):
        return "invalid_op", present, version
    if not present:
        return ("error" if op in strict_ops else "not_found"), present, version
    if expected is None or version != expected:
        return "conflict", present, version
    if op == DELETE:
        return "deleted", False, None
    return "updated", True, version + 1


class _Summary:
    """End state of one command segment for every start state that can matter."""

    def __init__(self):
        self.groups: dict = {ABSENT: [ABSENT]}  # current state → start classes
        self.classes: set = set()
        self.const = False  # after an initial row the end no longer depends on the start

    def _move(self, a, b):
        lst = self.groups.pop(a, None)
        if lst is None:
            return
        dst = self.groups.get(b)
        if dst is None:
            self.groups[b] = lst
        elif len(dst) < len(lst):
            lst.extend(dst)
            self.groups[b] = lst
        else:
            dst.extend(lst)

    def reset(self, version):
        """An initial row: every trajectory goes on as (present, version)."""
        self.groups, self.classes, self.const = {version: [ABSENT]}, set(), True

    def feed(self, op, e):
        if op in (UPDATE, DELETE) and e is not None and e not in self.classes and not self.const:
            # a start version first seen now has been unchanged so far
            self.classes.add(e)
            self.groups.setdefault(e, []).append(e)
        if op == CREATE:
            self._move(ABSENT, 0)
        elif op == UPDATE and e is not None and e in self.groups:
            self._move(e, e + 1)
        elif op == DELETE and e is not None and e in self.groups:
            self._move(e, ABSENT)

    def result(self):
        """``(absent_end, runs)``: the end state from absent, and the end state of
        every start version as runs ``(lo, hi, end)`` of consecutive start versions
        sharing an end (a long chain of successful updates is one run); versions in
        no run are unchanged."""
        absent_end = ABSENT
        per_version = []
        for state, starts in self.groups.items():
            for st in starts:
                if st == ABSENT:
                    absent_end = state
                else:
                    per_version.append((st, state))
        per_version.sort()
        runs = []
        for v, end in per_version:
            if runs and runs[-1][1] == v - 1 and runs[-1][2] == end:
                runs[-1][1] = v
            else:
                runs.append([v, v, end])
        return absent_end, runs


SUMMARY_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("pid", T.IntegerType()),
    # 0: from absent, 1: from the versions lo..hi, 2: from any state
    T.StructField("kind", T.IntegerType()),
    T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()),
    T.StructField("present", T.BooleanType()), T.StructField("version", T.LongType()),
])
START_SCHEMA = T.StructType([
    T.StructField("pid", T.IntegerType()), T.StructField("key", T.StringType()),
    T.StructField("present", T.BooleanType()), T.StructField("version", T.LongType()),
])


def _rows(batch: pa.RecordBatch):
    """(target_id, is_cmd, op, expected_version) of every row, as Python values."""
    return zip(*(batch.column(c).to_pylist() for c in ("target_id", "is_cmd", "op", "expected_version")))


def _summaries(strict):
    """Pass A over the sorted commands: what each partition does to its first entity, and how its last one ends."""
    schema = to_arrow_schema(SUMMARY_SCHEMA)

    def run(batches):
        pid = first = key = None
        seen = False  # a row was read; keys themselves are never null here
        summary, present, version = _Summary(), False, None
        for batch in batches:
            if pid is None and batch.num_rows:
                pid = part_of(batch)
            for k, is_cmd, op, e in _rows(batch):
                if not seen:
                    seen, first = True, k
                if k == first:
                    summary.feed(op, e) if is_cmd else summary.reset(e)
                    continue
                if k != key:
                    key, present, version = k, False, None
                if is_cmd:
                    _, present, version = step(op, e, present, version, strict)
                else:
                    present, version = True, e
        if not seen:
            return
        absent_end, runs = summary.result()

        def row(k, kind, lo, hi, end):
            return {"key": k, "pid": pid, "kind": kind, "lo": lo, "hi": hi, "present": end != ABSENT,
                    "version": None if end == ABSENT else end}

        out = [row(first, 2 if summary.const else 0, None, None, absent_end)]
        out += [row(first, 1, lo, hi, end) for lo, hi, end in runs]
        if key is not None:
            out.append(row(key, 2, None, None, version if present else ABSENT))
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _chain(batches):
    """Start state of every partition's first entity, from the summaries sorted by (key, pid, kind, lo)."""
    schema = to_arrow_schema(START_SCHEMA)
    key = pid = None
    state = after = (False, None)
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["key"] != key:
                key, pid, after = r["key"], None, (False, None)
            if r["pid"] != pid:
                pid, state = r["pid"], after  # after: the end of the partition before
            end = (r["present"], r["version"])
            if r["kind"] == 0:
                out.append({"pid": pid, "key": key, "present": state[0], "version": state[1]})
                if not state[0]:
                    after = end
            elif r["kind"] == 2 or state[0] and state[1] is not None and r["lo"] <= state[1] <= r["hi"]:
                after = end
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)


def versioned_apply(commands: DataFrame, initial: DataFrame, num_partitions: int | None = None,
                    strict_ops=(), payload=(), scope: Sequence[str] = ()) -> DataFrame:
    """Outcome of every command; see the module docstring for the rules.

    ``commands``: ``seq bigint, target_id string, op string, expected_version bigint``
    and the columns named in ``payload``, which come out as they went in.
    ``initial``: entities present before the batch, ``id string, version bigint``
    (rows without an id are no entities).  Commands of one entity with equal
    ``seq`` run in order of op and expected version.
    """
    if scope:
        # one text for (scope, id); a null id stays null
        def entity(c):
            return F.when(F.col(c).isNotNull(), F.to_json(F.struct(*scope, F.col(c).alias("id"))))
        out = versioned_apply(
            commands.withColumns({"_target": F.col("target_id"), "target_id": entity("target_id")}),
            initial.withColumn("id", entity("id")), num_partitions, strict_ops, [*scope, "_target", *payload])
        return out.withColumn("target_id", F.col("_target")).select(
            *scope, *[f.name for f in OUTCOME_SCHEMA], *payload)
    strict = tuple(o.upper() for o in strict_ops)
    payload = list(payload)
    cmds = commands.select(F.col("seq").cast("bigint"), "target_id", F.upper("op").alias("op"),
                           F.col("expected_version").cast("bigint"), *payload)
    known = cmds.where(F.col("target_id").isNotNull()).withColumn("is_cmd", F.lit(True))
    inits = initial.where(F.col("id").isNotNull()).select(
        F.col("id").alias("target_id"), F.col("version").cast("bigint").alias("expected_version"),
        F.lit(False).alias("is_cmd"))
    rows = known.unionByName(inits, allowMissingColumns=True)
    # false sorts before true: an entity's initial row precedes its commands
    ck = sorted_checkpoint(rows, ["target_id", "is_cmd", "seq", "op", "expected_version"], num_partitions)

    summaries = ck.select("target_id", "is_cmd", "op", "expected_version", PART).mapInArrow(_summaries(strict), SUMMARY_SCHEMA)
    chained = (summaries.repartition("key").sortWithinPartitions("key", "pid", "kind", "lo")
               .mapInArrow(_chain, START_SCHEMA))
    # one row per partition at most
    starts = {r["pid"]: (r["key"], r["present"], r["version"]) for r in chained.collect()}
    out_schema = T.StructType(OUTCOME_SCHEMA.fields + [ck.schema[c] for c in payload])

    def fold(batches):
        begun, key, present, version = False, None, False, None
        for batch in batches:
            if not begun and batch.num_rows:
                begun, (key, present, version) = True, starts.get(part_of(batch), (None, False, None))
            outcomes, presents, versions = [], [], []
            for k, is_cmd, op, e in _rows(batch):
                if k != key:
                    key, present, version = k, False, None
                if is_cmd:
                    outcome, present, version = step(op, e, present, version, strict)
                    outcomes.append(outcome), presents.append(present), versions.append(version)
                else:
                    present, version = True, e
            rows = batch.filter(batch.column("is_cmd"))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in ("seq", "target_id", "op", "expected_version")),
                 pa.array(outcomes, pa.string()), pa.array(presents, pa.bool_()), pa.array(versions, pa.int64()),
                 *(rows.column(c) for c in payload)], names=[f.name for f in out_schema])

    lost = cmds.where(F.col("target_id").isNull()).select(
        "seq", "target_id", "op", "expected_version", F.lit("no_target").alias("outcome"),
        F.lit(False).alias("present_after"), F.lit(None).cast("bigint").alias("version_after"), *payload)
    return ck.mapInArrow(fold, out_schema).unionByName(lost)


def versioned_table(outcomes: DataFrame, initial: DataFrame, payload=(), scope: Sequence[str] = ()) -> DataFrame:
    """The entity table after the batch: last outcome per entity, untouched rows kept.

    With ``payload`` (columns of both tables), a ``created`` or ``updated``
    outcome writes its payload: fields that are null in the command keep what
    they had, those of an entity created in this batch start from nothing.
    Everything is an aggregate per entity with a map-side partial step.
    """
    payload, target, key = list(payload), [*scope, "target_id"], [*scope, "id"]
    real = outcomes.where(F.col("target_id").isNotNull())
    last = real.groupBy(*target).agg(
        F.max_by(F.struct("present_after", "version_after"), F.struct("seq", "op", "expected_version")).alias("s"),
        F.max(F.when(F.col("outcome").isin("created", "deleted"), F.col("seq"))).alias("_since"))
    touched = last.where(F.col("s.present_after")).select(
        *scope, F.col("target_id").alias("id"), F.col("s.version_after").alias("version"), "_since")
    rest = initial.select(*key, F.col("version").cast("bigint"), *payload)
    untouched = rest.join(last.select(*scope, F.col("target_id").alias("id")), key, "left_anti")
    if not payload:
        return untouched.unionByName(touched.drop("_since"))
    writes = real.where(F.col("outcome").isin("created", "updated")).join(
        last.select(*target, "_since"), target).where(
        F.col("_since").isNull() | (F.col("seq") >= F.col("_since")))
    new = writes.groupBy(*scope, F.col("target_id").alias("id")).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(f"_new_{i}") for i, c in enumerate(payload)])
    old = rest.select(*key, *[F.col(c).alias(f"_old_{i}") for i, c in enumerate(payload)])
    written = touched.join(new, key, "left").join(old, key, "left").select(
        *key, "version",
        *[F.coalesce(F.col(f"_new_{i}"), F.when(F.col("_since").isNull(), F.col(f"_old_{i}"))).alias(c)
          for i, c in enumerate(payload)])
    return untouched.unionByName(written)
