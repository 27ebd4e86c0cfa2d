"""H2 as a stream: commands applied per entity with state kept between micro-batches.

The state per entity is ``(present, version)`` in a value state of
``transformWithState``; entities present before the stream starts come
in as the initial state. The rules are the batch fold's (``versioned.step``).

In arrival order (no ``watermark``), an entity's commands of one micro-batch
are applied in ``seq`` order as they come; the micro-batch's commands for one
key are held, so bound the trigger (``maxFilesPerTrigger``). In event-time
order, commands wait in a list state and an event-time timer releases them once
the watermark has passed them: shuffled micro-batches give the outcome of the
batch fold, as long as no command comes later than the watermark allows. Later
ones are dropped by Spark, and ``streams.drain`` tells of them. What the
watermark has not passed yet stays in the state for the next run.

Rows reach Python and leave it one by one, not as a pandas frame per entity:
most entities have few commands in a micro-batch. Numbers reach Python as text
and are exact over 2**53.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.versioned import OUTCOME_SCHEMA, step

STATE_SCHEMA = "present boolean, version long"
WAITING_SCHEMA = "at long, seq string, op string, expected_version string, payload string"
FOLDED_SCHEMA = T.StructType([*OUTCOME_SCHEMA.fields, T.StructField("payload", T.StringType())])
Folded = Row(*FOLDED_SCHEMA.names)
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _number(text) -> int | None:
    return None if text is None else int(text)


def _order(command):
    """Commands run by time, then seq, op and expected version; nulls first, as Spark sorts them."""
    return tuple((x is not None, nothing if x is None else x) for x, nothing in zip(command, (0, 0, "", 0)))


class VersionedProcessor(StatefulProcessor):
    """Folds each entity's commands into its (present, version) state."""

    def __init__(self, strict_ops=(), by_event_time: bool = False):
        self.strict_ops = tuple(o.upper() for o in strict_ops)
        self.by_event_time = by_event_time
        self.begun = None  # the entity whose initial state came last

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("entity", STATE_SCHEMA)
        if self.by_event_time:
            self.waiting = handle.getListState("waiting", WAITING_SCHEMA)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if key != self.begun:  # of repeated rows the first counts
            self.begun = key
            self.state.update((True, _number(initialState["version"])))

    def _commands(self, rows) -> list[tuple]:
        return [(_number(r["at"]), _number(r["seq"]), r["op"], _number(r["expected_version"]), r["payload"]) for r in rows]

    def handleInputRows(self, key, rows, timerValues):
        commands = self._commands(rows)
        if not self.by_event_time:
            yield from self._fold(key, commands)
            return
        self.waiting.appendList([(at, *(None if x is None else str(x) for x in (seq, op, e)), p)
                                 for at, seq, op, e, p in commands])
        self.handle.registerTimer(min(c[0] for c in commands))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs()
        held = [(at, _number(seq), op, _number(e), p) for at, seq, op, e, p in self.waiting.get()] if self.waiting.exists() else []
        ready, rest = ([c for c in held if (c[0] <= watermark) == passed] for passed in (True, False))
        if not ready:
            return
        self.waiting.clear()
        if rest:
            self.waiting.put([(at, *(None if x is None else str(x) for x in (seq, op, e)), p) for at, seq, op, e, p in rest])
            self.handle.registerTimer(min(c[0] for c in rest))
        yield from self._fold(key, ready)

    def _fold(self, key, commands):
        present, version = False, None
        if self.state.exists():
            present, version = self.state.get()
            present = bool(present)
        commands.sort(key=_order)
        folded = []
        for _, seq, op, e, payload in commands:
            outcome, present, version = step(op, e, present, version, self.strict_ops)
            folded.append(Folded(seq, key[0], op, e, outcome, present, version, payload))
        self.state.update((present, version))
        yield from folded

    def close(self) -> None:
        pass


def versioned_apply_stream(commands: DataFrame, initial: DataFrame, strict_ops=(), payload=(),
                           event_time: str | None = None, watermark: str | None = None) -> DataFrame:
    """Streaming outcomes for a command stream against an initial entity table.

    ``payload`` columns come out as they went in. With ``event_time`` (a
    timestamp column) and ``watermark`` (a delay), commands are applied in
    order of event time and seq, else in arrival order. A command without a
    target is ``no_target`` at once; one without an event time is dropped by
    the watermark; a null seq runs first. Needs the RocksDB state store: set
    here if the session names none, an error if it names another.
    """
    spark = commands.sparkSession
    if spark.conf.get(PROVIDER, "") not in ("", ROCKSDB):
        raise RuntimeError(f"{PROVIDER} names another state store; this stream needs {ROCKSDB}")
    spark.conf.set(PROVIDER, ROCKSDB)
    payload = list(payload)
    ordered = event_time is not None
    at = F.col(event_time).cast("timestamp") if ordered else F.lit(None).cast("timestamp")
    cmds = commands.select(
        F.col("seq").cast("bigint").alias("seq"), "target_id", F.upper("op").alias("op"),
        F.col("expected_version").cast("bigint").alias("expected_version"),
        F.to_json(F.struct(*payload)).alias("payload") if payload else F.lit(None).cast("string").alias("payload"), at.alias("_at"))
    lost = cmds.where(F.col("target_id").isNull()).select(
        "seq", "target_id", "op", "expected_version", F.lit("no_target").alias("outcome"), F.lit(False).alias("present_after"),
        F.lit(None).cast("bigint").alias("version_after"), "payload")
    known = cmds.where(F.col("target_id").isNotNull())
    if ordered:
        known = known.withWatermark("_at", watermark)
    known = known.select("target_id", "op", "payload", F.col("seq").cast("string").alias("seq"),
                         F.col("expected_version").cast("string").alias("expected_version"),
                         F.unix_millis("_at").cast("string").alias("at"), *(["_at"] * ordered))
    init = initial.where(F.col("id").isNotNull()).select(
        F.col("id").alias("target_id"), F.col("version").cast("bigint").cast("string").alias("version")).groupBy("target_id")
    folded = known.groupBy("target_id").transformWithState(
        statefulProcessor=VersionedProcessor(strict_ops, ordered), outputStructType=FOLDED_SCHEMA,
        outputMode="Append", timeMode="EventTime" if ordered else "None", initialState=init)
    out = folded.unionByName(lost)
    if not payload:
        return out.drop("payload")
    schema = T.StructType([T.StructField(c, commands.schema[c].dataType) for c in payload])
    parsed = F.from_json("payload", schema)
    return out.select(*[f.name for f in OUTCOME_SCHEMA], *[parsed[c].alias(c) for c in payload])
