"""Sessions and reloadable lists on the state processor.

* ``SessionProcessor``: a small typed entry a (customer, session) key, kept in
  the RocksDB state store and checkpointed, the entries of one slot of keys in one
  state, as every call between Python and the store takes long against the work on
  an entry. Open: earliest time and number of
  events so far. Closed: a tombstone, so whatever comes later is ignored. An
  optional idle limit, off by default, closes a session that had no event for so
  long by event time. The first batch may start from a table of open sessions.
* ``ListProcessor``: a stream of list changes meets the event stream before the
  sessions. The key is the event type (and a salt, so that a type with a third
  of all events is spread over many tasks), the state is that type's changes, and
  an event is flagged by the last change at or before its own offset. No restart:
  a change takes effect from the offset it names, for all events that are
  processed after it arrived.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How a session ended: by an end event, or by the idle limit.
BY_END, BY_IDLE = "end", "idle"
END_ONLY = ("application_software", "client_id", "event_type_cd", "event_response_txt")
END_FIELDS = ("event_id", "event_ts_us", *END_ONLY)
SESSION_OUT = ("customer_id string, session_id string, closed_by string, interaction_start_us long, n_events long, event_id long, "
               "application_software string, event_ts_us long, client_id string, event_type_cd string, event_response_txt string")
SLOT_STATE = ("customer_id array<string>, session_id array<string>, closed array<boolean>, start_us array<long>, last_us array<long>, "
              "n_events array<long>")
#: Columns of a table of open sessions that a stream may start from.
OPEN_SESSIONS = ("customer_id", "session_id", "start_us", "last_us", "n_events")
SALTS = 32
#: Session keys share a state by hash: a slot a state. A batch pays for the slots it touches,
#: each read and written whole, so a slot should hold some hundred keys at most.
SLOTS = 32_768


def use_rocks_db(spark: SparkSession) -> None:
    """State in RocksDB, which the state processor needs; a query keeps the
    store it was started with."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)


class SessionProcessor(StatefulProcessor):
    """A state is a slot of session keys, so that a call of the state store serves
    all keys of the slot that a batch has."""

    def __init__(self, idle_us: int | None = None):
        self.idle_us = idle_us

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sessions", SLOT_STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        slot, before = self._read()
        for x in initialState["sessions"]:
            slot[x["customer_id"], x["session_id"]] = (False, x["start_us"], x["last_us"], x["n_events"])
        self._write(slot, before)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        slot, before = self._read()
        # rows of a batch come in any order: the least end so far decides which count
        ends, counted = {}, {}
        for r in rows:
            event_id, ts, customer, session, of_end = r[:5]
            at = (customer, session)
            if at in slot and slot[at][0]:
                continue
            end = ends.get(at)
            if end is not None and event_id > end[0]:
                continue
            if of_end is not None:
                ends[at] = (event_id, ts, of_end)
            counted.setdefault(at, []).append((event_id, ts))
        if not counted:
            return
        now = timerValues.getCurrentWatermarkInMs() if self.idle_us is not None else None
        for at, seen in counted.items():
            _, start, last, n = slot.get(at, (False, None, None, 0))
            # rows of a batch come before the timers that are due in it
            if now is not None and last is not None and now >= self._due(last):
                yield self._close(slot, at, BY_IDLE, start, n)
                continue
            end = ends.get(at)
            times = [ts for event_id, ts in seen if end is None or event_id <= end[0]]
            start, n = min(times if start is None else [start, *times]), n + len(times)
            if end is None:
                slot[at] = (False, start, max(times if last is None else [last, *times]), n)
            else:
                yield self._close(slot, at, BY_END, start, n, {"event_id": end[0], "event_ts_us": end[1], **end[2]})
        self._write(slot, before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        slot, before = self._read()
        now = expiredTimerInfo.getExpiryTimeInMs()
        due = [(at, start, n) for at, (closed, start, last, n) in slot.items() if not closed and self._due(last) <= now]
        for at, start, n in due:
            yield self._close(slot, at, BY_IDLE, start, n)
        if due:
            self._write(slot, before - {now})  # the engine drops the timer that expired

    def _read(self) -> tuple[dict, set[int]]:
        """The slot's sessions by key, and the times its timers stand at."""
        held = self.state.get()
        slot = {(c, s): tuple(x) for c, s, *x in zip(*held, strict=True)} if held else {}
        return slot, self._timers(slot)

    def _write(self, slot: dict, before: set[int]) -> None:
        self.state.update(tuple(list(x) for x in zip(*((*at, *x) for at, x in slot.items()), strict=True)))
        after = self._timers(slot)
        for at in before - after:
            self.handle.deleteTimer(at)
        for at in after - before:
            self.handle.registerTimer(at)

    def _timers(self, slot: dict) -> set[int]:
        return set() if self.idle_us is None else {self._due(last) for closed, _, last, _ in slot.values() if not closed}

    def _due(self, last: int) -> int:
        return (last + self.idle_us) // 1000

    def _close(self, slot: dict, at: tuple, by: str, start: int, n: int, end: dict | None = None) -> Row:
        slot[at] = (True, None, None, n)
        return Row(customer_id=at[0], session_id=at[1], closed_by=by, interaction_start_us=start, n_events=n, **(end or dict.fromkeys(END_FIELDS)))


def slot_of(slots: int) -> Column:
    """The slot of a session key."""
    return F.pmod(F.xxhash64(F.col("customer_id").isNull(), "customer_id", F.col("session_id").isNull(), "session_id"), F.lit(slots)).cast("int").alias("slot")


def sessions(flagged: DataFrame, idle: str | None = None, late: str = "0 seconds", start_from: DataFrame | None = None, slots: int = SLOTS) -> DataFrame:
    """Closed sessions of a stream of valid events with ``is_end``: one shuffle
    on the session key's slot into the state. ``idle``: interval without an event after
    which a session is closed unpublished, by event time; ``late`` is how far
    events may be out of order then (later ones are dropped). ``start_from``: OPEN_SESSIONS
    columns. ``slots`` stays the same over restarts from one checkpoint."""
    spark = flagged.sparkSession
    use_rocks_db(spark)
    at = F.col("event_ts").cast("timestamp")
    # what only an end event shows is left out of the others
    slim = flagged.select("event_id", F.unix_micros(at).alias("event_ts_us"), "customer_id", "session_id", F.when(F.col("is_end"), F.struct(*END_ONLY)).alias("of_end"),
                          *([] if idle is None else [at.alias("event_ts")]), slot_of(slots))
    idle_us = None
    if idle is not None:
        slim = slim.withWatermark("event_ts", late)
        idle_us = micros(spark, idle)
    first = None if start_from is None else start_from.select(slot_of(slots), F.struct(*OPEN_SESSIONS).alias("s")) \
        .groupBy("slot").agg(F.collect_list("s").alias("sessions")).groupBy("slot")
    return slim.groupBy("slot").transformWithState(SessionProcessor(idle_us), SESSION_OUT, "append", "none" if idle is None else "eventtime", first)


def micros(spark: SparkSession, interval: str) -> int:
    """An interval of fixed length in microseconds."""
    zero = F.timestamp_micros(F.lit(0))
    return spark.range(1).select(F.unix_micros(zero + F.expr(f"interval {interval}"))).first()[0]


class ListProcessor(StatefulProcessor):
    """Rows are changes (``active`` not null: from this offset on the type is on
    the list, or off it) and events; events come out with their flag. A second
    change of a type at one offset replaces the first."""

    def __init__(self, fields: tuple[str, ...]):
        self.fields = fields

    def init(self, handle) -> None:
        self.changes = handle.getValueState("changes", "at array<long>, active array<boolean>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = self.changes.get()
        changes = dict(zip(*known, strict=True)) if known else {}
        events, new = [], {}
        for r in rows:
            if r["active"] is None:
                events.append(r)
            else:
                new[r["event_id"]] = r["active"]
        changes |= new
        at = sorted(changes)
        if new:
            self.changes.update((at, [changes[x] for x in at]))
        for r in events:
            i = bisect_right(at, r["event_id"])
            yield Row(**{c: r[c] for c in self.fields}, is_end=bool(i and changes[at[i - 1]]))


def flag_by_changes(events: DataFrame, changes: DataFrame, salts: int = SALTS) -> DataFrame:
    """The events with ``is_end``, by a stream of (from_event_id, event_type_cd,
    active): an event's type is on the list if the last change of that type at
    or before its offset says so. Every salt of a type gets each change."""
    use_rocks_db(events.sparkSession)
    kinds = {f.name: f.dataType for f in events.schema.fields}
    none = [F.lit(None).cast(kinds[c]).alias(c) for c in events.columns if c not in ("event_id", "event_type_cd")]
    copied = changes.where("from_event_id is not null and event_type_cd is not null and active is not null") \
        .select(F.col("from_event_id").alias("event_id"), "event_type_cd", *none, F.col("active"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    salted = events.select("*", F.lit(None).cast("boolean").alias("active"), F.pmod(F.xxhash64("event_id"), F.lit(salts)).cast("int").alias("salt"))
    schema = ", ".join(f"{c} {kinds[c].simpleString()}" for c in events.columns) + ", is_end boolean"
    both = salted.unionByName(copied)
    return both.groupBy("event_type_cd", "salt").transformWithState(ListProcessor(tuple(events.columns)), schema, "append", "none")
