"""Operators with keyed state and event-time timers: exact time-to-live de-duplication, and live positions that expire.

State lies in the engine's state store (RocksDB, see ``session.CONTRACT``) and is restored from the checkpoint. Timers fire
when the watermark passes them, so nothing depends on when a batch happens to run. Rows of one key and instant are cut
to one before they are shuffled; a key then brings its task at most one row per second and input task.
"""

from __future__ import annotations

import bisect
import functools
import json
import operator
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from contrail.functions import has_position
from contrail.operators.views import POSITION_COLUMNS
from contrail.schemas import DEDUPE_KEYS, DEDUPE_TTL_SECONDS, STATE
from contrail.sources.tables import FolderTarget

_AT, _WHEN, _ID, _BUCKET = "_at", "_when", "_id", "_bucket"
# Between two texts of a key; in JSON a line break is escaped.
_EXACT = "\n"
_BY_CLOCK = operator.itemgetter(0, 1)
# The engine's first watermark is the epoch, and a row at or before it would be late. Clocks may begin there, so the
# event time that the engine sees lies this many seconds (136 years) later. Workers get it as Python's times, which end
# with the year 9999; pandas' times would end in 2262, so it is made only where no pandas follows.
_SHIFT = 1 << 32


def _timer(second: int) -> int:
    return (second + _SHIFT) * 1000


def _first(value: object) -> tuple:
    """Sorts NaN and then nulls last."""
    return (value is None, value != value, value)


def _one_per_instant(df: DataFrame, keys: Sequence[str], order: Sequence[str], ascending: bool = True) -> DataFrame:
    """Of rows with equal key and clock that are read together, the first by ``order``: less to shuffle, same outcome."""
    keys, order = [*keys, _AT], [(c, "ascending" if ascending else "descending") for c in order]

    def firsts(batch: pa.RecordBatch) -> pa.Array:
        numbered = pa.table({str(n): batch[c] for n, c in enumerate(keys)}).append_column(
            "row", pa.array(np.arange(batch.num_rows)))
        names = numbered.column_names[:-1]
        return numbered.group_by(names, use_threads=False).aggregate([("row", "min")])["row_min"].combine_chunks()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = firsts(batch)
            if len(left) < batch.num_rows:
                if order:
                    nulls = "at_end" if ascending else "at_start"
                    batch = batch.take(pc.sort_indices(batch, sort_keys=order, null_placement=nulls))
                    left = firsts(batch)
                batch = batch.take(left)
            yield batch

    return df.mapInArrow(cut, df.schema)


def _timed(
    df: DataFrame, clock: str, lateness: int, keys: Sequence[str], order: Sequence[str], columns: Sequence[str],
    ascending: bool = True,
) -> DataFrame:
    """``columns`` with ``_at`` in whole seconds, one row per key and instant of those read together, and a watermark
    ``lateness`` seconds behind the newest; rows without a clock are left out."""
    at = F.col(clock).cast("long")
    cut = _one_per_instant(df.where(at.isNotNull()).select(*columns, at.alias(_AT)), keys, order, ascending)
    return cut.withColumn(_WHEN, F.timestamp_seconds(F.col(_AT) + _SHIFT)).withWatermark(_WHEN, f"{lateness} seconds")


# ---- time-to-live

class _TimeToLive(StatefulProcessor):
    """State of a bucket of keys: of each key the clocks of its acceptances that can still matter, in order.

    It is one text, as Python looks at every element of an array that goes to the store.
    """

    def __init__(self, columns: list[str], order: list[str], ttl: int):
        self.columns, self.order, self.ttl = columns, order, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.accepted = handle.getValueState("accepted", "clocks string, timer bigint")
        self.passed = Row(_ID, _AT, *self.columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        known, timer = self._read()
        changed = False
        for one, line in self._by_key(rows).items():
            clocks = known.get(one, [])
            for at, _, text, row in line:
                place = bisect.bisect_right(clocks, at)
                if place == 0 or at >= clocks[place - 1] + self.ttl:
                    clocks.insert(place, at)
                    known[one] = clocks
                    changed = True
                    yield self.passed(text, at, *[row[c] for c in self.columns])
        if changed:
            self._keep(known, timer, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        known, _ = self._read()
        self._keep(known, None, timerValues)
        return iter(())

    def close(self) -> None:
        pass

    def _by_key(self, rows: Iterator[Row]) -> dict[str, list[tuple]]:
        """The time line of each key: clock, places among rows of that clock, text of the key and row."""
        lines: dict[str, list[tuple]] = {}
        for row in rows:
            if not lines:  # fields are looked up once, as rows are many
                names = row.__fields__
                when, text, order = names.index(_WHEN), names.index(_ID), [names.index(c) for c in self.order]
            values = tuple(row)
            one = values[text].partition(_EXACT)[0]
            at = int(values[when].timestamp()) - _SHIFT
            lines.setdefault(one, []).append((at, [_first(values[c]) for c in order], values[text], row))
        for line in lines.values():
            line.sort(key=_BY_CLOCK)
        return lines

    def _read(self) -> tuple[dict[str, list[int]], int | None]:
        clocks, timer = self.accepted.get() or ("{}", None)
        return json.loads(clocks), timer

    def _keep(self, known: dict[str, list[int]], timer: int | None, timer_values) -> None:
        """Store what has not expired; the timer fires when the first of its keys has."""
        alive = timer_values.getCurrentWatermarkInMs() // 1000 - _SHIFT - self.ttl
        known = {one: left for one, clocks in known.items() if (left := [a for a in clocks if a > alive])}
        due = min((clocks[-1] + self.ttl for clocks in known.values()), default=None)
        if timer is not None and timer != due:
            self.handle.deleteTimer(_timer(timer))
        if due is None:
            self.accepted.clear()
            return
        self.accepted.update((json.dumps(known, ensure_ascii=False, separators=(",", ":")), due))
        if timer != due:
            self.handle.registerTimer(_timer(due))


# Types that JSON gives back as they were.
_TEXT = (T.StringType, T.BooleanType, T.IntegralType, T.FractionalType, T.DateType, T.TimestampType, T.TimestampNTZType,
         T.BinaryType)
_OPTIONS = {
    "ignoreNullFields": "false", "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    """A key as text, equal where all parts are equal or both null, up to ``_EXACT``. What follows is the text that gives
    the parts back, where that is another one."""
    kinds = {f.name: f.dataType for f in df.schema}

    def part(name: str, exact: bool) -> Column:
        value = F.col(name)
        if isinstance(kinds[name], T.StringType):
            value = F.validate_utf8(value)
        if isinstance(kinds[name], (T.FloatType, T.DoubleType)) and not exact:
            value = F.when(value == 0, F.lit(0.0)).otherwise(value)
        return value.alias(name)

    equal, exact = (F.to_json(F.struct(*[part(k, e) for k in keys]), _OPTIONS) for e in (False, True))
    zeros = [k for k in keys if isinstance(kinds[k], (T.FloatType, T.DoubleType))]
    if not zeros:
        return equal
    signed = functools.reduce(Column.__or__, [(F.col(k) == 0) & F.col(k).cast("string").startswith("-") for k in zeros])
    return F.when(signed, F.concat(equal, F.lit(_EXACT), exact)).otherwise(equal)


def dedupe_stateful(
    df: DataFrame, keys: Sequence[str] = DEDUPE_KEYS, ttl: int = DEDUPE_TTL_SECONDS, clock: str = "clock_s",
    tiebreak: Sequence[str] = (), lateness: int | None = None, buckets: int = 4096,
) -> DataFrame:
    """Streaming only: rows that pass, as ``operators.dedupe_ttl`` says, with the acceptances of a key as keyed state.

    A key is forgotten by a timer, one TTL after its last acceptance. Rows of a batch are taken in the order of their
    clock. A row that comes after newer ones, but less than ``lateness`` seconds (default: the TTL) behind the newest of
    all, passes unless an acceptance lies within the TTL before it, and does not undo what has passed; rows further
    behind are dropped and counted as late. A key's rows meet in one task, at most one per second of the batch and input
    task: for keys hotter than that use ``streaming.dedupe_stream``.

    Python asks the state store over a socket, some five times for each group, which is what most of the time went to
    with one key a group. So keys share ``buckets`` groups by their hash, and a batch asks once for all keys of one.
    Python also takes every field of a row out of its batch by itself. So the parts of a key, which are only compared,
    go through it as one text and are read from that again, and a whole-numbered clock goes as what is made of it.
    """
    if ttl <= 0:
        return df
    columns, kinds = df.columns, {f.name: f.dataType for f in df.schema}
    order = list(tiebreak) or [c for c in columns if c not in keys and c != clock]
    texts = [k for k in dict.fromkeys(keys) if isinstance(kinds[k], _TEXT) and k not in order]
    whole = isinstance(kinds.get(clock), T.IntegralType) and clock not in order and clock not in texts
    carried = [c for c in columns if c not in texts and not (whole and c == clock)]
    timed = _timed(df.withColumn(_ID, _key_text(df, keys)), clock, ttl if lateness is None else lateness, [_ID], order,
                   [_ID, *carried]).drop(_AT)
    equal = F.substring_index(_ID, _EXACT, 1)
    returned = T.StructType([T.StructField(_ID, T.StringType()), T.StructField(_AT, T.LongType()),
                             *[df.schema[c] for c in carried]])
    passed = timed.withColumn(_BUCKET, F.pmod(F.xxhash64(equal), F.lit(buckets))).groupBy(_BUCKET).transformWithState(
        _TimeToLive(carried, order, ttl), returned, "Append", "EventTime")
    if whole:
        passed = passed.withColumn(clock, F.col(_AT).cast(kinds[clock]))
    if texts:
        # A generator, so that the text is read once for all parts.
        parts = F.from_json(F.substring_index(_ID, _EXACT, -1), T.StructType([df.schema[k] for k in texts]),
                            {**_OPTIONS, "mode": "FAILFAST"})
        passed = passed.select("*", F.inline(F.array(parts)))
    return passed.select(*columns)


# ---- live positions

APPEARED, MOVED, REMOVED = "appeared", "moved", "removed"


class _Presence(StatefulProcessor):
    """State of a vehicle that is live: when it was last seen with a position."""

    def __init__(self, key: str, columns: list[str], order: list[str], max_age: int):
        self.key, self.columns, self.order, self.max_age = key, columns, order, max_age

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802
        before = live = self.seen.get()[0] if self.seen.exists() else None
        latest = None
        for row in sorted(rows, key=lambda r: [r[_AT], *[_first(r[c]) for c in self.order]]):
            at = row[_AT]
            if live is not None and at >= live + self.max_age + 1:
                yield self._gone(key[0], live + self.max_age)
                live = latest = None
            if live is not None and at < live:
                continue  # overtaken
            if row["_located"]:
                if live is None:
                    yield Row(**{self.key: key[0], "change": APPEARED, "at": at, **self._position(row)})
                live, latest = at, row
            elif live is not None:
                yield self._gone(key[0], at)
                live = latest = None
        if latest is not None:
            yield Row(**{self.key: key[0], "change": MOVED, "at": live, **self._position(latest)})
        if live != before:
            if before is not None:
                self.handle.deleteTimer(self._deadline(before))
            if live is None:
                self.seen.clear()
            else:
                self.seen.update((live,))
                self.handle.registerTimer(self._deadline(live))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802
        if self.seen.exists():
            live = self.seen.get()[0]
            self.seen.clear()
            yield self._gone(key[0], live + self.max_age)

    def close(self) -> None:
        pass

    def _deadline(self, live: int) -> int:
        """Within the last second in which the vehicle counts as live, so that the next one fires it."""
        return _timer(live + self.max_age) + 500

    def _position(self, row: Row) -> dict:
        return {c: row[c] for c in self.columns}

    def _gone(self, key: str, at: int) -> Row:
        return Row(**{self.key: key, "change": REMOVED, "at": at, **dict.fromkeys(self.columns)})


def live_changes(
    rows: DataFrame, max_age: int = 300, key: str = "icao24", time: str = "ingestion_ts", tiebreak: Sequence[str] = (),
    lateness: int = 0,
) -> DataFrame:
    """Streaming only: what happens to the live positions, as rows to apply to a table of them.

    A vehicle has ``appeared`` with its first position, ``moved`` to the newest one of a batch, and is ``removed`` when
    a newer row has no position or none has come for ``max_age`` seconds: then a timer fires, with nothing to trigger
    it but other vehicles' time. ``at`` is when that happened in event time, whole seconds; appearances and removals
    do not depend on how the rows are cut into batches. Rows more than ``lateness`` seconds behind are dropped.
    """
    columns = [c for c in POSITION_COLUMNS if c not in (key, "updated_at_utc")]
    order = list(tiebreak)
    kept = rows.where(F.col(key) != "").withColumn("_located", has_position(F.col("lat"), F.col("lon")))
    kept = kept.withColumn("_clock", F.unix_timestamp(time)).select(key, "_clock", "_located", *columns, *[
        c for c in order if c not in columns])
    # Of one second the last row counts, here as in the state.
    timed = _timed(kept, "_clock", lateness, [key], order, [c for c in kept.columns if c != "_clock"], ascending=False)
    fields = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType([T.StructField(key, fields[key]), T.StructField("change", T.StringType()),
                           T.StructField("at", T.LongType()), *[T.StructField(c, fields[c]) for c in columns]])
    changes = timed.groupBy(key).transformWithState(
        _Presence(key, columns, order, max_age), schema, "Append", "EventTime")
    return changes.withColumn("at", F.timestamp_seconds("at"))


def apply_changes(current: DataFrame, changes: DataFrame, key: str = "icao24") -> DataFrame:
    """The table of live positions after a batch of ``live_changes``: of each vehicle the last change, unless that is its
    removal. Both sides enter one aggregate; equal times are settled in the order removed, appeared, moved."""
    rank = F.when(F.col("change") == REMOVED, 0).when(F.col("change") == APPEARED, 1).otherwise(2)
    columns = current.columns
    both = current.withColumns({"change": F.lit(MOVED), "_rank": F.lit(-1)}).unionByName(
        changes.withColumnRenamed("at", "updated_at_utc").select(*columns, "change", rank.alias("_rank")))
    values = F.struct(*[c for c in [*columns, "change"] if c != key])
    last = both.groupBy(key).agg(F.max_by(values, F.struct("updated_at_utc", "_rank")).alias("_last"))
    return last.where(F.col("_last.change") != REMOVED).select(
        *[F.col(c if c == key else f"_last.{c}").alias(c) for c in columns])


LIVE = T.StructType([f for c in POSITION_COLUMNS for f in STATE.schema if f.name == c])


def keep_live(target: FolderTarget, name: str = "live_positions") -> Callable[[DataFrame, int], None]:
    """A batch writer that applies ``live_changes`` to a versioned table of live positions, read by ``read_live``."""

    def write(changes: DataFrame, batch_id: int) -> None:
        current = target.keyed(changes.sparkSession, name, before=batch_id)
        if current is None:
            current = changes.sparkSession.createDataFrame([], LIVE)
        target.write_version(apply_changes(current, changes), name, batch_id)

    return write


def read_live(spark: SparkSession, target: FolderTarget, name: str = "live_positions") -> DataFrame:
    rows = target.keyed(spark, name)
    return spark.createDataFrame([], LIVE) if rows is None else rows
