"""Stateful stream operators with event-time timers: delayed retries, and rows that come too late.

State lives in the query's state store below its checkpoint, and a timer bounds how long it stays. A
key costs a few calls between Spark and Python wherever it is a group of its own, so keys are dealt into
``BUCKETS`` by hash: a bucket is the group, its keys share one entry and one timer, set to the earliest
time any of them waits for. The operators see late rows: the event time they decide by is a plain
column, so that Spark moves the watermark by the source's own and leaves no row out before they are
counted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docloom import schemas
from docloom.operators.blocks import unpacked, written

STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
ACCEPTED, DUPLICATE, LATE = "accepted", "duplicate", "late"
KEY, BUCKET = "docloom_key", "docloom_bucket"  # columns; Spark hands names with a leading bar to Python as others
BUCKETS = 1024  # of keys; part of a checkpoint, so a query must go on with the number it began with
# Times with all their digits, so that different keys have different texts.
KEY_TEXT = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
            "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _watched(stream: DataFrame, ts: str, lateness: str, kept: str) -> DataFrame:
    """``ts`` sets the watermark and leaves the rows; its milliseconds stay as ``kept``."""
    return stream.withWatermark(ts, lateness).withColumn(kept, F.unix_millis(ts)).drop(ts)


def _keyed(stream: DataFrame, keys: Sequence[str], processor: StatefulProcessor, out: T.StructType | str) -> DataFrame:
    """``processor`` gets the rows of a bucket with their key as text in ``KEY``."""
    stream.sparkSession.conf.set(*STATE_STORE)
    key = F.to_json(F.struct(*[F.col(c).alias(str(i)) for i, c in enumerate(keys)]), KEY_TEXT)
    return stream.withColumn(KEY, key) \
        .withColumn(BUCKET, F.pmod(F.xxhash64(KEY), F.lit(BUCKETS)).cast("int")) \
        .groupBy(BUCKET).transformWithStateInPandas(
            statefulProcessor=processor, outputStructType=out, outputMode="Append", timeMode="EventTime")


class _Bucket(StatefulProcessor):
    """The keys of a bucket: one entry, an Arrow table of all that wait, and one timer.

    A timer rings when the watermark has reached its time, so what waits until the watermark or
    earlier is what timers of their own would have rung for.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("waiting", "rows binary, first bigint")

    def _held(self) -> tuple[pa.Table | None, int | None]:
        """What waits, and the time of the timer."""
        kept = self.entry.get() if self.entry.exists() else None
        return (unpacked(bytes(kept[0])), kept[1]) if kept else (None, None)

    def _hold(self, rows: pa.Table, first: int | None, timer: int | None) -> None:
        """Keep ``rows``, the earliest of which waits until ``first``; ``timer`` is still to ring, if any."""
        if timer is not None and timer != first:
            self.handle.deleteTimer(timer)
        if first is None:
            self.entry.clear()
            return
        if timer != first:
            self.handle.registerTimer(first)
        self.entry.update((written(rows), first))

    def close(self) -> None:
        pass


# Delayed retry ----------------------------------------------------------------------------------

RETRIED = "id string, status string, attempt_count int, tried_at timestamp, retry_at timestamp, last_error string"


class _Retry(_Bucket):
    """Outbox rows: each tried when it is due, and again at its retry time while it fails."""

    def _waiting(self) -> tuple[dict, int | None]:
        """Attempts made, error and time of the next try of each row that waits."""
        table, timer = self._held()
        rows = table.to_pydict() if table is not None else {"id": (), "attempt_count": (), "error": (), "due": ()}
        return dict(zip(rows["id"], zip(rows["attempt_count"], rows["error"], rows["due"]))), timer

    def _wait(self, held: dict, timer: int | None) -> None:
        attempts, errors, due = zip(*held.values()) if held else ((), (), ())
        self._hold(pa.table({
            "id": pa.array(list(held), pa.string()), "attempt_count": pa.array(attempts, pa.int32()),
            "error": pa.array(errors, pa.string()), "due": pa.array(due, pa.int64())}), min(due, default=None), timer)

    @staticmethod
    def _try(held: dict, key: str | None, attempt: int, error: str | None, at: int) -> tuple:
        attempt += 1
        retry = at + 1000 * min(300, 2 ** min(attempt, 8))
        if error is None:
            held.pop(key, None)
        else:
            held[key] = (attempt, error, retry)
        return (key, "failed" if error else "published", attempt, pd.Timestamp(at, unit="ms"),
                pd.Timestamp(retry, unit="ms") if error else pd.NaT, error[:schemas.ERROR_TEXT_MAX] if error else None)

    @staticmethod
    def _tried(tries: list[tuple]) -> Iterator[pd.DataFrame]:
        if tries:
            yield pd.DataFrame(tries, columns=["id", "status", "attempt_count", "tried_at", "retry_at", "last_error"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        given = pd.concat(list(rows))
        given = given[given["due"].notna()].sort_values("due", kind="stable").drop_duplicates("id")
        if given.empty:
            return
        held, timer = self._waiting()
        before = len(held)
        now, tries = timerValues.getCurrentWatermarkInMs(), []
        for row in given.itertuples():
            if row.id in held:  # delivered again while it waits
                continue
            error = None if pd.isna(row.error) else row.error
            if row.due <= max(now, row.seen):
                tries.append(self._try(held, row.id, int(row.attempt_count), error, max(int(row.due), int(row.seen))))
            else:
                # Not tried yet: its first ring is the first try.
                held[row.id] = (int(row.attempt_count), error, int(row.due))
        if len(held) > before:
            self._wait(held, timer)
        yield from self._tried(tries)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, _ = self._waiting()
        now = timerValues.getCurrentWatermarkInMs()
        tries = [self._try(held, name, attempt, error, due) for name, (attempt, error, due) in list(held.items()) if due <= now]
        self._wait(held, None)
        yield from self._tried(tries)


def publishing(checked: DataFrame, ts: str, lateness: str = "0 seconds") -> DataFrame:
    """Every try of every outbox row of a stream: (id, status, attempt_count, tried_at, retry_at, last_error).

    ``checked`` carries the columns of ``outbox.with_publish_error`` and the event time ``ts`` at which
    a row was written. A pending or failed row is tried when it becomes due, and a failed one again at
    its retry time, as the watermark passes it: two, four, eight seconds later and so on. The last try
    of each row up to an instant is what ``publish_due`` leaves when it polls at those times. A row
    delivered again while it waits changes nothing; rows published or held by a worker are not tried.
    """
    # Not a filter: Spark would move one below the watermark, and rows of others keep time too.
    due = F.when(F.col("status").isin("pending", "failed"), F.unix_millis("available_at"))
    rows = _watched(checked.withColumn("due", due), ts, lateness, "seen") \
        .select("id", "attempt_count", "error", "due", "seen")
    return _keyed(rows, ["id"], _Retry(), RETRIED)


# Late and repeated rows -------------------------------------------------------------------------


class _First(_Bucket):
    """The first row of a key is accepted; the key is forgotten when the horizon has passed."""

    def __init__(self, horizon_ms: int) -> None:
        self.horizon = horizon_ms

    def _seen(self) -> tuple[dict[str, int], int | None]:
        """Time of the accepted row of each known key."""
        table, timer = self._held()
        return (dict(zip(*table.to_pydict().values())) if table is not None else {}), timer

    def _remember(self, seen: dict[str, int], timer: int | None) -> None:
        at = pa.array(seen.values(), pa.int64())
        first = min(seen.values()) + self.horizon if seen else None
        self._hold(pa.table({"key": pa.array(list(seen), pa.string()), "at": at}), first, timer)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(rows)).sort_values("at_ms", kind="stable")
        now = timerValues.getCurrentWatermarkInMs()
        seen, timer = self._seen()
        before, outcome = len(seen), []
        for name, at in zip(every[KEY].tolist(), every["at_ms"].astype("int64").tolist()):
            if name in seen:
                outcome.append(DUPLICATE)
            elif at < now:
                outcome.append(LATE)
            else:
                outcome.append(ACCEPTED)
                seen[name] = at
        if len(seen) > before:
            self._remember(seen, timer)
        yield every.drop(columns=["at_ms", KEY, BUCKET]).assign(outcome=outcome)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        seen, _ = self._seen()
        now = timerValues.getCurrentWatermarkInMs()
        self._remember({name: at for name, at in seen.items() if at + self.horizon > now}, None)
        return iter(())


def deduplicated(events: DataFrame, keys: Sequence[str], ts: str, lateness: str, horizon_seconds: int) -> DataFrame:
    """Every row of ``events`` with its ``outcome``: accepted, duplicate or late.

    The first row of a key in event time, of those of a micro-batch, is accepted; another within
    ``horizon_seconds`` of it is a duplicate; a row behind the watermark whose key is not known is
    late, since its first copy may be forgotten. accepted + duplicate + late is the input.
    """
    columns = [c for c in events.columns if c != ts]
    out = T.StructType([*(events.schema[c] for c in columns), T.StructField("outcome", T.StringType())])
    return _keyed(_watched(events, ts, lateness, "at_ms").select(*columns, "at_ms"), keys, _First(1000 * horizon_seconds), out)


class _Window(_Bucket):
    """Messages of label sets and windows, sent on when the watermark passes the window's end."""

    def __init__(self, width_ms: int, labels: Sequence[str]) -> None:
        self.width, self.labels = width_ms, list(labels)

    def _rows(self, counted: pd.DataFrame, messages, late) -> Iterator[pd.DataFrame]:
        if len(counted):
            start = pd.to_datetime(counted["start_ms"], unit="ms")
            yield pd.DataFrame({"window_start": start, "window_end": start + dt.timedelta(milliseconds=self.width),
                                **{label: counted[label] for label in self.labels}, "messages": messages, "late": late})

    def _count(self, counted: pd.DataFrame, timer: int | None) -> None:
        first = int(counted["start_ms"].min()) + self.width if len(counted) else None
        self._hold(pa.Table.from_pandas(counted, preserve_index=False), first, timer)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        every = pd.concat(list(rows)).drop(columns=BUCKET).astype({"start_ms": "int64"}).assign(messages=1)
        counted = self._summed(every)
        late = counted["start_ms"] + self.width <= timerValues.getCurrentWatermarkInMs()
        if not late.all():
            table, timer = self._held()
            held = [] if table is None else [table.to_pandas()]
            self._count(self._summed(pd.concat([*held, counted[~late]])), timer)
        yield from self._rows(counted[late], 0, counted.loc[late, "messages"])

    @staticmethod
    def _summed(rows: pd.DataFrame) -> pd.DataFrame:
        """One row per key with the sum of its messages."""
        total = rows.groupby(KEY)["messages"].sum()
        first = rows.drop_duplicates(KEY)
        return first.assign(messages=total.loc[first[KEY]].to_numpy())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        counted = self._held()[0].to_pandas()
        closed = counted["start_ms"] + self.width <= timerValues.getCurrentWatermarkInMs()
        self._count(counted[~closed], None)
        yield from self._rows(counted[closed], counted.loc[closed, "messages"], 0)


def counted_windows(stream: DataFrame, labels: Sequence[str], ts: str, width_seconds: int = 15,
                    lateness: str = "1 minute") -> DataFrame:
    """(window_start, window_end, labels, messages, late): windows as they close, and late rows.

    A window closes when the watermark reaches its end and is sent once; a row that comes after that
    gives a row with ``messages`` 0 that counts it as ``late``, so no row is lost unseen.
    """
    width = 1000 * width_seconds
    out = T.StructType([
        T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
        *(stream.schema[c] for c in labels), T.StructField("messages", T.LongType()), T.StructField("late", T.LongType())])
    start: Column = F.col("at_ms") - F.pmod("at_ms", F.lit(width))
    rows = _watched(stream, ts, lateness, "at_ms").select(start.alias("start_ms"), *labels)
    return _keyed(rows, ["start_ms", *labels], _Window(width, labels), out)
