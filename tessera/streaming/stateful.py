"""Streaming operators with state of their own: a rate limit by token buckets, and keys that expire.

Both go by event time alone. Rows wait in state until the watermark has passed them and are then taken in the order of
their times, so results do not depend on how the stream was cut into batches, and a restart from the checkpoint goes on
where it stopped. State lives in RocksDB; what has run out is removed by timers. Keys are dealt to groups by a hash; a task
holds the state and a batch's rows of one group at a time, and numpy takes all keys of a group at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.stateful_processor import ListState

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; the setting is put back behind them."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _ms(micros: int) -> int:
    """The first millisecond of a watermark that has passed a time."""
    return -(-micros // 1000)


#: Groups that the keys are dealt to by a hash. A group's state is a few Arrow tables, so that what a batch costs goes by
#: its rows; the state store is asked a dozen times a group and not a dozen times a key. A checkpoint keeps its number.
KEY_GROUPS = 1024
#: Rows of a table kept in state in one value.
_ROWS = 1 << 20
#: Rows that come out in one.
_OUT = 1 << 14
#: Before all times.
_NEVER = -(1 << 62)


def _packed(table: pa.Table) -> list[tuple[bytes]]:
    out = []
    for lo in range(0, table.num_rows, _ROWS):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table.slice(lo, _ROWS))
        out.append((sink.getvalue().to_pybytes(),))
    return out


class _InOrder(StatefulProcessor):
    """Holds rows (key, at, id, cost) of a group of keys back until the watermark has passed them, then gives them to take()."""

    def __init__(self, key: pa.DataType):
        self.key = key

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = self.table("rows", at=pa.int64(), id=pa.int64(), cost=pa.int64())
        self.next = handle.getValueState("next", "ms bigint")

    def table(self, name: str, **columns: pa.DataType) -> tuple[ListState, pa.Schema]:
        """A table in state, with a column `key`."""
        return self.handle.getListState(name, "part binary"), pa.schema({"key": self.key, **columns})

    def read(self, state: tuple[ListState, pa.Schema]) -> pa.Table:
        found, schema = state
        return pa.concat_tables([schema.empty_table(), *(pa.ipc.open_stream(bytes(x[0])).read_all() for x in found.get())]).combine_chunks()

    def replace(self, state: tuple[ListState, pa.Schema], table: pa.Table) -> None:
        state[0].put(_packed(table)) if table.num_rows else state[0].clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at, ident, cost, keys = zip(*(x.row.split(" ", 3) for x in rows), strict=True)
        keys = pa.array(keys, pa.string()).cast(self.key)
        table = pa.table([keys, *(pa.array(map(int, c), pa.int64()) for c in (at, ident, cost))], schema=self.rows[1])
        self.rows[0].appendList(_packed(table))
        self._wake(_ms(pc.min(table["at"]).as_py()), self.next.get())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = self.next.get()
        if waiting is not None and waiting[0] * 1000 <= now:
            self.next.clear()
            waiting = None
        held = self.read(self.rows)
        passed = pc.less_equal(held["at"], now)
        ready, rest = held.filter(passed), held.filter(pc.invert(passed))
        if ready.num_rows:
            self.replace(self.rows, rest)
        out, due = self.take(ready, now)
        due = [x for x in (due, pc.min(rest["at"]).as_py()) if x is not None]
        if due:
            self._wake(_ms(min(due)), waiting)
        make = Row(*out)
        n = len(next(iter(out.values())))
        return (make(*(c[lo : lo + _OUT].tolist() for c in out.values())) for lo in range(0, n, _OUT))

    def _wake(self, ms: int, waiting: tuple[int] | None) -> None:
        """One timer is open at a time: the earliest."""
        if waiting is None or ms < waiting[0]:
            if waiting is not None:
                self.handle.deleteTimer(waiting[0])
            self.handle.registerTimer(ms)
            self.next.update((ms,))

    def take(self, ready: pa.Table, now: int) -> tuple[dict[str, np.ndarray], int | None]:
        """What comes out once all up to `now` is known, and when something else is due."""
        raise NotImplementedError

    def close(self) -> None:
        pass


def _numbered(*tables: pa.Table) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct keys of all tables, and for each table the numbers of its keys."""
    parts = [c for t in tables for c in t["key"].chunks]
    keys = pa.chunked_array(parts, tables[0].schema.field("key").type).combine_chunks().dictionary_encode()
    return keys.dictionary, np.split(keys.indices.to_numpy().astype(np.int64), np.cumsum([t.num_rows for t in tables])[:-1])


def _of(keys: pa.Array, number: np.ndarray) -> pa.Array:
    return keys.take(pa.array(number))


def _sorted_rows(ready: pa.Table, number: np.ndarray) -> list[np.ndarray]:
    """Number of the key, time, id and cost of the rows by key, time, id and cost."""
    at, ident, cost = (ready[c].to_numpy() for c in ("at", "id", "cost"))
    order = np.lexsort((cost, ident, at, number))
    return [x[order] for x in (number, at, ident, cost)]


class _Buckets(_InOrder):
    def __init__(self, capacity: int, period: int):
        super().__init__(pa.int64())
        self.capacity, self.period = capacity, period

    def init(self, handle) -> None:
        super().init(handle)
        #: When a key's bucket will be full again. At a time t it holds capacity - max(0, full - t) / period tokens.
        self.full = self.table("full", at=pa.int64())
        self.queue = self.table("queue", free=pa.int64(), at=pa.int64(), id=pa.int64())

    def take(self, ready, now):
        known, before = self.read(self.full), self.read(self.queue)
        keys, (of_known, of_before, number) = _numbered(known, before, ready)
        full = np.full(len(keys), _NEVER)
        full[of_known] = known["at"].to_numpy()
        number, at, ident, cost = _sorted_rows(ready, number)
        if len(number):
            # as in paced(): the largest, over the rows so far, of a row's time plus the tokens spent from it on
            first = np.searchsorted(number, number)
            spent = np.cumsum(cost) - cost
            spent = (spent - spent[first]) * self.period
            bases, rank = np.unique(at - spent, return_inverse=True)
            largest = bases[np.maximum.accumulate(number * len(bases) + rank) - number * len(bases)]
            start = full[number]
            behind = np.where(first == np.arange(len(number)), start, np.maximum(start, np.roll(largest, 1))) + spent
            free = np.maximum(at, behind - (self.capacity - cost) * self.period)
            last = np.append(number[1:] != number[:-1], True)
            full[number[last]] = (np.maximum(start, largest) + spent + cost * self.period)[last]
        else:
            free = at
        number = np.concatenate([of_before, number])
        free = np.concatenate([before["free"].to_numpy(), free])
        at = np.concatenate([before["at"].to_numpy(), at])
        ident = np.concatenate([before["id"].to_numpy(), ident])
        go, stay, open_ = free <= now, free > now, np.flatnonzero(full > now)  # a full bucket needs no state
        out = {"key": _of(keys, number[go]).to_numpy(), "id": ident[go], "arrived": at[go], "released": free[go]}
        if ready.num_rows or go.any():
            rest = [_of(keys, number[stay]), free[stay], at[stay], ident[stay]]
            self.replace(self.queue, pa.table(rest, schema=self.queue[1]))
        if ready.num_rows or len(open_) < known.num_rows:
            self.replace(self.full, pa.table([_of(keys, open_), full[open_]], schema=self.full[1]))
        # once more when a bucket is full again, to forget it
        due = np.concatenate([free[stay], full[open_]])
        return out, int(due.min()) if len(due) else None


def _by_group(rows: DataFrame, processor: StatefulProcessor, schema: str) -> DataFrame:
    """Rows (key, id, at, cost, time) through a processor, by groups of keys.

    A row goes to Python as one text and comes back in arrays of many, as each field of a row costs several microseconds.
    """
    line = F.concat_ws(" ", *[F.col(c).cast("string") for c in ("at", "id", "cost", "key")])
    dealt = rows.select(F.pmod(F.xxhash64("key"), F.lit(KEY_GROUPS)).alias("group"), line.alias("row"), "time").groupBy("group")
    columns = [x.split(" ") for x in schema.split(", ")]
    out = dealt.transformWithState(processor, ", ".join(f"{c} array<{t}>" for c, t in columns), "append", "eventTime")
    return out.select(F.explode(F.arrays_zip(*[c for c, _ in columns])).alias("r")).select("r.*")


def token_bucket(stream: DataFrame, key: str, id_col: str, time: str, late: str, capacity: int, period_us: int, cost: Column | None = None) -> DataFrame:
    """(key, id, arrived, released) in microseconds: rows of each key let go as a bucket of tokens allows.

    A key's bucket starts full with `capacity` tokens and gains one every period_us. A row needs `cost` tokens (1; no more
    than capacity, which raises, and at least 0), and is let go when they are there, after all rows of its key before it
    (by time, then id). A row comes out when the watermark (`late` behind the stream) has passed its release; until then it
    waits in state, so a key that is asked for more than its rate keeps a queue. Rows later than the watermark are dropped,
    as any windowed stream does. Rows without a key, an id or a time are left out.
    """
    if capacity < 1 or period_us < 1:
        raise ValueError("a bucket holds a token and gains one in a microsecond at least")
    cost = F.lit(1) if cost is None else cost
    checked = F.when((cost >= 0) & (cost <= capacity), cost.cast("long")).otherwise(F.raise_error(F.concat(F.lit(f"a row must cost 0 to {capacity} tokens, not "), cost.cast("string"))).cast("long"))
    rows = stream.withWatermark(time, late).where(F.col(key).isNotNull() & F.col(id_col).isNotNull() & F.col(time).isNotNull())
    rows = rows.select(F.col(key).cast("long").alias("key"), F.col(id_col).cast("long").alias("id"), F.unix_micros(time).alias("at"), checked.alias("cost"), F.col(time).alias("time"))
    return _by_group(rows, _Buckets(capacity, period_us), "key bigint, id bigint, arrived bigint, released bigint")


def paced(rows: DataFrame, key: str, id_col: str, time: str, capacity: int, period_us: int, cost: Column | None = None) -> DataFrame:
    """What token_bucket() gives for a whole table, by windows: a bucket is full again at the largest, over the rows so far,
    of a row's time plus the tokens spent from it on."""
    cost = F.lit(1) if cost is None else cost
    order = Window.partitionBy("key").orderBy("arrived", "id")
    rows = rows.select(F.col(key).cast("long").alias("key"), F.col(id_col).cast("long").alias("id"), F.unix_micros(time).alias("arrived"), cost.cast("long").alias("cost")).dropna()
    spent = F.sum("cost").over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("spent", spent).withColumn("base", F.col("arrived") - (F.col("spent") - F.col("cost")) * period_us)
    full = F.max("base").over(order.rowsBetween(Window.unboundedPreceding, -1)) + (F.col("spent") - F.col("cost")) * period_us
    return rows.select("key", "id", "arrived", F.greatest("arrived", full - (capacity - F.col("cost")) * period_us).alias("released"))


class _Expiring(_InOrder):
    def __init__(self, age: int):
        super().__init__(pa.string())
        self.age = age

    def init(self, handle) -> None:
        super().init(handle)
        self.known = self.table("known", until=pa.int64(), hits=pa.int64())

    def take(self, ready, now):
        known = self.read(self.known)
        keys, (of_known, number) = _numbered(known, ready)
        until, hits = np.full(len(keys), _NEVER), np.zeros(len(keys), np.int64)
        until[of_known], hits[of_known] = known["until"].to_numpy(), known["hits"].to_numpy()
        number, at, ident, _ = _sorted_rows(ready, number)
        times, rank = np.unique(at, return_inverse=True)
        place = number * (len(times) + 1) + rank
        row, end = (np.searchsorted(number, np.arange(len(keys)), side) for side in ("left", "right"))
        new, old = [], []

        def forget(which: np.ndarray) -> None:
            old.append((which, until[which], hits[which]))

        # one round takes one life of every key that has rows left
        live = np.flatnonzero(row < end)
        while len(live):
            stop = np.searchsorted(place, live * (len(times) + 1) + np.searchsorted(times, until[live]))
            stop = np.maximum(stop, row[live])
            hits[live] += stop - row[live]
            row[live] = stop
            live = live[stop < end[live]]
            forget(live[until[live] != _NEVER])
            at_row = row[live]
            new.append((live, at[at_row], ident[at_row]))
            until[live], hits[live], row[live] = at[at_row] + self.age, 0, at_row + 1
            live = live[row[live] < end[live]]
        gone = np.flatnonzero((until != _NEVER) & (until <= now))
        forget(gone)
        until[gone] = _NEVER
        left = np.flatnonzero(until != _NEVER)
        if ready.num_rows or len(gone):
            self.replace(self.known, pa.table([_of(keys, left), until[left], hits[left]], schema=self.known[1]))

        born, forgotten = np.concatenate([x for x, _, _ in new] + [left[:0]]), np.concatenate([x for x, _, _ in old])
        out = {
            "key": _of(keys, np.concatenate([born, forgotten])).to_numpy(zero_copy_only=False),
            "event": np.repeat(np.array(["new", "expired"], object), [len(born), len(forgotten)]),
            "at": np.concatenate([x for _, x, _ in new + old]),
            "id": np.concatenate([*(x.astype(object) for _, _, x in new), np.full(len(forgotten), None)]),
            "hits": np.concatenate([np.zeros(len(born), np.int64), *(x for _, _, x in old)]),
        }
        return out, int(until[left].min()) if len(left) else None


def expiring_keys(stream: DataFrame, key: Column, id_col: str, time: str, late: str, age_us: int) -> DataFrame:
    """(key, event, at, id, hits): each key's first row, and again its first row after it was forgotten.

    A key is known for age_us of event time from its first row on; rows that it has in that time are counted and do not
    make it younger. "new": the row that made it known (id, its time `at`). "expired": when it is forgotten, and how many
    rows it had in between. State holds the keys that are known now, no others. Rows come out when the watermark has passed
    their times; rows later than the watermark are dropped; rows without a key, an id or a time are left out.
    """
    rows = stream.withWatermark(time, late).withColumn("_key", key.cast("string"))
    rows = rows.where(F.col("_key").isNotNull() & F.col(id_col).isNotNull() & F.col(time).isNotNull())
    rows = rows.select(F.col("_key").alias("key"), F.col(id_col).cast("long").alias("id"), F.unix_micros(time).alias("at"), F.lit(0).cast("long").alias("cost"), F.col(time).alias("time"))
    return _by_group(rows, _Expiring(age_us), "key string, event string, at bigint, id bigint, hits bigint")
