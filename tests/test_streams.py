"""Streams with state of their own: restarts, late rows, crashes between output and ledger."""

import datetime
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tessera.streaming import jobs, stateful

START = datetime.datetime(2024, 1, 1)
TYPES = "user bigint, id bigint, ts timestamp"
SECOND = 10**6


def write(spark, path, rows):
    """One file; rows (user, id, seconds)."""
    frame = spark.createDataFrame([(u, i, None if t is None else START + datetime.timedelta(seconds=t)) for u, i, t in rows], TYPES)
    frame.coalesce(1).write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def finish(spark, frame, out, state, schema):
    with stateful.rocksdb(spark):
        query = frame.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
        query.awaitTermination()
    return query, spark.read.schema(schema).parquet(out).collect()


def seconds(micros):
    return micros / SECOND - START.replace(tzinfo=datetime.timezone.utc).timestamp()


def plain_bucket(rows, capacity, period, now):
    """Tokens counted second by second of each request, as a bucket is told of."""
    out = []
    for user in {u for u, _, _ in rows}:
        tokens, last = capacity, None
        for _, ident, at in sorted((r for r in rows if r[0] == user), key=lambda r: (r[2], r[1])):
            start = at if last is None else max(at, last)
            tokens = min(capacity, tokens + (start - (last if last is not None else start)) / period)
            free = start if tokens >= 1 - 1e-9 else start + (1 - tokens) * period
            tokens, last = tokens + (free - start) / period - 1, free
            if free <= now + 1e-6:
                out.append((user, ident, at, round(free, 3)))
    return sorted(out)


def test_token_bucket_goes_on_after_a_restart(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 2]), i, rng.randint(0, 400)) for i in range(120)]
    rows = sorted(rows, key=lambda r: r[2])
    path, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    types = "key bigint, id bigint, arrived bigint, released bigint"
    found = 0
    for k in range(3):  # three runs over one checkpoint
        part = rows[40 * k : 40 * k + 40]
        rng.shuffle(part)
        write(spark, path, part)
        limited = stateful.token_bucket(jobs.json_stream(spark, path, TYPES), "user", "id", "ts", "10 seconds", 2, 4 * SECOND)
        _, got = finish(spark, limited, out, state, types)
        assert len(got) > found  # what is let go comes out as time goes on
        found = len(got)
    got = sorted((r.key, r.id, round(seconds(r.arrived)), round(seconds(r.released), 3)) for r in got)
    now = max(t for _, _, t in rows) - 10
    assert got == plain_bucket(rows, 2, 4, now) and any(r[3] > r[2] for r in got)
    frame = spark.createDataFrame([(u, i, START + datetime.timedelta(seconds=t)) for u, i, t in rows], TYPES)
    paced = stateful.paced(frame, "user", "id", "ts", 2, 4 * SECOND).collect()
    assert sorted((r.key, r.id, round(seconds(r.arrived)), round(seconds(r.released), 3)) for r in paced if seconds(r.released) <= now) == got


def test_rows_that_cost_too_much_or_have_no_time(spark, tmp_path):
    path = str(tmp_path / "in")
    write(spark, path, [(1, 1, 0), (None, 2, 0), (1, None, 1), (1, 3, None)])
    stream = jobs.json_stream(spark, path, TYPES)
    _, got = finish(spark, stateful.token_bucket(stream, "user", "id", "ts", "0 seconds", 1, SECOND), str(tmp_path / "out"), str(tmp_path / "s"), "key bigint, id bigint")
    assert [(r.key, r.id) for r in got] == [(1, 1)]
    with pytest.raises(StreamingQueryException, match="must cost 0 to 1"):
        finish(spark, stateful.token_bucket(stream, "user", "id", "ts", "0 seconds", 1, SECOND, F.lit(2)), str(tmp_path / "out2"), str(tmp_path / "s2"), "key bigint")
    with pytest.raises(ValueError):
        stateful.token_bucket(stream, "user", "id", "ts", "0 seconds", 0, SECOND)


def test_keys_expire_come_again_and_leave_no_state(spark, tmp_path):
    path, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    types = "key string, event string, at bigint, id bigint, hits bigint"
    key = F.col("user").cast("string")
    write(spark, path, [(1, 1, 0), (1, 2, 50), (1, 3, 100), (2, 4, 99), (3, 5, 101), (None, 6, 5)])
    frame = lambda: stateful.expiring_keys(jobs.json_stream(spark, path, TYPES), key, "id", "ts", "10 seconds", 100 * SECOND)
    finish(spark, frame(), out, state, types)
    write(spark, path, [(2, 7, 198), (2, 8, 199), (9, 9, 5), (1, 10, 1000)])  # user 9 is later than the watermark
    query, got = finish(spark, frame(), out, state, types)
    assert jobs.late_rows(query) == 1
    write(spark, path, [(7, 11, 5000)])
    query, got = finish(spark, frame(), out, state, types)
    told = sorted((r.key, round(seconds(r.at)), r.event, r.id, r.hits) for r in got)
    assert told == [
        ("1", 0, "new", 1, 0), ("1", 100, "expired", None, 1), ("1", 100, "new", 3, 0), ("1", 200, "expired", None, 0), ("1", 1000, "new", 10, 0), ("1", 1100, "expired", None, 0),
        ("2", 99, "new", 4, 0), ("2", 199, "expired", None, 1), ("2", 199, "new", 8, 0), ("2", 299, "expired", None, 0), ("3", 101, "new", 5, 0), ("3", 201, "expired", None, 0),
    ]
    # all but the row that the watermark has not passed is forgotten
    assert spark.read.format("statestore").option("stateVarName", "known").load(state).count() == 0


@pytest.mark.parametrize("by_id", [True, False])
def test_a_crash_between_output_and_ledger(spark, tmp_path, by_id):
    path, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    sink = jobs.IdempotentSink(out, str(tmp_path / "ledger"), by_id=by_id, crash_at=1)
    rows = [[(1, 10 * k + i, i) for i in range(5)] for k in range(3)]
    write(spark, path, rows[0])
    stream = jobs.json_stream(spark, path, TYPES, 1).select("id")
    tail = jobs.live_tail(stream, sink, state, "50 milliseconds")
    tail.processAllAvailable()
    write(spark, path, rows[1])
    with pytest.raises(StreamingQueryException, match="stopped behind the output"):
        tail.processAllAvailable()
    assert [r.batch for r in sink.ledger(spark).collect()] == [0]  # the output of batch 1 is there, its entry is not
    assert {r.batch for r in sink.rows(spark, "id bigint").collect()} == {0, 1}
    tail = jobs.live_tail(stream, sink, state, "50 milliseconds")
    write(spark, path, rows[2])
    tail.processAllAvailable()
    tail.stop()
    found = sorted(r.id for r in sink.rows(spark, "id bigint").collect())
    once = sorted(i for part in rows for _, i, _ in part)
    assert found == (once if by_id else sorted(once + [i for _, i, _ in rows[1]]))  # at most that batch stands twice
    assert sorted(r.batch for r in sink.ledger(spark).collect()) == [0, 1, 2]


def test_state_goes_by_groups_of_keys(spark, tmp_path, monkeypatch):
    """Many keys in few groups, over a restart: the same rows as row by row, and one open timer a group, not a key."""
    monkeypatch.setattr(stateful, "KEY_GROUPS", 3)
    rng = random.Random(9)
    rows = sorted(((rng.choice([1, rng.randint(0, 60)]), i, rng.randint(0, 500)) for i in range(600)), key=lambda r: r[2])
    path, age, now = str(tmp_path / "in"), 20, rows[-1][2] - 10
    types = {"known": "key string, event string, at bigint, id bigint, hits bigint", "paced": "key bigint, id bigint, arrived bigint, released bigint"}
    for part in (rows[:300], rows[300:]):
        write(spark, path, part)
        stream = jobs.json_stream(spark, path, TYPES)
        frames = {
            "known": stateful.expiring_keys(stream, F.col("user").cast("string"), "id", "ts", "10 seconds", age * SECOND),
            "paced": stateful.token_bucket(stream, "user", "id", "ts", "10 seconds", 5, 2 * SECOND, F.col("id") % 3 + 1),
        }
        got = {name: finish(spark, frame, str(tmp_path / name), str(tmp_path / f"{name}-state"), types[name])[1] for name, frame in frames.items()}
    told = []
    for user in {u for u, _, _ in rows}:
        until, hits = None, 0
        for _, ident, at in sorted((r for r in rows if r[0] == user and r[2] <= now), key=lambda r: (r[2], r[1])):
            if until is not None and at < until:
                hits += 1
                continue
            told += [(str(user), "expired", until, None, hits)] if until is not None else []
            told.append((str(user), "new", at, ident, 0))
            until, hits = at + age, 0
        told += [(str(user), "expired", until, None, hits)] if until is not None and until <= now else []
    found = [(r.key, r.event, round(seconds(r.at)), r.id, r.hits) for r in got["known"]]
    assert sorted(map(repr, found)) == sorted(map(repr, told))
    frame = spark.createDataFrame([(u, i, START + datetime.timedelta(seconds=t)) for u, i, t in rows], TYPES)
    paced = stateful.paced(frame, "user", "id", "ts", 5, 2 * SECOND, F.col("id") % 3 + 1).collect()
    assert sorted(map(tuple, got["paced"])) == sorted(tuple(r) for r in paced if seconds(r.released) <= now)
    assert spark.read.format("statestore").option("stateVarName", "next").load(str(tmp_path / "known-state")).count() <= 3
