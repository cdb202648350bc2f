"""Sessions and free-of-copies streams: batch, stream, late rows, restarts."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cabstar.operators.sessions import first_arrivals, late_events, sessions, streamed_sessions

EVENT = "event_id long, ts timestamp, user_id long, value double"
BEGIN = datetime(2024, 1, 1)


def events(seed, n, hot=0.5):
    rng = random.Random(seed)
    user = lambda: 1 if rng.random() < hot else rng.choice([2, 3, None])
    rows = [(i, BEGIN + timedelta(minutes=rng.choice([rng.randrange(4000), 30 * rng.randrange(100)])), user(), rng.choice([None, 1.1, 0.3])) for i in range(n)]
    return [*rows, (n, None, 1, 1.0)]


def plain(rows, gap):
    out, last = [], {}
    for _, ts, user, value in sorted((r for r in rows if None not in r[1:3]), key=lambda r: r[1]):
        s = last.get(user)
        if s is None or ts - s[2] > gap:
            last[user] = s = [user, ts, ts, 0, []]
            out.append(s)
        s[2], s[3] = ts, s[3] + 1
        s[4] += [] if value is None else [value]
    return {(u, a, z, n, round(sum(v), 6) if v else None) for u, a, z, n, v in out}


def found(df):
    return {(r.user_id, r.session_start, r.last_event, r.n_events, None if r.total_value is None else round(r.total_value, 6)) for r in df.collect()}


def test_batch_sessions_equal_a_plain_loop(spark):
    rows = events(1, 500)
    df = spark.createDataFrame(rows, EVENT).repartition(4)
    for minutes in (30, 45):
        assert found(sessions(df, f"{minutes} minutes")) == plain(rows, timedelta(minutes=minutes))
    assert sessions(df.limit(0)).count() == 0


def stream(spark, folder, work, scratch, name):
    source = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(folder)
    out = f"{scratch}/{name}"
    query = work(source).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{scratch}/{name}-state")
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    return query, spark.read.parquet(out)


def test_streamed_sessions_equal_batch(spark, scratch):
    rows = sorted(events(2, 400)[:-1], key=lambda r: r[1])
    parts = [rows[:200], rows[200:], [(9999, BEGIN + timedelta(days=30), 77, 0.0)]]  # the last one closes all
    for part in parts:
        rng = random.Random(3)
        rng.shuffle(part)
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        _, got = stream(spark, f"{scratch}/in", lambda s: streamed_sessions(s, "30 minutes", "2 hours"), scratch, "out")
    batch = sessions(spark.createDataFrame(rows, EVENT), "30 minutes")
    assert found(got) == found(batch)


def test_copies_and_late_events(spark, scratch):
    minute = lambda m: BEGIN + timedelta(minutes=m)
    first = [(1, minute(0), 1, 1.0), (1, minute(0), 1, 1.0), (2, minute(200), 1, 1.0)]
    second = [(2, minute(200), 1, 1.0), (3, minute(190), 1, 1.0), (4, minute(1), 1, 1.0)]  # 4 comes too late
    late = 0
    for part in (first, second):  # an application each, over the state that the one before left
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        query, got = stream(spark, f"{scratch}/in", lambda s: first_arrivals(s, "30 minutes"), scratch, "out")
        late += late_events(query)
    assert sorted(r.event_id for r in got.collect()) == [1, 2, 3] and late == 1
    query, got = stream(spark, f"{scratch}/in", lambda s: first_arrivals(s, "30 minutes"), scratch, "out")  # a replay
    assert sorted(r.event_id for r in got.collect()) == [1, 2, 3] and late_events(query) == 0
    assert got.where(F.col("event_id") == 1).count() == 1
