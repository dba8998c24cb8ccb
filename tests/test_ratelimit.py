import datetime
import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from embedlift.operators.ratelimit import TOKEN, make_bucket, make_transfer, rate_limit


def by_hand(times, per_minute, burst):
    """Plain token bucket with exact fractions."""
    from fractions import Fraction

    tokens, last, out = Fraction(burst), None, []
    for t in times:
        if last is not None:
            tokens = min(Fraction(burst), tokens + Fraction((t - last) * per_minute, TOKEN))
        last = t
        ok = tokens >= 1
        tokens -= ok
        out.append(ok)
    return out


times_lists = st.lists(st.integers(0, 200_000_000), min_size=1, max_size=60).map(sorted)


@settings(max_examples=200, deadline=None)
@given(times_lists, st.integers(1, 20), st.integers(1, 5))
def test_bucket_follows_the_definition(times, per_minute, burst):
    assert make_bucket(per_minute, burst)(times, None)[0] == by_hand(times, per_minute, burst)


@settings(max_examples=300, deadline=None)
@given(times_lists, st.integers(1, 20), st.integers(1, 5), st.integers(0, 10**9))
def test_transfer_equals_replay(times, per_minute, burst, back):
    decide = make_bucket(per_minute, burst)
    start, extend, resolve = make_transfer(per_minute, burst)
    pieces = start(times[0])
    for cut in range(0, len(times), 7):
        pieces = extend(pieces, times[cut:cut + 7])
    v = times[0] * per_minute - back
    assert resolve(pieces, v) == decide(times, v)[1]
    assert resolve(pieces, None) == decide(times, None)[1]


def test_a_long_busy_stretch_stays_small():
    start, extend, _ = make_transfer(100, 20)
    times = list(range(0, 60_000_000, 20_000))
    assert len(extend(start(0), times)) <= 22


def test_burst_of_three_then_denied_and_keys_are_apart(spark):
    base = datetime.datetime(2026, 1, 1)
    rows = [(i, key, base) for i, key in enumerate(["a", "a", "b", "a", "a", None])]
    df = spark.createDataFrame(rows, "event_id bigint, api_key string, ts timestamp")
    got = {r["event_id"]: (r["allowed"], r["code"]) for r in rate_limit(df, per_minute=10, burst=3).collect()}
    assert [got[i][0] for i in range(6)] == [True, True, True, True, False, True]
    assert got[4][1] == -32002


def test_one_key_with_most_rows_over_many_partitions(spark):
    rng = random.Random(7)
    t, rows = 0, []
    for i in range(4000):
        t += rng.choice([0, 1000, 200_000, 3_000_000, 30_000_000])
        rows.append((i, "hot" if rng.random() < 0.9 else f"k{i % 5}", t))
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["event_id", "api_key", "us"])).selectExpr(
        "event_id", "api_key", "timestamp_micros(us) AS ts")
    got = {r["event_id"]: r["allowed"] for r in rate_limit(df, per_minute=30, burst=4, partitions=16).collect()}
    for key in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == key]
        assert [got[r[0]] for r in mine] == by_hand([r[2] for r in mine], 30, 4)
    assert len(got) == len(rows)


def test_high_rates_leave_64_bits(spark):
    base = 1_760_000_000_000_000
    rows = [(i, "hot", base + i * 4_000) for i in range(3000)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["event_id", "api_key", "us"])).selectExpr(
        "event_id", "api_key", "timestamp_micros(us) AS ts")
    got = {r["event_id"]: r["allowed"] for r in rate_limit(df, per_minute=6000, burst=5, partitions=8).collect()}
    assert [got[i] for i in range(3000)] == by_hand([r[2] for r in rows], 6000, 5)


def stream_decisions(spark, scratch, files, **options):
    """Rows of each file are one micro-batch; decisions and the task that made them by event id."""
    from pyspark.sql import functions as F

    from embedlift.sources.streams import stream_records
    from embedlift.streaming.requests import rate_limit_stream

    for i, rows in enumerate(files):
        df = spark.createDataFrame(pd.DataFrame(rows, columns=["event_id", "api_key", "us"])).selectExpr("event_id", "api_key", "timestamp_micros(us) AS ts")
        df.coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        stream = stream_records(spark, f"{scratch}/in", "event_id bigint, api_key string, ts timestamp", files_per_batch=1)
        (rate_limit_stream(stream, **options).withColumn("task", F.spark_partition_id()).writeStream.format("parquet").option("path", f"{scratch}/out")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start().awaitTermination())
    return {r["event_id"]: (r["allowed"], r["task"]) for r in spark.read.parquet(f"{scratch}/out").collect()}


def test_stream_splits_a_busy_key_and_decides_like_the_definition(spark, scratch):
    rng = random.Random(11)
    t, rows = 0, []
    for i in range(3000):
        t += rng.choice([0, 1000, 20_000, 300_000, 3_000_000])
        rows.append((i, None if rng.random() < 0.9 else f"k{i % 5}", t))
    got = stream_decisions(spark, scratch, [rows[:1500], rows[1500:]], per_minute=30, burst=4, slice_of="1 minute")
    for key in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == key]
        assert [got[r[0]][0] for r in mine] == by_hand([r[2] for r in mine], 30, 4)
    hot = [got[r[0]][1] for r in rows if r[1] is None]
    assert len(got) == len(rows) and len(set(hot)) >= 4 and max(map(hot.count, set(hot))) < 0.6 * len(hot)


def test_stream_takes_late_requests_as_arriving_now_and_ends_with_expiry(spark, scratch):
    first = [(i, "a", 60_000_000 + i) for i in range(3)]
    late = [(10 + i, "a", i) for i in range(30)] + [(50, "a", 90_000_000)]
    got = stream_decisions(spark, scratch, [first, late], per_minute=2, burst=3, forget_after="1 hour")
    assert [got[i][0] for i in range(3)] == [True] * 3
    assert not any(got[10 + i][0] for i in range(30)) and got[50][0]
