"""Live forms of the request log operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import TimerValues

from embedlift.model import RATE_BURST, RATE_PER_MINUTE, RPC_CODES
from embedlift.operators.ratelimit import ANONYMOUS, make_bucket, make_transfer

_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_CHUNK = "api_key string, first bigint, times binary, ties binary, pieces array<array<string>>"
_DECIDED = "api_key string, first bigint, times binary, ties binary, allowed array<boolean>, v string"


class _Buckets(StatefulProcessor):
    """The state of a key's bucket, carried over its chunks in time order."""

    def __init__(self, per_minute: int, burst: int, idle_ms: int | None):
        self.per_minute, self.burst, self.idle_ms = per_minute, burst, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("bucket", "v string, last bigint, timer bigint")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[Row]:
        import numpy as np

        decide = make_bucket(self.per_minute, self.burst)
        _, _, resolve = make_transfer(self.per_minute, self.burst)
        v, last, timer = self.state.get() if self.state.exists() else (None, None, None)
        v = None if v is None else int(v)   # kept as text: it leaves 64 bits at high rates
        for chunk in sorted(rows, key=lambda r: r["first"]):
            entry, allowed, times = v, None, np.frombuffer(bytes(chunk["times"]), dtype=np.int64)
            if chunk["pieces"] is None or last is not None and chunk["first"] < last:
                if last is not None:
                    times = np.maximum(times, last)
                allowed, v = decide(times.tolist(), v)
            else:
                v = resolve([(int(a), int(b), fixed == "1", int(x)) for a, b, fixed, x in chunk["pieces"]], v)
            last = int(times[-1]) if last is None else max(last, int(times[-1]))
            yield Row(api_key=key[0], first=chunk["first"], times=bytes(chunk["times"]), ties=bytes(chunk["ties"]), allowed=allowed,
                      v=None if entry is None else str(entry))
        if self.idle_ms:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = chunk["arrived_ms"] + self.idle_ms
            self.handle.registerTimer(timer)
        self.state.update((str(v), last, timer))

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo) -> Iterator[Row]:
        self.state.clear()
        yield from ()

    def close(self) -> None:
        pass


def rate_limit_stream(requests: DataFrame, key: str = "api_key", ts: str = "ts", tie: str = "event_id",
                      per_minute: int = RATE_PER_MINUTE, burst: int = RATE_BURST,
                      forget_after: str | None = None, slice_of: str = "1 minute") -> DataFrame:
    """Token bucket per key as stateful streaming: ``api_key, event_id, ts, allowed, code``.

    A key's requests are decided in time order inside a micro-batch and across them; a request older
    than the state counts as arriving now.

    No key has to fit a task. The requests of a micro-batch are dealt by key and time slice; each
    slice becomes one row, its requests packed, with the function from the state before it to the
    state after it that the batch form uses. Only these rows meet by key, where the stored state is
    carried from slice to slice at a cost that does not depend on their length. The slices are then
    dealt out again and decided with the state they start with. Slices of at most twice the burst
    are decided on the way.

    With ``forget_after`` ("1 hour") a timer drops the stored bucket of a key that has been silent
    that long, which is the same as a full bucket once it exceeds the time a bucket needs to fill.
    Timers go by the time of arrival, as a watermark of which no request is late: they fire while
    further batches arrive, and a query over finished input ends without waiting for them. Sets the
    session's state store provider, which this operator needs, to RocksDB.
    """
    spark = requests.sparkSession
    spark.conf.set(*_STORE)
    short, slice_us = 2 * burst, _milliseconds(slice_of) * 1000
    decide = make_bucket(per_minute, burst)
    start, extend, _ = make_transfer(per_minute, burst)

    def packed(batches):
        import pandas as pd

        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True).sort_values(["_key", "_t", "_tie"], kind="stable")
        for (name, _), chunk in rows.groupby(["_key", "_slice"], sort=False):
            times = chunk["_t"].to_numpy("int64")
            pieces = None
            if len(times) > short:
                given = times.tolist()
                pieces = [[str(int(x)) for x in p] for p in extend(start(given[0]), given)]
            yield pd.DataFrame({"api_key": [name], "first": [int(times[0])], "times": [times.tobytes()],
                                "ties": [chunk["_tie"].to_numpy("int64").tobytes()], "pieces": [pieces]})

    def unpacked(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            for r in batch.itertuples(index=False):
                times = np.frombuffer(r.times, dtype=np.int64)
                allowed = r.allowed
                if allowed is None:
                    allowed, _ = decide(times.tolist(), None if r.v is None else int(r.v))
                yield pd.DataFrame({"api_key": r.api_key, "event_id": np.frombuffer(r.ties, dtype=np.int64), "t": times, "allowed": np.asarray(allowed, dtype=bool)})

    keyed = requests.select(
        F.coalesce(F.col(key).cast("string"), F.lit(ANONYMOUS)).alias("_key"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"), F.col(tie).cast("bigint").alias("_tie"))
    keyed = keyed.withColumn("_slice", F.expr(f"_t div {slice_us}"))
    chunks = keyed.repartition("_key", "_slice").mapInPandas(packed, _CHUNK)
    idle_ms = _milliseconds(forget_after) if forget_after else None
    if idle_ms:
        now = F.current_timestamp()
        chunks = chunks.withColumn("arrived", now).withColumn("arrived_ms", F.unix_millis(now)).withWatermark("arrived", "1 second")
    carried = chunks.groupBy("api_key").transformWithState(_Buckets(per_minute, burst, idle_ms), _DECIDED, "append", "EventTime" if idle_ms else "None")
    decided = carried.repartition("api_key", "first").mapInPandas(unpacked, "api_key string, event_id bigint, t bigint, allowed boolean")
    return decided.select("api_key", "event_id", F.timestamp_micros("t").alias("ts"), "allowed",
                          F.when(F.col("allowed"), 0).otherwise(RPC_CODES["rate_limited"]).alias("code"))


def _milliseconds(text: str) -> int:
    number, unit = text.split()
    return int(float(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1000)
