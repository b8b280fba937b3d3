"""Streams: deduplication, micro-batches, the keyed work queue, incremental steps.

Times are processing times throughout; event-time windows over the events
table at the end are an extension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.coverage import gaps
from ..sources.sinks import append_unseen


def source(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A stream of a folder's files; ``files_per_batch`` is what holds a producer back, in place of high and low water marks."""
    reader = spark.readStream.format(fmt).schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(path)


def deduplicated(stream: DataFrame, keys: Sequence[str], time: str | None = None, keep: str = "1 day") -> DataFrame:
    """The first row of each key.  With a time column the state of old keys is dropped."""
    if time is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(time, keep).dropDuplicatesWithinWatermark(list(keys))


def flush(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = "60 seconds") -> StreamingQuery:
    """Micro-batches to ``write(rows, batch number)``; without ``every`` all that is there, then the end."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def idempotent(table, key: str, order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A batch writer that appends unseen keys, so a batch that comes again changes nothing."""
    return lambda rows, _: append_unseen(table, rows, key, order)


def annotator(annotate: Callable[[DataFrame], DataFrame], log_path: str, key: str = "sha256") -> Callable[[DataFrame, int], None]:
    """A batch writer that annotates rows without a good record in the log, and appends theirs."""

    def write(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        try:
            done = spark.read.parquet(log_path).where("ok").select(key)
            rows = rows.join(done, key, "left_anti")
        except Exception as e:  # no log yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        annotate(rows).write.mode("append").parquet(log_path)

    return write


class WorkQueue(StatefulProcessor):
    """Each item's way from pending to done or skipped, by key.

    Rows are ``(key, kind, ok, at)``: ``add``, ``claim`` and ``result``, with
    ``at`` in seconds.  A failed item is pending again after a doubling wait
    and skipped at the third failure; a claim older than ``stale`` seconds is
    taken back by a timer, which also runs between rows.
    """

    STALE, MOST, BASE, LONGEST = 600.0, 3, 5.0, 120.0
    OUT = "key string, status string, attempts int, next_try double"
    TIME = "ProcessingTime"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("item", "status string, attempts int, next_try double, claimed_at double")

    @classmethod
    def step(cls, now: tuple[str, int, float, float], kind: str, ok: bool | None, at: float) -> tuple[str, int, float, float]:
        """The state after one event; this is the whole of the rules."""
        status, attempts, next_try, claimed = now
        if status == "claimed" and at - claimed >= cls.STALE:
            status = "pending"
        if kind == "claim" and status == "pending" and at >= next_try:
            return "claimed", attempts, next_try, at
        if kind == "result" and status == "claimed":
            if ok:
                return "done", attempts + 1, next_try, claimed
            attempts += 1
            wait = min(cls.BASE * 2 ** (attempts - 1), cls.LONGEST)
            return ("skipped" if attempts >= cls.MOST else "pending"), attempts, at + wait, claimed
        return status, attempts, next_try, claimed

    def _now(self) -> tuple[str, int, float, float]:
        return tuple(self.state.get()) if self.state.exists() else ("pending", 0, 0.0, 0.0)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = self._now()
        for r in pd.concat(list(rows)).sort_values("at", kind="stable").itertuples():
            now = self.step(now, r.kind, r.ok, r.at)
        self.state.update(now)
        if now[0] == "claimed":
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(self.STALE * 1000))
        yield pd.DataFrame({"key": [key[0]], "status": [now[0]], "attempts": [now[1]], "next_try": [now[2]]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        status, attempts, next_try, claimed = self._now()
        if status == "claimed":
            self.state.update(("pending", attempts, next_try, claimed))
            yield pd.DataFrame({"key": [key[0]], "status": ["pending"], "attempts": [attempts], "next_try": [next_try]})

    def close(self) -> None:
        pass


class SourceCap(StatefulProcessor):
    """How many requests a source may have in flight: one more after a good one, half after congestion, within 1 and 32, from 4.

    Rows are ``(source, ok, congested, seq)``.
    """

    OUT = "source string, cap double"
    TIME = "None"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cap = handle.getValueState("cap", "cap double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        cap = self.cap.get()[0] if self.cap.exists() else 4.0
        for r in pd.concat(list(rows)).sort_values("seq", kind="stable").itertuples():
            if r.ok:
                cap = min(32.0, cap + 1)
            elif r.congested:
                cap = max(1.0, cap / 2)
        self.cap.update((cap,))
        yield pd.DataFrame({"source": [key[0]], "cap": [cap]})

    def close(self) -> None:
        pass


def stateful(stream: DataFrame, key: str, processor: StatefulProcessor) -> DataFrame:
    """A processor over a keyed stream.  It needs the RocksDB state store.

    A processor with timers runs batches without data too, so such a query
    doesn't end by itself, unless ``spark.sql.streaming.noDataMicroBatches.enabled`` is off.
    """
    return stream.groupBy(key).transformWithStateInPandas(processor, processor.OUT, "Update", processor.TIME)


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def missing_work(entities: DataFrame, counts: DataFrame, queue: DataFrame, threshold: int, wave: int) -> DataFrame:
    """What a generator emits in a wave: entities under the threshold that have nothing in the queue."""
    open_ = queue.where(F.col("status").isin("pending", "claimed")).select(F.col("instance").alias("name"))
    return gaps(entities, counts, threshold).join(open_, "name", "left_anti").withColumn("wave", F.lit(wave))


def every(spark: SparkSession, seconds: int, step: Callable[[int], None], checkpoint: str) -> StreamingQuery:
    """Run ``step(n)`` again and again, such as governance, on a rate trigger."""
    rate = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    return rate.writeStream.foreachBatch(lambda _, n: step(n)).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def waves(generate: Callable[[int], int], drained: Callable[[], bool], wait: Callable[[], None], first: int = 1, most: int | None = None) -> int:
    """Generate wave after wave of missing work: the next one when the queues are drained, until one is empty.  Returns the last wave's number.

    ``generate(n)`` puts the work of a wave into the queue and says how much it was.
    """
    n = first
    while generate(n) and (most is None or n < first + most - 1):
        while not drained():
            wait()
        n += 1
    return n


def refill(step: Callable[[], int], wait: Callable[[], None], idle: int = 6) -> int:
    """Do a step again and again until it has had nothing to do ``idle`` times in a row; how much was done in all."""
    done = empty = 0
    while empty < idle:
        n = step()
        done, empty = done + n, 0 if n else empty + 1
        if not n:
            wait()
    return done


class Climb:
    """How many calls to have in flight: a step on after a window of the best throughput so far, a step the other way after any other."""

    def __init__(self, start: int, step: int, low: int, high: int) -> None:
        self.level, self.step, self.low, self.high, self.best = start, step, low, high, 0.0

    def window(self, throughput: float) -> int:
        """The level for the next window."""
        if throughput > self.best:
            self.best = throughput
        else:
            self.step = -self.step
        self.level = max(self.low, min(self.high, self.level + self.step))
        return self.level


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """An extension: counts by event-time window, with a watermark for late rows."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")
