"""States that machines push, beside those that are pulled from them: a fresh push wins, else the last pulled state.

Both arrive as one stream of reports. Per machine two values and one timer are kept (``transformWithState``): the timer
of a push fires when it is too old, and the machine's state is then the pulled one again, without a new report."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from ..sources.writers import fresh_path

LARGEST_PUSH = 1_000_000
STATE = "machine string, version bigint, source string, payload string, at timestamp"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def acceptable(payload: Column) -> Column:
    """Whether a push has 1 to 1,000,000 bytes that are a JSON object."""
    kind = F.schema_of_variant(F.try_parse_json(payload))
    return F.coalesce((F.octet_length(payload) > 0) & (F.octet_length(payload) <= LARGEST_PUSH) & kind.startswith("OBJECT"), F.lit(False))


class FreshPush(StatefulProcessor):
    """Reports: machine, is_push, payload, us (microseconds since 1970). One row for each change of a machine's state, numbered by ``version``.

    by_event_time: a push is stale when the watermark has passed it (the stream's lateness is the time to live); else
    when so many milliseconds have passed since it arrived."""

    def __init__(self, ttl_ms: int, by_event_time: bool) -> None:
        self.ttl_ms, self.by_event_time = ttl_ms, by_event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        report = "payload string, us bigint"
        self.pushed = handle.getValueState("pushed", report)
        self.pulled = handle.getValueState("pulled", report)
        self.shown = handle.getValueState("shown", "version bigint, source string, payload string, us bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        # each call of a state goes through a socket: a batch's rows are folded here, and each state is read and written once
        old = pushed, pulled = self.pushed.get(), self.pulled.get()
        pushes = 0
        for row in rows:
            if row.is_push and (pushed is None or row.us >= pushed[1]):
                pushed, pushes = (row.payload, row.us), pushes + 1
            elif not row.is_push and (pulled is None or row.us >= pulled[1]):
                pulled = row.payload, row.us
        for state, was, now in ((self.pushed, old[0], pushed), (self.pulled, old[1], pulled)):
            if now != was:
                state.update(now)
        if pushes:
            for timer in list(self.handle.listTimers()) if old[0] is not None else ():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(pushed[1] // 1000 + 1 if self.by_event_time else timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)
        yield from self.changed(key, pushed, pulled)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.pushed.clear()
        yield from self.changed(key, None, self.pulled.get())

    def changed(self, key: tuple, pushed: tuple | None, pulled: tuple | None) -> Iterator[Row]:
        """The state that now holds, if it is not the one shown last."""
        source, state = ("push", pushed) if pushed is not None else ("pull", pulled) if pulled is not None else ("none", (None, None))
        shown = self.shown.get() or (0, None, None, None)
        now = (source, *state)
        if now != tuple(shown[1:]):
            self.shown.update((shown[0] + 1, *now))
            yield Row(machine=key[0], version=shown[0] + 1, source=now[0], payload=now[1], us=now[2])

    def close(self) -> None:
        pass


def fresh_states(reports: DataFrame, ttl: str, by_event_time: bool = True) -> DataFrame:
    """reports: a stream of machine, is_push, payload, at. Changes of the machines' states (columns of STATE).

    ttl: an interval such as ``20 seconds``. Pushes that are not acceptable do not count. With by_event_time the clock is
    the latest ``at`` of any machine, so the outcome does not hang on when batches run; reports
    that come more than ttl behind it are dropped. Else it is the time at which a push arrives. The session needs RocksDB as its state store (``ROCKSDB``)."""
    rows = reports.where(~F.col("is_push") | acceptable(F.col("payload")))
    rows = rows.withWatermark("at", ttl) if by_event_time else rows
    amount, unit = ttl.split(" ")
    seconds = int(amount) * {"second": 1, "minute": 60, "hour": 3600}[unit.rstrip("s")]
    processor = FreshPush(seconds * 1000, by_event_time)
    changes = rows.withColumn("us", F.unix_micros("at")).groupBy("machine").transformWithState(processor, STATE.replace("at timestamp", "us bigint"), "Update", "EventTime" if by_event_time else "ProcessingTime")
    return changes.select("machine", "version", "source", "payload", F.timestamp_micros("us").alias("at"))


def kept_states(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the changes to a table of one folder a batch; a batch that is tried again replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_states(changes: DataFrame) -> DataFrame:
    """The last change of each machine."""
    columns = [c for c in ("version", "source", "payload", "at")]
    return changes.groupBy("machine").agg(F.max_by(F.struct(*columns), "version").alias("s")).select("machine", "s.*")


def states_of(reports: DataFrame, ttl: str) -> DataFrame:
    """The states once a stream of reports has been read to its end."""
    spark = reports.sparkSession
    path, checkpoint = fresh_path(spark, "states"), fresh_path(spark, "place")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        kept_states(fresh_states(reports, ttl), path, checkpoint).awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return latest_states(spark.read.schema(f"{STATE}, batch int").parquet(path))
