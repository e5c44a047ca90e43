"""Resume as a stream: done keys stay done, failed ones come again after a while, and what is known expires."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from leadpanel.streaming.jobs import write_appends

#: Timers and expiry need this state store. Timers of the processing time always ask for one more batch, so a run
#: over what is available would never end with batches that have no data.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
OUTPUT = "key string, attempt int, reason string"
KEEP_MS = 30 * 24 * 3600 * 1000


class Attempts(StatefulProcessor):
    """State of one key: how often it was tried, whether it is done, and when a failed one may come again.

    Rows of a key are requests (``ok`` null) and results. In one batch a success outweighs a failure, and
    both are known before a request is answered, so the order of rows within a batch does not matter.
    """

    def __init__(self, retry_after_ms: int, keep_ms: int):
        self.retry_after_ms, self.keep_ms = retry_after_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "attempt int, done boolean, failed boolean, not_before bigint", self.keep_ms)

    def _again_later(self, at: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        asked = failed_now = done_now = False
        for part in rows:
            ok = part["ok"]
            asked |= bool(ok.isna().any())
            done_now |= bool(ok.eq(True).any())
            failed_now |= bool(ok.eq(False).any())
        attempt, done, failed, not_before = self.known.get() or (0, False, False, 0)
        now = timerValues.getCurrentProcessingTimeInMs()
        if done or done_now:
            self.known.update((attempt, True, False, 0))  # a key that comes again is kept for longer
            return
        if failed_now:
            attempt, failed, not_before = max(attempt, 1), True, now + self.retry_after_ms
        if asked and (attempt == 0 or failed and now >= not_before):
            yield self._given(key, attempt + 1, "failed" if failed else "new")
            return
        if failed_now:
            self._again_later(not_before)
        self.known.update((attempt, False, failed, not_before))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        attempt, done, failed, _ = self.known.get() or (0, True, False, 0)  # expired: the key is as if never seen
        if failed and not done:
            yield self._given(key, attempt + 1, "failed")

    def _given(self, key, attempt: int, reason: str) -> pd.DataFrame:
        self.known.update((attempt, False, False, 0))
        return pd.DataFrame({"key": [key[0]], "attempt": [attempt], "reason": [reason]}).astype({"attempt": "int32"})

    def close(self) -> None:
        pass


def keys_to_try(events: DataFrame, key: str, ok: str, retry_after_ms: int = 0, keep_ms: int = KEEP_MS) -> DataFrame:
    """``key, attempt, reason`` of every key to try, from a stream of requests (``ok`` null) and results.

    A key is given once; again after a failure, when it is asked for or when its timer goes off; never once it
    is done, as long as its state is kept. Rows without a key are left out. The query needs ``SETTINGS``.
    """
    rows = events.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(ok).cast("boolean").alias("ok"))
    return rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=Attempts(retry_after_ms, keep_ms), outputStructType=OUTPUT, outputMode="Append", timeMode="ProcessingTime")


def resume_available(events: DataFrame, key: str, ok: str, path: str, checkpoint: str, retry_after_ms: int = 0, keep_ms: int = KEEP_MS) -> StreamingQuery:
    """Works through what has arrived and appends the keys to try to ``path``; timers go off with the batches."""
    spark = events.sparkSession
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        return write_appends(keys_to_try(events, key, ok, retry_after_ms, keep_ms), path, checkpoint)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
