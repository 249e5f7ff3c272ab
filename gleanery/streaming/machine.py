"""The ledger as a stateful stream: allowed changes of status, attempts, and records that time out while they are under way."""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# --- fixed values: the statuses of a record, which may follow which, and what a step that is cut off fails to ------
FOLLOWS = {
    "": ("new",),
    "new": ("downloading", "ignored", "duplicate"),
    "downloading": ("downloading", "downloaded", "download_failed", "ignored", "duplicate"),
    "download_failed": ("downloading", "ignored", "duplicate"),
    "ignored": ("downloading", "ignored", "duplicate"),
    "downloaded": ("extracting", "extracted"),
    "extracting": ("extracting", "extracted", "extract_failed"),
    "extract_failed": ("extracting", "extracted"),
    "extracted": ("ingesting", "ingest_failed"),
    "ingesting": ("ingesting", "ingested", "ingest_failed"),
    "ingest_failed": ("ingesting", "ingest_failed"),
}
FAILS_TO = {"downloading": "download_failed", "extracting": "extract_failed", "ingesting": "ingest_failed"}
# -------------------------------------------------------------------------------------------------------------------

_STATE = "status string, at long, seq long, attempts int"

# the processor also runs in processes of Spark's own, which need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Ledger(StatefulProcessor):
    """Rows (key, at in microseconds, seq, status) -> a row for each: whether it is accepted, what stood before, attempts so far; and a row for each time-out."""

    def __init__(self, patience: int):
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.record = handle, handle.getValueState("record", _STATE)

    def _late(self, status: str, at: int) -> int:
        """When a record under way fails, in whole milliseconds, as timers have them."""
        return -(-(at + self.patience) // 1000) * 1000

    def _read(self):
        held = self.record.get()
        return ("", None, None, 0) if held is None else tuple(held)

    def _put(self, key, old, new) -> None:
        if old[0] in FAILS_TO:
            self.handle.deleteTimer(self._late(old[0], old[1]) // 1000)
        if new[0] in FAILS_TO:
            self.handle.registerTimer(self._late(new[0], new[1]) // 1000)
        self.record.update(new)

    @staticmethod
    def _row(key, at, seq, status, previous, attempts, reason) -> Row:
        return Row(key=key[0], at=at, seq=seq, status=status, previous=previous or None, attempts=attempts, accepted=reason in (None, "timeout"), reason=reason)

    def _timed_out(self, key, old):
        new = (FAILS_TO[old[0]], self._late(old[0], old[1]), old[2], old[3])
        return new, self._row(key, new[1], None, new[0], old[0], new[3], "timeout")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        begun = old = self._read()
        for r in sorted(rows, key=lambda r: (r.at, r.seq)):
            if old[0] in FAILS_TO and self._late(old[0], old[1]) <= r.at:
                old, row = self._timed_out(key, old)
                yield row
            if old[1] is not None and (r.at, r.seq) <= (old[1], old[2]):
                yield self._row(key, r.at, r.seq, r.status, old[0], old[3], "late")
            elif r.status not in FOLLOWS.get(old[0], ()):
                yield self._row(key, r.at, r.seq, r.status, old[0], old[3], "not_allowed")
            else:
                new = (r.status, r.at, r.seq, old[3] + (r.status == "downloading"))
                yield self._row(key, r.at, r.seq, r.status, old[0], new[3], None)
                old = new
        if old != begun:  # state and timer change once a batch, however many events it has of the record
            self._put(key, begun, old)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        old = self._read()
        if old[0] in FAILS_TO and self._late(old[0], old[1]) <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
            new, row = self._timed_out(key, old)
            self._put(key, old, new)
            yield row

    def close(self) -> None:
        pass


def ledger(events: DataFrame, key: str, at: str, seq: str, status: str, patience: int = 3600, late: str = "10 minutes") -> DataFrame:
    """key, at, seq, status, previous, attempts, accepted, reason of each event of a stream (or of a table), and of each record that times out.

    Events of a record are taken by time, then seq. One that may not follow its status (see FOLLOWS; a record begins as new) is rejected as 'not_allowed', one that is not later than what
    the record has seen as 'late'; both leave the record as it is. A record that stays under way for `patience` seconds fails at that time, with reason 'timeout': when
    its next event comes, or when the watermark, `late` behind the newest event, has passed it. attempts counts downloads. Rows without key, time, seq or status are left out.
    State is one row for each record; it does not expire, as a record's status is never forgotten.
    """
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    kind = events.schema[key].dataType.simpleString()
    rows = events.select(F.col(key).alias("key"), F.col(at).cast("timestamp").alias("ts"), F.col(seq).cast("long").alias("seq"), F.col(status).alias("status")).where("key is not null and ts is not null and seq is not null and status is not null")
    rows = rows.withColumn("at", F.unix_micros("ts"))
    if rows.isStreaming:
        rows = rows.withWatermark("ts", late)
    out = f"key {kind}, at long, seq long, status string, previous string, attempts int, accepted boolean, reason string"
    told = rows.groupBy("key").transformWithState(Ledger(patience * 1_000_000), out, "append", "eventTime" if rows.isStreaming else "none")
    return told.withColumn("at", F.timestamp_micros("at"))
