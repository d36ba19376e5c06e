"""States of sources, kept by a stream from the outcomes of their refreshes, and the ledger of addresses to try again.

A source's state depends on its latest outcome, on whether any outcome before it was good (a last good table is kept then),
and on whether that table is still valid. All of it follows from sums that do not depend on the order in which events come:
the first success, the latest event, and for each address the latest failure and the latest success. So late events count
as if they had come in time, a task holds one row of a source's events at a time, and a replay of all events in batch
gives the same states.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ledgerlake.functions.text import ladder

#: Columns of an event: a source's outcome (UPDATED, NO_CHANGE or FAILED, with the step that failed), whether its last good
#: table is valid, and the address that was read or failed. (at, id) is a total order of a source's events.
EVENT = "source string, at timestamp, id long, outcome string, step string, valid boolean, url string"
STATE = "source string, status string, since timestamp, events long, waiting long, retry array<string>"
#: Addresses of a source whose events are summed at once.
NOTES = 10_000
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def status_of(outcome: Column, step: Column, good_before: Column, valid: Column) -> Column:
    """UPDATED, NO_CHANGE, STALE_OK:<step> where a last good table is kept, FAILED:<step> where none is there or valid."""
    return ladder([
        (outcome == "UPDATED", "UPDATED"),
        (good_before & ~valid, "FAILED:BASELINE_INVALID"),
        ((outcome == "NO_CHANGE") & good_before, "NO_CHANGE"),
        (outcome == "NO_CHANGE", "FAILED:NO_BASELINE"),
    ], F.concat(F.when(good_before, F.lit("STALE_OK:")).otherwise(F.lit("FAILED:")), F.coalesce(step, F.lit("UNKNOWN"))))


def status_class(status: Column) -> Column:
    """updated, no_change, stale_last_good or failed."""
    return ladder([(status.isin("OK", "UPDATED"), "updated"), (status.isin("NO_CHANGE", "STALE_OK:NO_CHANGE"), "no_change"), (F.startswith(status, F.lit("STALE_OK:")), "stale_last_good")], "failed")


class SourceStates(StatefulProcessor):
    """One row for a source each time that events of it come: its status, and the addresses to try again, latest first."""

    def __init__(self, keep: int = 100):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "at timestamp, id long, outcome string, step string, valid boolean")
        self.good = handle.getValueState("good", "at timestamp, id long")
        self.seen = handle.getValueState("seen", "n long")
        self.urls = handle.getMapState("urls", "url string", "failed_at timestamp, failed_id long, done_at timestamp, done_id long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        latest, good = self.latest.get(), self.good.get()
        count = (self.seen.get() or (0,))[0]
        # each access to the state is a message to the JVM, so events are summed by address before they meet it
        notes: dict[str, list] = {}
        for batch in rows:
            for at, i, outcome, step, valid, url in batch[["at", "id", "outcome", "step", "valid", "url"]].itertuples(index=False, name=None):
                count += 1
                place = (at.to_pydatetime(), int(i))
                if latest is None or place > tuple(latest[:2]):
                    latest = (*place, outcome, step, bool(valid))
                if outcome == "UPDATED" and (good is None or place < tuple(good)):
                    good = place
                if isinstance(url, str):
                    note, k = notes.setdefault(url, [None, None]), int(outcome != "FAILED")
                    if note[k] is None or place > note[k]:
                        note[k] = place
                    if len(notes) >= NOTES:
                        self._store(notes)
        self._store(notes)
        self.latest.update(latest), self.good.update(good) if good else None, self.seen.update((count,))
        waiting, retry = self._ledger()
        yield pd.DataFrame({"source": [key[0]], "at": [latest[0]], "id": [latest[1]], "outcome": [latest[2]], "step": [latest[3]], "valid": [latest[4]], "good_before": [good is not None and tuple(good) < tuple(latest[:2])], "events": [count], "waiting": [waiting], "retry": [retry]})

    def _store(self, notes: dict[str, list]) -> None:
        """Brings the latest failure and success of some addresses into the state, and empties the notes."""
        for url, new in notes.items():
            old = self.urls.getValue((url,)) or (None,) * 4
            kept = [was if n is None or (was[0] is not None and was > n) else n for was, n in zip((tuple(old[:2]), tuple(old[2:])), new)]
            if (now := (*kept[0], *kept[1])) != tuple(old):
                self.urls.updateValue((url,), now)
        notes.clear()

    def _ledger(self) -> tuple[int, list[str]]:
        open_, last = 0, []
        for (url,), (failed_at, failed_id, done_at, done_id) in self.urls.iterator():
            if failed_at is not None and (done_at is None or (failed_at, failed_id) > (done_at, done_id)):
                open_ += 1
                (heapq.heappush if len(last) < self.keep else heapq.heappushpop)(last, (failed_at, failed_id, url))
        return open_, [url for _, _, url in sorted(last, reverse=True)]

    def close(self) -> None:
        """Nothing is open beside the state."""


_SEEN = "source string, at timestamp, id long, outcome string, step string, valid boolean, good_before boolean, events long, waiting long, retry array<string>"


def _named(df: DataFrame) -> DataFrame:
    return df.select("source", status_of(F.col("outcome"), F.col("step"), F.col("good_before"), F.col("valid")).alias("status"), F.col("at").alias("since"), "events", "waiting", "retry")


def _clean(events: DataFrame) -> DataFrame:
    """Events that can be placed; a missing validity counts as valid."""
    return events.where("source IS NOT NULL AND at IS NOT NULL AND id IS NOT NULL AND outcome IS NOT NULL").withColumn("valid", F.coalesce("valid", F.lit(True)))


def source_states(stream: DataFrame, keep: int = 100) -> DataFrame:
    """A stream of STATE rows from a stream of events; the session needs the state store PROVIDER."""
    kept = _clean(stream).groupBy("source").transformWithStateInPandas(SourceStates(keep), outputStructType=_SEEN, outputMode="Update", timeMode="None")
    return _named(kept)


def write_states(states: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes each micro-batch's rows under path; a batch that comes again replaces its own."""
    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/d={number}")

    return states.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_states(written: DataFrame) -> DataFrame:
    """Each source's latest row: that with the most events."""
    rest = [c for c in written.columns if c not in ("source", "d")]
    return written.groupBy("source").agg(F.max_by(F.struct(*rest), "events").alias("s")).select("source", "s.*")


def replayed_states(events: DataFrame, keep: int = 100) -> DataFrame:
    """The same rows from all events in batch."""
    events = _clean(events)
    place = F.struct("at", "id")
    one = events.groupBy("source").agg(
        F.max(F.struct("at", "id", "outcome", "step", "valid")).alias("l"), F.min(F.when(F.col("outcome") == "UPDATED", place)).alias("g"), F.count("*").alias("events"),
    )
    failed = F.col("outcome") == "FAILED"
    urls = events.where("url IS NOT NULL").groupBy("source", "url").agg(F.max(F.when(failed, place)).alias("f"), F.max(F.when(~failed, place)).alias("d")).where("f IS NOT NULL AND (d IS NULL OR f > d)")
    nth = F.row_number().over(Window.partitionBy("source").orderBy(F.desc("f"), F.desc("url")))
    waiting = urls.groupBy("source").agg(F.count("*").alias("waiting"))
    retry = urls.withColumn("_k", nth).where(F.col("_k") <= keep).groupBy("source").agg(F.transform(F.sort_array(F.collect_list(F.struct("_k", "url"))), lambda r: r["url"]).alias("retry"))
    both = one.join(waiting, "source", "left").join(retry, "source", "left")
    good = F.coalesce(F.col("g") < F.struct(F.col("l.at").alias("at"), F.col("l.id").alias("id")), F.lit(False))
    return _named(both.select("source", "l.*", good.alias("good_before"), "events", F.coalesce("waiting", F.lit(0)).cast("long").alias("waiting"), F.coalesce("retry", F.array().cast("array<string>")).alias("retry")))
