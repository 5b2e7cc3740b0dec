"""Streams: items deduplicated under a watermark, and events merged in keyed state with a timeout for silent ones."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.events import FOLD_SCHEMA, STALE_HOURS, Event, fold_items, fold_row

OUTPUT = FOLD_SCHEMA + ", closed boolean"
LATENESS = "24 hours"
#: Hours after which the state of a closed event goes.
KEEP_HOURS = 24


def once(items: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Each (source_id, external_id) once, remembered as long as the watermark on published_at allows."""
    return items.withWatermark("published_at", lateness).dropDuplicatesWithinWatermark(["source_id", "external_id"])


class EventMerger(StatefulProcessor):
    """State is the event as it stands; its size grows with distinct sources and lines, not with repeats. An event without an
    item for STALE_HOURS is closed; its state goes KEEP_HOURS later."""

    def __init__(self, stale_ms: int = STALE_HOURS * 3_600_000, keep_ms: int = KEEP_HOURS * 3_600_000) -> None:
        self.stale_ms, self.keep_ms = stale_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("event", "event string, closed boolean")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        event = Event.of(self.state.get()[0]) if self.state.exists() else Event()
        for item in fold_items(pd.concat(list(rows)).sort_values(["published_at", "id"], kind="stable", na_position="first")):
            event.add(item)
        self.state.update((event.json(), False))
        self._wake(timerValues, self.stale_ms)
        yield self._row(key, event, False)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        text, closed = self.state.get()
        if closed:
            self.state.clear()
            return
        event = Event.of(text)
        told = event.status != "dismissed"
        event.status, event.severity = "dismissed", "low"
        self.state.update((event.json(), True))
        self._wake(timerValues, self.keep_ms)
        if told:
            yield self._row(key, event, True)

    def _wake(self, timerValues: Any, after: int) -> None:
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        self.handle.registerTimer(int(timerValues.getCurrentProcessingTimeInMs()) + after)

    def close(self) -> None:
        pass

    def _row(self, key: Any, e: Event, closed: bool) -> pd.DataFrame:
        return pd.DataFrame([fold_row(key[0], e) | {"closed": closed}])


def merged_events(items: DataFrame, merger: EventMerger | None = None) -> DataFrame:
    """Updates of events: a row for each key with new items, and one when it was closed for silence. Repeated messages
    don't count again, as the state knows them.

    Needs the RocksDB state store: spark.sql.streaming.stateStore.providerClass.
    """
    return items.groupBy("report_id").transformWithStateInPandas(merger or EventMerger(), OUTPUT, "update", "ProcessingTime")
