"""Per-key state programs (``transformWithStateInPandas``): the T forms.

State lives in the RocksDB state store, is committed with every
micro-batch and survives restarts (C1). ``init`` declares the state once
per task before any data (C3).

Rows of a key reach ``handleInputRows`` in shuffle order, not arrival
order, so each call sorts its rows by ``(ts, event_id)``; micro-batches
must be time-ordered (file order) for the result to equal the batch form.
A call holds one key's rows of ONE micro-batch, so its size is bounded by
the trigger size (``maxFilesPerTrigger`` / ``maxBytesPerTrigger``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

ORDER = ["ts", "event_id"]
COUNT_STATE = StructType([StructField("n", LongType())])


def _sorted(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    pdf = pd.concat(list(rows), ignore_index=True)
    return pdf.sort_values(ORDER, kind="stable").reset_index(drop=True)


class RunningCount(StatefulProcessor):
    """A4 (and A9 after a filter): events so far per key, value state.

    ``limit`` gives A8: the list is cleared when it grows past ``limit``,
    so the emitted value is ``count % (limit + 1)``. ``value`` gives A1: the
    running sum of that column.
    """

    def __init__(self, key: str = "user_id", name: str = "n", limit: int | None = None, value: str | None = None):
        self.key, self.name, self.limit, self.value = key, name, limit, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", COUNT_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows)
        base = self.count.get()[0] if self.count.exists() else 0
        step = np.ones(len(pdf), "int64") if self.value is None else pdf[self.value].fillna(0).to_numpy("int64")
        n = base + np.cumsum(step)
        self.count.update((int(n[-1]),))
        out = n if self.limit is None else n % (self.limit + 1)
        yield pd.DataFrame({"event_id": pdf["event_id"].astype("int64"),
                            self.key: pdf[self.key], self.name: out})

    def close(self) -> None:
        pass


class TypeCounts(StatefulProcessor):
    """A5: per key, a map event type -> count; emits one column per type
    (null while the type has not been seen)."""

    def __init__(self, types: list[str], columns: list[str], key: str = "user_id"):
        self.types, self.columns, self.key = types, columns, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", StructType([StructField("event_type", StringType())]),
                                         COUNT_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows)
        out = {"event_id": pdf["event_id"].astype("int64"), self.key: pdf[self.key]}
        for t, col in zip(self.types, self.columns):
            base = self.counts.getValue((t,))[0] if self.counts.containsKey((t,)) else 0
            run = base + np.cumsum((pdf["event_type"] == t).to_numpy(), dtype="int64")
            if len(run) and run[-1] > 0:
                self.counts.updateValue((t,), (int(run[-1]),))
            out[col] = pd.Series(run, dtype="Int64").mask(run == 0)
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass


class ListSize(StatefulProcessor):
    """A list of events per key; emits its size after each add.

    With ``ttl_ms`` the list state expires entries ``ttl_ms`` after they
    were written (processing time), which is A7's retention, and the size is
    read off the list. Without one the size is kept beside the list, which is
    then only appended to; with ``max_items`` the list is cut to the newest
    ``max_items`` events, so state and work per key are bounded.
    """

    def __init__(self, key: str = "user_id", name: str = "n", ttl_ms: int | None = None, max_items: int | None = None):
        self.key, self.name, self.ttl_ms, self.max_items = key, name, ttl_ms, max_items

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.items = handle.getListState("events", StructType([StructField("event_id", LongType())]),
                                         self.ttl_ms)
        self.size = handle.getValueState("size", COUNT_STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows)
        new = [(int(e),) for e in pdf["event_id"]]
        if self.ttl_ms is not None:
            base = sum(1 for _ in self.items.get()) if self.items.exists() else 0
        else:
            base = self.size.get()[0] if self.size.exists() else 0
        n = base + np.arange(1, len(pdf) + 1, dtype="int64")
        if self.max_items is not None:
            n = np.minimum(n, self.max_items)
            kept = list(self.items.get()) if self.items.exists() else []
            self.items.put([tuple(x) for x in (kept + new)[-self.max_items:]])
        else:
            self.items.appendList(new)
        if self.ttl_ms is None:
            self.size.update((int(n[-1]),))
        yield pd.DataFrame({"event_id": pdf["event_id"].astype("int64"),
                            self.key: pdf[self.key], self.name: n})

    def close(self) -> None:
        pass
