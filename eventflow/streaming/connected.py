"""Two streams in one keyed state program (a state per side, each side's rows handled by their own method).

The streams are tagged and united, so Spark deals one frame by the key and one
program sees both. A call holds one key's rows of one micro-batch, sorted by
``(ts, event_id)``; running values that sums can express have a form that
splits a hot key (:func:`eventflow.operators.joins.connected_share`).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

LEFT, RIGHT = "left", "right"
_STATE_KEY = "__state_key"


class TwoInput:
    """User logic over two inputs. States are tuples of the declared schemas; a method returns its side's new state
    and the output tuples for the row. Both methods read both states."""

    left_state: StructType
    right_state: StructType
    output: list[StructField] = []
    #: input columns that the methods read, besides the key, ``ts`` and ``event_id``
    left_columns: list[str] = []
    right_columns: list[str] = []

    def zero_left(self) -> tuple:
        raise NotImplementedError

    def zero_right(self) -> tuple:
        raise NotImplementedError

    def on_left(self, row, left: tuple, right: tuple) -> tuple[tuple, list[tuple]]:
        raise NotImplementedError

    def on_right(self, row, left: tuple, right: tuple) -> tuple[tuple, list[tuple]]:
        raise NotImplementedError


class _Program(StatefulProcessor):
    def __init__(self, logic: TwoInput, names: list[str]):
        self.logic, self.names = logic, names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.left = handle.getValueState("left", self.logic.left_state)
        self.right = handle.getValueState("right", self.logic.right_state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "event_id"], kind="stable")
        logic = self.logic
        left = tuple(self.left.get()) if self.left.exists() else logic.zero_left()
        right = tuple(self.right.get()) if self.right.exists() else logic.zero_right()
        sides, out = set(pdf["side"]), []
        for row in pdf.itertuples(index=False):
            if row.side == LEFT:
                left, made = logic.on_left(row, left, right)
            else:
                right, made = logic.on_right(row, left, right)
            out += made
        if LEFT in sides:
            self.left.update(left)
        if RIGHT in sides:
            self.right.update(right)
        yield pd.DataFrame.from_records(out, columns=self.names).astype(object).where(lambda d: d.notna(), None)

    def close(self) -> None:
        pass


def stream_connect_keyed(left: DataFrame, right: DataFrame, key: str, logic: TwoInput) -> DataFrame:
    """One state program per key over the tagged union of two streams with ``ts`` and ``event_id``."""
    own = [key, "ts", "event_id"]
    both = left.select(*own, *logic.left_columns).withColumn("side", F.lit(LEFT)).unionByName(
        right.select(*own, *logic.right_columns).withColumn("side", F.lit(RIGHT)), allowMissingColumns=True)
    out = StructType(list(logic.output))
    # state stores take no null keys: a null key's rows are one key of their own
    both = both.withColumn(_STATE_KEY, F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-")))
    return both.groupBy(_STATE_KEY).transformWithStateInPandas(_Program(logic, out.names), out, "Append", "None")


class SideShare(TwoInput):
    """The left side's share of a key's rows so far, in per cent, after every row of either side."""

    left_state = right_state = StructType([StructField("n", LongType())])

    def __init__(self, key: str = "user_id", key_type=None):
        self.key = key
        self.output = [StructField("event_id", LongType()), StructField(key, key_type or LongType()),
                       StructField("side", StringType()), StructField("share", DoubleType())]

    def zero_left(self):
        return (0,)

    def zero_right(self):
        return (0,)

    def _out(self, row, n_left, n_right):
        return [(row.event_id, getattr(row, self.key), row.side, n_left * 100.0 / (n_left + n_right))]

    def on_left(self, row, left, right):
        n = left[0] + 1
        return (n,), self._out(row, n, right[0])

    def on_right(self, row, left, right):
        n = right[0] + 1
        return (n,), self._out(row, left[0], n)
