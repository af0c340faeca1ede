"""User-defined incremental aggregates (zero / add / merge / result).

Spark's built-in aggregates are always preferred. When the logic is custom,
this runs it in Arrow-batched phases so that no group's rows, and not even all
its partial accumulators, are ever gathered in one place:

1. ``mapInPandas``: every task folds its own batches into one accumulator per
   group (a combiner), flushing when it holds too many groups;
2. a middle merge per (group, salt), the salt dealing the tasks of step 1 into
   ``fan`` parts;
3. ``groupBy(keys).applyInPandas``: at most ``fan`` accumulators a group are
   merged and turned into the result.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


class Accumulator:
    """Base class; subclass and define the four methods and two schemas.

    ``acc_fields``: list of StructField describing the accumulator state.
    ``result_fields``: list of StructField of the output columns.
    ``add(acc, batch)`` receives a pandas DataFrame holding rows of ONE
    group (any subset of the group, in any order).
    """

    acc_fields: list[StructField] = []
    result_fields: list[StructField] = []
    columns: list[str] | None = None  # input columns add() needs (None = all)

    def zero(self) -> dict:
        raise NotImplementedError

    def add(self, acc: dict, batch: pd.DataFrame) -> dict:
        raise NotImplementedError

    def merge(self, a: dict, b: dict) -> dict:
        raise NotImplementedError

    def result(self, acc: dict) -> dict:
        raise NotImplementedError


FAN = 32
_SALT = "__salt"


def partials(df: DataFrame, keys: Sequence[str], acc: Accumulator, max_groups_per_flush: int = 50_000) -> DataFrame:
    """(keys, accumulator fields): what each task has folded of each group."""
    keys = list(keys)
    cols = keys + [c for c in (acc.columns or df.columns) if c not in keys]
    d = df.select(*cols)
    names = [f.name for f in acc.acc_fields]

    def _rows(state: dict) -> pd.DataFrame:
        return pd.DataFrame.from_records([[*k, *[a[n] for n in names]] for k, a in state.items()], columns=keys + names)

    def fold(batches):
        state: dict = {}
        for pdf in batches:
            if pdf.empty:
                continue
            for k, part in pdf.groupby(keys, dropna=False, sort=False):
                key = k if isinstance(k, tuple) else (k,)
                state[key] = acc.add(state.get(key, acc.zero()), part)
            if len(state) >= max_groups_per_flush:
                yield _rows(state)
                state = {}
        if state:
            yield _rows(state)

    return d.mapInPandas(fold, StructType([d.schema[k] for k in keys] + list(acc.acc_fields)))


def merged(parts: DataFrame, keys: Sequence[str], acc: Accumulator, fan: int = FAN) -> DataFrame:
    """(keys, accumulator fields), one row a group: merged per (group, salt) first, then per group."""
    keys = list(keys)
    names = [f.name for f in acc.acc_fields]
    one = StructType([parts.schema[k] for k in keys] + list(acc.acc_fields))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = acc.zero()
        for rec in pdf[names].to_dict("records"):
            total = acc.merge(total, rec)
        return pd.DataFrame({k: [pdf[k].iloc[0]] for k in keys} | {n: [total[n]] for n in names})

    salted = parts.withColumn(_SALT, F.pmod(F.spark_partition_id(), F.lit(fan)))
    middle = salted.groupBy(*keys, _SALT).applyInPandas(merge, one)
    return middle.groupBy(*keys).applyInPandas(merge, one)


def results(accs: DataFrame, keys: Sequence[str], acc: Accumulator) -> DataFrame:
    """(keys, result fields) of merged accumulators."""
    keys = list(keys)
    names, out = [f.name for f in acc.acc_fields], [f.name for f in acc.result_fields]

    def finish(batches):
        for pdf in batches:
            got = [acc.result(rec) for rec in pdf[names].to_dict("records")]
            yield pd.DataFrame({k: pdf[k] for k in keys} | {n: [g[n] for g in got] for n in out})

    return accs.mapInPandas(finish, StructType([accs.schema[k] for k in keys] + list(acc.result_fields)))


def aggregate(df: DataFrame, keys: Sequence[str], acc: Accumulator,
              max_groups_per_flush: int = 50_000, fan: int = FAN) -> DataFrame:
    return results(merged(partials(df, keys, acc, max_groups_per_flush), keys, acc, fan), keys, acc)


class CountIf(Accumulator):
    """Conditional count: rows where ``column == value`` (the A3 example)."""

    def __init__(self, column: str, value, name: str = "n"):
        from pyspark.sql.types import LongType
        self.column, self.value, self.name = column, value, name
        self.columns = [column]
        self.acc_fields = [StructField("__count", LongType())]
        self.result_fields = [StructField(name, LongType())]

    def zero(self):
        return {"__count": 0}

    def add(self, acc, batch):
        return {"__count": acc["__count"] + int((batch[self.column] == self.value).sum())}

    def merge(self, a, b):
        return {"__count": int(a["__count"]) + int(b["__count"])}

    def result(self, acc):
        return {self.name: int(acc["__count"])}
