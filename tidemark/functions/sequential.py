"""Recurrences over a series: exponential means and the parabolic stop. Each series is one group of bounded length, but in `scanned_ewm`."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.functions.storage import checkpointed

Series = pd.Series
#: A column of a recurrence, from a series' rows in time order.
Step = Callable[[pd.DataFrame], "Series | np.ndarray"]


def series_columns(df: DataFrame, steps: dict[str, Step], key: str = "symbol", order: str = "date") -> DataFrame:
    """`df` with the columns of `steps` that it has not yet, all from one grouped map; a step may use the ones before it.

    Pass narrow rows and add other columns afterwards: every column of `df` goes through Python."""
    steps = {name: step for name, step in steps.items() if name not in df.columns}
    if not steps:
        return df
    schema = StructType([*df.schema.fields, *[StructField(name, DoubleType()) for name in steps]])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(order, kind="stable")
        for name, step in steps.items():
            group[name] = step(group)
        return group

    return df.groupBy(key).applyInPandas(run, schema)


def ewm(source: str | Step, span: int, least: int) -> Step:
    """Exponential mean: the value i rows back weighs (1 - 2 / (span + 1)) ** i; missing values keep their place."""
    values = source if callable(source) else lambda group: group[source]
    return lambda group: values(group).astype(float).ewm(span=span, min_periods=least).mean()


def ewm_columns(df: DataFrame, wanted: dict[str, tuple[str | Step, int, int]], key: str = "symbol", order: str = "date") -> DataFrame:
    """`df` with a column for each name in `wanted`: (input, span, known values needed)."""
    return series_columns(df, {name: ewm(*x) for name, x in wanted.items()}, key, order)


def parabolic(high: np.ndarray, low: np.ndarray, step: float, top: float, standard: bool) -> np.ndarray:
    """Stop levels of one series. standard: a bar through the stop turns the trend; otherwise the stop only trails a rise."""
    n = len(high)
    out = np.full(n, np.nan)
    if not n:
        return out
    rising, stop, extreme, speed = True, low[0], high[0], step
    out[0] = stop
    for i in range(1, n):
        if np.isnan(high[i]) or np.isnan(low[i]) or np.isnan(stop):
            stop = np.nan
            continue
        stop = stop + speed * (extreme - stop)
        if standard and (low[i] < stop if rising else high[i] > stop):
            rising, stop, speed = not rising, extreme, step
            extreme = high[i] if rising else low[i]
        else:
            stop = min(stop, low[i - 1]) if rising else max(stop, high[i - 1])
            if high[i] > extreme if rising else low[i] < extreme:
                extreme = high[i] if rising else low[i]
                speed = min(speed + step, top)
        out[i] = stop
    return out


def sar(mode: str = "reference", step: float = 0.02, top: float = 0.2) -> Step:
    """The parabolic stop of high and low. mode 'reference' never turns, 'standard' does. A missing bar makes all later values missing."""
    return lambda group: parabolic(group["high"].to_numpy(float), group["low"].to_numpy(float), step, top, mode == "standard")


def sar_column(df: DataFrame, mode: str = "reference", step: float = 0.02, top: float = 0.2, key: str = "symbol", order: str = "date", name: str = "sar") -> DataFrame:
    return series_columns(df, {name: sar(mode, step, top)}, key, order)


#: Rows that are summed together in a scan: weights of that many rows stay within the range of doubles.
_SPAN = 64


def decayed_sums(values: np.ndarray, decay: float, start: tuple[float, float, int] = (0.0, 0.0, 0)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place the sums of decay ** i times the value i rows back, and of decay ** i where it is known, and how many are; on top of a state before."""
    known = ~np.isnan(values)
    n, own, ones = len(values), np.where(known, values, 0.0), known.astype(float)
    tops, lows, counts = np.empty(n), np.empty(n), start[2] + np.cumsum(known)
    top, low = start[:2]
    powers = decay ** np.arange(_SPAN + 1)
    spread = np.tril(decay ** np.maximum(np.subtract.outer(np.arange(_SPAN), np.arange(_SPAN)), 0))
    for i in range(0, n, _SPAN):
        part = slice(i, min(n, i + _SPAN))
        m = part.stop - i
        tops[part], lows[part] = spread[:m, :m] @ own[part] + powers[1 : m + 1] * top, spread[:m, :m] @ ones[part] + powers[1 : m + 1] * low
        top, low = tops[part.stop - 1], lows[part.stop - 1]
    return tops, lows, counts


def scanned_ewm(df: DataFrame, wanted: dict[str, tuple[str, int, int]], key: str = "symbol", order: str = "date", tasks: int | None = None) -> DataFrame:
    """`ewm_columns` for series that are too long for one task: columns for each name in `wanted` (input, span, known values needed).

    The rows are sorted by key and order into ranges, which are written once. A range is an affine map of the sums before it: the first pass
    sends the state that the last series of each range is left in, a row a range; these are put together, and the
    second pass starts each range where the one before ended. Rows of one key and order may come in any order among themselves."""
    tasks = tasks or df.sparkSession.sparkContext.defaultParallelism * 4
    parts = checkpointed(df.repartitionByRange(tasks, key, order).sortWithinPartitions(key, order))
    decays = [1 - 2 / (span + 1) for _, span, _ in wanted.values()]

    def read(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
        tables = [b for b in batches if b.num_rows]
        return pa.Table.from_batches(tables) if tables else None

    def ends(keys: np.ndarray) -> np.ndarray:
        """Where each series of a range begins, and the range's end."""
        return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])

    def state(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = read(batches)
        if table is not None:
            keys = table[key].to_numpy()
            last = ends(keys)[-2]
            sums = []
            for (c, _, _), d in zip(wanted.values(), decays):
                values = table[c].to_numpy().astype(float)[last:]
                at = int(max(np.flatnonzero(~np.isnan(values)), default=-1))  # the last known row, where the mean is made
                top, low, count = decayed_sums(values, d)
                sums += [float(top[-1]), float(low[-1]), float(count[-1]), float(top[at]), float(low[at]), float(at)]
            row = [TaskContext.get().partitionId(), str(keys[0]), str(keys[-1]), len(keys) - last, last == 0, sums]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["part", "first", "last", "n", "alone", "sums"])

    states = sorted(parts.mapInArrow(state, "part long, first string, last string, n long, alone boolean, sums array<double>").collect(), key=lambda r: r["part"])
    new = [(0.0, 0.0, 0.0, math.nan)] * len(wanted)
    starts, before, now = {}, None, new
    for r in states:  # a row a range
        now = now if before == r["first"] else new
        starts[r["part"]], before = now, r["last"]
        now, left = [], now if r["alone"] else new
        for (top, low, count, mean), d, i in zip(left, decays, range(0, len(r["sums"]), 6)):
            own, at = r["sums"][i : i + 5], int(r["sums"][i + 5])
            mean = mean if at < 0 else (own[3] + top * d ** (at + 1)) / (own[4] + low * d ** (at + 1))
            now.append((own[0] + top * d ** r["n"], own[1] + low * d ** r["n"], own[2] + count, mean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = read(batches)
        if table is None:
            return
        at, start = ends(table[key].to_numpy()), starts[TaskContext.get().partitionId()]
        for i, (name, (column, _, least)) in enumerate(wanted.items()):
            values, out = table[column].to_numpy().astype(float), np.empty(len(table))
            for j, (a, b) in enumerate(zip(at, at[1:])):
                top, low, count = decayed_sums(values[a:b], decays[i], (start if j == 0 else new)[i][:3])
                known = np.maximum.accumulate(np.where(np.isnan(values[a:b]), -1, np.arange(b - a)))  # a missing row keeps the mean before it
                mean = np.where(known < 0, (start if j == 0 else new)[i][3], (top / np.where(low > 0, low, 1.0))[known])
                out[a:b] = np.where(count >= max(least, 1), mean, np.nan)
            table = table.append_column(name, pa.array(out, from_pandas=True))
        yield from table.combine_chunks().to_batches()

    schema = StructType([*df.schema.fields, *[StructField(name, DoubleType()) for name in wanted]])
    return parts.mapInArrow(run, schema)
