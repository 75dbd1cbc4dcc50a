"""Windows and features of a stream from keyed, bounded state in the engine's state store.

Each symbol keeps its last few rows in the store, which the engine writes for the symbols of a
batch only, checkpoints with the query's progress and restores after a failure. What a batch costs
depends on its rows and symbols, not on the stream's past. A symbol's rows of one batch meet in one
task: bound a batch by the source's options (files or offsets per trigger); for symbols too heavy
for that, ``state.windows_of`` splits them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from barweave.schema import DERIVED_COLUMNS, FEATURES, PRICE_COLUMNS

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# From the remembered rows followed by the new ones, and how many are remembered, to the rows given
# out: (columns in the order of the result, without the key).
Compute = Callable[[list[tuple], int], list[tuple]]


class LastRows(StatefulProcessor):
    """Keeps the last ``depth`` rows of a key, ordered, and computes results for new ones."""

    def __init__(self, key: str, columns: list[str], order: int, kept: T.StructType, depth: int,
                 out: list[str], compute: Compute):
        self._key, self._columns, self._order = key, columns, order
        self._kept, self._depth, self._out, self._compute = kept, depth, out, compute

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getListState("last", self._kept)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = [tuple(r) for r in self._last.get()]
        new = [r for part in rows for r in part[self._columns].itertuples(index=False, name=None)]
        # Rows of a batch are taken in order; one older than an earlier batch counts as late and
        # stands where it arrives.
        new.sort(key=lambda r: tuple((v is not None, v) for v in r[: self._order]))
        every = known + [tuple(None if pd.isna(v) else v for v in r) for r in new]
        self._last.put(every[-self._depth :])
        found = self._compute(every, len(known))
        if found:
            out = pd.DataFrame(found, columns=self._out)
            out.insert(0, self._key, key[0])
            yield out

    def close(self) -> None:
        pass


class LastColumns(LastRows):
    """Like ``LastRows``, but ``compute`` takes and gives columns as arrays: no Python objects for
    the rows of a batch, only for those remembered."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = [tuple(r) for r in self._last.get()]
        new = pd.concat([part[self._columns] for part in rows], ignore_index=True)
        order = self._columns[: self._order]
        new = new.sort_values(order, kind="stable", na_position="first")
        every = {c: _behind([r[i] for r in known], new[c]) for i, c in enumerate(self._columns)}
        last = zip(*(every[c][-self._depth :].tolist() for c in self._columns))
        # Only NaN and NaT differ from themselves.
        self._last.put([tuple(None if v != v else v for v in r) for r in last])
        found = self._compute(every, len(known))
        out = pd.DataFrame(dict(zip(self._out, found, strict=True)))
        if len(out):
            out.insert(0, self._key, key[0])
            yield out


def _behind(known: list, new: pd.Series) -> np.ndarray:
    """Values remembered, then new ones: floats, or objects of any kind."""
    numbers = new.dtype.kind == "f" and all(v is None or isinstance(v, float) for v in known)
    kind = float if numbers else object
    before = np.empty(len(known), kind)
    before[:] = known
    return np.concatenate([before, new.to_numpy(kind)])


def _kind(stream: DataFrame, names: Sequence[str]) -> T.StructType:
    return T.StructType([stream.schema[n] for n in names])


def use_state_store(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store; a query takes the setting when it starts."""
    spark.conf.set(_PROVIDER, _ROCKS)


def _run(
    stream, key, columns, order, depth, out: T.StructType, compute, kind: type[LastRows] = LastRows
) -> DataFrame:
    use_state_store(stream.sparkSession)
    result = T.StructType([stream.schema[key], *out.fields])
    processor = kind(key, list(columns), order, _kind(stream, columns), depth, out.names, compute)
    return (
        stream.select(key, *columns)
        .groupBy(key)
        .transformWithStateInPandas(processor, result, outputMode="Append", timeMode="None")
    )


def sequences(
    stream: DataFrame,
    length: int = 5,
    features: Sequence[str] = FEATURES,
    order: Sequence[str] = ("date",),
    key: str = "symbol",
) -> DataFrame:
    """(key, order..., sequence): every row with the last ``length`` feature rows of its key, its own
    included, oldest first; NULL while there are fewer."""
    n = len(order)

    def compute(rows: list[tuple], known: int) -> list[tuple]:
        out = []
        for i in range(known, len(rows)):
            steps = [list(r[n:]) for r in rows[i + 1 - length : i + 1]] if i + 1 >= length else None
            out.append((*rows[i][:n], steps))
        return out

    steps = T.ArrayType(T.ArrayType(T.DoubleType()))
    out = T.StructType([*(stream.schema[c] for c in order), T.StructField("sequence", steps)])
    return _run(stream, key, [*order, *features], n, length - 1 or 1, out, compute)


def _before(prices: np.ndarray, k: int) -> np.ndarray:
    """The prices ``k`` rows earlier, NaN where there are none."""
    return np.concatenate([np.full(min(k, len(prices)), np.nan), prices[: max(0, len(prices) - k)]])


def _ratios(prices: np.ndarray, k: int) -> np.ndarray:
    """Change against the price ``k`` rows earlier; 0 where there is none or it is 0."""
    before = _before(prices, k)
    with np.errstate(all="ignore"):
        return np.where(np.isnan(prices) | np.isnan(before) | (before == 0), 0.0, prices / before - 1)


def _averages(prices: np.ndarray, back: int) -> np.ndarray:
    """Average of the known prices from ``back`` rows earlier on; NaN where there is none. What a
    sum loses by rounding is added at its end, as ``sum`` does it."""
    total, lost, known = np.zeros((3, len(prices)))
    with np.errstate(all="ignore"):
        for k in range(back, -1, -1):
            price = _before(prices, k)
            there = ~np.isnan(price)
            price = np.where(there, price, 0.0)
            after = total + price
            larger, smaller = np.where(abs(total) >= abs(price), (total, price), (price, total))
            lost += (larger - after) + smaller
            total = after
            known += there
        return np.where(np.isfinite(lost), total + lost, total) / known


def bar_features(stream: DataFrame, key: str = "symbol", price: str = "close") -> DataFrame:
    """Bars of raw prices with averages, returns and label, each given out when the next bar of its
    symbol arrives and the label is known; the last bar of a symbol waits for it in the state."""
    columns = ["date", *PRICE_COLUMNS]

    def compute(rows: dict[str, np.ndarray], known: int) -> list[np.ndarray]:
        prices = rows[price].astype(float)
        # The last remembered row has waited for its successor.
        some = slice(max(0, known - 1), len(prices) - 1)
        averages = [_averages(prices, k)[some] for k in (4, 9)]
        back = [_ratios(prices, k)[some] for k in (1, 5)]
        label = (prices[1:] > prices[:-1]).astype(np.int32)[some]
        return [*(rows[c][some] for c in columns), *averages, *back, label]

    derived = [T.StructField(c, T.DoubleType()) for c in DERIVED_COLUMNS]
    fields = [*_kind(stream, columns).fields, *derived, T.StructField("target", T.IntegerType())]
    return _run(stream, key, columns, 1, 10, T.StructType(fields), compute, LastColumns)
