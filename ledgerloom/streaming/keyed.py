"""Streams with one row of state per key, kept in Spark's state store.

The state is part of the query's checkpoint: a restarted query goes on where it was, and no earlier
batch is read again. All rows of a key in one batch meet in one task; the source's rate limit
(``maxFilesPerTrigger``) bounds them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, StructField, StructType

Step = Callable[[pd.DataFrame, "tuple | None"], "tuple[pd.DataFrame, tuple | None]"]


def with_state(stream: DataFrame, keys: Sequence[str], step: Step, output: StructType | str, state: StructType | str) -> DataFrame:
    """Apply ``step(rows, state)`` to the rows of each key of a batch; it returns the rows to emit and the key's next state.

    ``state`` is None for a key that has none yet; None as the next state leaves it as it is.
    """

    def follow(key: tuple, batches: Iterator[pd.DataFrame], store: GroupState) -> Iterator[pd.DataFrame]:
        given = list(batches)
        rows = given[0] if len(given) == 1 else pd.concat(given, ignore_index=True)
        found, after = step(rows, tuple(store.get) if store.exists else None)
        if after is not None:
            store.update(after)
        yield found

    return stream.groupBy(*keys).applyInPandasWithState(follow, output, state, "append", GroupStateTimeout.NoTimeout)


def with_previous(stream: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """Each row with ``before``, the value of the row before it in its key, and ``late``.

    Rows are put in ``order`` within a batch. A row that does not come after the last one of an
    earlier batch is ``late`` and compared with nothing. The state is the last row's order and value.
    """
    fields, names = {f.name: f for f in stream.schema}, [*order, value]
    state = StructType([fields[n] for n in names])
    output = StructType([*stream.schema.fields, StructField("before", fields[value].dataType), StructField("late", BooleanType())])

    def step(rows: pd.DataFrame, last: tuple | None):
        # Plain arrays: with few rows a key, each operation on a series would cost more than all rows.
        places = _places([rows[name].to_numpy() for name in order])
        if (np.diff(places) != 1).any():
            rows = rows.take(places)
        late = np.zeros(len(rows), bool)
        if last is not None:
            after, equal = np.zeros(len(rows), bool), np.ones(len(rows), bool)
            for name, seen in zip(order, last):
                column, seen = _comparable(rows[name].to_numpy(), seen)
                after |= equal & np.asarray(column > seen, bool)
                equal &= np.asarray(column == seen, bool)
            late = ~after
        on_time, before = np.flatnonzero(~late), np.full(len(rows), None, object)
        if len(on_time):
            values = rows[value].astype(object).to_numpy()[on_time[:-1]]
            before[on_time[1:]] = np.where(pd.isna(values), None, values)
            before[on_time[0]] = None if last is None else last[-1]
        found = rows.assign(before=before, late=late)
        return found, tuple(_plain(rows[n].iat[on_time[-1]]) for n in names) if len(on_time) else None

    return with_state(stream, [key], step, output, state)


def _places(columns: list[np.ndarray]) -> np.ndarray:
    """The places of the rows in the order of the columns; equal ones stay as they are, missing values come last."""
    if all(c.dtype.kind in "iufM" for c in columns):
        return np.lexsort(columns[::-1])
    frame = pd.DataFrame(dict(enumerate(columns)))
    return frame.sort_values(list(frame.columns), kind="stable").index.to_numpy()


def _comparable(column: np.ndarray, seen) -> tuple:
    """A column and a value of the state as numpy or, for texts and decimals, pandas compares them."""
    if column.dtype.kind == "M":
        return column, np.datetime64(seen)
    return (column if column.dtype.kind in "iuf" else pd.Series(column)), seen


def _plain(value):
    """A value as the state store takes it."""
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value
