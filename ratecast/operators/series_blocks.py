"""Whole series handed to numpy in blocks of many, so that a series costs no Python call of its own for each step.

``map_series`` gives a function the rows of some hundred series at once. In a block, series of like length are columns of one
array (time down, a series a column, zeros below a shorter one's end), on which lags, sums and recursions are array operations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow.compute import take
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecast.operators.forecast import cluster_series

#: Rows of a block, about; a longer series is whole in one.
BLOCK_ROWS = 2 ** 18
#: Smallest share of a column's variation that those before it leave, for a system that is solved by elimination.
LEAST_PIVOT = 1e-11


def together(frame: DataFrame, tasks: int | None, *carry: str, order: Column | str = "ds") -> DataFrame:
    """``symbol, ds``, the columns to carry and ``place`` (1 for the first row of a series): each series' rows in one partition and in order.

    The window asks for that itself, so no rule of the planner may read a bucketed table otherwise.
    """
    place = F.row_number().over(Window.partitionBy("symbol").orderBy(order))
    return cluster_series(frame.select("symbol", "ds", *carry), tasks).select("symbol", "ds", *carry, place.alias("place"))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows of whole series, the first row of each and the end) from the rows of ``together``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        first = np.flatnonzero(batch.column("place").to_numpy() == 1)
        if len(first) and size + first[-1] >= BLOCK_ROWS:
            yield _block([*held, batch.slice(0, first[-1])])
            held, size = [batch.slice(first[-1])], batch.num_rows - int(first[-1])
        elif batch.num_rows:
            held.append(batch)
            size += batch.num_rows
    if size:
        yield _block(held)


def _block(held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(held).combine_chunks()
    return table, np.append(np.flatnonzero(table.column("place").to_numpy() == 1), table.num_rows)


def map_series(rows: DataFrame, fn: Callable[[pa.Table, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` of each block of series, for rows as from ``together``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in blocks(batches):
            yield fn(table, cuts)

    return rows.mapInArrow(run, schema)


def types(frame: DataFrame, *names: str) -> str:
    """Columns of a frame, as in a schema."""
    return ", ".join(f"{c} {frame.schema[c].dataType.simpleString()}" for c in names)


def values(table: pa.Table, column: str) -> np.ndarray:
    """A column as doubles, null as NaN."""
    return table.column(column).combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False)


def first_of(table: pa.Table, column: str, start: np.ndarray) -> pa.Array:
    """A column's values in the rows ``start``."""
    return take(table.column(column).combine_chunks(), pa.array(start))


def like_lengths(n: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the series in groups of like length: the longest of a group has at most a quarter and 32 rows more than the shortest."""
    order = np.argsort(n, kind="stable")
    sizes, at = n[order], 0
    while at < len(order):
        to = int(np.searchsorted(sizes, sizes[at] * 1.25 + 32, "right"))
        yield order[at:to]
        at = to


def columns(flat: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Series of ``n`` values from ``start`` on as columns, zeros below their ends."""
    t = np.arange(n.max(initial=0))[:, None]
    return np.where(t < n, flat[np.minimum(start + t, len(flat) - 1)], 0.0) if len(t) else np.zeros((0, len(n)))


def inside(n: np.ndarray, rows: int) -> np.ndarray:
    """1 where a column has a value."""
    return (np.arange(rows)[:, None] < n).astype(float)


def lag(x: np.ndarray, k: int) -> np.ndarray:
    """``x`` moved down by ``k`` rows, zeros above."""
    return x if not k else np.concatenate((np.zeros((min(k, len(x)), x.shape[1])), x[:max(len(x) - k, 0)]))


def dot(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.einsum("tb,tb->b", x, y)


def gram(x: list[np.ndarray]) -> np.ndarray:
    """Products of all pairs of the columns of each series (k x k x series)."""
    out = np.empty((len(x), len(x), x[0].shape[1]))
    for i in range(len(x)):
        for j in range(i, len(x)):
            out[i, j] = out[j, i] = dot(x[i], x[j])
    return out


def solve(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(solutions k x series of symmetric systems, whether each is far from singular), by elimination after scaling to a diagonal of 1."""
    k = len(a)
    scale = np.sqrt(np.maximum(np.stack([a[i, i] for i in range(k)]), 0.0))
    sound = (scale > 0).all(0)
    scale = np.where(scale > 0, scale, 1.0)
    a, x = a / scale[:, None] / scale[None], b / scale
    for i in range(k):
        pivot = a[i, i]
        sound &= pivot > LEAST_PIVOT
        pivot = np.where(pivot > LEAST_PIVOT, pivot, 1.0)
        a[i, i] = pivot
        for j in range(i + 1, k):
            f = a[j, i] / pivot
            a[j, i + 1:] -= f * a[i, i + 1:]
            x[j] -= f * x[i]
    for i in range(k - 1, -1, -1):
        for j in range(i + 1, k):
            x[i] -= a[i, j] * x[j]
        x[i] /= a[i, i]
    return x / scale, sound
