"""Arrow functions that take their batches in portions, so that a task's Python memory depends on neither rows nor input."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import ArrowUDFType

#: Bytes of text, or of list entries at ``ENTRY`` bytes each, that are worked on at once; a longer row goes alone.
MOST_BYTES = 1 << 20
ENTRY = 16


def weights(column: pa.Array) -> np.ndarray:
    """Bytes of every string, or entries of every list (or counted by an integer) as bytes; nulls have none."""
    if pa.types.is_integer(column.type):
        return np.asarray(pc.fill_null(column, 0), np.int64) * ENTRY
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        return np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    return np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64) * ENTRY


def portions(sizes: np.ndarray, most: int = MOST_BYTES) -> Iterator[tuple[int, int]]:
    """(first, count) of consecutive rows of at most ``most`` together, or of one row."""
    upto = np.cumsum(sizes + 1)
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right")))
        yield at, end - at
        at = end


def in_portions(f: Callable[..., pa.Array], kind: T.DataType, most: int = MOST_BYTES):
    """An Arrow function of columns that gives ``f`` portions of them, measured by the first column."""

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            columns = batch if isinstance(batch, tuple) else (batch,)
            for at, n in portions(weights(columns[0]), most):
                yield f(*(c.slice(at, n) for c in columns))

    return F.arrow_udf(run, kind, ArrowUDFType.SCALAR_ITER)
