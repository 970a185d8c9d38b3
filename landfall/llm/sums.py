"""Sums of vectors over all rows, added up within tasks first."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Tasks that add up what the tasks before them found; the driver adds up theirs.
LAST = 16


def _partial(of_batch: Callable[[pa.RecordBatch], np.ndarray]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = of_batch(batch)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

    return run


def _vector(batch: pa.RecordBatch) -> np.ndarray:
    return sum(np.frombuffer(v, np.float64) for v in batch.column("v").to_pylist())


def summed(df: DataFrame, of_batch: Callable[[pa.RecordBatch], np.ndarray], width: int) -> np.ndarray:
    """The sum of ``of_batch`` (``width`` float64 numbers) over all batches of rows."""
    partial = df.mapInArrow(_partial(of_batch), "v binary").repartition(LAST)
    rows = partial.mapInArrow(_partial(_vector), "v binary").collect()  # LAST rows at most
    return sum((np.frombuffer(r.v, np.float64) for r in rows), np.zeros(width))


def matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A column of equally long lists of numbers as a matrix."""
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1).astype(np.float64)
