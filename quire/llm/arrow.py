"""Arrow-batch plumbing for the operators that run Python."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.shipping import ship


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow with this package at hand on every executor; a worker, which Spark uses again, gives back what a task has freed."""
    ship(df.sparkSession)

    def released(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(released, schema)


def give_back() -> None:
    """Returns freed memory to the system: Arrow's pool and, where the C library can, its heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small slices of each batch, so that what Python holds stays bounded."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
