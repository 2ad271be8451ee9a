"""Helpers of the Arrow operators: slices of bounded size, flat byte views, list columns."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airpanel.session import work_folder

SLICE_BYTES = 4 << 20  # texts handled at once; one longer text is a slice of its own


def by_value(name: str) -> None:
    """Ship the functions of a module with the tasks: executors need not have the library installed."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


by_value(__name__)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def unused(df: DataFrame, *names: str) -> list[str]:
    """These names, lengthened until no column of ``df`` has them."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written to the shared work folder and read again, which cuts the lineage."""
    spark: SparkSession = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary array without nulls, and the offsets of its values (one more than values)."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[starts[0]:starts[-1]], starts - starts[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices with about ``limit`` bytes of text; every row is in one slice.

    Workers live on between tasks and stages, so what a task's arrays leave free goes back to the system at its end.
    """
    yield from _slices(batches, column, limit)
    give_back()


def give_back() -> None:
    """Return freed memory of Arrow and the C library to the system, where they can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def list_array(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def owner(offsets: np.ndarray) -> np.ndarray:
    """Row number of every element of a flat array."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
