"""Arrow functions on executors that need not have this package installed."""

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_STATE: dict[str, dict] = {}


def worker_state(owner: str) -> dict:
    """What a Python worker keeps between tasks; it keeps the tables of one operator at a time."""
    if owner not in _STATE:
        if _STATE:
            _STATE.clear()
            _give_back()
        _STATE[owner] = {}
    return _STATE[owner]


def _give_back() -> None:
    """Return memory that is free again to the system; workers of several operators share an executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def ship(spark: SparkSession) -> None:
    """Hand the package's source to the executors, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, keeps: bool = False
) -> DataFrame:
    """``df.mapInArrow`` with the package's code on the executors.

    A function that ``keeps`` tables for later tasks asks for them by ``worker_state``. Any other one
    begins by letting go of the tables that its worker holds from earlier operators.
    """
    ship(df.sparkSession)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("none")
        return function(batches)

    return df.mapInArrow(function if keeps else alone, schema)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows, cut only where the values of the first ``keys`` columns change."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        last = [batch.column(k)[n - 1].as_py() for k in range(keys)]
        same = np.ones(n, bool)
        for k in range(keys):
            same &= batch.column(k).to_numpy(zero_copy_only=False) == last[k]
        at = n - int(np.argmin(same[::-1])) if not same.all() else 0
        if at == 0 and held and [held[-1].column(k)[0].as_py() for k in range(keys)] == last:
            held.append(batch)
            continue
        if held or at:
            yield _joined([*held, batch.slice(0, at)])
        held = [batch.slice(at)]
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
