"""Shared helpers of the training-data operators: Arrow batches as flat arrays, code shipping."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import scratch_dir

from .rolling import forget

#: Setting by which a finished job's shuffle files go.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Bytes of the batches that tasks hand to Python workers and hold beside their rows.
ARROW_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20

_shipped: set[str] = set()
_kept: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """What an operator's tasks leave in a worker for its next ones; a task of another operator drops it."""
    return _kept.setdefault(operator, {})


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers: one zip per application, handed to
    ``addPyFile``, which Spark itself sends to every executor."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tidelog-code-"), "tidelog_code.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def give_back(operator: str | None = None) -> None:
    """Hands free memory of the Arrow pool and the C heap back to the system, with the tables that grew with the
    texts and what other operators than ``operator`` have :func:`kept`.  Python workers live on between stages,
    more of them than there are cores; what one task took would otherwise count against the executor in all later ones."""
    for name, held in _kept.items():
        if name != operator:
            held.clear()
    forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(fn):
    """``fn(batches)`` for ``mapInArrow``, with a :func:`give_back` when it has ended: what its frame held is free by then."""
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            give_back()

    return run


def arrow_map(df: DataFrame, fn, schema: str, operator: str | None = None) -> DataFrame:
    """``df.mapInArrow`` with ``fn(batch) -> iterable of batches`` applied to each batch; what ``operator`` has
    :func:`kept` stays."""
    ship(df.sparkSession)

    def run(batches):
        try:
            for batch in batches:
                if batch.num_rows:
                    yield from fn(batch)
                    del batch
                    give_back(operator)
        finally:
            give_back(operator)

    return df.mapInArrow(run, schema)


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary Arrow column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    width = np.int64 if large else np.int32
    off = np.frombuffer(offsets, dtype=width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def groups(offsets: np.ndarray, limit: int = 1 << 20):
    """Ranges ``[i, j)`` of consecutive texts of about ``limit`` bytes; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` inside each ``[bounds[i], bounds[i + 1])``."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def row_key(id_col: str, text_col: str):
    """64-bit key of a row from its id and text; rows equal in both share it.  A hash skips nulls, so it also
    takes whether each is null: (null, 'a') and ('a', null) are two rows."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder.  A table on one side of a join is a plain shuffle
    there, where an aggregate by the join's key would keep a hot key from being split.  The shuffle files of
    the job are deleted with its end: nothing reads them again, and without that they stay until the
    driver happens to collect garbage.  Batches for Python have ``BATCH_BYTES`` at most: a row may be large."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, name)
    before = {CLEANUP: spark.conf.get(CLEANUP, "false"), ARROW_BYTES: spark.conf.get(ARROW_BYTES)}
    spark.conf.set(CLEANUP, "true")
    spark.conf.set(ARROW_BYTES, BATCH_BYTES)
    try:
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return spark.read.parquet(path)
