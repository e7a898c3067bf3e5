"""Codecs of the user's own: opaque bytes to typed values and back, in Arrow batches.

A codec is a picklable object.  ``open()`` runs once per task, before its first batch, and sets up what the codec needs
there (dictionaries, parsers, compiled formats); the batches of the task then pass through one after the other, so
memory is one batch (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows).  No shuffle is involved.  A codec that names
the ``columns`` it reads is sent no others, and none are made into Python values for it.

Payloads that Spark's own functions can decode need none of this: see :mod:`tidelog.functions.decode`.
"""

from __future__ import annotations

from typing import Any, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidelog.schema import require_columns
from tidelog.session import ship_code


class MessageDecoder:
    """Bytes to values of the Spark type ``ddl``.  Override :meth:`decode`, or :meth:`decode_batch` for whole batches."""

    ddl: str = "binary"
    #: Names of the columns that the decoder reads; None: all.
    columns: Sequence[str] | None = None

    def open(self) -> None:
        """Called once per task."""

    def decode(self, message: dict) -> Any:
        """The value of one message (its columns by name); None skips it.  An exception fails the query."""
        raise NotImplementedError

    def decode_batch(self, messages: pa.RecordBatch, to: pa.DataType) -> pa.Array:
        return pa.array([self.decode(m) for m in messages.to_pylist()], type=to)


class MessageEncoder:
    """Records to messages.  Override :meth:`encode`, or :meth:`encode_batch` for whole batches."""

    #: Names of the columns that the encoder reads; None: all.
    columns: Sequence[str] | None = None

    def open(self) -> None:
        """Called once per task."""

    def encode(self, record: dict) -> dict:
        """``data`` and optionally ``key``, ``attributes`` (name to list of bytes) and ``event_time`` of one record.  An
        exception fails the query."""
        raise NotImplementedError

    def encode_batch(self, records: pa.RecordBatch, to: pa.StructType) -> pa.StructArray:
        names = [to.field(i).name for i in range(to.num_fields)]
        out = [self.encode(r) for r in records.to_pylist()]
        for m in out:
            if not set(m) <= set(names):
                raise ValueError(f"a message has the fields {names}; the encoder gave {sorted(m)}")
        return pa.array([{**m, "attributes": None if m.get("attributes") is None else list(m["attributes"].items())} for m in out], type=to)


def _in_order(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those columns of ``df`` that are in ``names``."""
    return [c for c in df.columns if c in set(names)]


def decode_with(messages: DataFrame, decoder: MessageDecoder, on_error: str = "skip", out: str = "value",
                keep: Sequence[str] | None = None) -> DataFrame:
    """The messages (columns ``keep``, default all) with ``out``, the decoded value.

    The decoder sees the columns it names, else all columns given.  A value of None is a message it cannot decode: with ``on_error="skip"`` ``out``
    stays null - the message is skipped on emit and still moves the position - and with ``"fail"`` the query fails.
    An exception of the decoder always fails the query."""
    if on_error not in ("skip", "fail"):
        raise ValueError("on_error must be 'skip' or 'fail'")
    require_columns(messages, ["part", "off", "data"])
    kept = list(keep) if keep is not None else [c for c in messages.columns if c != out]
    value = T.StructField(out, T.DataType.fromDDL(decoder.ddl))
    schema = T.StructType([messages.schema[c] for c in kept] + [value])
    to = to_arrow_type(value.dataType)
    reads = list(messages.columns if decoder.columns is None else decoder.columns)
    require_columns(messages, reads)
    needed = _in_order(messages, [*kept, *reads, *(["part", "off"] if on_error == "fail" else [])])
    ship_code(messages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder.open()
        for batch in batches:
            values = decoder.decode_batch(batch.select(reads), to)
            if on_error == "fail" and values.null_count:
                at = values.is_null().to_pylist().index(True)
                raise ValueError(f"cannot decode message at part {batch['part'][at]} offset {batch['off'][at]}")
            yield pa.RecordBatch.from_arrays([batch[c] for c in kept] + [values], names=kept + [out])
    return messages.select(*needed).mapInArrow(run, schema)


MESSAGE_FIELDS = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("data", T.BinaryType()),
                               T.StructField("attributes", T.MapType(T.StringType(), T.ArrayType(T.BinaryType()))),
                               T.StructField("event_time", T.TimestampNTZType())])


def encode_with(records: DataFrame, encoder: MessageEncoder, keep: Sequence[str] = ()) -> DataFrame:
    """``key, data, attributes, event_time`` of every record as the encoder gives them, and the columns ``keep`` of the
    record (its routing key, its order).  What the encoder leaves out is null; :func:`tidelog.operators.messages.to_messages` routes
    them and sets the wire's defaults."""
    names = [f.name for f in MESSAGE_FIELDS.fields]
    if set(keep) & set(names):
        raise ValueError(f"columns to keep clash with the message fields {names}")
    schema = T.StructType([records.schema[c] for c in keep] + MESSAGE_FIELDS.fields)
    to = to_arrow_type(MESSAGE_FIELDS)
    reads = list(records.columns if encoder.columns is None else encoder.columns)
    require_columns(records, reads, "records")
    ship_code(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.open()
        for batch in batches:
            messages = encoder.encode_batch(batch.select(reads), to)
            yield pa.RecordBatch.from_arrays([batch[c] for c in keep] + messages.flatten(), names=list(keep) + names)
    return records.select(*_in_order(records, [*keep, *reads])).mapInArrow(run, schema)
