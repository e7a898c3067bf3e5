"""Payload decoders.

A decoder is a function ``DataFrame -> Column`` over the envelope (the full-message form); a
data-only decoder sees just ``data``.  A decoder returns null for a message it cannot decode.
Built-ins stay JVM-side (``get_json_object`` / ``try_cast``); an opaque codec can be wrapped
with :func:`pandas_decoder`, which runs Arrow-batched.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.schema import require_columns

Decoder = Callable[[DataFrame], Column]


def data_only(fn: Callable[[Column], Column], data_col: str = "data") -> Decoder:
    """Lift a payload-only decoder to the envelope."""
    return lambda df: fn(df[data_col])


def full_message(fn: Callable[[DataFrame], Column]) -> Decoder:
    """A decoder that reads any envelope column (``data``, ``attr``, ``publish_time``, ...)."""
    return fn


def json_field(field: str, ddl_type: str = "bigint") -> Callable[[Column], Column]:
    """Payload decoder: ``$.field`` of a JSON object, null if not JSON or not of that type."""
    path = f"$.{field}"

    def dec(data: Column) -> Column:
        return F.get_json_object(data.cast("string"), path).try_cast(ddl_type)
    return dec


def utf8_text() -> Callable[[Column], Column]:
    """Payload decoder: the payload as text (the simple string schema)."""
    return lambda data: data.cast("string")


def pandas_decoder(fn, return_type: str) -> Callable[[Column], Column]:
    """Wrap a vectorised ``pd.Series -> pd.Series`` codec (Arrow batches, one call per batch)."""
    from pyspark.sql.functions import pandas_udf

    udf = pandas_udf(fn, return_type)
    return lambda data: udf(data)


def decode(log: DataFrame, decoder: Decoder, on_error: str = "skip", out: str = "value") -> DataFrame:
    """Add ``out`` = decoded value.

    ``on_error="skip"``: undecodable messages keep a null value (they are skipped on emit but
    still advance the position).  ``on_error="fail"``: the query fails on the first message that
    has a payload the decoder cannot read.
    """
    require_columns(log, ["part", "off", "data"])
    value = decoder(log)
    if on_error == "fail":
        value = F.when(value.isNull() & log["data"].isNotNull(),
                       F.raise_error(F.concat(F.lit("cannot decode message at part "),
                                              log["part"].cast("string"), F.lit(" offset "),
                                              log["off"].cast("string")))).otherwise(value)
    elif on_error != "skip":
        raise ValueError("on_error must be 'skip' or 'fail'")
    return log.withColumn(out, value)
