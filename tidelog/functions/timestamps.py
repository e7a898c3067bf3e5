"""Timestamp extractors (message -> record time) and the sink's event-time choice.

All timestamps are cut to milliseconds, as the connector does.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.schema import NO_TIMESTAMP, TIMESTAMP_UNIT

Extractor = Callable[[DataFrame], Column]


# All conversions work on wall-clock fields (date, hour, minute, fractional second), which do not
# depend on the session time zone, so results are the same under any spark.sql.session.timeZone.
_EPOCH_DATE = "1970-01-01"


def _ntz(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def _parts(ts: Column, unit: int) -> Column:
    """Units (1_000 = ms, 1_000_000 = us) since 1970-01-01 00:00:00 of a wall-clock timestamp."""
    days = F.datediff(F.to_date(ts), F.lit(_EPOCH_DATE).cast("date")).cast("bigint")
    sec = F.date_part(F.lit("SECOND"), ts)                 # seconds with fraction, decimal
    return (days * (86_400 * unit) + F.hour(ts).cast("bigint") * (3_600 * unit)
            + F.minute(ts).cast("bigint") * (60 * unit) + F.floor(sec * unit).cast("bigint"))


def epoch_micros(ts: Column) -> Column:
    return _parts(_ntz(ts), 1_000_000)


def ms(ts: Column) -> Column:
    """Cut a timestamp to milliseconds, keeping it wall-clock (``TIMESTAMP_NTZ``)."""
    t = _ntz(ts)
    sub_ms = F.pmod(F.floor(F.date_part(F.lit("SECOND"), t) * 1_000_000).cast("bigint"), F.lit(1000))
    return F.timestamp_add("MICROSECOND", -sub_ms, t)


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since the epoch of a wall-clock (UTC) timestamp."""
    return _parts(_ntz(ts), 1_000)


def from_epoch_ms(ms_col: Column) -> Column:
    """Wall-clock (UTC) timestamp of epoch milliseconds."""
    return F.timestamp_add("MILLISECOND", ms_col.cast("bigint"),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def publish_time() -> Extractor:
    """The default extractor: publish time."""
    return lambda df: ms(df["publish_time"])


def event_time() -> Extractor:
    """Event time when the message has one, else publish time."""
    return lambda df: ms(F.coalesce(df["event_time"], df["publish_time"]))


def custom(fn: Callable[[DataFrame], Column]) -> Extractor:
    """Any column expression over the envelope, cut to milliseconds."""
    return lambda df: ms(fn(df))


def sink_event_ms(ts_ms: Column, watermark_ms: Column, now_ms: Column) -> Column:
    """Event time a sink stamps on a record: the record's timestamp, else the current watermark;
    if that is the "no timestamp" sentinel (or missing), the wall clock ``now_ms``."""
    chosen = F.coalesce(ts_ms, watermark_ms)
    return F.coalesce(F.nullif(chosen, F.lit(NO_TIMESTAMP).cast("bigint")), now_ms)
