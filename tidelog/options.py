"""Source and sink options (frozen, validated on construction)."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame

from tidelog.schema import DEFAULT_MAX_OUTSTANDING_BYTES


@dataclass(frozen=True)
class FlowControl:
    """Bound on input per trigger: bytes and messages outstanding."""

    bytes_outstanding: int
    messages_outstanding: int

    def __post_init__(self):
        if self.bytes_outstanding <= 0 or self.messages_outstanding <= 0:
            raise ValueError("flow control limits must be positive")


@dataclass(frozen=True)
class LogSourceOptions:
    """What a reader of a log needs.

    ``subscription`` and ``flow_control`` are required.  ``timestamp`` maps the envelope to the
    record timestamp (default: publish time).  ``decoder`` maps the envelope to the value column
    (default: the raw ``data``).  ``on_error`` is ``"skip"`` (undecodable -> null value, skipped
    but the position still advances) or ``"fail"``.
    """

    subscription: str
    flow_control: FlowControl
    timestamp: Callable[[DataFrame], Column] | None = None
    decoder: Callable[[DataFrame], Column] | None = None
    on_error: str = "skip"
    resume: str = "exclusive"

    def __post_init__(self):
        if not self.subscription:
            raise ValueError("subscription is required")
        if self.flow_control is None:
            raise ValueError("flow_control is required")
        if self.on_error not in ("skip", "fail"):
            raise ValueError("on_error must be 'skip' or 'fail'")
        if self.resume not in ("exclusive", "inclusive"):
            raise ValueError("resume must be 'exclusive' or 'inclusive'")


@dataclass(frozen=True)
class LogSinkOptions:
    """What a writer of a log needs: the topic, a byte budget and an encoder."""

    topic: str
    num_partitions: int
    max_outstanding_bytes: int = DEFAULT_MAX_OUTSTANDING_BYTES
    encoder: Callable[[DataFrame], dict[str, Column]] | None = field(default=None)

    def __post_init__(self):
        if not self.topic:
            raise ValueError("topic is required")
        if self.num_partitions < 1:
            raise ValueError("num_partitions must be at least one")
        if self.max_outstanding_bytes < 1:
            raise ValueError("max_outstanding_bytes must be positive")
