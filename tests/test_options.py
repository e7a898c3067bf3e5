"""Source / sink option validation."""

import pytest

from tidelog.options import FlowControl, LogSinkOptions, LogSourceOptions
from tidelog.schema import DEFAULT_MAX_OUTSTANDING_BYTES


def test_source_requires_subscription_and_flow_control():
    fc = FlowControl(100_000, 100)
    assert LogSourceOptions("subscriptions/s", fc).on_error == "skip"
    with pytest.raises(ValueError):
        LogSourceOptions("", fc)
    with pytest.raises(ValueError):
        LogSourceOptions("subscriptions/s", None)
    with pytest.raises(ValueError):
        LogSourceOptions("subscriptions/s", fc, on_error="ignore")
    with pytest.raises(ValueError):
        FlowControl(0, 1)


def test_sink_defaults_and_validation():
    o = LogSinkOptions("topics/t", 2)
    assert o.max_outstanding_bytes == DEFAULT_MAX_OUTSTANDING_BYTES == 100 * 1024 * 1024
    with pytest.raises(ValueError):
        LogSinkOptions("", 2)
    with pytest.raises(ValueError):
        LogSinkOptions("topics/t", 0)


def test_cluster_conf_scales_with_input():
    from tidelog.session import cluster_conf

    big = cluster_conf(100 * 1024**4, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = cluster_conf(10 * 1024**2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)
