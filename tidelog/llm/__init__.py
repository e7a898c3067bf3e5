"""Operators of a training-data pipeline; nothing else in the library imports this subpackage.

Each module holds one operator with its registered query and SQL; ``queries`` and ``oracle_sql``
collect them for the entry module.
"""

from __future__ import annotations


def _modules():
    from . import (op1_jaccard, op2_quality, op3_sharding, op4_decontaminate, op5_tokens, op6_lm, op7_warc,
                   op8_sentencepiece, op9_substring, op10_suffix, op11_divergence, op12_simhash, op13_runs)

    return (op1_jaccard, op2_quality, op3_sharding, op4_decontaminate, op5_tokens, op6_lm, op7_warc,
            op8_sentencepiece, op9_substring, op10_suffix, op11_divergence, op12_simhash, op13_runs)


def queries():
    """Query name -> ``fn(spark, sf_dir) -> DataFrame``."""
    return {m.NAME: m.query for m in _modules()}


def oracle_sql():
    """Query name -> DuckDB SQL, for the operators that SQL can express."""
    return {m.NAME: m.SQL for m in _modules() if m.SQL}
