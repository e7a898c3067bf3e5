"""Flush groups: which messages of a partition are outstanding together under a byte budget.

A publisher takes messages in order until the next one would pass the budget, waits for what is outstanding, and goes
on.  A message counts its size, or the whole budget if it is larger, so each fits alone.  The groups are the greedy cuts
of each partition's ordered sizes.  Where a group starts depends on every group before it; the cuts are
found without walking a partition in one task:

1. Prefix sums give each message the bytes before it (``begin``).  Blocks are stretches of ``begin``
   (``block_bytes``, at least 16 budgets), so a hot partition is many blocks.  The successor of a message, the start
   of the next group had one started there, is the first whose end passes ``begin + budget``: a binary search.
2. A block sees its own messages and those of the next block's first budget (a sixteenth at most, sent
   twice).  Only messages in the first budget of a block can be the first start in it; for these, doubling of successors
   inside the block gives the first start in the next block.
3. These jumps from block to block are doubled by joins on (partition, message): ``log2(blocks)`` rounds over the entry
   messages only.  From the first message of each partition the levels then give the real start of every block.
4. Each block lists its groups from its real start on; a window over one row per block numbers them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.ordered import index_within, prefix_sum
from tidelog.schema import DEFAULT_MAX_OUTSTANDING_BYTES, require_columns
from tidelog.session import checkpoint_root, ship_code

BUDGETS_PER_BLOCK = 16
LEAST_BLOCK_BYTES = 32 << 20
GROUPS_DDL = "part INT, block BIGINT, seq BIGINT, first_off BIGINT, last_off BIGINT, n BIGINT, bytes BIGINT, accounted BIGINT"


def _successors(rows: pd.DataFrame, budget: int) -> tuple[pd.DataFrame, np.ndarray, int]:
    """Rows in order (those of the next block last), successor of every own row as a row number, and how many are own."""
    rows = rows.sort_values("idx", ignore_index=True)
    begin = rows["begin"].to_numpy()
    own = int((~rows["ahead"].to_numpy()).sum())
    return rows, np.searchsorted(begin + rows["acc"].to_numpy(), begin[:own] + budget, side="right"), own


def _jumps(budget: int, block_bytes: int):
    def run(key, rows):
        rows, jump, own = _successors(rows, budget)
        while (inside := jump < own).any():
            jump[inside] = jump[jump[inside]]
        begin, idx = rows["begin"].to_numpy(), rows["idx"].to_numpy()
        use = (begin[:own] - key[1] * block_bytes < budget) & (jump < len(rows))
        return pd.DataFrame({"part": key[0], "block": key[1], "idx": idx[:own][use], "to": idx[jump[use]]})
    return run


def _groups(budget: int):
    def run(key, rows, entry):
        if len(entry) == 0 or len(rows) == 0:      # a block that lies within the last group of the block before
            return pd.DataFrame({"part": [], "block": [], "seq": [], "first_off": [], "last_off": [], "n": [], "bytes": [], "accounted": []})
        rows, succ, own = _successors(rows, budget)
        at, starts = int(np.searchsorted(rows["idx"].to_numpy(), entry["idx"].iloc[0])), []
        succ = succ.tolist()
        while at < own:
            starts.append(at)
            at = succ[at]
        cuts = np.array(starts + [at], dtype=np.int64)
        off = rows["off"].to_numpy()
        total = np.concatenate(([0], np.cumsum(rows["bytes"].to_numpy())))
        acc = np.concatenate(([0], np.cumsum(rows["acc"].to_numpy())))
        first, last = cuts[:-1], cuts[1:]
        return pd.DataFrame({"part": key[0], "block": key[1], "seq": np.arange(len(first)), "first_off": off[first],
                             "last_off": off[last - 1], "n": last - first, "bytes": total[last] - total[first],
                             "accounted": acc[last] - acc[first]})
    return run


def flush_groups(log: DataFrame, size: Column, budget: int = DEFAULT_MAX_OUTSTANDING_BYTES,
                 block_bytes: int | None = None, part_bound: int | None = None) -> DataFrame:
    """``part, grp, first_off, last_off, n, bytes, accounted`` of every flush group of a log, in offset order.

    ``grp`` counts from 0 in each partition; ``bytes`` are the true sizes, ``accounted`` what the budget counts.  A null
    size counts 0; an empty log has no groups."""
    require_columns(log, ["part", "off"])
    if budget < 1:
        raise ValueError("budget must be positive")
    width = block_bytes or max(BUDGETS_PER_BLOCK * budget, LEAST_BLOCK_BYTES)
    if width < budget:
        raise ValueError("a block must hold at least one budget")
    checkpoint_root(log.sparkSession)
    ship_code(log.sparkSession)
    sized = log.select("part", "off", F.coalesce(size, F.lit(0)).cast("bigint").alias("bytes"))
    numbered = (index_within(sized, ["part"], ["off"], out="idx", group_bound=part_bound)
                .withColumn("acc", F.least("bytes", F.lit(int(budget)).cast("bigint"))))
    placed = (prefix_sum(numbered, ["part"], "idx", "acc", out="begin")
              .withColumn("block", F.expr(f"begin div {width}")).checkpoint(eager=True))
    ahead = (placed.where((F.col("block") > 0) & (F.col("begin") - F.col("block") * width < budget))
             .withColumn("block", F.col("block") - 1))
    seen = placed.withColumn("ahead", F.lit(False)).unionByName(ahead.withColumn("ahead", F.lit(True)))

    blocks = placed.agg(F.max("block")).first()[0]      # one number
    entries = placed.where("idx = 0").select("part", "block", "idx")
    if blocks:
        level = seen.groupBy("part", "block").applyInPandas(
            _jumps(budget, width), "part INT, block BIGINT, idx BIGINT, to BIGINT").checkpoint(eager=True)
        levels, step = [level], 1
        while step * 2 <= blocks:
            then = level.select("part", F.col("idx").alias("to"), F.col("to").alias("_to"))
            level = level.join(then, ["part", "to"]).select("part", "block", "idx", F.col("_to").alias("to")).checkpoint(eager=True)
            levels.append(level)
            step *= 2
        for level in reversed(levels):
            reached = entries.join(level.drop("block"), ["part", "idx"]).select(
                "part", (F.col("block") + step).alias("block"), F.col("to").alias("idx"))
            entries = entries.unionByName(reached).checkpoint(eager=True)
            step //= 2
    groups = (seen.groupBy("part", "block").cogroup(entries.groupBy("part", "block"))
              .applyInPandas(_groups(budget), GROUPS_DDL)).checkpoint(eager=True)
    before = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = groups.groupBy("part", "block").agg(F.count(F.lit(1)).alias("_n")).select(
        "part", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return groups.join(counts, ["part", "block"]).select(
        "part", (F.col("_before") + F.col("seq")).alias("grp"), "first_off", "last_off", "n", "bytes", "accounted")
