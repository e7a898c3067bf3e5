"""Rows per task for order-dependent operators on a log whose partition 0 holds about a third of
all rows, against the naive one-window-per-partition form.

Usage: python tools/skew_check.py [sf_dir] [shuffle_partitions]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidelog.operators.ordered import index_within, prev_offset  # noqa: E402
from tidelog.session import get_spark  # noqa: E402
from tidelog.sources.logs import table  # noqa: E402


def skewed_log(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    hot = F.col("event_id") % 3 == 0                # a third of all rows -> partition 0
    return ev.select(F.when(hot, F.lit(0)).otherwise(F.col("user_id") % 7 + 1).cast("int").alias("part"),
                     F.col("event_id").alias("off"))


def per_task(df, out_col):
    # aggregate the operator's own output so the optimizer cannot drop the operator
    c = (df.withColumn("_pid", F.spark_partition_id()).groupBy("_pid")
         .agg(F.count(F.lit(1)).alias("count"), F.max(out_col).alias("_m")).collect())
    counts = sorted(r["count"] for r in c)
    return max(counts), sum(counts) / len(counts), len(counts)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    n = int(argv[2]) if len(argv) > 2 else 64
    spark = get_spark("local[8]", n, extra={"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    log = skewed_log(spark, sf_dir)
    total = log.count()
    hot = log.where("part = 0").count()
    print(f"rows {total}, partition 0 holds {hot} ({hot / total:.0%}); {n} shuffle partitions")
    rows = [
        ("lag: Window.partitionBy(part)", log.withColumn("p", F.lag("off").over(Window.partitionBy("part").orderBy("off")))),
        ("lag: prev_offset (chunks of 1024 offsets)", prev_offset(log, width=1024).select("part", "off", "prev_off")),
        ("row_number: Window.partitionBy(part)", log.withColumn("i", F.row_number().over(Window.partitionBy("part").orderBy("off")))),
        ("row_number: index_within (range partitions)", index_within(log, ["part"], ["off"], out="i", num_ranges=n)),
    ]
    print("| operator | max rows in one task | mean rows per task | tasks with rows |")
    print("|---|---|---|---|")
    for name, df in rows:
        mx, mean, k = per_task(df, df.columns[-1])
        print(f"| {name} | {mx:,} | {mean:,.0f} | {k} |")


if __name__ == "__main__":
    main(sys.argv)
