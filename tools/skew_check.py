"""Skew check for the similarity self-join.

Builds a grade table where one user holds a third of all rows (and every
item), writes it to the shared scratch folder, and times ``cosine`` with and
without heavy-user blocks. Both runs must return identical results.

Usage: python tools/skew_check.py [light_rows] [hot_rows] [items]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import functions as F

    from affinity.operators import similarity
    from affinity.session import get_session, scratch_path

    light_n = int(sys.argv[1]) if len(sys.argv) > 1 else 2_000_000
    hot_n = int(sys.argv[2]) if len(sys.argv) > 2 else 1_000_000
    items = int(sys.argv[3]) if len(sys.argv) > 3 else 5000
    spark = get_session("local[8]", shuffle_partitions=32)
    path = scratch_path(spark, "skew")
    light = spark.range(light_n).select(
        (F.col("id") % max(1, light_n // 10)).cast("string").alias("sno"),
        F.pmod(F.xxhash64("id"), F.lit(items)).cast("string").alias("cno"),
        (F.col("id") % 7 + 1).cast("double").alias("weight"))
    hot = spark.range(hot_n).select(F.lit("HOT").alias("sno"), (F.col("id") % items).cast("string").alias("cno"),
                                    (F.col("id") % 5 + 1).cast("double").alias("weight"))
    light.unionByName(hot).write.parquet(path)
    grades = spark.read.parquet(path)
    for blocks in (None, 1):
        t = time.perf_counter()
        n, s = similarity.cosine(grades, blocks=blocks).agg(F.count("*"), F.sum("sim")).first()
        print(f"blocks={blocks}: {time.perf_counter() - t:.1f}s rows={n} checksum={s:.6f}")
    spark.stop()


if __name__ == "__main__":
    main()
