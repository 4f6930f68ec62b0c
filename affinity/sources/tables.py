"""The driver's star-schema tables seen as a grade table.

``scores_view`` maps ``lineitem ⋈ orders (⋈ part)`` onto the score schema:

* ``sno``    = customer key (the "student")
* ``cno``    = part brand (25 items, many duplicates) or part key
* ``score``  = 50 + quantity (51 .. 100)
* ``term``   = order year ‖ 'Q' ‖ quarter
* ``cohort`` = order year

Only the columns needed are read (the scans show a pruned ``ReadSchema``) and
filters on ``score`` / ``cohort`` applied by the caller are pushed below the
joins by Catalyst. Join strategy is left to AQE: at scale every table here is
large, so nothing is hinted to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scores_view(spark: SparkSession, sf_dir: str, item: str = "brand", score_lt: float | None = None,
                cohort: str | None = None, cohort_not: str | None = None) -> DataFrame:
    """``(sno, cno, score, term, cohort)`` over the whole line-item table.

    ``score_lt`` / ``cohort`` / ``cohort_not`` restrict the view with
    predicates on the raw columns (``l_quantity < score_lt - 50`` and an order
    date range), which reach the parquet scans as pushed filters; callers
    still apply their own filters on the derived columns.
    """
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if score_lt is not None:
        li = li.where(F.col("l_quantity") < F.lit(float(score_lt) - 50.0))
    if cohort is not None:
        od = od.where(_year_range(cohort))
    if cohort_not is not None:
        od = od.where(~_year_range(cohort_not))
    df = li.join(od, li.l_orderkey == od.o_orderkey)
    if item == "brand":
        pt = load_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        df = df.join(pt, df.l_partkey == pt.p_partkey)
        cno = F.col("p_brand")
    elif item == "part":
        cno = F.col("l_partkey").cast("string")
    else:
        raise ValueError(f"item must be 'brand' or 'part', got {item!r}")
    year = F.year("o_orderdate")
    return df.select(
        F.col("o_custkey").cast("string").alias("sno"),
        cno.alias("cno"),
        (F.lit(50.0) + F.col("l_quantity")).alias("score"),
        F.concat(year.cast("string"), F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias("term"),
        year.cast("string").alias("cohort"),
    )


def item_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(cno, score)`` of every line item, by part: what per-item statistics over all cohorts need,
    without the orders."""
    li = load_table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity")
    return li.select(F.col("l_partkey").cast("string").alias("cno"), (F.lit(50.0) + F.col("l_quantity")).alias("score"))


def _year_range(year: str):
    y = int(year)
    lo = F.lit(f"{y:04d}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{y + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (F.col("o_orderdate") >= lo) & (F.col("o_orderdate") < hi)
