"""Per-item grade profile (course statistics used for clustering).

Fixed values: pass / good / great cuts are 60 / 80 / 90 (score >= cut).
The average counts non-positive grades in the denominator only, as the
reference does (a 0 or negative grade lowers the average).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PASS, GOOD, GREAT = 60.0, 80.0, 90.0


def course_profile(scores: DataFrame, item: str = "cno", score: str = "score",
                   cuts: tuple[float, float, float] = (PASS, GOOD, GREAT)) -> DataFrame:
    """``(item, avg, pass, good, great, n)`` with the item name trimmed.

    One hash aggregation (partial + final) over the whole table.
    """
    s = F.col(score).cast("double")
    n = F.count(F.lit(1))

    def share(cut: float):
        return F.sum(F.when(s >= F.lit(cut), F.lit(1.0)).otherwise(F.lit(0.0))) / n

    return (scores.groupBy(F.trim(F.col(item)).alias(item))
            .agg((F.sum(F.when(s > 0, s).otherwise(F.lit(0.0))) / n).alias("avg"),
                 share(cuts[0]).alias("pass"), share(cuts[1]).alias("good"),
                 share(cuts[2]).alias("great"), n.alias("n")))
