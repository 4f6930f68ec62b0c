"""Item-based collaborative-filtering scores.

``predict`` follows the reference scoring rule:

* join the similarity matrix with the user's weighted items on ``item2``;
* per user keep the ``n`` joined rows with the highest user weight of
  ``item2`` (ties: higher similarity, then item1, item2 — deterministic);
* ``pred(user, item1) = Σ sim·weight / len`` where ``len`` is the number of
  kept rows of that user (or a fixed ``divisor``);
* keep ``pred > threshold`` (NaN never passes).

Plan: neighbours are cut to ``n`` per item and grade rows to ``n`` per user
(exact also with tied weights, see ``predict``), then one shuffle-join, then the window on
``user`` with ``row_number() <= n``
which Spark turns into a WindowGroupLimit (a partial top-n before the shuffle,
so even a user with a third of all rows sends at most n rows per map task);
the count window and the per-(user, item1) sum reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions import squash as squash_expr
from affinity.operators.ordering import with_positions
from affinity.session import checkpoint_dir

# Fixed values of the reference scoring rule.
TOP_N = 50
THRESHOLD = 0.98


def predict(similarity: DataFrame, perf: DataFrame, n: int = TOP_N, threshold: float | None = THRESHOLD,
            divisor: float | None = None, squash: str | None = None, user: str = "sno",
            item: str = "cno", weight: str = "weight", out: str = "pre_score",
            order: bool = False) -> DataFrame:
    """``(user, item, out)`` predictions from ``similarity(item1, item2, sim)``
    and ``perf(user, item, weight)`` (raw rows: repeats count)."""
    s = similarity.select("item1", "item2", "sim")
    p = perf.select(F.col(user).alias("_u"), F.col(item).alias("item2"),
                    F.col(weight).cast("double").alias("_w"))
    # Two exact cuts before the join leave at most n * n joined rows per user.
    # An item's neighbours beyond its first n by (sim desc, item1) follow n
    # joined rows of the same grade row. Grade rows are ordered by their best
    # joined row (weight desc, then the best neighbour's sim desc, item1,
    # item2): whatever follows n of them follows n joined rows.
    near = Window.partitionBy("item2").orderBy(F.col("sim").desc(), F.col("item1"))
    # The cut table is read twice (best neighbours and join): materialise it once rather
    # than the whole similarity table, which is ordered and sent only for this cut.
    checkpoint_dir(similarity.sparkSession)
    s = s.withColumn("_rs", F.row_number().over(near)).where(F.col("_rs") <= n).checkpoint(eager=True)
    best = s.where(F.col("_rs") == 1).select("item2", F.col("sim").alias("_bs"), F.col("item1").alias("_bi"))
    by_best = Window.partitionBy("_u").orderBy(F.col("_w").desc(), F.col("_bs").desc(), F.col("_bi"), F.col("item2"))
    p = (p.join(best, "item2").withColumn("_rw", F.row_number().over(by_best)).where(F.col("_rw") <= n)
         .drop("_rw", "_bs", "_bi"))
    j = p.join(s.drop("_rs"), "item2")
    rank = Window.partitionBy("_u").orderBy(F.col("_w").desc(), F.col("sim").desc(),
                                            F.col("item1"), F.col("item2"))
    kept = j.withColumn("_rn", F.row_number().over(rank)).where(F.col("_rn") <= n)
    kept = kept.withColumn("_len", F.count(F.lit(1)).over(Window.partitionBy("_u")))
    agg = kept.groupBy("_u", "item1").agg(F.sum(F.col("sim") * F.col("_w")).alias("_s"),
                                          F.max("_len").alias("_len"))
    div = F.lit(float(divisor)) if divisor is not None else F.col("_len").cast("double")
    pred = squash_expr(F.try_divide(F.col("_s"), div), squash)
    res = agg.select(F.col("_u").alias(user), F.col("item1").alias(item), pred.alias(out))
    if threshold is not None:
        res = res.where((F.col(out) > F.lit(float(threshold))) & ~F.isnan(out))
    if order:
        res = res.orderBy(user, out)
    return res


def ordered(pred: DataFrame, user: str = "sno", item: str = "cno", score: str = "pre_score",
            partitions: int | None = None) -> DataFrame:
    """Predictions with their ``position`` in the order (user, score, item), as range partitions
    with prefix-summed counts: no task holds more than its range, a user may span several."""
    return with_positions(pred, user, score, item, partitions=partitions)


def seen_items(perf: DataFrame, item: str = "cno") -> DataFrame:
    """Distinct items present in the score rows."""
    return perf.select(item).distinct()


def exclude_items(pred: DataFrame, known: DataFrame, per_user: bool = True,
                  user: str = "sno", item: str = "cno") -> DataFrame:
    """Drop predictions of items already known (per user, or known to anyone)."""
    keys = [user, item] if per_user else [item]
    return pred.join(known.select(*keys).distinct(), keys, "left_anti")
