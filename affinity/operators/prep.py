"""Selections and weights on the score table.

Fixed values (defaults taken from the reference jobs):
    train cut       70   (score strictly below)
    preview cut     65   (score strictly below)
    held-out cohort given by the caller (the reference used its 2016 intake)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions import deficit

TRAIN_CUT = 70.0
PREVIEW_CUT = 65.0


def train_scores(scores: DataFrame, holdout: str, cut: float = TRAIN_CUT, term: str | None = None,
                 user: str = "sno", item: str = "cno", score: str = "score",
                 cohort: str = "cohort", term_col: str = "term") -> DataFrame:
    """Grades below ``cut`` outside the held-out cohort (NULL cohort drops)."""
    cond = (F.col(score) < F.lit(float(cut))) & (F.col(cohort) != F.lit(holdout))
    if term is not None:
        cond = cond & (F.col(term_col) == F.lit(term))
    return scores.where(cond).select(user, item, score)


def preview_scores(scores: DataFrame, cohort_value: str, cut: float = PREVIEW_CUT,
                   term: str | None = None, user: str = "sno", item: str = "cno",
                   score: str = "score", cohort: str = "cohort", term_col: str = "term") -> DataFrame:
    """Grades below ``cut`` of the cohort to be predicted."""
    cond = (F.col(score) < F.lit(float(cut))) & (F.col(cohort) == F.lit(cohort_value))
    if term is not None:
        cond = cond & (F.col(term_col) == F.lit(term))
    return scores.where(cond).select(user, item, score)


def basket_pairs(scores: DataFrame, holdout: str, cut: float = TRAIN_CUT,
                 user: str = "sno", item: str = "cno", score: str = "score",
                 cohort: str = "cohort") -> DataFrame:
    """``(basket, item)`` pairs of the training grades (one row per grade)."""
    return train_scores(scores, holdout, cut, user=user, item=item, score=score,
                        cohort=cohort).select(user, item)


def with_deficit(df: DataFrame, cut: float, score: str = "score", out: str = "weight") -> DataFrame:
    """Replace ``score`` by the weight ``cut - score`` (high = did badly)."""
    cols = [c for c in df.columns if c != score]
    return df.select(*cols, deficit(score, cut).alias(out))
