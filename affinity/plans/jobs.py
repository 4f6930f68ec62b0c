"""End-to-end jobs of the reference, as DataFrame plans.

* :func:`train`   grades → deficit weights (70) → cosine (optionally boosted by
  frequent itemsets or by explicit pairs)
* :func:`predict` preview grades → deficit weights (65) → item-CF scores
* :func:`mine_rules` grade pairs → baskets → mining → itemsets and rules
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from affinity.operators import baskets as B
from affinity.operators import prep, recommend, similarity
from affinity.session import checkpoint_dir


def train(train_rows: DataFrame, cut: float = prep.TRAIN_CUT, itemsets: DataFrame | None = None,
          boost_weight: float = 32.0, pairs: DataFrame | None = None, method: str = "cosine",
          user: str = "sno", item: str = "cno", score: str = "score", towards: DataFrame | None = None,
          summed: bool = False) -> DataFrame:
    """Item-item similarity from training grades (``score < cut`` rows); cosines with ``towards``
    only to these items, as the scores of grades in them need. ``summed``: ``train_rows`` come
    from :func:`summed_weights`."""
    if method == "cosine":
        w = train_rows if summed else prep.with_deficit(train_rows.select(user, item, score), cut, score=score)
        sim = similarity.cosine(w, user=user, item=item, weight="weight", towards=towards, summed=summed)
    elif method == "cooccurrence":
        sim = similarity.cooccurrence(train_rows, user=user, item=item)
    else:
        raise ValueError(f"unknown method {method!r}")
    if itemsets is not None:
        sim = similarity.boost_by_itemsets(sim, itemsets, weight=boost_weight)
    if pairs is not None:
        sim = similarity.boost_by_pairs(sim, pairs)
    return sim


def summed_weights(train_rows: DataFrame, cut: float = prep.TRAIN_CUT, user: str = "sno", item: str = "cno",
                   score: str = "score") -> DataFrame:
    """``(user, item, weight)``: the summed deficit weights of each pair, stored once for jobs that
    both mine baskets (``distinct=True``) and train (``summed=True``)."""
    checkpoint_dir(train_rows.sparkSession)
    w = prep.with_deficit(train_rows.select(user, item, score), cut, score=score)
    return similarity.pair_weights(w, user, item, "weight").withColumnsRenamed({"item": item, "v": "weight"}).checkpoint(eager=True)


def predict(preview_rows: DataFrame, sim: DataFrame, cut: float = prep.PREVIEW_CUT,
            n: int = recommend.TOP_N, threshold: float | None = recommend.THRESHOLD,
            exclude_seen: bool = False, seen_by: str = "user", user: str = "sno", item: str = "cno",
            score: str = "score", **kw) -> DataFrame:
    """Scores ``(user, item, pre_score)`` for the preview grades; ``exclude_seen`` drops items
    known to the same user, or to anyone with ``seen_by="anyone"``."""
    if exclude_seen:
        # read twice (scores and exclusion): materialise once
        checkpoint_dir(preview_rows.sparkSession)
        preview_rows = preview_rows.select(user, item, score).checkpoint(eager=True)
    perf = prep.with_deficit(preview_rows.select(user, item, score), cut, score=score)
    pred = recommend.predict(sim, perf, n=n, threshold=threshold, user=user, item=item, **kw)
    if exclude_seen:
        pred = recommend.exclude_items(pred, preview_rows, per_user=seen_by == "user", user=user, item=item)
    return pred


def mine_rules(pairs: DataFrame, min_support: float, min_confidence: float, basket: str = "sno",
               item: str = "cno", num_partitions: int | None = None, distinct: bool = False):
    """``(itemsets, rules, mined)`` from (basket, item) pairs; ``distinct``: they are distinct
    and stored already."""
    bk = B.to_baskets(pairs, basket=basket, item=item, min_support=min_support, distinct=distinct)
    mined = B.mine(bk, min_support, min_confidence, num_partitions=num_partitions)
    return B.frequent_itemsets(mined), B.association_rules(mined), mined


def rules_job(pairs: DataFrame, min_support: float, min_confidence: float, out_path: str | None = None,
              basket: str = "sno", item: str = "cno", text: bool = True, single_file: bool = False,
              whole: bool = False) -> DataFrame:
    """Rule-mining job: baskets → mining → wide rules
    ``(antecedent1..4, consequent, confidence, antecedent)``; optionally written as
    tab-separated text (one file only with ``single_file``) or as parquet. The text has the
    six fixed columns; ``whole`` adds the full antecedent, which parquet always has."""
    from affinity.sinks import RULE_COLS, write_files

    _, rules, _ = mine_rules(pairs, min_support, min_confidence, basket=basket, item=item)
    wide = B.rules_wide(rules)
    if out_path is not None:
        if text:
            write_files(wide.select(*(RULE_COLS if whole else RULE_COLS[:-1])), out_path, fmt="text", single_file=single_file)
        else:
            write_files(wide, out_path)
    return wide


def itemsets_job(pairs: DataFrame, min_support: float, basket: str = "sno", item: str = "cno",
                 wide: bool = False) -> DataFrame:
    """Itemset job: ``(items, freq as double)`` or the wide ``item1..item4`` shape."""
    from pyspark.sql import functions as F

    fi, _, _ = mine_rules(pairs, min_support, 0.0, basket=basket, item=item)
    if wide:
        return B.itemsets_wide(fi, keep_freq=False)
    return fi.select("items", F.col("freq").cast("double").alias("freq"))


def kmeans_job(features: DataFrame, key: str = "cno", cols: list[str] | None = None, k: int = 4,
               max_iter: int = 30, seed: int = 7, n_init: int = 1, out_path: str | None = None) -> DataFrame:
    """Cluster-labelling job: ``(key, label)`` for every row, optionally written."""
    from affinity.operators import clustering
    from affinity.sinks import write_labels

    cols = cols or [c for c in features.columns if c != key]
    labels = clustering.kmeans_labels(features, key, cols, k=k, max_iter=max_iter, seed=seed, n_init=n_init)
    if out_path is not None:
        write_labels(labels.withColumnRenamed(key, "cno"), out_path, mode="overwrite")
    return labels
