"""The query catalogue over the driver tables (``queries()`` of the entry module).

Every query reads the whole tables under ``sf_dir`` (see
:mod:`affinity.sources.tables` for the grade view) and returns a DataFrame
whose column names match :func:`affinity.plans.oracle.oracle_sql`. Computed
doubles that are sums of non-integers are rounded to 6 places (engines add in
different orders); ratios of exact integer sums are returned as computed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions import joined
from affinity.operators import anonymize, baskets, clustering, prep, profile, recommend, similarity
from affinity.plans import jobs
from affinity.plans.params import (
    BOOST_SUPPORT,
    BOOST_WEIGHT,
    EPSILON,
    HOLDOUT,
    KMAX_MICRO,
    KMEANS_ITER,
    KMEANS_K,
    LLOYD_K,
    LOW_THRESHOLD,
    MIN_CONFIDENCE,
    MIN_SUPPORT,
    ORDER_MIN_CONFIDENCE,
    ORDER_MIN_SUPPORT,
    PREVIEW_CUT,
    SEED,
    TERM,
    THRESHOLD,
    TOP_N,
    TRAIN_CUT,
)
from affinity.session import checkpoint_dir, scratch_path
from affinity.sources import item_scores, load_table, read_baskets, read_features, read_pairs, read_ratings, read_scores, read_wide_scores, scores_view
from affinity.sinks import write_files, write_itemsets, write_labels, write_predictions, write_rules

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ inputs

def _train_view(spark, sf_dir, item="brand"):
    return scores_view(spark, sf_dir, item, score_lt=TRAIN_CUT, cohort_not=HOLDOUT)


def _train(spark, sf_dir, item="brand"):
    return prep.train_scores(_train_view(spark, sf_dir, item), HOLDOUT, TRAIN_CUT)


def _preview(spark, sf_dir, item="brand"):
    view = scores_view(spark, sf_dir, item, score_lt=PREVIEW_CUT, cohort=HOLDOUT)
    return prep.preview_scores(view, HOLDOUT, PREVIEW_CUT)


def _brand_cosine(spark, sf_dir):
    return jobs.train(_train(spark, sf_dir), TRAIN_CUT)


def _weights_once(spark, sf_dir):
    """Summed weights of the training grades, one stored row for each pair, for queries that
    both mine baskets and compute similarities from them."""
    return jobs.summed_weights(_train(spark, sf_dir), TRAIN_CUT)


def _itemsets(spark, sf_dir, support, stored=None):
    """Mined from the training grades, or from ``stored`` rows, one for each pair."""
    rows = stored if stored is not None else _train(spark, sf_dir)
    return jobs.mine_rules(rows.select("sno", "cno"), support, MIN_CONFIDENCE, distinct=stored is not None)


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


# ----------------------------------------------------------------- queries

def q_train_scores(spark, sf_dir):
    return _train(spark, sf_dir)


def q_preview_scores(spark, sf_dir):
    return _preview(spark, sf_dir)


def q_basket_pairs(spark, sf_dir):
    return prep.basket_pairs(_train_view(spark, sf_dir), HOLDOUT, TRAIN_CUT)


def q_cooccurrence(spark, sf_dir):
    return similarity.cooccurrence(_train(spark, sf_dir))


def q_cosine(spark, sf_dir):
    return jobs.train(_train(spark, sf_dir, "part"), TRAIN_CUT)


def _scores(spark, sf_dir, sim, threshold):
    pred = jobs.predict(_preview(spark, sf_dir), sim, PREVIEW_CUT, n=TOP_N, threshold=threshold)
    return pred.select("sno", "cno", _r6("pre_score"))


def q_recommend(spark, sf_dir):
    return _scores(spark, sf_dir, _brand_cosine(spark, sf_dir), THRESHOLD)


def q_recommend_scores(spark, sf_dir):
    return _scores(spark, sf_dir, _brand_cosine(spark, sf_dir), None)


def q_recommend_unseen(spark, sf_dir):
    pred = jobs.predict(_preview(spark, sf_dir), _brand_cosine(spark, sf_dir), PREVIEW_CUT, n=TOP_N,
                            threshold=None, exclude_seen=True)
    return pred.select("sno", "cno", _r6("pre_score"))


def q_seen_items(spark, sf_dir):
    return recommend.seen_items(_preview(spark, sf_dir))


def q_frequent_itemsets(spark, sf_dir):
    fi, _, _ = _itemsets(spark, sf_dir, MIN_SUPPORT)
    return fi.select(joined("items").alias("items"), "size", "freq")


def q_itemsets_wide(spark, sf_dir):
    fi, _, _ = _itemsets(spark, sf_dir, MIN_SUPPORT)
    return baskets.itemsets_wide(fi)


def q_itemset_summary(spark, sf_dir):
    fi, _, _ = _itemsets(spark, sf_dir, MIN_SUPPORT)
    return baskets.itemset_summary(fi)


def q_association_rules(spark, sf_dir):
    _, rules, _ = _itemsets(spark, sf_dir, MIN_SUPPORT)
    return rules.select(joined("antecedent").alias("antecedent"), "consequent",
                        _r6("confidence"), _r6("lift"), _r6("support"))


def q_rules_wide(spark, sf_dir):
    _, rules, _ = _itemsets(spark, sf_dir, MIN_SUPPORT)
    return baskets.rules_wide(rules).withColumn("confidence", F.round("confidence", 6))


def q_recommend_from_rules(spark, sf_dir):
    checkpoint_dir(spark)
    pairs = _train(spark, sf_dir).select("sno", "cno").distinct().checkpoint(eager=True)
    _, rules, _ = _itemsets(spark, sf_dir, MIN_SUPPORT, pairs)
    return baskets.recommend_from_rules(rules, pairs, distinct=True)


def _order_pairs(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    pt = load_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (li.join(pt, li.l_partkey == pt.p_partkey)
            .select(F.col("l_orderkey").cast("string").alias("basket"), F.col("p_type").alias("item")))


def q_order_itemsets(spark, sf_dir):
    fi, _, _ = jobs.mine_rules(_order_pairs(spark, sf_dir), ORDER_MIN_SUPPORT, ORDER_MIN_CONFIDENCE,
                                   basket="basket", item="item")
    return fi.select(joined("items").alias("items"), "size", "freq")


def q_order_rules(spark, sf_dir):
    _, rules, _ = jobs.mine_rules(_order_pairs(spark, sf_dir), ORDER_MIN_SUPPORT,
                                      ORDER_MIN_CONFIDENCE, basket="basket", item="item")
    return rules.select(joined("antecedent").alias("antecedent"), "consequent",
                        _r6("confidence"), _r6("lift"), _r6("support"))


def _boosted(spark, sf_dir):
    rows = _weights_once(spark, sf_dir)
    fi, _, _ = _itemsets(spark, sf_dir, BOOST_SUPPORT, rows)
    return jobs.train(rows, TRAIN_CUT, itemsets=fi, boost_weight=BOOST_WEIGHT, summed=True)


def q_cosine_boosted(spark, sf_dir):
    return _boosted(spark, sf_dir)


def q_recommend_boosted(spark, sf_dir):
    return _scores(spark, sf_dir, _boosted(spark, sf_dir), THRESHOLD)


def q_recommend_boosted_scores(spark, sf_dir):
    return _scores(spark, sf_dir, _boosted(spark, sf_dir), None)


def q_pair_boost(spark, sf_dir):
    rows = _weights_once(spark, sf_dir)
    fi, _, _ = _itemsets(spark, sf_dir, MIN_SUPPORT, rows)
    pairs = fi.where(F.col("size") == 2).select(F.get("items", 0).alias("a"), F.get("items", 1).alias("b"),
                                               F.col("freq").cast("double").alias("value"))
    return jobs.train(rows, TRAIN_CUT, pairs=pairs, summed=True)


def _profile(spark, sf_dir, **cohort):
    return profile.course_profile(scores_view(spark, sf_dir, "part", **cohort) if cohort else item_scores(spark, sf_dir))


def q_course_profile(spark, sf_dir):
    p = _profile(spark, sf_dir)
    return p.select("cno", _r6("avg"), _r6("pass"), _r6("good"), _r6("great"), "n")


FEATURES = ["avg", "pass", "good", "great"]


def _kmeans(spark, sf_dir):
    p = _profile(spark, sf_dir)
    return clustering.kmeans_labels(p, "cno", FEATURES, k=KMEANS_K, max_iter=KMEANS_ITER, seed=SEED)


def q_kmeans_assign(spark, sf_dir):
    return _kmeans(spark, sf_dir)


def q_cluster_sizes(spark, sf_dir):
    return clustering.cluster_sizes(_kmeans(spark, sf_dir))


def _tiers(train_points, new_points):
    return clustering.forecast_tier(train_points, new_points, "avg", "cno", k=LLOYD_K, epsilon=EPSILON)


def q_lloyd_tiers(spark, sf_dir):
    p = _profile(spark, sf_dir)
    t = _tiers(p, p)
    return t.select("cno", _r6("avg"), _r6("center"), F.col("tier_rank").cast("int").alias("tier_rank"), "tier")


def q_forecast_tier(spark, sf_dir):
    train = _profile(spark, sf_dir, cohort_not=HOLDOUT)
    new = _profile(spark, sf_dir, cohort=HOLDOUT)
    t = _tiers(train, new)
    return t.select("cno", _r6("avg"), _r6("center"), "tier")


def _micro(spark, sf_dir):
    s = scores_view(spark, sf_dir, "brand")
    cells = s.groupBy(F.col("sno").alias("id"), F.col("cno").alias("attr")).agg(
        (F.sum("score") / F.count(F.lit(1))).alias("value"))
    return anonymize.microaggregate(cells, kmax=KMAX_MICRO)


def q_microaggregate(spark, sf_dir):
    m = _micro(spark, sf_dir)
    return m.select("id", "attr", F.round(F.round("center", 9), 3).alias("value"))


def _names(spark, rows):
    """Attribute names that become columns: bounded like any pivot (spark.sql.pivotMaxValues)."""
    limit = int(spark.conf.get("spark.sql.pivotMaxValues", "10000"))
    names = rows.select("attr").distinct().limit(limit + 1).collect()
    if len(names) > limit:
        raise ValueError(f"more than {limit} attributes for the wide sheet; use the long form")
    return sorted(r.attr for r in names)


def q_microaggregate_wide(spark, sf_dir):
    """The anonymised sheet: one row per id, one column per attribute."""
    m = _micro(spark, sf_dir).select("id", "attr", F.round(F.round("center", 9), 3).alias("value"))
    return anonymize.to_wide(m, "id", _names(spark, m))


def q_anonymised_sheet(spark, sf_dir):
    """The anonymised sheet as fixed-point text lines, through the file sink."""
    checkpoint_dir(spark)
    m = _micro(spark, sf_dir).select("id", "attr", F.round(F.round("center", 9), 3).alias("value")).checkpoint(eager=True)
    names = _names(spark, m)
    lines = anonymize.format_sheet(anonymize.to_wide(m, "id", names), names)
    path = f"{scratch_path(spark, 'sheet-text')}/data"
    write_files(lines, path, fmt="text")
    return spark.read.text(path).select(F.substring_index("value", "\t", 1).alias("id"),
                                        F.expr("substring(value, instr(value, '\t') + 1)").alias("value"))


def q_microaggregate_detail(spark, sf_dir):
    m = _micro(spark, sf_dir)
    return m.select("id", "attr", _r6("value"), "band", "k", "cluster", _r6("center"), "cluster_size")


def q_read_write_roundtrip(spark, sf_dir):
    """Training grades written as tab-separated text and parquet to the shared
    folder, read back with the text reader."""
    rows = _train(spark, sf_dir)
    base = scratch_path(spark, "roundtrip")
    write_files(rows, f"{base}/tsv", fmt="text", sep="\t")
    back = read_ratings(spark, f"{base}/tsv", sep="\t")
    write_files(back, f"{base}/parquet")
    return spark.read.parquet(f"{base}/parquet")


def q_recommend_low_threshold(spark, sf_dir):
    """The threshold filter with a cut that keeps part of the scores."""
    return _scores(spark, sf_dir, _brand_cosine(spark, sf_dir), LOW_THRESHOLD)


def _grades_back(spark, sf_dir, name, write, read):
    """Training grades written in one of the reference's shapes and read back."""
    base = f"{scratch_path(spark, name)}/data"
    write(_train(spark, sf_dir), base)
    return read(base)


def q_read_pairs(spark, sf_dir):
    return _grades_back(spark, sf_dir, "pairs", lambda d, p: write_files(d.select("sno", "cno"), p, fmt="text"),
                        lambda p: read_pairs(spark, p, basket="sno", item="cno"))


def q_read_scores_csv(spark, sf_dir):
    return _grades_back(spark, sf_dir, "scores", lambda d, p: write_files(d.select("sno", "cno", "score"), p, fmt="csv"),
                        lambda p: read_scores(spark, p, fmt="csv").select("sno", "cno", "score"))


def q_read_baskets(spark, sf_dir):
    """Baskets as lines of items, read back and counted by size."""
    def write(d, p):
        lines = baskets.to_baskets(d.select("sno", "cno"))
        write_files(lines.select(F.concat_ws(" ", "items").alias("line")), p, fmt="text")

    back = _grades_back(spark, sf_dir, "baskets", write, lambda p: read_baskets(spark, p))
    return back.groupBy(joined("items").alias("items")).agg(F.count(F.lit(1)).alias("n"))


def q_read_wide_scores(spark, sf_dir):
    """Best grade per student and brand as a wide sheet with header, read back as cells."""
    def write(d, p):
        cells = d.groupBy(F.col("sno").alias("id"), F.col("cno").alias("attr")).agg(F.max("score").alias("value"))
        cells = cells.checkpoint(eager=True)
        write_files(anonymize.to_wide(cells, "id", _names(spark, cells)), p, fmt="tsv", header=True)

    return anonymize.to_long(_grades_back(spark, sf_dir, "sheet", write, lambda p: read_wide_scores(spark, p)))


def q_sink_labels(spark, sf_dir):
    """Tier labels through the label sink."""
    path = f"{scratch_path(spark, 'labels')}/data"
    p = _profile(spark, sf_dir)
    write_labels(_tiers(p, p).select("cno", F.col("tier").alias("label")), path)
    return spark.read.parquet(path)


def q_sink_predictions(spark, sf_dir):
    path = f"{scratch_path(spark, 'predictions')}/data"
    write_predictions(q_recommend_scores(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_sink_rules(spark, sf_dir):
    path = f"{scratch_path(spark, 'rules')}/data"
    write_rules(q_rules_wide(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_sink_itemsets(spark, sf_dir):
    path = f"{scratch_path(spark, 'itemsets')}/data"
    write_itemsets(q_itemsets_wide(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_kmeans_check(spark, sf_dir):
    """Per course: is its label the nearest of the model's centres, and in 0..k-1?"""
    checkpoint_dir(spark)
    p = _profile(spark, sf_dir).checkpoint(eager=True)
    model = clustering.fit_kmeans(p, FEATURES, k=KMEANS_K, max_iter=KMEANS_ITER, seed=SEED)
    labels = clustering.assign(model, p, "cno", FEATURES)
    centres = [[float(x) for x in c] for c in model.clusterCenters()]  # k rows
    away = [sum((F.col(f) - F.lit(x)) * (F.col(f) - F.lit(x)) for f, x in zip(FEATURES, c, strict=True)) for c in centres]
    own = F.get(F.array(*away), F.col("label").cast("int"))
    return p.join(labels, "cno").select("cno", (own <= F.least(*away) + F.lit(1e-9)).alias("is_nearest"),
                                        F.col("label").cast("int").between(0, KMEANS_K - 1).alias("in_range"))


def q_ordered_scores(spark, sf_dir):
    """Scores in the order (user, score, item) with their position."""
    return recommend.ordered(q_recommend_scores(spark, sf_dir))


def q_recommend_unseen_by_anyone(spark, sf_dir):
    """Scores of the parts that no student of the preview has a grade in."""
    # read twice (rated parts, scores): materialise once
    checkpoint_dir(spark)
    preview = _preview(spark, sf_dir, "part").checkpoint(eager=True)
    # a score reads only the similarities to parts with a grade
    sim = jobs.train(_train(spark, sf_dir, "part"), TRAIN_CUT, towards=recommend.seen_items(preview))
    pred = jobs.predict(preview, sim, PREVIEW_CUT, n=TOP_N, threshold=None, exclude_seen=True, seen_by="anyone")
    return pred.select("sno", "cno", _r6("pre_score"))


def q_recommend_atan(spark, sf_dir):
    """Scores squashed by atan."""
    pred = jobs.predict(_preview(spark, sf_dir), _brand_cosine(spark, sf_dir), PREVIEW_CUT, n=TOP_N, threshold=None, squash="atan")
    return pred.select("sno", "cno", _r6("pre_score"))


def q_train_scores_term(spark, sf_dir):
    """Training grades of one term."""
    return prep.train_scores(_train_view(spark, sf_dir), HOLDOUT, TRAIN_CUT, term=TERM)


def q_itemset_pairs(spark, sf_dir):
    """Frequent itemsets of two items."""
    _, _, mined = _itemsets(spark, sf_dir, MIN_SUPPORT)
    return baskets.frequent_itemsets(mined, size=2).select(joined("items").alias("items"), "size", "freq")


def q_rule_summary(spark, sf_dir):
    _, rules, _ = _itemsets(spark, sf_dir, MIN_SUPPORT)
    return baskets.rule_summary(rules)


def q_rule_text(spark, sf_dir):
    """Rules as report lines, in both formats."""
    _, rules, _ = _itemsets(spark, sf_dir, MIN_SUPPORT)
    rules = rules.withColumn("confidence", F.format_string("%.6f", F.round("confidence", 6)))
    return baskets.rule_text(rules).unionByName(baskets.rule_text(rules, "arrows"))


def q_course_count(spark, sf_dir):
    """Number of courses with a profile and of their grades."""
    return _profile(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_courses"), F.sum("n").alias("n_scores"))


def q_read_features(spark, sf_dir):
    """Course profiles written as padded text with a header line, read back as features."""
    p = _profile(spark, sf_dir).select("cno", *FEATURES)
    path = f"{scratch_path(spark, 'features')}/data"
    cells = [F.concat(F.lit("  "), F.col(c).cast("string"), F.lit(" ")) for c in p.columns]
    head = spark.range(1).select(F.lit("\t".join(p.columns)).alias("value"))
    write_files(head.union(p.select(F.concat_ws("\t\t", *cells).alias("value"))), path, fmt="text")
    back = read_features(spark, path, key="cno", features=FEATURES, fmt="text", keyed=True)
    return back.select("cno", *[_r6(c) for c in FEATURES])


def q_kmeans_centres(spark, sf_dir):
    """Is every centre the mean of its members, feature by feature?"""
    checkpoint_dir(spark)
    p = _profile(spark, sf_dir).checkpoint(eager=True)
    model = clustering.fit_kmeans(p, FEATURES, k=KMEANS_K, max_iter=10 * KMEANS_ITER, seed=SEED)
    centres = clustering.centres_frame(model, FEATURES).withColumnRenamed("cluster", "label")
    labels = clustering.assign(model, p, "cno", FEATURES)
    means = p.join(labels, "cno").groupBy(F.col("label").cast("int").alias("label")).agg(*[F.avg(c).alias(f"m_{c}") for c in FEATURES])
    same = [F.abs(F.col(c) - F.col(f"m_{c}")) < 1e-3 for c in FEATURES]
    # a centre moves by less than the fit's tolerance after its last assignment
    return centres.join(means, "label", "left").select(F.col("label"), *[F.coalesce(s, F.lit(False)).alias(c) for s, c in zip(same, FEATURES, strict=True)])


QUERIES: dict[str, Query] = {
    "ordered_scores": q_ordered_scores,
    "recommend_unseen_by_anyone": q_recommend_unseen_by_anyone,
    "recommend_atan": q_recommend_atan,
    "train_scores_term": q_train_scores_term,
    "itemset_pairs": q_itemset_pairs,
    "rule_summary": q_rule_summary,
    "rule_text": q_rule_text,
    "course_count": q_course_count,
    "read_features": q_read_features,
    "kmeans_centres": q_kmeans_centres,
    "anonymised_sheet": q_anonymised_sheet,
    "recommend_low_threshold": q_recommend_low_threshold,
    "read_pairs": q_read_pairs,
    "read_scores_csv": q_read_scores_csv,
    "read_baskets": q_read_baskets,
    "read_wide_scores": q_read_wide_scores,
    "sink_labels": q_sink_labels,
    "sink_predictions": q_sink_predictions,
    "sink_rules": q_sink_rules,
    "sink_itemsets": q_sink_itemsets,
    "kmeans_check": q_kmeans_check,
    "train_scores": q_train_scores,
    "preview_scores": q_preview_scores,
    "basket_pairs": q_basket_pairs,
    "cooccurrence": q_cooccurrence,
    "cosine": q_cosine,
    "recommend": q_recommend,
    "recommend_scores": q_recommend_scores,
    "recommend_unseen": q_recommend_unseen,
    "seen_items": q_seen_items,
    "frequent_itemsets": q_frequent_itemsets,
    "itemsets_wide": q_itemsets_wide,
    "itemset_summary": q_itemset_summary,
    "association_rules": q_association_rules,
    "rules_wide": q_rules_wide,
    "recommend_from_rules": q_recommend_from_rules,
    "order_itemsets": q_order_itemsets,
    "order_rules": q_order_rules,
    "cosine_boosted": q_cosine_boosted,
    "recommend_boosted": q_recommend_boosted,
    "recommend_boosted_scores": q_recommend_boosted_scores,
    "pair_boost": q_pair_boost,
    "course_profile": q_course_profile,
    "kmeans_assign": q_kmeans_assign,
    "cluster_sizes": q_cluster_sizes,
    "lloyd_tiers": q_lloyd_tiers,
    "forecast_tier": q_forecast_tier,
    "microaggregate": q_microaggregate,
    "microaggregate_wide": q_microaggregate_wide,
    "microaggregate_detail": q_microaggregate_detail,
    "read_write_roundtrip": q_read_write_roundtrip,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
