"""Clustering: MLlib k-means on profiles, exact 1-D splits, and 1-D Lloyd iterations.

All 1-D work runs on a value histogram ``(group.., v, n)``, so its cost depends on
distinct values, not rows, and on running sums of n, n·v, n·v², from which the mean and
the squared error of any interval of values follow. Nothing of a group passes through
the driver.

``exact_split`` finds the intervals with the least squared error. It fills the table
"best split of the first j values into q intervals" layer by layer. The best last cut
moves right with j, so the cuts of a few j's bound those between them: each level
tries ``fan`` times the distinct values, not all pairs.

``lloyd_1d`` keeps a group's values (at most GROUP_VALUES) as one sorted array with its
running sums. A round finds the border between neighbouring centres by bisection and
takes the new means from the sums; rounds run inside one expression. Larger groups
(there are at most rows / GROUP_VALUES of them) iterate as Spark aggregates.

Lloyd's rules (fixed, from the reference):
* start: explicit ``init`` list, else equal-width ``lo + (hi-lo)(2i+1)/(2k)``, or
  with ``start="rank"`` the distinct values of rank ``floor((2i+1)m / (2k))`` of m,
  so no cluster is empty at the start when there are k distinct values;
* nearest centre by ``|v - c|``; ties go to the later centre;
* a centre with no members keeps its value;
* a group stops when no centre moves by more than ``epsilon``; the result is
  the last update.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.functions import nearest_index, nearest_index_k
from affinity.operators.ordering import running_sums
from affinity.session import checkpoint_dir, scratch_path

# Fixed tier names from the reference (lowest average first).
TIER_NAMES = {
    3: ["easy", "middle", "hard"],
    5: ["very easy", "easy", "middle", "hard", "very hard"],
}


# ------------------------------------------------------------ MLlib k-means

def fit_kmeans(df: DataFrame, features: list[str], k: int = 4, max_iter: int = 30, seed: int = 7,
               n_init: int = 1) -> KMeansModel:
    """k-means on raw (unscaled) features; ``n_init`` seeds, lowest cost kept."""
    vec = VectorAssembler(inputCols=features, outputCol="_features").transform(df.select(*features))
    vec = vec.select("_features").persist(StorageLevel.MEMORY_AND_DISK)
    best = None
    try:
        for r in range(max(1, n_init)):
            model = KMeans(k=k, maxIter=max_iter, seed=seed + r, featuresCol="_features").fit(vec)
            if best is None or model.summary.trainingCost < best.summary.trainingCost:
                best = model
    finally:
        vec.unpersist()
    return best


def kmeans_labels(df: DataFrame, key: str, features: list[str], k: int = 4, max_iter: int = 30,
                  seed: int = 7, n_init: int = 1, label: str = "label") -> DataFrame:
    """Fit k-means and label every row: ``(key, label)``.

    The input is checkpointed once (fit and assignment both read it).
    """
    checkpoint_dir(df.sparkSession)
    data = df.select(key, *features).checkpoint(eager=True)
    model = fit_kmeans(data, features, k=k, max_iter=max_iter, seed=seed, n_init=n_init)
    return assign(model, data, key, features, label)


def assign(model: KMeansModel, df: DataFrame, key: str, features: list[str],
           label: str = "label") -> DataFrame:
    """``(key, label)`` with the cluster index as a string label."""
    vec = VectorAssembler(inputCols=features, outputCol="_features").transform(df)
    out = model.setFeaturesCol("_features").setPredictionCol("_pred").transform(vec)
    return out.select(key, F.col("_pred").cast("string").alias(label))


def centres_frame(model: KMeansModel, features: list[str]):
    """Model centres as a small DataFrame ``(cluster, f1..fn)``."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rows = [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    schema = T.StructType([T.StructField("cluster", T.IntegerType())]
                          + [T.StructField(f, T.DoubleType()) for f in features])
    return spark.createDataFrame(rows, schema)


def cluster_sizes(assigned: DataFrame, label: str = "label") -> DataFrame:
    return assigned.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------- 1-D Lloyd

GROUP_VALUES = 50_000  # distinct values of a group that one row holds; beyond, rounds are Spark aggregates
ROUNDS = 64  # Lloyd rounds in one expression
FAN = 16  # positions tried between two known ones


def histogram(points: DataFrame, value: str, group_cols: list[str] | tuple = (),
              weight: str | None = None) -> DataFrame:
    """``(group.., v, n)``: distinct values with their multiplicity."""
    w = F.col(weight) if weight else F.lit(1)
    return (points.groupBy(*group_cols, F.col(value).cast("double").alias("v"))
            .agg(F.sum(w).cast("long").alias("n")))


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_split(hist: DataFrame, kmax: int, group_cols: list[str], fan: int = FAN) -> DataFrame:
    """``(group.., k, error, sizes, centres)`` for k = 1 .. kmax (at most the group's distinct
    values): the split of the group's values into k intervals with the least squared error,
    its intervals' row counts and means, ascending.

    ``hist`` is ``(group.., v, n)``, one row per group and value. Ties: the last cut is the
    smallest value whose error (per row, to 9 places) is least, and so on to the left.
    """
    low = hist.groupBy(*group_cols).agg(F.min("v").alias("_low"))
    own = hist.select(*group_cols, "v", F.col("n").cast("double").alias("n"))
    shifted = own.join(low, group_cols).withColumn("x", F.col("v") - F.col("_low"))  # small numbers, small rounding
    sums = running_sums(shifted, group_cols, "v", {"cum_n": F.col("n"), "cum_s": F.col("n") * F.col("x"),
                                                   "cum_q": F.col("n") * F.col("x") * F.col("x")})
    sums = _written(sums.select(*group_cols, "pos", "_low", "cum_n", "cum_s", "cum_q"), "split-sums")
    last = sums.groupBy(*group_cols).agg(F.max("pos").alias("m"))
    values = _written(sums.join(last, group_cols), "split-values")
    m_max = values.agg(F.max("m")).first()[0] or 0
    top = 1  # levels: the coarsest step covers the largest group
    while fan ** top < m_max:
        top += 1

    def mean(n, s):
        return s / n + F.col("_low")

    layer = values.select(*group_cols, "pos", "m", "_low", "cum_n", "cum_s", "cum_q", (F.col("cum_q") - F.col("cum_s") * F.col("cum_s") / F.col("cum_n")).alias("error"),
                          F.array("cum_n").alias("sizes"), F.array(mean(F.col("cum_n"), F.col("cum_s"))).alias("centres"))
    out = [_whole(layer, group_cols, 1)]
    for q in range(2, kmax + 1):
        known = _best_last_cut(values.where((F.col("pos") == F.col("m")) & (F.col("m") >= q)), layer, group_cols, F.lit(q - 1), F.col("pos") - 1)
        for level in range(1, top + 1) if q < kmax else ():
            step, wide = fan ** (top - level), fan ** (top - level + 1)
            j = F.col("pos")
            here = values.where((j % step == 0) & (j % wide != 0) & (j < F.col("m")) & (j >= q))
            here = here.withColumn("_left", j - j % wide).withColumn("_right", F.least(F.col("_left") + wide, F.col("m")))
            for side in ("left", "right"):
                cut = known.select(*group_cols, F.col("pos").alias(f"_{side}"), F.col("cut").alias(f"_{side}_cut"))
                here = here.join(cut, [*group_cols, f"_{side}"], "left")
            found = _best_last_cut(here, layer, group_cols, F.coalesce("_left_cut", F.lit(q - 1)), F.least(j - 1, F.col("_right_cut")))
            known = known.unionByName(found)
        layer = known.drop("cut")
        out.append(_whole(layer, group_cols, q))
    return reduce(DataFrame.unionByName, out)


def _whole(layer: DataFrame, group_cols: list[str], q: int) -> DataFrame:
    return layer.where(F.col("pos") == F.col("m")).select(
        *group_cols, F.lit(q).alias("k"), "error", F.transform("sizes", lambda x: x.cast("long")).alias("sizes"), "centres")


def _best_last_cut(ends: DataFrame, layer: DataFrame, group_cols: list[str], lo, hi) -> DataFrame:
    """For every end (group.., pos) the best position in lo..hi after which the last interval
    starts, with the split of ``layer`` before it."""
    cols = ["pos", "m", "_low", "cum_n", "cum_s", "cum_q"]
    tried = ends.select(*group_cols, *cols, lo.cast("long").alias("_lo"), hi.cast("long").alias("_hi")).where("_lo <= _hi") \
        .withColumn("cut", F.explode(F.sequence("_lo", "_hi")))
    before = layer.select(*group_cols, F.col("pos").alias("cut"), F.col("cum_n").alias("_n"), F.col("cum_s").alias("_s"), F.col("cum_q").alias("_q"),
                          F.col("error").alias("_e"), F.col("sizes").alias("_sizes"), F.col("centres").alias("_centres"))
    n, s, q = F.col("cum_n") - F.col("_n"), F.col("cum_s") - F.col("_s"), F.col("cum_q") - F.col("_q")
    error = F.col("_e") + q - s * s / n
    pick = F.struct(F.round(error / F.col("cum_n"), 9).alias("r"), "cut", error.alias("error"),
                    F.concat("_sizes", F.array(n)).alias("sizes"), F.concat("_centres", F.array(s / n + F.col("_low"))).alias("centres"))
    best = tried.join(before, [*group_cols, "cut"]).groupBy(*group_cols, *cols).agg(F.min(pick).alias("b"))
    return _written(best.select(*group_cols, *cols, "b.error", "b.sizes", "b.centres", "b.cut"), "split-layer")


def lloyd_1d(hist: DataFrame, k: int | str, kmax: int | None = None, group_cols: list[str] | tuple = (),
             init: list[float] | None = None, epsilon: float = 0.001, max_iter: int = 10_000,
             start: str = "width", group_values: int = GROUP_VALUES) -> DataFrame:
    """Converged centres ``(group.., centres array<double>)`` per group.

    ``hist`` is ``(group.., v, n)`` (see :func:`histogram`); ``k`` is a
    number or the name of a per-group column holding it (then ``kmax`` bounds
    it). Missing clusters (``i >= k``) are NULL in the array.
    """
    groups = list(group_cols)
    if kmax is None:
        if not isinstance(k, int):
            raise ValueError("kmax is required when k is a column")
        kmax = k
    if init is not None and isinstance(k, int) and len(init) != k:
        raise ValueError(f"init has {len(init)} centres for k = {k}")
    k_col = F.lit(k) if isinstance(k, int) else F.col(k)
    keys = groups or ["_all"]
    rows = hist.where(F.col("v").isNotNull())
    rows = rows.select(*(groups or [F.lit(0).alias("_all")]), "v", "n", k_col.cast("int").alias("_k"))
    rows = _written(rows, "lloyd-histogram")
    # sizes of the groups: one row per group, never collected
    sized = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
    large = sized.where(F.col("_m") > group_values).select(*keys)
    has_large = not large.isEmpty()
    small = rows.join(large, keys, "left_anti") if has_large else rows
    out = _lloyd_arrays(small, keys, kmax, init, epsilon, max_iter, start, group_values)
    if has_large:
        out = out.unionByName(_lloyd_rounds(rows.join(large, keys, "left_semi"), keys, kmax, init, epsilon, max_iter, start))
    return out.select(*groups, "centres")


def _start(kmax: int, init: list[float] | None, start: str, lo, hi, at_rank):
    """Array of kmax start centres (NULL from k on)."""
    def centre(i: int):
        if init is not None:
            return F.lit(float(init[i])) if i < len(init) else F.lit(None).cast("double")
        if start == "rank":
            return at_rank(i)
        return lo + (hi - lo) * F.lit(2 * i + 1) / (2 * F.col("_k")).cast("double")

    return F.array(*[F.when(F.col("_k") > i, centre(i)) for i in range(kmax)])


def _moving(epsilon: float):
    return lambda old, new: F.exists(F.zip_with(old, new, lambda a, b: F.abs(a - b) > epsilon), lambda x: F.coalesce(x, F.lit(False)))


def _let(value, use):
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _lloyd_arrays(rows: DataFrame, keys: list[str], kmax: int, init, epsilon: float, max_iter: int, start: str,
                  group_values: int) -> DataFrame:
    """Groups of at most ``group_values`` values: one row each, rounds inside an expression."""
    so_far = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.select(*keys, "_k", "v", F.sum(F.col("n").cast("double")).over(so_far).alias("cum_n"), F.sum(F.col("n") * F.col("v")).over(so_far).alias("cum_s"))
    one = sums.groupBy(*keys).agg(F.max("_k").alias("_k"), F.array_sort(F.collect_list(F.struct("v", "cum_n", "cum_s"))).alias("h"))
    one = one.select(*keys, "_k", F.col("h.v").alias("v"), F.concat(F.array(F.lit(0.0)), "h.cum_n").alias("cum_n"),
                     F.concat(F.array(F.lit(0.0)), "h.cum_s").alias("cum_s"))
    v, m = F.col("v"), F.size("v")
    first = _start(kmax, init, start, F.get(v, 0), F.get(v, m - 1),
                   lambda i: F.get(v, F.floor(F.lit(2 * i + 1) * m / (2 * F.col("_k"))).cast("int")))
    state = _written(one.withColumn("c", first).withColumn("moved", F.lit(True)), "lloyd")
    bits = F.sequence(F.lit(1), F.lit(max(1, group_values.bit_length())))

    def border(a, b):
        """Values before the first one that goes to the right one of two neighbouring centres."""
        def goes_right(x):
            left, right = F.abs(x - a["c"]), F.abs(x - b["c"])
            return (left > right) | ((left == right) & (b["i"] > a["i"]))

        def halve(s, _):
            mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
            right = goes_right(F.get(v, mid))
            return F.when(s["lo"] >= s["hi"], s).otherwise(F.struct(
                F.when(right, s["lo"]).otherwise(mid + 1).alias("lo"), F.when(right, mid).otherwise(s["hi"]).alias("hi")))

        return F.aggregate(bits, F.struct(F.lit(0).alias("lo"), m.alias("hi")), halve, lambda s: s["lo"])

    def round_(c):
        every = F.array_sort(F.filter(F.transform(c, lambda x, i: F.struct(x.alias("c"), i.alias("i"))), lambda x: x["c"].isNotNull()))

        def of(order):
            last = F.size(order) - 1
            borders = F.concat(F.array(F.lit(0)), F.transform(F.slice(order, 2, F.greatest(last, F.lit(0))),
                                                              lambda b, p: border(F.get(order, p), b)), F.array(m))

            def means(at):
                new = F.transform(order, lambda x, p: F.struct(
                    x["i"].alias("i"),
                    F.try_divide(F.get(F.col("cum_s"), F.get(at, p + 1)) - F.get(F.col("cum_s"), F.get(at, p)),
                                 F.get(F.col("cum_n"), F.get(at, p + 1)) - F.get(F.col("cum_n"), F.get(at, p))).alias("mean")))
                return _let(new, lambda ms: F.transform(c, lambda old, i: F.coalesce(
                    F.get(F.filter(ms, lambda y: y["i"] == i), 0)["mean"], old)))

            return _let(borders, means)

        # of equal centres the last one takes the values
        return _let(every, lambda e: _let(F.filter(e, lambda x, p: (p == F.size(e) - 1) | (F.get(e, p + 1)["c"] != x["c"])), of))

    moving = _moving(epsilon)
    advance = F.aggregate(F.sequence(F.lit(1), F.lit(min(ROUNDS, max_iter))), F.struct("c", "moved"), lambda s, _: F.when(
        s["moved"], _let(round_(s["c"]), lambda new: F.struct(new.alias("c"), moving(s["c"], new).alias("moved")))).otherwise(s))
    done = []
    for _ in range(-(-max_iter // ROUNDS)):
        state = _written(state.withColumn("s", advance).select(*keys, "_k", "v", "cum_n", "cum_s", "s.c", "s.moved"), "lloyd")
        done.append(state.where(~F.col("moved")).select(*keys, F.col("c").alias("centres")))
        state = state.where("moved")
        if state.isEmpty():
            return reduce(DataFrame.unionByName, done)
    raise RuntimeError(f"lloyd_1d: groups still move after {max_iter} iterations")


def _lloyd_rounds(rows: DataFrame, keys: list[str], kmax: int, init, epsilon: float, max_iter: int, start: str) -> DataFrame:
    """Groups of many values: every round one aggregate with map-side sums."""
    rows = _written(rows, "lloyd-large")
    if start == "rank" and init is None:
        placed = running_sums(rows, keys, "v", {})
        size = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
        at = placed.join(size, keys)
        ranked = at.groupBy(*keys).agg(F.max("_k").alias("_k"), *[
            F.max(F.when(F.col("pos") - 1 == F.floor(F.lit(2 * i + 1) * F.col("_m") / (2 * F.col("_k"))), F.col("v"))).alias(f"_s{i}")
            for i in range(kmax)])
        begin = ranked.select(*keys, _start(kmax, init, start, None, None, lambda i: F.col(f"_s{i}")).alias("c"))
    else:
        ends = rows.groupBy(*keys).agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"), F.max("_k").alias("_k"))
        begin = ends.select(*keys, _start(kmax, init, start, F.col("_lo"), F.col("_hi"), None).alias("c"))
    state, done, moving = _written(begin, "lloyd-centres"), [], _moving(epsilon)
    for _ in range(max_iter):
        near = rows.join(state, keys).withColumn("_i", nearest_index_k("v", "c", kmax))
        means = near.groupBy(*keys, "_i").agg((F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("_mean"))
        by_group = means.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_i", "_mean"))).alias("_means"))
        new = state.join(by_group, keys).withColumn("_new", F.transform("c", lambda x, i: F.coalesce(F.try_element_at("_means", i), x)))
        state = _written(new.select(*keys, F.col("_new").alias("c"), moving(F.col("c"), F.col("_new")).alias("_moved")), "lloyd-centres")
        done.append(state.where(~F.col("_moved")).select(*keys, F.col("c").alias("centres")))
        state = state.where("_moved").drop("_moved")
        if state.isEmpty():
            return reduce(DataFrame.unionByName, done)
    raise RuntimeError(f"lloyd_1d: groups still move after {max_iter} iterations")


def _literal_array(values: list[float | None]):
    return F.array(*[F.lit(v).cast("double") for v in values])


def assign_nearest(df: DataFrame, value: str, centres: DataFrame, group_cols: list[str] | tuple = (),
                   out_index: str = "cluster", out_center: str = "center", kmax: int | None = None) -> DataFrame:
    """Attach the nearest centre (and its index) to every row.

    ``centres`` has one row per group; how it is joined is left to its measured size.
    """
    group_cols = list(group_cols)
    if group_cols:
        j = df.join(centres, group_cols)
    else:
        # One group: k numbers, inlined as a literal array (no join at all).
        row = centres.select("centres").first()
        only = row["centres"] if row is not None else [None]
        j = df.withColumn("centres", _literal_array(only))
        kmax = len(only)
    v = F.col(value).cast("double")
    idx = nearest_index_k(v, "centres", kmax) if kmax else nearest_index(v, "centres")
    return (j.withColumn(out_index, idx)
            .withColumn(out_center, F.get(F.col("centres"), F.col(out_index)))
            .drop("centres"))


def tier_labels(centres: DataFrame, group_cols: list[str] | tuple = (), descending: bool = False) -> DataFrame:
    """``(group.., cluster, center, tier_rank, tier)`` — centres ranked ascending
    (``descending=True`` makes the highest average the first tier); names for
    k = 3 and k = 5, NULL otherwise."""
    group_cols = list(group_cols)
    ex = centres.select(*group_cols, F.posexplode("centres").alias("cluster", "center")).where(
        F.col("center").isNotNull())
    order = F.col("center").desc() if descending else F.col("center").asc()
    w = Window.partitionBy(*group_cols).orderBy(order, F.col("cluster").asc())
    kk = F.count(F.lit(1)).over(Window.partitionBy(*group_cols))
    ranked = ex.withColumn("tier_rank", F.row_number().over(w) - 1).withColumn("_k", kk)
    name = F.lit(None).cast("string")
    for kv, names in TIER_NAMES.items():
        arr = F.array(*[F.lit(s) for s in names])
        name = F.when(F.col("_k") == kv, F.get(arr, F.col("tier_rank"))).otherwise(name)
    return ranked.withColumn("tier", name).drop("_k")


def forecast_tier(train_points: DataFrame, new_points: DataFrame, value: str = "avg", key: str = "cno",
                  k: int = 3, epsilon: float = 0.001, init: list[float] | None = None) -> DataFrame:
    """Tier of items: Lloyd on ``train_points[value]``, then the nearest centre
    for every row of ``new_points`` (pass the same DataFrame to label the
    training items themselves)."""
    checkpoint_dir(train_points.sparkSession)
    same = new_points is train_points
    train_points = train_points.select(key, value).checkpoint(eager=True)
    new_points = train_points if same else new_points
    cent = lloyd_1d(histogram(train_points, value), k, epsilon=epsilon, init=init)
    tiers = tier_labels(cent)
    asg = assign_nearest(new_points.select(key, value), value, cent)
    # one row per tier (k rows)
    return asg.join(F.broadcast(tiers.select("cluster", "tier_rank", "tier")), "cluster")
