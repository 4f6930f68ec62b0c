import pytest

from affinity.operators import anonymize, clustering, profile

PROFILE_ROWS = [("m1", 90.0), ("m1", 0.0), ("m1", 60.0), ("m2", 80.0), ("m2", 90.0), ("m3", 70.0),
                ("m3", -1.0), ("m4", 95.0), ("m5 ", 60.0), ("m5", 62.0)]


@pytest.fixture(scope="module")
def prof(spark):
    df = spark.createDataFrame(PROFILE_ROWS, "cno string, score double")
    return profile.course_profile(df).cache()


def test_course_profile(prof):
    # FIXTURES.md §2.8
    got = {r.cno: (r.avg, r["pass"], r.good, r.great) for r in prof.collect()}
    want = {"m1": (50, 2 / 3, 1 / 3, 1 / 3), "m2": (85, 1, 1, 0.5), "m3": (35, 0.5, 0, 0),
            "m4": (95, 1, 1, 1), "m5": (61, 1, 0, 0)}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v)


def test_lloyd_tiers_and_forecast(spark, prof):
    cent = clustering.lloyd_1d(clustering.histogram(prof, "avg"), 3, init=[50.0, 61.0, 95.0], epsilon=0.001)
    cs = cent.first()["centres"]
    assert cs == pytest.approx([42.5, 61.0, 90.0])
    tiers = {r.tier: r.center for r in clustering.tier_labels(cent).collect()}
    assert tiers == pytest.approx({"easy": 42.5, "middle": 61.0, "hard": 90.0})
    new = spark.createDataFrame([("new", 90.0), ("new", 78.0), ("new", 89.0)], "cno string, score double")
    fc = clustering.forecast_tier(prof, profile.course_profile(new), init=[50.0, 61.0, 95.0])
    row = fc.first()
    assert row.tier == "hard" and row.center == pytest.approx(90.0)


def test_lloyd_equal_width_start_and_ties(spark):
    pts = spark.createDataFrame([(0.0,), (10.0,)], "avg double")
    cent = clustering.lloyd_1d(clustering.histogram(pts, "avg"), 3)
    # start 1.667, 5, 8.333; the middle centre stays empty and keeps its value
    assert cent.first()["centres"] == pytest.approx([0.0, 5.0, 10.0])
    one = spark.createDataFrame([(5.0,)], "avg double")
    asg = clustering.assign_nearest(one, "avg", cent).first()
    assert asg.cluster == 1


def test_descending_tiers(spark):
    cent = spark.createDataFrame([([1.0, 3.0, 2.0],)], "centres array<double>")
    t = {r.cluster: r.tier for r in clustering.tier_labels(cent, descending=True).collect()}
    assert t == {1: "easy", 2: "middle", 0: "hard"}


def test_kmeans_fit_assign(spark, prof):
    feats = ["avg", "pass", "good", "great"]
    model = clustering.fit_kmeans(prof, feats, k=2, seed=3, n_init=2)
    lab = clustering.assign(model, prof, "cno", feats)
    assert lab.count() == 5
    assert {r.label for r in lab.collect()} <= {"0", "1"}
    assert clustering.cluster_sizes(lab).agg({"n": "sum"}).first()[0] == 5


def test_microaggregation_fixture(spark):
    # FIXTURES.md §2.7
    vals = [40, 55, 58, 59, 62, 71, 72, 78, 79, 95, 96, 100]
    cells = spark.createDataFrame([(str(i + 1), "x", float(v)) for i, v in enumerate(vals)],
                                  "id string, attr string, value double")
    out = {r.value: r for r in anonymize.microaggregate(cells).collect()}
    want = {40: 53.0, 55: 53.0, 58: 53.0, 59: 53.0, 62: 62.0, 71: 71.5, 72: 71.5, 78: 78.5, 79: 78.5,
            95: 95.5, 96: 95.5, 100: 95.5}
    for v, c in want.items():
        assert out[float(v)].center == pytest.approx(c), v
    assert out[62.0].cluster_size == 1 and out[62.0].k == 1
    assert out[71.0].k == 2 and out[71.0].cluster_size == 2
    sup = {r.value: r.center for r in anonymize.microaggregate(cells, suppress=True).collect()}
    assert sup[62.0] is None and sup[71.0] == pytest.approx(71.5)


def test_microaggregation_preserves_band_means(spark):
    import random

    rnd = random.Random(5)
    cells = spark.createDataFrame([(str(i), "x", float(rnd.randint(40, 99))) for i in range(300)],
                                  "id string, attr string, value double")
    rows = anonymize.microaggregate(cells).collect()
    by_band = {}
    for r in rows:
        by_band.setdefault(r.band, []).append(r)
    for b, rs in by_band.items():
        mean_v = sum(r.value for r in rs) / len(rs)
        mean_c = sum(r.center for r in rs) / len(rs)
        assert mean_c == pytest.approx(mean_v, abs=1e-9)
        assert all(r.cluster_size >= 2 for r in rs) or len(rs) == 1


def test_wide_long_roundtrip(spark):
    wide = spark.createDataFrame([("1", 50.0, 91.0), ("2", None, 70.0)], "id string, m1 double, m2 double")
    long = anonymize.to_long(wide)
    assert long.count() == 3
    back = anonymize.to_wide(long, attrs=["m1", "m2"]).orderBy("id").collect()
    assert back[1].m1 is None and back[1].m2 == 70.0


def test_format_sheet(spark):
    wide = spark.createDataFrame([("1", 53.0, 71.5)], "id string, m1 double, `m#2` double")
    line = anonymize.format_sheet(wide, ["m1", "m#2"]).first().value
    assert line == "53.000\t71.500\t"
    gap = spark.createDataFrame([("2", None, 60.0)], wide.schema)
    assert anonymize.format_sheet(gap, ["m1", "m#2"]).first().value == "\t60.000\t"


def test_empty_training_gives_null_clusters(spark):
    empty = spark.createDataFrame([], "cno string, avg double")
    pts = spark.createDataFrame([("x", 1.0)], "cno string, avg double")
    cent = clustering.lloyd_1d(clustering.histogram(empty, "avg"), 3)
    assert cent.count() == 0
    row = clustering.assign_nearest(pts, "avg", cent).first()
    assert row.cluster is None and row.center is None


def test_kmeans_centres_are_member_means(spark):
    import random

    rnd = random.Random(11)
    pts = [(f"c{i}", float(rnd.choice([10, 50, 90]) + rnd.random()), float(rnd.random()))
           for i in range(60)]
    df = spark.createDataFrame(pts, "cno string, avg double, pass double")
    feats = ["avg", "pass"]
    model = clustering.fit_kmeans(df, feats, k=3, max_iter=50, seed=2)
    lab = {r.cno: int(r.label) for r in clustering.assign(model, df, "cno", feats).collect()}
    centres = model.clusterCenters()
    for c in range(3):
        members = [p for p in pts if lab[p[0]] == c]
        assert members
        for d in range(2):
            assert centres[c][d] == pytest.approx(sum(m[d + 1] for m in members) / len(members), abs=1e-6)


def test_kmeans_job_writes_labels(spark, prof):
    from affinity.plans import jobs
    from affinity.session import scratch_path

    out = scratch_path(spark, "labels")
    lab = jobs.kmeans_job(prof.select("cno", "avg", "pass", "good", "great"), k=2, out_path=out)
    assert lab.count() == 5
    assert spark.read.parquet(out).columns == ["cno", "label"]


def test_band_uses_raw_value(spark):
    cells = spark.createDataFrame([("1", "x", 59.9996), ("2", "x", 60.0004)], "id string, attr string, value double")
    got = {r.id: r.band for r in anonymize.microaggregate(cells).collect()}
    assert got == {"1": 0, "2": 1}


def test_lloyd_takes_any_number_of_groups(spark):
    """120,000 groups: centres stay in the table, none in the driver."""
    from pyspark.sql import functions as F

    pts = spark.range(120_000).select(F.col("id").alias("g"), F.explode(F.array(*[F.lit(x) for x in (0.0, 1.0, 9.0, 10.0)])).alias("v"))
    cent = clustering.lloyd_1d(clustering.histogram(pts, "v", ["g"]), 2, group_cols=["g"])
    assert cent.count() == 120_000
    assert [tuple(r.centres) for r in cent.select("centres").distinct().collect()] == [(0.5, 9.5)]


def plain_lloyd(hist, k, epsilon, init=None, start="width"):
    """Lloyd's rules over (v, n) rows in plain Python."""
    hist = sorted(hist)
    lo, hi, m = hist[0][0], hist[-1][0], len(hist)
    c = init or [lo + (hi - lo) * (2 * i + 1) / (2 * k) if start == "width" else hist[(2 * i + 1) * m // (2 * k)][0] for i in range(k)]
    while True:
        sums = [[0.0, 0] for _ in c]
        for v, n in hist:
            i = max(range(k), key=lambda i: (-abs(v - c[i]), i))
            sums[i][0] += n * v
            sums[i][1] += n
        new = [s / n if n else old for (s, n), old in zip(sums, c)]
        if all(abs(a - b) <= epsilon for a, b in zip(new, c)):
            return new
        c = new


@pytest.mark.parametrize("group_values", [50_000, 10])
@pytest.mark.parametrize("start,init", [("width", None), ("rank", None), ("width", [30.0, 30.0, 5.0])])
def test_lloyd_equals_plain_python(spark, group_values, start, init):
    """Groups held in one row and groups in Spark rounds follow the same rules."""
    import random

    rnd = random.Random(4)
    rows = [(g, float(rnd.choice([rnd.randint(0, 12), rnd.randint(0, 90)])), rnd.randint(1, 4)) for g in "abcd" for _ in range({"a": 3, "b": 9}.get(g, 60))]
    hist = {}
    for g, v, n in rows:
        hist.setdefault(g, {}).setdefault(v, 0)
        hist[g][v] += n
    df = clustering.histogram(spark.createDataFrame(rows, "g string, v double, n int"), "v", ["g"], weight="n")
    got = {r.g: r.centres for r in clustering.lloyd_1d(df, 3, group_cols=["g"], start=start, init=init, group_values=group_values).collect()}
    assert got.keys() == hist.keys()
    for g, h in hist.items():
        assert got[g] == pytest.approx(plain_lloyd(list(h.items()), 3, 0.001, init, start), abs=1e-9), g


def test_lloyd_k_per_group(spark):
    from pyspark.sql import functions as F

    pts = spark.createDataFrame([(v, 1) for v in (0.0, 2.0, 10.0, 12.0)], "v double, n int").withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    got = {r.k: r.centres for r in clustering.lloyd_1d(pts, "k", kmax=3, group_cols=["k"]).collect()}
    assert got == {1: [6.0, None, None], 2: [1.0, 11.0, None]}


def best_split(values, k):
    """Least squared error over all ways to cut the sorted distinct values."""
    from itertools import combinations

    hist = sorted(values.items())
    best = None
    for cuts in combinations(range(1, len(hist)), k - 1):
        parts = [hist[a:b] for a, b in zip((0, *cuts), (*cuts, len(hist)))]
        means = [sum(v * n for v, n in p) / sum(n for _, n in p) for p in parts]
        error = sum(n * (v - c) ** 2 for p, c in zip(parts, means) for v, n in p)
        if best is None or error < best[0] - 1e-9:
            best = error, [sum(n for _, n in p) for p in parts], means
    return best


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_exact_split_equals_all_cuts(spark, fan):
    import random

    rnd = random.Random(fan)
    rows = [(g, round(rnd.gauss(70, 8) if g < "c" else rnd.choice([1, 2, 40, 41, 90]) + rnd.random(), 2), rnd.randint(1, 5))
            for g in "abcde" for _ in range({"a": 2, "b": 1, "c": 17}.get(g, 40))]
    hist = {}
    for g, v, n in rows:
        hist.setdefault(g, {}).setdefault(v, 0)
        hist[g][v] += n
    df = clustering.histogram(spark.createDataFrame(rows, "g string, v double, n int"), "v", ["g"], weight="n")
    got = {(r.g, r.k): r for r in clustering.exact_split(df, 4, ["g"], fan=fan).collect()}
    assert set(got) == {(g, k) for g, h in hist.items() for k in range(1, min(4, len(h)) + 1)}
    for (g, k), r in got.items():
        error, sizes, means = best_split(hist[g], k)
        assert r.error == pytest.approx(error, abs=1e-6)
        assert r.sizes == sizes and r.centres == pytest.approx(means)


def test_exact_split_beats_lloyd(spark):
    """Lloyd from ranks stays in a worse split here; the exact one does not."""
    values = [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 30.0, 50.0]
    df = clustering.histogram(spark.createDataFrame([("g", v) for v in values], "g string, v double"), "v", ["g"])

    def error(centres):
        return sum(min((v - c) ** 2 for c in centres) for v in values)

    lloyd = clustering.lloyd_1d(df, 3, group_cols=["g"], start="rank", epsilon=1e-9).first().centres
    exact = clustering.exact_split(df, 3, ["g"]).where("k = 3").first().centres
    assert error(exact) == pytest.approx(best_split({v: 1 for v in values}, 3)[0])
    assert error(exact) < error(lloyd) - 1


def test_exact_split_of_nothing(spark):
    none = spark.createDataFrame([], "g string, v double, n long")
    assert clustering.exact_split(none, 3, ["g"]).collect() == []


def test_running_sums_across_ranges(spark):
    from pyspark.sql import functions as F

    from affinity.operators.ordering import running_sums

    rows = [(g, i, i % 5) for g in ("hot", "b", None) for i in range(300 if g == "hot" else 7)]
    df = spark.createDataFrame(rows, "g string, v int, n int").repartition(4)
    got = running_sums(df, ["g"], "v", {"total": F.col("n")}, partitions=9)
    want = sorted(((g, v, n, v + 1, sum(x % 5 for x in range(v + 1))) for g, v, n in rows), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_nearest_index_forms_agree(spark):
    from affinity.functions import nearest_index, nearest_index_k

    rows = [(v, c) for v in (0.0, 1.0, 2.0, 2.5, 3.0, 5.0, None)
            for c in ([1.0, 2.0, 3.0], [2.0, 2.0, None], [None, None, None], [3.0, 1.0, 2.0], [1.0, 4.0, None])]
    df = spark.createDataFrame(rows, "v double, c array<double>")
    got = df.select(nearest_index("v", "c").alias("a"), nearest_index_k("v", "c", 3).alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_microaggregation_uses_the_largest_feasible_k(spark):
    rows = [(str(i), "x", v) for i, v in enumerate([60.0] * 3 + [61.0] * 3 + [69.0] * 3)]
    got = anonymize.microaggregate(spark.createDataFrame(rows, "id string, attr string, value double")).collect()
    assert {r.k for r in got} == {3} and {r.center for r in got} == {60.0, 61.0, 69.0}


def test_microaggregation_rounds_centres_only(spark):
    rows = [(str(i), "x", v) for i, v in enumerate([70.0004, 70.0004, 70.0014])]
    got = anonymize.microaggregate(spark.createDataFrame(rows, "id string, attr string, value double")).collect()
    assert {round(r.center, 3) for r in got} == {70.001} and {r.value for r in got} == {70.0004, 70.0014}


def test_lloyd_refuses_a_wrong_start_and_unfinished_work(spark):
    hist = clustering.histogram(spark.createDataFrame([(float(i * i),) for i in range(30)], "v double"), "v")
    with pytest.raises(ValueError):
        clustering.lloyd_1d(hist, 3, init=[1.0, 2.0])
    with pytest.raises(RuntimeError):
        clustering.lloyd_1d(hist, 3, max_iter=1, epsilon=0.0)
