import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from affinity.operators import prep, similarity
from affinity.plans import jobs
from tests.conftest import HOLDOUT, as_dict


def test_cooccurrence_worked_example(spark):
    # FIXTURES.md §2.1
    rows = [("A", "a"), ("A", "b"), ("B", "a"), ("B", "c"), ("C", "a"), ("C", "b"), ("C", "c")]
    df = spark.createDataFrame(rows, "sno string, cno string")
    got = as_dict(similarity.cooccurrence(df))
    assert len(got) == 6
    for (x, y), v in {("a", "b"): 0.816497, ("a", "c"): 0.816497, ("b", "c"): 0.5}.items():
        assert got[(x, y)] == pytest.approx(v, abs=1e-6)
        assert got[(y, x)] == pytest.approx(v, abs=1e-6)


def test_train_and_preview_selection(grades):
    tr = prep.train_scores(grades, HOLDOUT)
    pv = prep.preview_scores(grades, HOLDOUT)
    assert sorted((r.sno, r.cno) for r in tr.collect()) == [
        ("s1", "a"), ("s1", "b"), ("s2", "a"), ("s2", "c"), ("s3", "a"), ("s3", "b"), ("s3", "c")]
    assert sorted((r.sno, r.cno) for r in pv.collect()) == [("p1", "a"), ("p2", "b"), ("p2", "c")]


def test_term_filter(spark):
    rows = [("u", "a", 50.0, "2016秋", "2015级"), ("u", "b", 50.0, "2017春", "2015级")]
    df = spark.createDataFrame(rows, "sno string, cno string, score double, term string, cohort string")
    got = prep.train_scores(df, HOLDOUT, term="2016秋").collect()
    assert [(r.sno, r.cno) for r in got] == [("u", "a")]


def test_cosine_train(grades):
    # FIXTURES.md §2.3
    sim = jobs.train(prep.train_scores(grades, HOLDOUT))
    got = as_dict(sim)
    for (x, y), v in {("a", "b"): 0.518875, ("a", "c"): 0.843696, ("b", "c"): 0.309016}.items():
        assert got[(x, y)] == pytest.approx(v, abs=1e-6)
        assert got[(y, x)] == pytest.approx(v, abs=1e-6)
    assert not any(x == y for x, y in got)


def test_salted_self_join_matches_plain(grades):
    w = prep.with_deficit(prep.train_scores(grades, HOLDOUT), 70.0)
    plain = as_dict(similarity.cosine(w, blocks=1))
    salted = as_dict(similarity.cosine(w, blocks=4, heavy_items=0))
    assert plain.keys() == salted.keys()
    for k in plain:
        assert salted[k] == pytest.approx(plain[k], rel=1e-12)


def test_duplicates_multiply_like_raw_self_join(spark):
    # A retake (same user, item twice) counts like the reference's raw self-join.
    rows = [("u", "a", 1.0), ("u", "a", 2.0), ("u", "b", 1.0), ("v", "a", 1.0), ("v", "b", 3.0)]
    df = spark.createDataFrame(rows, "sno string, cno string, weight double")
    got = as_dict(similarity.cosine(df))
    a = np.array([3.0, 1.0])
    b = np.array([1.0, 3.0])
    assert got[("a", "b")] == pytest.approx(a @ b / np.sqrt((a @ a) * (b @ b)))


def test_boost_by_pairs_sums_duplicates(spark):
    sim = spark.createDataFrame([("a", "b", 0.5), ("b", "a", 0.5), ("a", "c", 0.1)],
                                "item1 string, item2 string, sim double")
    pairs = spark.createDataFrame([("b", "a", 1.0), ("a", "b", 2.0)], "a string, b string, value double")
    got = as_dict(similarity.boost_by_pairs(sim, pairs))
    assert got[("a", "b")] == pytest.approx(3.5)
    assert got[("b", "a")] == pytest.approx(3.5)
    assert got[("a", "c")] == pytest.approx(0.1)


triples = st.lists(st.tuples(st.sampled_from("uvwxyz"), st.sampled_from("abcdefg"),
                             st.integers(min_value=1, max_value=9)), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(triples)
def test_cosine_matches_brute_force(spark, rows):
    df = spark.createDataFrame([(u, i, float(w)) for u, i, w in rows], "sno string, cno string, weight double")
    got = as_dict(similarity.cosine(df, blocks=3, heavy_items=2))
    users = sorted({u for u, _, _ in rows})
    items = sorted({i for _, i, _ in rows})
    m = np.zeros((len(users), len(items)))
    for u, i, w in rows:
        m[users.index(u), items.index(i)] += w
    want = {}
    for x in range(len(items)):
        for y in range(len(items)):
            if x != y and (m[:, x] * m[:, y]).sum() > 0:
                want[(items[x], items[y])] = m[:, x] @ m[:, y] / np.sqrt((m[:, x] @ m[:, x]) * (m[:, y] @ m[:, y]))
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-9)
        assert got[k] == pytest.approx(got[(k[1], k[0])])
        assert -1e-12 <= got[k] <= 1 + 1e-12


def test_heavy_user_paths_agree(spark, monkeypatch):
    # one user holds a third of the rows and most items; light users elsewhere
    rows = [("hot", f"i{j}", float(1 + j % 5)) for j in range(60)]
    rows += [(f"u{k}", f"i{(k * 7 + j) % 60}", float(1 + (k + j) % 4)) for k in range(40) for j in range(3)]
    df = spark.createDataFrame(rows, "sno string, cno string, weight double")
    plain = as_dict(similarity.cosine(df, blocks=1))
    broadcast_heavy = as_dict(similarity.cosine(df, blocks=4, heavy_items=30))
    monkeypatch.setattr(similarity, "HEAVY_BROADCAST_LIMIT", 0)  # force the shuffle-join path
    shuffled_heavy = as_dict(similarity.cosine(df, blocks=4, heavy_items=30))
    assert plain.keys() == broadcast_heavy.keys() == shuffled_heavy.keys()
    for k, v in plain.items():
        assert broadcast_heavy[k] == pytest.approx(v, rel=1e-12)
        assert shuffled_heavy[k] == pytest.approx(v, rel=1e-12)


def test_blocks_follow_the_degree(spark):
    """One user of 100 times heavy_items: equal results, and no task cell grows with the degree."""
    from pyspark.sql import functions as F

    heavy = 20
    rows = [("hot", f"i{j}", float(1 + j % 5)) for j in range(100 * heavy)] + [(f"u{k}", f"i{k % 50}", 2.0) for k in range(200)]
    df = spark.createDataFrame(rows, "sno string, cno string, weight double")
    a = df.select("sno", F.col("cno").alias("item"), F.col("weight").alias("v"), F.lit(1.0).alias("n"))
    x, y, keys = similarity.pair_sides(a, "sno", heavy)
    assert keys == ["sno", "_bx", "_by"]
    cells = x.groupBy(*keys).count().join(y.groupBy(*keys).agg(F.count("*").alias("c2")), keys).select((F.col("count") * F.col("c2")).alias("p"))
    largest, total = cells.agg(F.max("p"), F.sum("p")).first()
    assert largest <= 5 * heavy * heavy and total >= (100 * heavy) ** 2
    # half the pairs as sums: the aggregate of blocked and plain joins agrees
    def totals(**kw):
        return similarity.cosine(df, **kw).agg(F.count("*"), F.round(F.sum("sim"), 3)).first()

    assert totals(heavy_items=heavy) == totals(blocks=1)


def test_the_pair_table_is_not_joined(spark, grades):
    """Norms travel with the pairs: the only join is the self-join of the rows."""
    w = prep.with_deficit(prep.train_scores(grades, HOLDOUT), 70.0)
    plan = similarity.cosine(w)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Aggregate")]
    assert "Join" not in above


def test_tasks_follow_the_pairs(spark, monkeypatch):
    """The self-join has as many tasks as its pairs ask for, with and without blocks, and the same rows."""
    from pyspark.sql import functions as F

    rows = [(f"u{u}", f"i{i}", float(1 + (u * i) % 7)) for u in range(20) for i in range(u % 6, 12)]
    df = spark.createDataFrame(rows, "sno string, cno string, weight double")
    want = as_dict(similarity.cosine(df))
    a = df.select("sno", F.col("cno").alias("item"), F.col("weight").alias("v"), F.lit(1.0).alias("n")).checkpoint()
    monkeypatch.setattr(similarity, "PAIRS_A_TASK", 100)
    n_pairs = sum(d * (d - 1) // 2 for d in (12 - u % 6 for u in range(20)))
    for heavy in (2000, 10):
        x, y, _ = similarity.pair_sides(a, "sno", heavy)
        assert x.rdd.getNumPartitions() == y.rdd.getNumPartitions() == -(-n_pairs // 100) > 1
    assert as_dict(similarity.cosine(df)) == as_dict(similarity.cosine(df, heavy_items=10)) == want


def test_cosine_towards_some_items(spark):
    rows = [(f"u{u}", f"i{i}", float(1 + (u * i) % 7)) for u in range(9) for i in range(u % 4, 8)]
    df = spark.createDataFrame(rows, "sno string, cno string, weight double")
    some = spark.createDataFrame([("i2",), ("i5",), ("i5",), ("other",), (None,)], "cno string")
    want = {k: v for k, v in as_dict(similarity.cosine(df)).items() if k[1] in ("i2", "i5")}
    got = similarity.cosine(df, towards=some)
    assert got.count() == len(want) == 14 and as_dict(got) == want
    assert similarity.cosine(df, towards=some.limit(0)).count() == 0
