import pytest

from affinity.operators import baskets, prep
from affinity.plans import jobs
from tests.conftest import HOLDOUT, as_dict


@pytest.fixture(scope="module")
def mined(grades):
    pairs = prep.basket_pairs(grades, HOLDOUT)
    return jobs.mine_rules(pairs, 0.5, 0.65)


def test_itemsets(mined):
    # FIXTURES.md §2.4
    fi, _, _ = mined
    got = {",".join(r["items"]): r["freq"] for r in fi.collect()}
    assert got == {"a": 3, "b": 2, "c": 2, "a,b": 2, "a,c": 2}


def test_rules(mined):
    _, rules, _ = mined
    got = {(",".join(r.antecedent), r.consequent): r.confidence for r in rules.collect()}
    assert got.keys() == {("b", "a"), ("c", "a"), ("a", "b"), ("a", "c")}
    assert got[("b", "a")] == pytest.approx(1.0)
    assert got[("a", "b")] == pytest.approx(2 / 3)
    assert all(0.65 <= v <= 1.0 for v in got.values())


def test_wide_shapes(mined):
    fi, rules, _ = mined
    wide = {tuple(r)[:4] for r in baskets.itemsets_wide(fi).collect()}
    assert ("a", "b", None, None) in wide
    rw = {tuple(r) for r in baskets.rules_wide(rules).collect()}
    assert ("b", None, None, None, "a", 1.0, "b") in rw


def test_wide_shapes_keep_long_sets_apart(spark):
    sets = spark.createDataFrame([(list("abcde"), 2), (list("abcdf"), 3)], "items array<string>, freq long")
    assert {r["items"] for r in baskets.itemsets_wide(sets).collect()} == {"a,b,c,d,e", "a,b,c,d,f"}


def test_duplicate_items_removed_before_fit(spark):
    pairs = spark.createDataFrame([("x", "a"), ("x", "a"), ("x", "b"), ("y", "a")], "sno string, cno string")
    fi, _, _ = jobs.mine_rules(pairs, 0.5, 0.5)
    got = {",".join(r["items"]): r["freq"] for r in fi.collect()}
    assert got == {"a": 2, "b": 1, "a,b": 1}


def test_support_is_anti_monotone(mined):
    fi, _, _ = mined
    freq = {tuple(r["items"]): r["freq"] for r in fi.collect()}
    for items, f in freq.items():
        for i in range(len(items)):
            sub = items[:i] + items[i + 1:]
            if sub:
                assert freq[sub] >= f


def test_boosted_cosine(grades, mined):
    # FIXTURES.md §2.5: sim + 32 · cnt / 11
    fi, _, _ = mined
    sim = jobs.train(prep.train_scores(grades, HOLDOUT), itemsets=fi)
    got = as_dict(sim)
    assert got[("a", "b")] == pytest.approx(6.337056, abs=1e-6)
    assert got[("a", "c")] == pytest.approx(6.661878, abs=1e-6)
    assert got[("c", "b")] == pytest.approx(0.309016, abs=1e-6)


def test_boosted_predictions(grades, mined):
    fi, _, _ = mined
    sim = jobs.train(prep.train_scores(grades, HOLDOUT), itemsets=fi)
    got = {(r.sno, r.cno): r.pre_score
           for r in jobs.predict(prep.preview_scores(grades, HOLDOUT), sim, threshold=None).collect()}
    assert got[("p1", "b")] == pytest.approx(63.370563, abs=1e-6)
    assert got[("p1", "c")] == pytest.approx(66.618777, abs=1e-6)
    assert got[("p2", "a")] == pytest.approx(59.875694, abs=1e-6)


def test_recommend_from_rules(spark, mined):
    _, rules, _ = mined
    pairs = spark.createDataFrame([("q", "b"), ("r", "a"), ("t", "a"), ("t", "b")], "sno string, cno string")
    got = {(r.sno, r.cno) for r in baskets.recommend_from_rules(rules, pairs).collect()}
    # q has b → a; r has a → b, c; t has a,b → c only (a, b already owned)
    assert got == {("q", "a"), ("r", "b"), ("r", "c"), ("t", "c")}


def test_rule_text(mined):
    _, rules, _ = mined
    txt = {r.value for r in baskets.rule_text(rules.where("consequent = 'a'")).collect()}
    assert "[b]-->[a],1.0" in txt


def test_rules_and_itemsets_jobs(spark, grades):
    from affinity.session import scratch_path

    pairs = prep.basket_pairs(grades, HOLDOUT)
    out = scratch_path(spark, "rules")
    wide = jobs.rules_job(pairs, 0.5, 0.65, out_path=out)
    assert wide.count() == 4
    lines = {r.value for r in spark.read.text(out).collect()}
    assert "b\t\t\t\ta\t1.0" in lines
    got = {tuple(r["items"]): r.freq for r in jobs.itemsets_job(pairs, 0.5).collect()}
    assert got[("a", "b")] == 2.0
    assert jobs.itemsets_job(pairs, 0.5, wide=True).columns == ["item1", "item2", "item3", "item4", "items"]


def test_infrequent_items_leave_before_baskets_are_built(spark):
    """Emptied baskets count in the threshold; the longest basket shrinks to the frequent items."""
    rows = [(f"b{i}", "common") for i in range(6)] + [("b0", f"rare{j}") for j in range(200)] + [("b7", "rare1"), ("b8", "rare2"), ("b9", None)]
    pairs = spark.createDataFrame(rows + rows[:3], "sno string, cno string")
    whole = {r.sno: len(r["items"]) for r in baskets.to_baskets(pairs).collect()}
    pruned = {r.sno: r["items"] for r in baskets.to_baskets(pairs, min_support=0.5).collect()}
    assert max(whole.values()) == 201 and max(map(len, pruned.values())) == 1
    assert pruned.keys() == whole.keys() and pruned["b7"] == []
    fi, _, mined = jobs.mine_rules(pairs, 0.5, 0.5)
    assert mined.n == 9  # b0..b5, b7, b8, b9
    assert [(r["items"], r.freq) for r in fi.collect()] == [(["common"], 6)]
    assert jobs.mine_rules(pairs, 0.7, 0.5)[0].collect() == []


def test_rules_equal_the_library(spark):
    """Rules joined from the written itemsets are those of FP-Growth itself."""
    import random

    from pyspark.ml.fpm import FPGrowth

    rnd = random.Random(8)
    rows = sorted({(f"b{i}", f"i{min(9, int(rnd.expovariate(0.35)))}") for i in range(60) for _ in range(6)})
    pairs = spark.createDataFrame(rows, "sno string, cno string")
    _, rules, mined = jobs.mine_rules(pairs, 0.1, 0.4)
    model = FPGrowth(itemsCol="items", minSupport=0.1, minConfidence=0.4).fit(baskets.to_baskets(pairs))
    want = {(tuple(sorted(r.antecedent)), r.consequent[0]): (r.confidence, r.lift, r.support) for r in model.associationRules.collect()}
    got = {(tuple(r.antecedent), r.consequent): (r.confidence, r.lift, r.support) for r in rules.collect()}
    assert len(want) > 20 and got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v)
    assert baskets.frequent_itemsets(mined, size=2).where("size <> 2").count() == 0
    assert {r.size: r.n_rules for r in baskets.rule_summary(rules).collect()} == {
        n: sum(len(a) == n for a, _ in want) for n in {len(a) for a, _ in want}}


def test_rules_meet_baskets_by_their_rarest_item(spark):
    """Same suggestions from far fewer rows than one per basket item and rule."""
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(2)
    rows = sorted({(f"b{i}", "all") for i in range(80)} | {(f"b{i}", f"i{rnd.randint(0, 11)}") for i in range(80) for _ in range(4)})
    pairs = spark.createDataFrame(rows, "sno string, cno string")
    names = ["all", *[f"i{j}" for j in range(12)], "nobody"]
    rules = [(sorted(rnd.sample(names, rnd.randint(1, 3))), rnd.choice(names)) for _ in range(60)]
    rules = [(a, c) for a, c in rules if c not in a]
    df = spark.createDataFrame(rules, "antecedent array<string>, consequent string")
    held = {}
    for b, i in rows:
        held.setdefault(b, set()).add(i)
    want = {(b, c) for b, h in held.items() for a, c in rules if set(a) <= h and c not in h}
    assert {tuple(r) for r in baskets.recommend_from_rules(df, pairs).collect()} == want
    met = baskets.rule_candidates(df, pairs).count()
    every = pairs.join(df.select(F.explode("antecedent").alias("cno")), "cno").count()
    assert met < every / 2


def test_parts_together_give_the_itemsets_of_all_baskets(spark, monkeypatch):
    """Itemsets that only some parts report are counted in the others; parts may lack an item."""
    import random
    from itertools import combinations

    from pyspark.errors import PythonException

    monkeypatch.setattr(baskets, "PART_BASKETS", 16)
    rnd = random.Random(5)
    rows = [sorted({f"i{min(9, int(rnd.expovariate(0.3)))}" for _ in range(rnd.randint(1, 6))}) for _ in range(150)]
    rows += [["z", "y", "x"]] * 30 + [[]] * 5 + [None] * 4  # the last stand together in few partitions
    df = spark.createDataFrame([(r,) for r in rows], "items array<string>").coalesce(1)
    least = 19  # ceil(0.1 * 185)
    want = {}
    for r in filter(None, rows):
        for k in range(1, len(r) + 1):
            for s in combinations(sorted(r), k):
                want[s] = want.get(s, 0) + 1
    want = {s: n for s, n in want.items() if n >= least}
    mined = baskets.mine(df, 0.1)
    got = [(tuple(r["items"]), r.freq) for r in mined.itemsets.collect()]
    assert len(got) == len(want) and dict(got) == want and max(map(len, want)) == 3
    assert mined.n == 189
    assert {tuple(r["items"]): r.freq for r in baskets.mine(df, 0.1, num_partitions=3).itemsets.collect()} == want
    numbers = spark.createDataFrame([([1, 2],), ([2],)], "items array<int>")
    assert {tuple(r["items"]): r.freq for r in baskets.mine(numbers, 0.5).itemsets.collect()} == {(1,): 1, (2,): 2, (1, 2): 1}
    assert baskets.mine(df.limit(0), 0.1).itemsets.collect() == []
    with pytest.raises(PythonException):
        baskets.mine(spark.createDataFrame([(["a", "a"],)], "items array<string>"), 0.1)


def test_baskets_send_their_pairs_once(spark):
    # a join by item would put all baskets' pairs of one item into one task
    rows = [(f"u{i}", item) for i in range(40) for item in ("a", "b", f"r{i}") if item != "b" or i % 2]
    pairs = spark.createDataFrame(rows, "sno string, cno string")
    got = baskets.to_baskets(pairs, min_support=0.3)
    assert {(r.sno, tuple(r["items"])) for r in got.collect()} == {(f"u{i}", ("a", "b") if i % 2 else ("a",)) for i in range(40)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_b" in plan and "hashpartitioning(_i" not in plan


def test_stored_pairs_and_sums_give_what_raw_grades_give(spark):
    rows = [(f"u{i % 7}" if i % 11 else None, f"i{i * i % 5}" if i % 13 else None, 50.0 + i % 15) for i in range(90)]
    train = spark.createDataFrame([*rows, *rows[:9]], "sno string, cno string, score double")
    weights = jobs.summed_weights(train)
    assert weights.count() == weights.select("sno", "cno").distinct().count() < train.count()
    pairs = weights.select("sno", "cno")
    raw, _, _ = jobs.mine_rules(train.select("sno", "cno"), 0.3, 0.5)
    stored, rules, _ = jobs.mine_rules(pairs, 0.3, 0.5, distinct=True)
    assert sorted(map(str, raw.collect())) == sorted(map(str, stored.collect()))
    assert as_dict(jobs.train(weights, itemsets=stored, summed=True)) == as_dict(jobs.train(train, itemsets=raw))
    given = [sorted(map(str, baskets.recommend_from_rules(rules, p, distinct=d).collect())) for p, d in ((train, False), (pairs, True))]
    assert given[0] == given[1]
    # neither the baskets' pairs nor the sums are grouped again
    plan = baskets.to_baskets(pairs, min_support=0.3, distinct=True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_b" in plan and "hashpartitioning(_b#" in plan and plan.count("Exchange hashpartitioning") == 1
