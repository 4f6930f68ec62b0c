import os

import pytest

from affinity.session import scratch_path
from affinity.sinks import write_files, write_predictions
from affinity.sources import (
    read_baskets,
    read_features,
    read_pairs,
    read_ratings,
    read_scores,
    read_wide_scores,
)


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_text_readers(spark):
    base = scratch_path(spark, "io").replace("file:", "")
    _write(f"{base}/pairs.tsv", "b1\ta\nb1\tb\nb2\ta\nbroken\n")
    _write(f"{base}/ratings.txt", "u1::a::3.5\nu2::b::x\nu3::c::4\n")
    _write(f"{base}/wide.tsv", "ID\tm1\tm2\n1\t50\t91\n2\t\t70\n")
    _write(f"{base}/baskets.txt", "a b a\n\nc  d\n")
    _write(f"{base}/feat.txt", "ID\tf1\tf2\n 1.0\t\t2.0 \n3\t4\n")
    _write(f"{base}/course.csv", "x,m1,90\nx, m1 ,0\nx,m2,bad\n")
    assert sorted(tuple(r) for r in read_pairs(spark, f"{base}/pairs.tsv").collect()) == [
        ("b1", "a"), ("b1", "b"), ("b2", "a")]
    rt = {r.sno: r.score for r in read_ratings(spark, f"{base}/ratings.txt", sep="::").collect()}
    assert rt == {"u1": 3.5, "u3": 4.0}
    wide = read_wide_scores(spark, f"{base}/wide.tsv").orderBy("id").collect()
    assert wide[0].m1 == 50.0 and wide[1].m1 is None
    bk = sorted(r["items"] for r in read_baskets(spark, f"{base}/baskets.txt").collect())
    assert bk == [["a", "b"], ["c", "d"]]
    ft = read_features(spark, f"{base}/feat.txt", fmt="text", features=["f1", "f2"]).collect()
    assert sorted((r.f1, r.f2) for r in ft) == [(1.0, 2.0), (3.0, 4.0)]
    sc = read_scores(spark, f"{base}/course.csv", fmt="csv").collect()
    assert sorted((r.cno, r.score) for r in sc) == [("m1", 0.0), ("m1", 90.0)]


def test_writers_roundtrip(spark):
    base = scratch_path(spark, "sink")
    df = spark.createDataFrame([("u", "a", 1.5)], "sno string, cno string, pre_score double")
    write_predictions(df, f"{base}/pred", mode="overwrite")
    assert spark.read.parquet(f"{base}/pred").first().pre_score == 1.5
    write_files(df, f"{base}/txt", fmt="text", single_file=True)
    assert spark.read.text(f"{base}/txt").first().value == "u\ta\t1.5"


def test_cohort_partitioned_scores_prune(spark, grades):
    from affinity.operators import prep
    from affinity.sinks import write_scores
    from tests.conftest import HOLDOUT

    path = scratch_path(spark, "scores")
    write_scores(grades, path)
    back = read_scores(spark, path)
    pv = prep.preview_scores(back, HOLDOUT)
    plan = pv._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cohort" in plan and "2016级" in plan
    assert sorted((r.sno, r.cno) for r in pv.collect()) == [("p1", "a"), ("p2", "b"), ("p2", "c")]


def test_score_columns_by_position(spark):
    base = scratch_path(spark, "positional")
    spark.createDataFrame([("s", "c", 50.0, "T1", "2015")], "a string, b string, c double, d string, e string").write.parquet(base)
    assert tuple(read_scores(spark, base).first()) == ("s", "c", 50.0, "T1", "2015")


def test_features_keep_every_column_and_line(spark):
    base = scratch_path(spark, "features")
    cols = ", ".join(f"f{i} double" for i in range(6))
    spark.createDataFrame([("c1", *map(float, range(6)))], f"cno string, {cols}").write.parquet(f"{base}/p")
    assert read_features(spark, f"{base}/p").columns == ["cno", *[f"f{i}" for i in range(6)]]
    spark.createDataFrame([("ID\tA\tB",), ("1.0\t 2.0\t3.0\t4.0\t5.0",)], "value string").write.text(f"{base}/t")
    assert [tuple(r) for r in read_features(spark, f"{base}/t", fmt="text").collect()] == [(1.0, 2.0, 3.0, 4.0, 5.0)]


def test_key_predicates_cover_every_row_once(spark):
    """Run by a database: ranges and hash parts are disjoint and cover all keys, NULL included."""
    import duckdb

    from affinity.sources import key_bounds, key_predicates

    keys = [None, "", "a", "b'c", "math 1", "数学", "z", "O''x", "m", "m", "~"] + [f"k{i}" for i in range(50)]
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INT, k VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(keys)))
    cases = [key_predicates("k", bounds) for bounds in ([], ["b'c"], ["", "k3", "m", "数"])]
    cases += [key_predicates("k", parts=n, hash_expr="CAST(hash({key}) % 1000000 AS INT)") for n in (1, 7)]
    for predicates in cases:
        parts = [[r[0] for r in con.execute(f"SELECT i FROM t WHERE {p}").fetchall()] for p in predicates]
        assert sorted(i for p in parts for i in p) == list(range(len(keys)))
    # the same texts by Spark's own crc32
    spark.createDataFrame(list(enumerate(keys)), "i int, k string").createOrReplaceTempView("keyed")
    rows = [r.i for p in key_predicates("k", parts=5) for r in spark.sql(f"SELECT i FROM keyed WHERE {p}").collect()]
    assert sorted(rows) == list(range(len(keys)))
    bounds = key_bounds(spark.table("keyed"), "k", 4)
    assert len(bounds) == 3 and bounds == sorted(bounds)
    sizes = [spark.sql(f"SELECT i FROM keyed WHERE {p}").count() for p in key_predicates("k", bounds)]
    assert sum(sizes) == len(keys) and max(sizes) <= 2 * len(keys) / 4
    assert key_bounds(spark.table("keyed").where("false"), "k", 4) == []


def test_key_predicates_refuse_nonsense():
    from affinity.sources import key_predicates

    for wrong in ({}, {"bounds": ["a"], "parts": 2}, {"parts": 0}, {"bounds": ["b", "a"]}):
        with pytest.raises(ValueError):
            key_predicates("k", **wrong)


def test_feature_text_with_key(spark):
    path = scratch_path(spark, "features")
    lines = ["cno\tavg\tpass", "  m1 \t 70.5\t\t0.5 ", "m2\t1\tx", "\t\t", "m3\t2\t3"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = {tuple(r) for r in read_features(spark, path, features=["avg", "pass"], fmt="text", keyed=True).collect()}
    assert got == {("m1", 70.5, 0.5), ("m3", 2.0, 3.0)}


def test_long_itemsets_survive_the_sink(spark):
    from affinity.operators import baskets
    from affinity.sinks import write_itemsets, write_rules

    sets = spark.createDataFrame([(list("abcde"), 2), (list("abcdf"), 3)], "items array<string>, freq long")
    path = scratch_path(spark, "sets")
    write_itemsets(baskets.itemsets_wide(sets), path)
    assert {(r["items"], r.freq) for r in spark.read.parquet(path).collect()} == {("a,b,c,d,e", 2), ("a,b,c,d,f", 3)}
    rules = spark.createDataFrame([(list("abcde"), "z", 0.5), (list("abcdf"), "z", 0.5)], "antecedent array<string>, consequent string, confidence double")
    path = scratch_path(spark, "rules")
    write_rules(baskets.rules_wide(rules), path)
    assert {r["antecedent"] for r in spark.read.parquet(path).collect()} == {"a,b,c,d,e", "a,b,c,d,f"}
