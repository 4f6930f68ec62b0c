"""The filter audit against one Python walk per order of the filters."""

import itertools
import re

from pyspark.sql import functions as F

from affinity.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    texts = [(d, s or "", t or "") for d, s, t in docs]
    good, toxic = ({d for d, *v in labels if d is not None and v[i] == 1} for i in (0, 1))
    failed = []
    for d, part, t in texts:
        w = WORD.findall(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": d is not None and any(e is not None and e < d and t == u for e, _, u in texts)}
        failed.append((part, d, {f for f, x in fails.items() if x}))
    out, by_filter = {}, {}
    for part in {p for p, *_ in failed}:
        for order in itertools.permutations("ABCDE"):
            left = [(d, f) for p, d, f in failed if p == part]
            for step, own in enumerate(order, 1):
                gone = [(d, f) for d, f in left if own in f]
                before = len([1 for p, d, f in failed if p == part and own in f]) - len(gone)
                left = [(d, f) for d, f in left if own not in f]
                out[part, "".join(order), step] = (
                    len(left), len(gone), before, sum(p == part and f == {own} for p, _, f in failed),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone))
                by_filter[part, own] = by_filter.get((part, own), 0) + len(gone)
    return sorted((*k, *v, by_filter[k[0], k[1][k[2] - 1]]) for k, v in out.items())


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def got(docs, labels, **options):
    return sorted(tuple(r) for r in audit.audit(docs, labels, **options).select(*COLUMNS).collect())


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_awkward_rows(spark, weird):
    labels = [(5, 1, 0), (20, 1, None), (20, 0, 1), (21, None, 1), (30, 1, 1), (None, 1, 1), (999, 1, 1)]
    docs = weird.unionByName(weird.filter("doc_id IN (6, 30, 31)").withColumn("doc_id", F.col("doc_id") + 100))
    docs = docs.withColumn("n", F.lit("x")).withColumn("hash", F.lit("y")).withColumn("part", F.lit("z"))
    want = brute([(r["doc_id"], r["source"], r["text"]) for r in docs.collect()], labels)
    own = labelled(spark, labels).withColumn("part", F.lit(1)).withColumn("text", F.lit(2))
    assert got(docs, own) == want
    assert got(docs, own, salt_rows=2) == want
    assert got(docs, own, broadcast_hashes=0) == want


def test_hot_group_of_copies_is_spread(spark):
    rows = [(i, "a copy " * 30, "s", "en", 1) for i in range(500)] + [(1000 + i, f"text {i}", "t", "en", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars int")
    want = brute([(r[0], r[2], r[1]) for r in rows], [])
    assert got(docs, labelled(spark, []), salt_rows=50) == want


def test_equal_hashes_of_unlike_texts(spark, monkeypatch):
    """Only the exact text counts, whatever the hash says."""
    monkeypatch.setattr(audit, "_hash", lambda c: F.unhex(F.lit("00")).alias("hash"))
    rows = [(1, "x"), (2, "y"), (3, "x"), (4, "y"), (5, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("source", F.lit("s"))
    facts = audit.numbers(docs)
    assert sorted(r["doc_id"] for r in audit.copies(docs, facts).collect()) == [3, 4]


def test_empty_tables(spark, nothing):
    assert got(nothing, labelled(spark, [])) == []


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "a b c", "s"), (3, "a b", "s")], "doc_id bigint, text string, source string")
    rows = audit.audit(docs, labelled(spark, []), {"X": "n_words > 2"}).collect()
    assert sorted((r["filter_order"], r["step"], r["kept"], r["removed"], r["shapley"]) for r in rows) == [
        ("EX", 1, 2, 1, 2), ("EX", 2, 1, 1, 2), ("XE", 1, 2, 1, 2), ("XE", 2, 1, 1, 2)]
