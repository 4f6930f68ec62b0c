"""Importance resampling against plain Python on the smoke data and awkward rows."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from affinity.llm import resample
from affinity.llm.queries import queries

from .conftest import SMOKE

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets_of(text, buckets, orders):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    grams = [" ".join(words[i:i + n]) for n in range(1, orders + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]


def brute(docs, target, percent=25, min_words=20, seed=7, buckets=10_000, orders=2):
    own = [(d, *buckets_of(t, buckets, orders)) for d, t in docs]
    s, t = [0] * buckets, [0] * buckets
    for _, _, f in own:
        for b in f:
            s[b] += 1
    for text in target:
        for b in buckets_of(text, buckets, orders)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for d, n, f in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= min_words))
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], math.inf if r[0] is None else r[0], -r[2], r[1]))
    drawn = fit[:percent * len(fit) // 100]
    out = [(*r[:4], i + 1) for i, r in enumerate(drawn)]
    rest = list(rows)
    for r in drawn:
        rest.remove(r)
    return sorted([*out, *((*r[:4], None) for r in rest)], key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_query_equals_plain_python(spark, smoke):
    target = [r["text"] for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    want = brute([(r["doc_id"], r["text"]) for r in smoke.collect()], target)
    assert got(queries()["op12_resampling"](spark, SMOKE)) == want


@pytest.mark.parametrize("options", [{}, {"orders": 1}, {"orders": 3, "buckets": 97, "percent": 60, "min_words": 2, "seed": 11}])
def test_awkward_rows(spark, weird, options):
    target = [None, "", "Number start of the word 5", "naïve CAFÉ 東京"]
    texts = spark.createDataFrame([(t, 1) for t in target], "text string, weight int")
    docs = weird.withColumn("score", F.lit("x")).withColumn("weight", F.lit("x")).withColumn("rank", F.lit("x"))
    want = brute([(r["doc_id"], r["text"]) for r in weird.collect()], target, **options)
    assert got(resample.draw(docs, texts, **options)) == want


def test_empty_tables(spark, weird, nothing):
    target = spark.createDataFrame([("a b",)], "text string")
    assert got(resample.draw(nothing, target)) == []
    none = spark.createDataFrame([], "text string")
    assert got(resample.draw(weird, none)) == brute([(r["doc_id"], r["text"]) for r in weird.collect()], [])


def test_slabs_hold_every_text_once():
    texts = pa.array(["abc", None, "", "x" * 50, "de", "f"])
    parts = [p.to_pylist() for p in resample.slabs(texts, 5)]
    assert [x for p in parts for x in p] == ["abc", "", "", "x" * 50, "de", "f"]
    assert all(sum(map(len, p)) <= 5 or len(p) == 1 for p in parts)


def test_slab_size_does_not_matter(weird):
    texts = pa.array([r["text"] for r in weird.collect()])
    whole = np.zeros(50, np.int64)
    small = np.zeros(50, np.int64)
    for total, size in ((whole, 1 << 22), (small, 20)):
        for slab in resample.slabs(texts, size):
            for _, bucket in resample.features(slab, 50, 2)[1]:
                total += np.bincount(bucket, minlength=50)
    assert whole.tolist() == small.tolist()


def test_sample_keeps_whole_rows(spark, smoke):
    target = spark.read.parquet(f"{SMOKE}/benchmark.parquet")
    ids = {r["doc_id"] for r in resample.draw(smoke, target).filter("rank IS NOT NULL").collect()}
    drawn = resample.sample(smoke, target)
    assert drawn.columns == smoke.columns
    assert {r["doc_id"] for r in drawn.collect()} == ids
