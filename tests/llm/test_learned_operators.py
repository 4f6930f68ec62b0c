"""Operators that learn: held-out accuracy, exactness of their searches, awkward tables."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.llm import ann, langid, toxicity

from .conftest import SMOKE

SF = "/root/testdata/sf0.01"


# --- op 7 ---------------------------------------------------------------------

def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = langid.identify(docs).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_code_lengths(spark):
    """The table gives the code lengths of a direct PPM walk over the counts."""
    rows = [(i, t, lang, None, None) for i, (t, lang) in enumerate([("abracadabra abra", "x"), ("banana band ban", "y")] * 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    model = langid.fit(docs)
    texts = {"x": [], "y": []}
    for r in rows:
        if zlib.crc32(str(r[0]).encode()) % 4 != 2:
            texts[r[2]].append(r[1].encode())

    def bits(lang, text):
        grams = {}
        for t in texts[lang]:
            for k in range(langid.ORDER + 1):
                for i in range(len(t) - k):
                    grams.setdefault(t[i:i + k], {}).setdefault(t[i + k], []).append(1)
        total, padded = 0.0, b" " * langid.ORDER + text
        for i in range(langid.ORDER, len(padded)):
            for k in range(langid.ORDER, -1, -1):
                seen = grams.get(padded[i - k:i])
                if not seen:
                    continue
                n, d, c = sum(map(len, seen.values())), len(seen), len(seen.get(padded[i], ()))
                if c:
                    total -= np.log2(c / (n + d))
                    break
                total -= np.log2(d / (n + d))
            else:
                total += 8
        return total

    for text in (b"abra band", b"zzz", b"banana"):
        assert np.allclose(langid.code_lengths(model, text), [bits("x", text), bits("y", text)], rtol=1e-5)


def test_language_trees_are_whole(spark):
    """Many languages and byte values take nothing from a language's tree."""
    rng = np.random.default_rng(1)
    letters = [chr(c) for c in range(0x41, 0x800) if chr(c).isalpha()]
    rows = [(i, "".join(rng.choice(letters, 150)), f"l{i:03d}") for i in range(160)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    learnt = {lang: text.encode() for i, text, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert model.languages == sorted(learnt)
    asked = rows[0][1].encode()[:60] + rows[1][1].encode()[:60]
    for lang, bits in list(zip(model.languages, langid.code_lengths(model, asked), strict=True))[:12]:
        t, padded, want = learnt[lang], b" " * langid.ORDER + asked, 0.0
        for i in range(langid.ORDER, len(padded)):
            cost = 8.0
            for k in range(langid.ORDER + 1):
                after = [t[j + k] for j in range(len(t) - k) if t[j:j + k] == padded[i - k:i]]
                if after:
                    n, d, c = len(after), len(set(after)), after.count(padded[i])
                    cost = -np.log2(c / (n + d)) if c else cost - np.log2(d / (n + d))
            want += cost
        assert np.isclose(bits, want, rtol=1e-5)


def test_language_code_lengths_over_slabs(monkeypatch):
    gram, n = np.unique([1 << 8 | c for c in b"abcab"] + [1 << 16 | a << 8 | b for a, b in zip(b"abca", b"bcab", strict=True)], return_counts=True)
    model = langid.Model(["x"], [langid.tree(gram, n)])
    texts = [b"abcabcabc", b"zz", b"", b"a" * 50]
    whole = langid.all_code_lengths(model, texts)
    monkeypatch.setattr(langid, "SLAB", 4)
    assert np.allclose(langid.all_code_lengths(model, texts), whole) and whole[2, 0] == 0


def test_language_awkward(weird, nothing):
    rows = langid.identify(weird).collect()
    assert len(rows) == weird.count()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 8)} == {"und"}
    assert langid.identify(nothing).count() == 0
    assert {r["lang_pred"] for r in langid.identify(weird.withColumn("lang", weird["lang"].substr(9, 1)).filter("false")).collect()} == set()


# --- op 8 ---------------------------------------------------------------------

def test_nearest_examples_are_exact():
    rng = np.random.default_rng(0)
    idf = rng.uniform(1, 5, 40)
    rows = [(i, int(rng.integers(0, 2)), sorted(rng.choice(40, int(rng.integers(0, 6)), replace=False).tolist()), None) for i in range(500)]
    rows = [(i, y, t, rng.integers(1, 5, len(t)).tolist()) for i, y, t, _ in rows]
    index = toxicity.build(rows, idf)
    at = {int(d): n for n, d in enumerate(index.ids)}
    for i, _, t, tf in rows[:120]:
        if t:
            q = index.unit(np.array(t), np.array(tf, float))
            cosine = q @ index.weights[t][:, :len(rows)]
            want = sorted(((-round(float(c), 12), int(index.ids[n])) for n, c in enumerate(cosine) if c > 0 and n != at[i]))[:7]
            got = [(-round(c, 12), int(index.ids[n])) for c, n in index.nearest([(np.array(t), np.array(tf, float), i, 0.0)], 7)[0]]
            assert got == want


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = [r for r in toxicity.score(docs, labels).collect() if r["held_out"]]
    assert all(r["predicted"] == int(r["score"] >= 0.7) and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    hits = sum(r["predicted"] and truth[r["doc_id"]] for r in rows)
    assert hits / sum(truth[r["doc_id"]] for r in rows) > 0.85
    assert hits / sum(r["predicted"] for r in rows) > 0.95


def test_copy_of_toxic_example_without_markers(spark):
    """A text's neighbours come from all its terms: a copy of a labelled toxic text finds it."""
    words = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in ("mun", "tor", "vis", "pel")]
    rng = np.random.default_rng(5)
    texts = {i: " ".join(rng.choice(words, 30)) for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1}
    toxic = {i: int(n % 9 == 0) for n, i in enumerate(texts)}
    held = [i for i in range(1000, 1400) if zlib.crc32(str(i).encode()) % 3 == 1]
    copied = dict(zip(held, texts, strict=False))
    rows = list(texts.items()) + [(h, texts[i] + " unheard words") for h, i in copied.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(list(toxic.items()), "doc_id bigint, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect() if r["held_out"]}
    assert got.keys() == copied.keys() and len(copied) > 50
    assert all(got[h]["nearest"] == i and 0.5 < got[h]["cosine"] < 1 for h, i in copied.items())


def test_all_terms_are_weighed():
    n, bad = np.array([100, 100, 10, 1] + [1] * 50), np.array([10, 90, 10, 1] + [0] * 50)
    weight = toxicity.marker_weights(n, bad, 1000, 100)
    assert weight[0] == weight[3] == 1 and weight[2] > weight[1] > 1


def test_index_without_terms_or_examples():
    assert toxicity.build([(1, 0, [], [])], np.zeros(0)).most.shape == (0, 1)
    assert toxicity.build([], np.ones(3)).most.shape == (0, 0)


def plain_terms(text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    tf = collections.Counter(("word", w) for w in words)
    tf.update(("prefix", w[:5]) for w in words if len(w) >= 5)
    for term, n in list(tf.items()):
        if n >= 2:
            tf.update({("count", term, k): 1 for k in (2, 4, 8) if n >= k})
            tf.update({("share", term, k): 1 for k in (8, 7, 6, 5, 4) if n * 2 ** k >= len(words)})
    return tf


def plain_toxicity(docs, labels):
    """Vectors, idf, marker weights, neighbours, votes and calibration in plain Python."""
    toxic = {}
    for d, y in labels:
        if d is not None and y is not None and zlib.crc32(str(d).encode()) % 3 != 1:
            toxic[d] = max(toxic.get(d, 0), int(y == 1))
    texts = {}
    for d, t in docs:
        if d in toxic:
            texts[d] = min((x for x in (texts.get(d), t) if x is not None), default=None)
    vectors = {d: plain_terms(t) for d, t in texts.items()}
    n, bad = collections.Counter(), collections.Counter()
    for d, v in vectors.items():
        n.update(v.keys())
        bad.update(t for t in v if toxic[d])
    df, total, total_bad = collections.Counter(), len(texts), sum(toxic[d] for d in texts)
    for _, t in docs:
        df.update(plain_terms(t).keys())
    weight, unknown = {}, math.log(len(docs) + 1) + 1
    for t in n:
        weight[t] = math.log((len(docs) + 1) / (df[t] + 1)) + 1
        rate, share = total_bad / total, bad[t] / n[t]
        if 0 < rate < 1 and share > rate:
            kl = share * math.log(share / rate) + ((1 - share) * math.log((1 - share) / (1 - rate)) if share < 1 else 0)
            if n[t] * kl >= math.log(max(1, len(n)) / 0.5):
                weight[t] *= 1 + 3 * kl ** 2

    def unit(v):
        w = {t: (1 + math.log(k)) * weight.get(t, unknown) for t, k in v.items()}
        length = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / length for t, x in w.items() if t in weight}

    units = {d: unit(v) for d, v in vectors.items()}

    def vote(v, but):
        q = unit(v)
        near = sorted((-sum(x * u.get(t, 0) for t, x in q.items()), d) for d, u in units.items() if d != but)
        near = [(-c, d) for c, d in near[:15] if -c > 1e-12]
        return sum(c * toxic[d] for c, d in near) / sum(c for c, _ in near) if near else 0.0

    levels = []
    own = sorted((round(vote(vectors[d], d), 3), toxic[d]) for d in vectors)
    for v in sorted({v for v, _ in own}):
        ys = [y for w, y in own if w == v]
        levels.append([v * len(ys), sum(ys), len(ys)])
        while len(levels) > 1 and levels[-2][1] / levels[-2][2] >= levels[-1][1] / levels[-1][2]:
            last = levels.pop()
            levels[-1] = [a + b for a, b in zip(levels[-1], last)]
    at, score = [v / k for v, _, k in levels], [(y + 1) / (k + 2) for _, y, k in levels]
    return [(d, float(np.interp(vote(plain_terms(t), d if d in texts else None), at, score))) for d, t in docs]


def test_scores_equal_plain_python(spark):
    rng = np.random.default_rng(9)
    words = [f"{a}{b}{c}" for a in ("mar", "tel", "vi", "ko") for b in ("na", "stor", "lu") for c in ("", "s", "ren")]
    rows = []
    for i in range(150):
        text = " ".join(rng.choice(words, int(rng.integers(3, 40))))
        rows.append((i, text + " vile vile vilest nasty" if i % 5 == 0 else text, int(i % 5 == 0)))
    docs = [(i, t) for i, t, _ in rows] + [(500, None), (501, ""), (502, "123 !"), (503, "unheard of"), (3, "aaa"), (None, "vile nasty"), (None, "vile nasty")]
    labels = [(i, y) for i, _, y in rows if i % 7] + [(10, 0), (503, None), (None, 1)]
    got = toxicity.score(spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("score", F.lit("x")).withColumn("toxic", F.lit("y")),
                         spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    want = sorted(((repr(d), round(s, 5)) for d, s in plain_toxicity(docs, labels)))
    assert sorted((repr(r["doc_id"]), round(r["score"], 5)) for r in got) == want
    assert len({s for _, s in want}) > 2


def test_blocks_are_skipped_only_below_their_bound(monkeypatch):
    """Same neighbours whether the first blocks' cosines rule out the others or all are read."""
    rng = np.random.default_rng(4)
    idf = rng.uniform(1, 5, 300)
    groups = [rng.choice(300, 40, replace=False) for _ in range(6)]
    rows = [(i, 0, sorted(rng.choice(groups[i % 6], 20, replace=False).tolist()), [1] * 20) for i in range(900)]
    index = toxicity.build(rows, idf)
    assert index.blocks.shape[1] > 20 and len(index.most[0]) == 15
    queries = [(np.array(t), np.ones(20), i, 0.5) for i, _, t, _ in rows[:60]]
    few = index.nearest(queries, 7)
    monkeypatch.setattr(toxicity, "FIRST_BLOCKS", 15)
    assert index.nearest(queries, 7) == few


def test_index_holds_dense_rows_only_where_a_group_needs_them():
    """A term's weights are dense in the groups of examples where it is frequent: the index
    grows with the weights it holds, not with frequent terms times examples, and nothing is lost."""
    rng = np.random.default_rng(8)
    kinds, own = 8, 100  # kinds of texts with terms of their own
    rows = [(i, 0, np.sort(i % kinds * own + rng.choice(own, 40, replace=False)), rng.integers(1, 4, 40)) for i in range(4096)]
    idf = rng.uniform(1, 5, kinds * own)
    index = toxicity.build(rows, idf)
    size = lambda x: x.nbytes if isinstance(x, np.ndarray) else sum(map(size, vars(x).values())) if hasattr(x, "__dict__") else 0
    assert index.blocks.shape[1] > 0.9 * kinds * own and size(index.blocks) + size(index.weights) < kinds * own * 4096 * 4 / 2
    full = np.zeros((4096, kinds * own))
    for i, _, t, tf in rows:
        full[i, t] = index.unit(t, tf.astype(float)).astype(np.float32)
    for i, _, t, tf in rows[::97]:
        cosine = np.round(full[:, t] @ index.unit(t, tf.astype(float)), 12)
        want = sorted((-float(c), n) for n, c in enumerate(cosine) if c > 0 and n != i)[:15]
        got = [(-c, int(index.ids[n])) for c, n in index.nearest([(t, tf.astype(float), i, 0.0)], 15)[0]]
        assert [n for _, n in got] == [n for _, n in want] and np.allclose([c for c, _ in got], [c for c, _ in want], atol=1e-11)


def test_terms_of_long_and_foreign_words():
    for text in (None, "", "123 _", "Été été ÉTÉ_été a1b² ßx", "x" * 31 + " " + "x" * 32 + " " + "x" * 33 + " " + "x" * 34, "\ud800word \U00010400\U0001f600 漢字漢字漢字"):
        want = sorted(plain_terms(text).values())
        ids, tf = toxicity.terms_in(text)
        assert sorted(tf.tolist()) == want and len(set(ids.tolist())) == len(want) and (np.diff(ids) > 0).all()


def test_toxicity_awkward(spark, weird, nothing):
    labels = spark.createDataFrame([(4, 1, 1), (4, 1, 0), (6, 0, None), (None, 1, 1), (30, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = toxicity.score(weird, labels).collect()
    assert len(rows) == weird.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = toxicity.score(weird, labels.filter("false")).collect()
    assert len(none) == weird.count() and {r["score"] for r in none} == {0.0}
    assert toxicity.score(nothing, labels).count() == 0


# --- op 2 ---------------------------------------------------------------------

def brute(ids, vectors, query, k):
    u = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    s = np.round(u @ u[ids == query][0], 12)
    order = np.lexsort((ids, -s))
    return [int(ids[i]) for i in order if ids[i] != query][:k]


@pytest.mark.parametrize("leaf", [8192, 64])
def test_neighbours_recall(spark, monkeypatch, leaf):
    monkeypatch.setattr(ann, "LEAF_POINTS", leaf)
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = ann.nearest(table, ann.usable(table, "vec_id", "embedding").filter("vec_id % 50 = 0")).collect()
    data = table.toPandas()
    ids, vectors = data["vec_id"].to_numpy(), np.stack(data["embedding"]).astype(float)
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        got = [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q]
        want = brute(ids, vectors, q, 5)
        assert len(got) == 5
        hits += len(set(got) & set(want))
        total += 5
    assert hits / total >= 0.95


def test_neighbours_awkward(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [float("nan"), 1.0]),
            (8, [None, 1.0]), (9, [float("inf"), 1.0]), (None, [1.0, 1.0]), (10, [1.0, 2.0, 3.0]), (11, [1.0, 0.0]), (11, [1.0, 0.0])]
    rows += [(i, [1.0, 0.0]) for i in range(12, 40)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asked = ann.usable(table, "vec_id", "embedding").filter("vec_id % 50 = 0")
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(table, asked).collect())
    assert [g[1] for g in got] == [1, 2, 11, 12, 13] and all(g[2] == 1.0 for g in got)
    few = table.filter("vec_id in (0, 3)")
    assert [r["vec_id"] for r in ann.nearest(few, asked).collect()] == [3]
    assert ann.nearest(table.filter("false"), asked).count() == 0


def test_repeated_ids_have_one_vector_in_any_order(spark):
    """Of the vectors of one id the smallest counts, whatever order rows come in; extra columns do not matter."""
    rows = [(0, [1.0, 0.1]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.2]), (2, [1.0, 0.3]), (50, [0.0, 1.0]), (50, [1.0, 0.0])]
    answers = []
    for order in (rows, rows[::-1]):
        table = spark.createDataFrame(order, "vec_id bigint, embedding array<double>").coalesce(1)
        for name in ("v", "ids", "leaf", "query_id", "rank", "away", "bound"):
            table = table.withColumn(name, F.lit("x"))
        asked = ann.usable(table, "vec_id", "embedding").filter("vec_id % 50 = 0")
        answers.append(sorted(tuple(r) for r in ann.nearest(table, asked, k=2).collect()))
    assert answers[0] == answers[1]
    assert [(r[0], r[1], r[2]) for r in answers[0]] == [(0, 1, 2), (0, 2, 1), (50, 1, 1), (50, 2, 2)]


def test_chi_square_closed_form():
    x = np.random.default_rng(3).chisquare(ann.DIMENSIONS, 200_000)
    for q in (2.0, 7.3, 15.5):
        assert abs(ann.chi_square(np.array([q]))[0] - (x <= q).mean()) < 0.01
