"""Text operators against brute force, and on awkward and empty tables."""

import collections
import hashlib
import math
import re

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from affinity.llm import bpe, license, linededup, lm, minhash, mixing, quality

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r["doc_id"]].append(r)
    return out


# --- op 1 ---------------------------------------------------------------------

def test_quality_base_numbers(weird):
    got = by_id(quality.score(weird))
    assert sum(map(len, got.values())) == weird.count()
    for r in weird.collect():
        w = WORD.findall(r["text"] or "")
        places = collections.defaultdict(list)
        for i in range(len(w) - 7):
            places[tuple(w[i:i + 8])].append(i)
        repeated = {i + k for v in places.values() if len(v) > 1 for i in v for k in range(8)}
        lines = [x for x in (r["text"] or "").split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", r["text"] or "")), len(lines) - len(set(lines)), len(repeated))
        assert any((g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == want for g in got[r["doc_id"]])


def test_quality_keeps_columns_and_empty(weird, nothing):
    kept = quality.keep_good(weird)
    assert kept.columns == weird.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert 20 in ids and not ids & {1, 2, 3, 4, 10}
    assert quality.score(nothing).count() == 0
    assert quality.keep_good(nothing).columns == nothing.columns


# --- op 9 ---------------------------------------------------------------------

def brute_lines(rows, min_chars=40, min_docs=5):
    strip = " \t\n\x0b\x0c\r"
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(strip).translate(low)
    held = collections.defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if d is not None and len(key(x)) >= min_chars:
                held[key(x)].add(d)
    out = collections.defaultdict(list)
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if d is None or len(held.get(key(x), ())) < min_docs or max(held[key(x)]) == d]
        out[d].append((len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def test_line_dedup_equals_brute_force(weird, nothing):
    want = brute_lines([(r["doc_id"], r["text"]) for r in weird.collect()])
    got = by_id(linededup.digest(weird))
    for d, rows in want.items():
        assert sorted((n, k, hashlib.sha256(t.encode()).hexdigest()) for n, k, t in rows) == sorted(
            (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got[d])
    texts = linededup.drop_lines(weird)
    assert texts.columns == weird.columns
    got = by_id(texts)
    for d, rows in want.items():
        assert sorted(t for *_, t in rows) == sorted(r["text"] or "" for r in got[d])
    assert linededup.digest(nothing).count() == 0


def test_line_runs_admit_each_line_once(spark):
    def lines(*pairs):
        return linededup.line_keys(spark.createDataFrame([(d, t, None, None, None) for d, t in pairs], "doc_id bigint, text string, a int, b int, c int"), 1)

    runs = linededup.LineRuns(spark, fanout=2)
    first = runs.admit(lines((1, "a\nb")))
    second = runs.admit(lines((2, "b\nc")))
    third = runs.admit(lines((3, "a\nd")))
    assert [x.count() for x in (first, second, third)] == [2, 1, 1]
    assert sum(map(len, runs.levels)) == 2 and runs.levels[0] == runs.levels[0][:1]
    assert {r["n_docs"] for r in runs.keys().collect()} == {1, 2}


@pytest.mark.parametrize("batches,broadcast", [(1, 0), (3, 1_000_000), (7, 0)])
def test_batches_and_joins_do_not_change_the_lines(spark, weird, batches, broadcast):
    """Keys that come back in later batches, also in few documents a batch."""
    text = "A line of more than forty characters that comes back."
    rows = [(i, f"{text} {i % 6}\n{text} {i % 3}\n{text} {i}") for i in range(100, 140)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").unionByName(weird.select("doc_id", "text"))
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute_lines(pairs)
    got = linededup.drop_lines(docs, batches=batches, broadcast_keys=broadcast)
    assert sorted(((r["doc_id"], r["text"] or "") for r in got.collect()), key=repr) == sorted(((d, t or "") for d, x in want.items() for *_, t in x), key=repr)


def test_own_columns_may_have_any_name(spark, nothing):
    """Working columns of the stages never meet the documents' own."""
    rows = [(i, "A line of more than forty characters, in every text.", "d", "v", "l", "k", "g") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, __d string, __v string, __l string, ___keep string, __gone string")
    kept = linededup.drop_lines(docs)
    assert kept.columns == docs.columns and sorted(r["text"] for r in kept.collect()) == [""] * 5 + [rows[0][1]]
    one = minhash.keep_one(docs)
    assert one.columns == docs.columns and [tuple(r) for r in one.collect()] == [rows[0]]
    assert linededup.drop_lines(nothing).collect() == [] and minhash.keep_one(nothing).collect() == []


# --- op 10 --------------------------------------------------------------------

def brute_components(rows, shingle, similarity=80):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        k = min(shingle, len(w))
        if d is not None:
            sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= similarity * max(len(x), len(y)):
                n = len(x & y)
                if 100 * n >= similarity * (len(x) + len(y) - n):
                    p, q = sorted((find(a), find(b)))
                    root[q] = p
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates_equal_brute_force(smoke, weird, nothing, shingle):
    for docs in (smoke, weird):
        want = brute_components([(r["doc_id"], r["text"]) for r in docs.collect()], shingle)
        got = minhash.near_duplicates(docs, shingle).collect()
        assert len(got) == docs.count()
        for r in got:
            if r["doc_id"] is None:
                assert r["component_id"] is None and r["kept"]
            else:
                assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
                assert r["kept"] == (r["component_id"] == r["doc_id"])
    assert minhash.near_duplicates(nothing).count() == 0


def test_near_duplicate_chains_are_not_lost(spark):
    """Texts that drift word by word: neighbours link, far ones only through the chain."""
    rows = [(1000 - s, " ".join([f"w{i + 6 * s}" for i in range(100)])) for s in range(40)]
    rows += [(2000 + s, " ".join([f"v{i}" for i in range(80)] + [f"x{s}{i}" for i in range(12)])) for s in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute_components(rows, 2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs, 2).collect()}
    assert got == want


def test_keep_one_keeps_columns(weird):
    out = minhash.keep_one(weird)
    assert out.columns == weird.columns
    assert {30, 20, 4} <= {r["doc_id"] for r in out.collect()} and not {31, 35} & {r["doc_id"] for r in out.collect()}


# --- op 5 ---------------------------------------------------------------------

def test_mixing_targets_and_copies(smoke, weird, nothing):
    for docs in (smoke, weird):
        rows = mixing.taken(docs).collect()
        assert len(rows) == docs.count()
        assert all(r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] for r in rows)
        assert math.isclose(sum({(r["source_size"], r["target"]): r["target"] for r in rows}.values()), 1.5 * sum(r["size"] for r in rows), rel_tol=0.2)
    mixed = mixing.mix(smoke)
    assert mixed.columns == smoke.columns
    count = collections.Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    want = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.taken(smoke).collect() if r["size"]}
    assert {d: n for d, n in want.items() if n} == {d: n for d, n in count.items() if d in want}
    assert mixing.taken(nothing).count() == 0 and mixing.mix(nothing).count() == 0


def test_mixing_buckets_do_not_change_the_plan(smoke):
    sized = mixing.sizes(smoke)
    a, b = (sorted(map(tuple, mixing.plan(sized, n).collect())) for n in (1, 64))
    assert a == b


# --- op 6 ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return LIBRARY


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sA1é東 　😀.<|>"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_encoding_equals_the_library(text):
    tok, lib = bpe.tokenizer(PATH), LIBRARY
    ids = lib.encode(text, add_special_tokens=False).ids
    assert bpe.encode_text(tok, text).tolist() == ids
    assert bpe.decode_ids(tok, np.array(ids, np.uint32)) == lib.decode(ids, skip_special_tokens=False)


def test_codes_equal_the_library(weird, smoke, nothing, library):
    for docs in (weird, smoke):
        got = by_id(bpe.code(docs, PATH))
        rows = docs.collect()
        assert sum(map(len, got.values())) == len(rows)
        for r in rows:
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            want = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
            assert want in [(g["n_tokens"], g["ids_sha256"], g["decoded_sha256"]) for g in got[r["doc_id"]]]
    assert bpe.code(nothing, PATH).count() == 0


def test_shared_chunks_are_joined_exactly(spark, library):
    """Long shared passages behind different openings: most ids come from shared chunks."""
    rng = np.random.default_rng(1)
    passage = " ".join("".join(rng.choice(list("abcdeé東 "), 6)) for _ in range(3000))
    rows = [(i, f"opening {i}{'x' * i} " + passage[:9000 + 700 * i] + f" and the end {i}") for i in range(8)]
    ends = [bpe.cuts(t.encode()) for _, t in rows]
    assert all(len(e) > 3 for e in ends)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in bpe.code(docs, PATH, bpe.whole, bpe.WHOLE).collect()}
    for i, t in rows:
        assert got[i]["ids"] == library.encode(t, add_special_tokens=False).ids and got[i]["decoded"] == t


@pytest.mark.parametrize("text", ["\n" * 1_000_000, " " * 2_000_000, "a" + "\n" * 200_000 + "b", "x" + " " * 50_000 + "'s y", "\t\u3000" * 9_000 + "é",
                                  "<|endoftext|>" + " \n" * 30_000 + "<|endoftext|> z" + " " * 5_000, " " * 4096, "a " + " " * 4096 + "1"])
def test_long_white_space(library, text):
    tok = bpe.tokenizer(PATH)
    ids = library.encode(text, add_special_tokens=False).ids
    assert bpe.encode_text(tok, text).tolist() == ids
    assert bpe.decode_ids(tok, np.array(ids, np.uint32)) == text


def test_a_join_that_does_not_hold_is_repaired(spark, library):
    """Ids of a chunk cut inside a token are told apart, and such a text is encoded as a whole."""
    rng = np.random.default_rng(2)
    passage = " ".join("".join(rng.choice(list("abcdefgh"), 7)) for _ in range(300))
    tok, text = bpe.tokenizer(PATH), "opening " + passage + " end"
    whole = bpe._packed(bpe.encode_text(tok, passage))
    schema = "version binary, seq int, skip bigint, take bigint, packed binary"
    at = bpe.anchors(passage.encode()).tolist()
    fits = [(b"a", 0, None, None, bpe._packed(bpe.encode_text(tok, "opening"))), (b"a", 1, at[0], at[9] - at[0], whole)]
    fails = [(b"b", 0, None, None, whole), (b"b", 1, at[0] + 1, 200, whole), (b"b", 2, 5, 10**6, whole)]
    got = bpe._joined(spark.createDataFrame(fits + fails, schema).coalesce(1), PATH, bpe.whole, bpe.WHOLE).collect()
    assert [(r["agrees"], r["decoded"]) for r in got] == [(True, "opening" + passage[at[0]:at[9]]), (False, None)]
    texts = spark.createDataFrame([(b"b", zstandard.compress(text.encode()))], "version binary, z binary")
    again = bpe._again(texts, PATH, bpe.whole, bpe.WHOLE).collect()
    assert [(r["ids"], r["decoded"]) for r in again] == [(library.encode(text, add_special_tokens=False).ids, text)]


# --- op 4 ---------------------------------------------------------------------

def brute_scores(rows):
    texts = [["<s>", *t.split(), "</s>"] for _, t in rows if (t or "").encode().split()]
    c1 = collections.Counter(w for t in texts for w in t)
    c2 = collections.Counter(p for t in texts for p in zip(t, t[1:], strict=False))
    total = sum(n for w, n in c1.items() if w != "<s>")
    out = []
    for d, text in rows:
        words = [x.decode() for x in (text or "").encode().split()]
        if not words:
            out.append((d, 0, 0.0))
            continue
        t = ["<s>", *words, "</s>"]
        o1, o2, rest, score = collections.Counter(t), collections.Counter(zip(t, t[1:], strict=False)), max(1, total - len(t) + 1), 0.0
        for v, w in zip(t, t[1:], strict=False):
            n, u = c2[v, w] - o2[v, w], c1[w] - o1[w]
            score += math.log(n / (c1[v] - o1[v])) if n else math.log(0.4 * u / rest) if u else math.log(0.16 / rest)
        out.append((d, len(words), score))
    return out


@pytest.mark.parametrize("hot", [1 << 16, 64])
def test_lm_scores_equal_brute_force(spark, smoke, nothing, monkeypatch, hot):
    monkeypatch.setattr(lm, "HOT_WORDS", hot)
    rows = [(r["doc_id"], r["text"]) for r in smoke.collect()] + [(None, "the of"), (None, None), (7, "the of"), (7, "the of"), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r["doc_id"] or -1, r["n_words"], r["log_score"]) for r in lm.score(docs, parts=7).collect())
    want = sorted((d or -1, n, s) for d, n, s in brute_scores(rows))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=1e-5)
    assert lm.score(nothing).count() == 0


# --- op 3 ---------------------------------------------------------------------

def test_licences_are_found(spark, smoke, nothing):
    extra = [(10_000, "Some words.\nReleased under the MIT License.\nmit der Zeit", None, None, None),
             (10_001, "This package is distributed under the Zorblatt Public License, version 9.", None, None, None),
             (10_002, None, None, None, None), (10_003, "", None, None, None),
             (10_004, "Released under the MIT License.\nReleased under the MIT License.", None, None, None)]
    docs = smoke.unionByName(spark.createDataFrame(extra, smoke.schema))
    model = license.fit(docs)
    got = {(r["doc_id"], r["paragraph"]): r["family"] for r in license.scan(docs, model).collect()}
    assert got[10_000, 1] == "mit" and (10_000, 2) not in got
    assert got.get((10_001, 0), "unknown") == "unknown"
    assert got[10_004, 0] == got[10_004, 1] == "mit"
    known = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "All rights reserved.": "all-rights-reserved",
             "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit",
             "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0"}
    want = {(r["doc_id"], i): known[x] for r in docs.collect() for i, x in enumerate((r["text"] or "").split("\n")) if x in known}
    assert {k: got.get(k) for k in want} == want
    assert not [k for k, f in got.items() if f != "unknown" and k not in want]
    assert license.scan(nothing, model).count() == 0


def test_wrapped_licences(spark, smoke):
    bsd = ["// Redistribution and use in source and binary forms, with or without", "// modification, are permitted provided that the following conditions are met:"]
    gpl = [" * This program is free software: you can redistribute it and/or modify", " * it under the terms of the GNU General Public License as published by",
           " * the Free Software Foundation, either version 3 of the License, or", " * (at your option) any later version."]
    extra = [(10_000, "\n".join(["int x;", "", *bsd, "", "int y;"])), (10_001, "\n".join(["/*", *gpl, " */"])),
             (10_002, "\n".join([*bsd, *gpl])), (10_003, f"{bsd[0]}\n\n{bsd[1]}"), (10_004, "Words before it. All\nrights\nreserved. Words after it.")]
    docs = smoke.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    got = [(r["doc_id"], r["paragraph"], r["family"]) for r in license.scan(docs).filter("doc_id >= 10000").collect()]
    assert sorted(g for g in got if g[0] != 10_003) == [(10_000, 2, "bsd"), (10_001, 1, "gpl-3.0"), (10_002, 0, "bsd"), (10_002, 2, "gpl-3.0"),
                                                        (10_004, 0, "all-rights-reserved")]
    assert {g[2] for g in got if g[0] == 10_003} <= {"unknown"}  # a blank line parts them


def test_no_notice_confirmed_by_plain_words():
    for pairs in license._templates():
        assert sum(set(p.split()) <= license.PLAIN for p in pairs) / len(pairs) < license.CONFIRM


def test_licences_in_legal_prose(spark):
    """Words of the notices that are common in the corpus don't hide a notice."""
    prose = ["The rights of the heirs are reserved to all members.", "All heirs reserved the rights they had.", "The license of the pub was sold.",
             "A public library is open to all.", "Version two of the work was lost.", "Trees grow slowly here.", "He said nothing at all about it."]
    rows = [(i, "\n".join(prose[(i + k) % 7] for k in range(4))) for i in range(60)]
    rows += [(1000, "All rights reserved."), (1001, "Nothing here.\nReleased under the MIT License.")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["doc_id"], r["paragraph"]): r["family"] for r in license.scan(docs).collect()}
    assert got.get((1000, 0)) == "all-rights-reserved" and got.get((1001, 1)) == "mit"
    assert {k for k, f in got.items() if f != "unknown"} == {(1000, 0), (1001, 1)}


def test_language_model_rows_stay_small_in_many_partitions(spark):
    # the more partitions, the fewer pairs share a row: its words must not cost 8 bytes each
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[k] for k in draw.integers(0, 400, 200))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    hashes = lm.WordHashes()
    hot = np.sort(np.concatenate([[lm.START, lm.END], lm._hashed(" ".join(words).encode(), hashes)]))
    sizes = [sum(len(r["blob"]) for r in lm._exploded(docs, parts, hot).collect()) for parts in (1, 64)]
    assert sizes[1] < 2 * sizes[0]
    assert (lm.named(lm.numbered(hot, hot)[0], hot) == hot).all()
