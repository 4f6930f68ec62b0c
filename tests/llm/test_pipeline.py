"""The pipeline's stages against plain Python on the smoke data."""

import collections
import hashlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from affinity.llm import mixing, quality
from affinity.llm.common import stored

from .conftest import SMOKE
from .test_text_operators import brute_components, brute_lines


def test_stages(spark, smoke):
    docs = smoke
    seen = {"documents": docs}
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SMOKE), "stage")
        if name != P.STAGES[-1][0]:
            assert docs.dtypes == smoke.dtypes
        seen[name] = docs

    def texts(name):
        return [(r["doc_id"], r["text"]) for r in seen[name].collect()]

    kept = {r["doc_id"] for r in quality.score(smoke).filter("kept").collect()}
    assert sorted(texts("quality_rules")) == sorted((d, t) for d, t in texts("documents") if d in kept)
    lines = brute_lines(texts("quality_rules"))
    assert sorted(texts("line_dedup")) == sorted((d, t) for d, rows in lines.items() for *_, t in rows)
    comps = brute_components(texts("line_dedup"), 5)
    assert sorted(texts("near_dedup")) == sorted((d, t) for d, t in texts("line_dedup") if comps[d][1] == d)
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.taken(seen["near_dedup"]).collect() if r["size"]}
    copies = collections.Counter(d for d, _ in texts("mix_sources"))
    assert {d: n for d, n in taken.items() if n} == {d: n for d, n in copies.items() if d in taken}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for d, t in texts("mix_sources"):
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert want == collections.Counter(tuple(r) for r in seen["encode"].collect())


def test_run_gives_the_last_stage(spark):
    assert P.run(spark, SMOKE).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_stages_on_awkward_and_empty_tables(spark, weird, nothing):
    """Every stage over what its predecessor kept: NULLs, repeats, columns of any name, no rows."""
    clashing = weird
    for name in ("__gone", "__d", "__keep", "n", "share"):
        clashing = clashing.withColumn(name, F.lit("x"))
    for docs in (clashing, nothing):
        first = docs
        for name, stage in P.STAGES:
            docs = stored(stage(spark, docs, SMOKE), "stage")
            if name != P.STAGES[-1][0]:
                assert docs.columns == first.columns
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert docs.collect() == []
