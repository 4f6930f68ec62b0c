import pytest

from affinity.operators import prep
from affinity.plans import jobs
from affinity.session import scratch_path
from affinity.streaming import latest_predictions, start_scoring
from tests.conftest import HOLDOUT


def test_stream_rescoring_equals_batch(spark, grades):
    sim = jobs.train(prep.train_scores(grades, HOLDOUT))
    preview = prep.preview_scores(grades, HOLDOUT)
    base = scratch_path(spark, "stream")
    src = f"{base}/in"
    # two arrivals: p2's grades come in separate files
    preview.where("sno = 'p1' OR cno = 'b'").write.parquet(f"{src}/part1")
    preview.where("sno = 'p2' AND cno = 'c'").write.parquet(f"{src}/part2")
    stream = spark.readStream.schema(preview.schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    q = start_scoring(stream, sim, f"{base}/history", f"{base}/out", f"{base}/ckpt", threshold=None)
    q.awaitTermination(120)
    got = {(r.sno, r.cno): r.pre_score for r in latest_predictions(spark, f"{base}/out").collect()}
    want = {(r.sno, r.cno): r.pre_score for r in jobs.predict(preview, sim, threshold=None).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v)


def test_replayed_batch_and_lost_scores(spark, grades):
    """A replay overwrites its batch; a user whose new scores all fall below the threshold has none."""
    from affinity.streaming import _batch_writer

    sim = jobs.train(prep.train_scores(grades, HOLDOUT))
    preview = prep.preview_scores(grades, HOLDOUT)
    base = scratch_path(spark, "replay")
    write = _batch_writer(sim, f"{base}/h", f"{base}/o", "sno", {"threshold": 10.0})
    for batch_id, rows in ((0, "cno = 'b'"), (1, "cno <> 'b'"), (1, "cno <> 'b'")):
        write(preview.where(rows), batch_id)
    got = sorted(map(tuple, latest_predictions(spark, f"{base}/o").select("sno", "cno", "pre_score").collect()))
    want = sorted(map(tuple, jobs.predict(preview, sim, threshold=10.0).select("sno", "cno", "pre_score").collect()))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])
