"""Structured Streaming adapter for the scorer.

The reference has no streaming. The one streaming form its batch job admits
is grades arriving over time while the similarity table stays fixed. A
user's scores depend on all of that user's grades (top-N over the user's
rows), so each micro-batch

1. writes its rows to its own partition of a history table in the shared
   folder, split by a hash bucket of the user,
2. re-runs :func:`affinity.plans.jobs.predict` for the users the batch
   touched, reading their full history (a left-semi join on the user),
3. writes the new scores to the batch's own partition of the output, with one
   row without item for every user touched.

:func:`latest_predictions` keeps, per user, the rows of that user's last
batch; a user left without scores there has none. The result equals the batch
job over all grades seen so far. A replayed batch overwrites its own two
partitions, so a restart neither doubles rows nor changes scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from affinity.plans import jobs


HISTORY_BUCKETS = 256


def _bucket(user: str):
    return F.pmod(F.xxhash64(F.col(user)), F.lit(HISTORY_BUCKETS)).cast("int").alias("_bucket")


def _batch_writer(sim: DataFrame, history_path: str, out_path: str, user: str, predict_kw: dict):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        # History is partitioned by a hash bucket of the user: a batch reads
        # only the buckets of the users it touched (dynamic partition pruning).
        keyed = batch.select("*", _bucket(user))
        keyed.write.mode("overwrite").partitionBy("_bucket").parquet(f"{history_path}/batch_id={batch_id}")
        touched = batch.select(user, _bucket(user)).distinct()
        schema = keyed.schema.add("batch_id", "long")
        rows = (spark.read.schema(schema).option("basePath", history_path).parquet(history_path)
                .where(F.col("batch_id") <= batch_id)
                .join(touched, [user, "_bucket"], "left_semi").drop("_bucket", "batch_id"))
        pred = jobs.predict(rows, sim, user=user, **predict_kw)
        marks = touched.select(user)
        for c in pred.columns:
            if c != user:
                marks = marks.withColumn(c, F.lit(None).cast(pred.schema[c].dataType))
        pred.unionByName(marks).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    return run


def start_scoring(grades: DataFrame, sim: DataFrame, history_path: str, out_path: str,
                  checkpoint_location: str, user: str = "sno", available_now: bool = True,
                  **predict_kw) -> StreamingQuery:
    """Score a stream of preview grades ``(user, item, score)`` against ``sim``."""
    writer = (grades.writeStream
              .foreachBatch(_batch_writer(sim, history_path, out_path, user, predict_kw))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def latest_predictions(spark: SparkSession, out_path: str, user: str = "sno", score: str = "pre_score") -> DataFrame:
    """Scores of every user from that user's most recent batch."""
    allp = spark.read.parquet(out_path)
    last = allp.groupBy(user).agg(F.max("batch_id").alias("batch_id"))
    item = next(c for c in allp.columns if c not in (user, "batch_id", score))
    return allp.join(last, [user, "batch_id"], "left_semi").where(F.col(item).isNotNull()).drop("batch_id")
