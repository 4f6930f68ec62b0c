"""Mixing sources to target weights by Efraimidis-Spirakis sampling
(DataFrame and SQL functions only).

Sources, in code point order with NULL last, weigh 5, 2, 1, repeating, and share
``share`` times the words of all documents; a target stops at twice its
source's words, what it can't use goes to the others by weight. A source
gives ``floor(target / words)`` complete epochs, then a fraction: its documents
in order of the exponential key -ln(u) / w, where u comes from a hash of the
doc_id and w is the document's quality weight (share of letters among
word characters, from 0.1 to 1), as long as the middle of a document
lies within the rest of the target.

The order within a source is never sorted in one task: keys fall into
``buckets`` slices of the key range, the slices' sums are prefix-summed per
source, and rows are sorted within (source, slice). What remains is one cut per
source, so texts are filtered where they lie.

Defined results: NULL text has size 0; rows with equal doc_id in one source have
equal keys and the cut takes all or none of them; an empty table gives no rows;
sources without words have target 0; other columns are ignored by ``plan`` and
kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, stored, unit_hash, words_of

SOURCE_WEIGHTS = (5, 2, 1)
SHARE_HALVES = 3  # the targets add up to this many halves of all words
MAX_EPOCHS = 2
SEED = 11
BUCKETS = 1024


def _size() -> Column:
    return F.size(words_of(F.col("text"))).cast("bigint")


def quality_weight(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    letters = F.length(text) - F.length(F.regexp_replace(text, r"\p{L}+", ""))
    chars = F.length(F.regexp_replace(text, SPACES, ""))
    return F.when(chars == 0, F.lit(1.0)).otherwise(0.1 + 0.9 * letters / chars)


def _key() -> Column:
    return -F.log(unit_hash(F.lit(SEED), F.col("doc_id"))) / quality_weight(F.col("text"))


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target, epochs, rest): one row per source."""
    w = F.element_at(F.array(*map(F.lit, SOURCE_WEIGHTS)), F.col("n") % len(SOURCE_WEIGHTS) + 1)
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = src.withColumn("n", (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1).cast("int"))
    src = src.withColumn("w", w.cast("bigint")).withColumn("cap", MAX_EPOCHS * F.col("source_size"))
    everyone = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("w"), "n").rowsBetween(Window.unboundedPreceding, -1)
    src = src.withColumn("halves", SHARE_HALVES * F.sum("source_size").over(everyone)) \
        .withColumn("before", F.coalesce(F.sum("cap").over(filled), F.lit(0))) \
        .withColumn("others", F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(filled), F.lit(0)))
    src = src.withColumn("full", (F.col("halves") - 2 * F.col("before")) * F.col("w") >= 2 * F.col("cap") * F.col("others"))
    left = F.col("halves") - 2 * F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everyone), F.lit(0))
    open_w = F.sum(F.when(~F.col("full"), F.col("w"))).over(everyone)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        (F.col("w") * left).cast("double") / (2 * open_w).cast("double"))
    src = src.withColumn("target", target)
    size = F.col("source_size")
    src = src.withColumn("epochs", F.when(size == 0, F.lit(0)).otherwise(F.floor(F.col("target") / size)).cast("bigint"))
    return src.select("source", "source_size", "target", "epochs", (F.col("target") - F.col("epochs") * size).alias("rest"))


def plan(sized: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Per source: source_size, target, epochs and the cut (cut_key, cut_id) of the
    fractional epoch. ``sized``: doc_id, source, size, key."""
    tg = stored(targets(sized), "targets")
    spread = sized.withColumn("id", _id()).withColumn(
        "bucket", F.least(F.floor(buckets * (1 - F.exp(-F.col("key")))), F.lit(buckets - 1)))
    in_source = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    slices = spread.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    slices = slices.withColumn("start", F.coalesce(F.sum("words").over(in_source), F.lit(0)))
    slices = slices.join(tg, slices["source"].eqNullSafe(tg["source"])).select(
        slices["source"].alias("s"), F.col("bucket").alias("b"), "start", "rest")
    slices = stored(slices, "slices")
    in_slice = Window.partitionBy("source", "bucket").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    through = F.col("start") + F.sum("size").over(in_slice)
    ordered = spread.join(slices, spread["source"].eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    chosen = ordered.withColumn("middle", 2 * through - F.col("size")).filter(F.col("middle") <= 2 * F.col("rest"))
    cuts = chosen.groupBy("source").agg(F.max(F.struct("key", "id")).alias("cut")).select(
        F.col("source").alias("s"), F.col("cut.key").alias("cut_key"), F.col("cut.id").alias("cut_id"))
    return stored(tg.join(cuts, tg["source"].eqNullSafe(F.col("s")), "left").drop("s", "rest"), "mix-plan")


def _id() -> Column:
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))


def _copies() -> Column:
    """Times a document is taken, from its key, id and its source's plan."""
    within = (F.col("key") < F.col("cut_key")) | ((F.col("key") == F.col("cut_key")) & (_id() <= F.col("cut_id")))
    return F.col("epochs") + F.coalesce(within, F.lit(False)).cast("bigint")


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", _size().alias("size"), _key().alias("key"))


def taken(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    sized = stored(sizes(docs), "sizes")
    p = plan(sized).withColumnRenamed("source", "s")
    return sized.join(p, sized["source"].eqNullSafe(F.col("s"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.least(_copies(), F.lit(MAX_EPOCHS))).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix: every document as many times as it is taken, with its own columns."""
    p = plan(stored(sizes(docs), "sizes")).withColumnRenamed("source", "s").withColumn("words", F.col("source_size"))
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "doc_id", "source", _key().alias("key"))
    rows = rows.join(p, rows["source"].eqNullSafe(F.col("s")))
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.least(_copies(), F.lit(MAX_EPOCHS)).cast("int")))).select("row.*")
