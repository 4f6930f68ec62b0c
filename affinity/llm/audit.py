"""Audit of how filters interact: what each removes in every order of application.

Filters on one document alone give bits by SQL conditions in one scan. The filter of exact
copies is an existential self-join: a document fails if a row with its hash, its exact text
and a smaller doc_id exists (left-semi join). The ids it marks are united with the ids that
fail the others, bits are merged by id and counted by combination; all orders follow from
at most 2^filters counts a part.

Texts are shuffled only where their hash occurs under several ids. The other side of the
semi-join is one row per text with its smallest id (pre-aggregated in every task), copied
once per SALT_ROWS rows of its hash, so that a hot group of copies spreads over tasks.

Defined results: NULL text is the empty text (which is a text like any other for copies);
NULL source counts as the empty one; NULL doc_id is no smaller and no larger than any, so
it is neither a copy nor makes one, and has no label; rows that repeat a doc_id are documents of their own,
and copies of each other only of a smaller id; a doc_id labelled several times has a label
if one of its rows says so; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, words_of

# Filters on one document: letter -> failure condition over the columns of ``numbers``.
FILTERS = {
    "A": "n_words < 50",
    "B": "100 * n_distinct < 65 * n_words",
    "C": "100 * n_upper > 5 * n_points",
    "D": "has_symbol",
}
COPIES = "E"  # the filter of exact copies
SALT_ROWS = 1000  # rows of one hash that one task compares
BROADCAST_HASHES = 1_000_000  # repeated hashes (16 bytes each) sent to every task; beyond, texts are shuffled to them


def numbers(docs: DataFrame) -> DataFrame:
    """(doc_id, part, hash, n_words, n_distinct, n_upper, n_points, has_symbol); no shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("t"), words_of(text).alias("w"))
    return out.select(
        "doc_id", "part", _hash("t"), F.size("w").cast("long").alias("n_words"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        (F.length("t") - F.length(F.regexp_replace("t", "[A-Z]+", ""))).cast("long").alias("n_upper"),
        F.length("t").cast("long").alias("n_points"), F.col("t").rlike(r"[#$%&*|]").alias("has_symbol"))


def _hash(column: str):
    return F.unhex(F.md5(F.col(column).cast("binary"))).alias("hash")


def copies(docs: DataFrame, facts: DataFrame, salt_rows: int = SALT_ROWS, broadcast_hashes: int = BROADCAST_HASHES) -> DataFrame:
    """(doc_id, part, hash) of the rows whose exact text stands under a smaller doc_id.

    ``facts`` has (doc_id, hash) of every row of ``docs``.
    """
    groups = facts.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")) \
        .filter("low < high").select("hash", (F.lit(1) + F.expr(f"n div {salt_rows}")).cast("int").alias("salts"))
    groups = stored(groups, "audit-hashes")
    if groups.count() <= broadcast_hashes:
        groups = F.broadcast(groups)
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("hash", _hash("text")).join(groups, "hash")
    own = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "part"), F.col("salts")).cast("int"))
    first = rows.groupBy("hash", "text").agg(F.min("doc_id").alias("smallest"), F.max("salts").alias("salts"))
    first = first.select("hash", "text", "smallest", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    mine, other = own.alias("mine"), first.alias("other")
    same = [F.col(f"mine.{c}") == F.col(f"other.{c}") for c in ("hash", "salt", "text")]
    return mine.join(other, [*same, F.col("other.smallest") < F.col("mine.doc_id")], "left_semi").select("doc_id", "part", "hash")


def combinations(docs: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS, **options) -> DataFrame:
    """(part, bits, n, good, toxic): documents by the set of filters they fail, bit i for
    the i-th of ``filters`` and the highest bit for copies; ``good`` and ``toxic`` of them
    are labelled quality = 1 and toxic = 1."""
    bits = sum((F.when(F.expr(c), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(filters.values())), F.lit(0))
    facts = stored(numbers(docs).select("doc_id", "part", "hash", bits.alias("bits")), "audit-facts")
    marked = copies(docs, facts, **options).select("doc_id", "part", "hash", F.lit(1 << len(filters)).alias("bits"), F.lit(0).alias("n"))
    # a row's bits depend on its id, part and text alone, so equal ones stay together
    united = facts.withColumn("n", F.lit(1)).unionByName(marked).groupBy("doc_id", "part", "hash").agg(
        F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    known = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"))
    joined = united.join(known, F.col("doc_id") == F.col("id"), "left")
    return joined.groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS, **options) -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley."""
    letters = [*filters, COPIES]
    bit = {x: 1 << i for i, x in enumerate(letters)}
    steps = [F.struct(F.lit("".join(order)).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(bit[x]).alias("own"),
                      F.lit(sum(bit[y] for y in order[:k])).alias("before"))
             for order in permutations(letters) for k, x in enumerate(order)]
    n_orders = len(steps) // len(letters)
    # at most 2^filters counts a part
    parts = combinations(docs, labels, filters, **options).groupBy("part").agg(
        F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("c"))
    rows = parts.select("part", "c", F.explode(F.array(*steps)).alias("s")).select("part", "c", "s.*")
    own, before = F.col("own"), F.col("before")

    def total(condition, value=lambda x: x["n"]):
        return F.aggregate("c", F.lit(0).cast("bigint"),
                           lambda a, x: a + F.when(condition(x["bits"]), value(x)).otherwise(F.lit(0).cast("bigint"))).cast("bigint")

    def fails(b):
        return b.bitwiseAND(own) != 0

    def here(b):
        return fails(b) & (b.bitwiseAND(before) == 0)

    # a document that fails k filters is removed by each of them in 1 / k of the orders
    share = lambda x: x["n"] * F.expr(f"{n_orders}L") / F.bit_count(x["bits"])
    return rows.select(
        "part", "filter_order", "step",
        total(lambda b: b.bitwiseAND(own.bitwiseOR(before)) == 0).alias("kept"),
        total(here).alias("removed"),
        total(lambda b: fails(b) & (b.bitwiseAND(before) != 0)).alias("redundant"),
        total(lambda b: b == own).alias("unique_fails"),
        total(here, lambda x: x["good"]).alias("good_lost"),
        total(here, lambda x: x["toxic"]).alias("toxic_lost"),
        total(fails, lambda x: share(x).cast("bigint")).alias("shapley"))
