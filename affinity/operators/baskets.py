"""Frequent itemsets, association rules and rule-based suggestions.

The support threshold is ``ceil(min_support · baskets)`` and confidence is
``>= min_confidence``. Baskets are item *sets*: duplicates are removed before
mining (which rejects repeated items) and the arrays are sorted so every
report is deterministic. Items below the threshold leave the pairs before any
basket is built, so a basket holds frequent items only; baskets that lose all
their items stay, empty, and count in the threshold.

Mining is exact in two passes over equal parts of the baskets, each part held as
one bit per basket for every item (see :func:`mine`), so its work is a bit
intersection per itemset and part and never a tree of all baskets.

The mined itemsets are written once to the shared folder. Rules come from that
table by joins: an itemset less one item is another mined itemset.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions import joined, slot
from affinity.session import checkpoint_dir, scratch_path

_SEP = "\u0001"
PART_BASKETS = 1 << 16  # baskets of a part: 8 KB of bits an item
PART_ITEMS = 1 << 22  # items of a part's baskets together
ITEMS_BROADCAST_LIMIT = 200_000  # frequent items broadcast only below this checked count


@dataclass(frozen=True)
class Mined:
    """Itemsets ``(items sorted array, freq)`` mined from ``n`` baskets."""

    itemsets: DataFrame
    n: int
    min_confidence: float


def to_baskets(pairs: DataFrame, basket: str = "sno", item: str = "cno", items: str = "items",
               min_support: float | None = None, distinct: bool = False) -> DataFrame:
    """``(basket, items)``: the sorted distinct items of every basket.

    De-duplication is map-side, so a basket's array is bounded by the number of
    distinct items, not by its row count; with ``min_support`` by the number of
    items that ``ceil(min_support · baskets)`` baskets hold. ``distinct``: the pairs are
    distinct and stored already, so they are neither sent nor written again.
    """
    if min_support is None:
        return pairs.groupBy(basket).agg(F.array_sort(F.collect_set(item)).alias(items))
    # distinct pairs are read three times: baskets counted, items counted, baskets built
    checkpoint_dir(pairs.sparkSession)
    p = pairs.select(F.col(basket).alias("_b"), F.col(item).alias("_i"))
    if not distinct:
        p = p.distinct().checkpoint(eager=True)
    least = math.ceil(min_support * p.select("_b").distinct().count())
    # counted before the join, so that the pairs needn't be sent by their items, of which few may hold most
    frequent = p.groupBy("_i").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select("_i", F.lit(True).alias("_keep")).checkpoint(eager=True)
    if frequent.count() <= ITEMS_BROADCAST_LIMIT:
        frequent = F.broadcast(frequent)
    marked = p.join(frequent, "_i", "left").select("_b", F.when(F.col("_keep"), F.col("_i")).alias("_i"))
    return marked.groupBy("_b").agg(F.array_sort(F.collect_list("_i")).alias(items)).withColumnRenamed("_b", basket)


def _item_bits(part: pa.Table) -> pa.Table:
    """``(_p, _n, item, bits)``: of one part's baskets, the bit set of those that hold each item."""
    lists = part.column("_items").combine_chunks()
    codes = lists.flatten().dictionary_encode(null_encoding="encode")
    sizes = lists.value_lengths().to_numpy()
    basket, code = np.repeat(np.arange(len(sizes)), sizes), codes.indices.to_numpy()
    order = np.lexsort((basket, code))
    basket, code = basket[order], code[order]
    if ((np.diff(code) == 0) & (np.diff(basket) == 0)).any():
        raise ValueError("items in a basket must be unique")
    bits, row = [], np.zeros(-(-len(sizes) // 64) * 64, bool)
    for held in np.split(basket, np.flatnonzero(np.diff(code)) + 1) if len(code) else []:
        row[held] = True
        bits.append(np.packbits(row).tobytes())
        row[held] = False
    return pa.table({"_p": pa.array([part.column("_p")[0].as_py()] * len(bits), pa.int64()),
                     "_n": pa.array([len(sizes)] * len(bits), pa.int64()),
                     "item": codes.dictionary, "bits": pa.array(bits, pa.binary())})


def _bit_rows(part: pa.Table) -> np.ndarray:
    """The bit sets as rows of 64-bit words."""
    return np.frombuffer(b"".join(part.column("bits").to_pylist()), np.uint64).reshape(len(part), -1)


def _part_itemsets(part: pa.Table, least: int, n: int) -> pa.Table:
    """``(items, freq, _p, _least)``: the itemsets that hold in the part's share of ``least``
    of ``n`` baskets, by depth-first intersection of the items' bit sets."""
    share = max(1, -(-least * part.column("_n")[0].as_py() // n))
    codes, freq = [], []

    def grow(prefix: list[int], items: np.ndarray, rows: np.ndarray) -> None:
        held = np.bitwise_count(rows).sum(axis=1, dtype=np.int64)
        kept = np.flatnonzero(held >= share)
        items, rows = items[kept], rows[kept]
        for i, (item, count) in enumerate(zip(items.tolist(), held[kept].tolist(), strict=True)):
            codes.append([*prefix, item])
            freq.append(count)
            if i + 1 < len(items):
                grow(codes[-1], items[i + 1:], rows[i + 1:] & rows[i])

    grow([], np.arange(len(part)), _bit_rows(part))
    ends = np.cumsum([0, *map(len, codes)])
    flat = pa.array([c for items in codes for c in items], pa.int64())
    items = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), part.column("item").combine_chunks().take(flat))
    return pa.table({"items": items, "freq": pa.array(freq, pa.int64()),
                     "_p": pa.array([part.column("_p")[0].as_py()] * len(freq), pa.int64()),
                     "_least": pa.array([share] * len(freq), pa.int64())})


def _counted(part: pa.Table, wanted: pa.Table) -> pa.Table:
    """``(items, freq)``: in how many of the part's baskets each wanted itemset lies."""
    sets = wanted.column("items").combine_chunks()
    freq = np.zeros(len(sets), np.int64)
    if len(part):
        at = {item: i for i, item in enumerate(part.column("item").to_pylist())}
        rows = _bit_rows(part)
        for k, items in enumerate(sets.to_pylist()):
            if all(i in at for i in items):
                freq[k] = np.bitwise_count(np.bitwise_and.reduce(rows[[at[i] for i in items]], axis=0)).sum(dtype=np.int64)
    return pa.table({"items": sets, "freq": pa.array(freq)})


def mine(baskets: DataFrame, min_support: float, min_confidence: float = 0.0, items: str = "items",
         num_partitions: int | None = None) -> Mined:
    """Mine the frequent itemsets and write them.

    The baskets are checkpointed first, since they are read more than once and the
    source must not run as often, and dealt evenly to parts of about
    ``PART_BASKETS`` baskets or ``PART_ITEMS`` items (or ``num_partitions`` parts). An itemset in ``least`` of all
    baskets is in the part's share of them in at least one part, so the parts' own
    frequent itemsets are all candidates. Those that can still reach ``least``, were
    every part that did not report them one short of its share, are counted in these parts.
    """
    spark = baskets.sparkSession
    checkpoint_dir(spark)
    data = baskets.select(F.col(items).alias("_items")).checkpoint(eager=True)
    whole = data.where(F.col("_items").isNotNull())
    n_all, n, n_items = data.agg(F.count(F.lit(1)), F.count("_items"), F.coalesce(F.sum(F.array_size("_items").cast("long")), F.lit(0))).first()
    least = math.ceil(min_support * n)
    n_parts = min(max(n, 1), num_partitions or max(1, round(n / PART_BASKETS), round(n_items / PART_ITEMS)))
    array_type = data.schema["_items"].dataType.simpleString()
    item_type = data.schema["_items"].dataType.elementType.simpleString()
    dealt = whole.select(F.pmod(F.monotonically_increasing_id(), F.lit(n_parts)).alias("_p"), "_items")
    stored, path = scratch_path(spark, "item-bits"), scratch_path(spark, "itemsets")
    dealt.groupBy("_p").applyInArrow(_item_bits, f"_p long, _n long, item {item_type}, bits binary").write.parquet(stored)
    bits = spark.read.parquet(stored)
    found = bits.groupBy("_p").applyInArrow(lambda part: _part_itemsets(part, least, n), f"items {array_type}, freq long, _p long, _least long")
    found = found.withColumn("items", F.array_sort("items"))
    if n_parts > 1:
        found = _completed(found, bits, least, n, n_parts)
    found.select("items", "freq").write.parquet(path)
    return Mined(spark.read.parquet(path), n_all, min_confidence)


def _completed(found: DataFrame, bits: DataFrame, least: int, n: int, n_parts: int) -> DataFrame:
    """Itemsets in ``least`` baskets of all parts, from the parts' own ``found`` ones."""
    # Read twice (sums, parts to count). No part's share exceeds the longest part's.
    sums = found.groupBy("items").agg(F.sum("freq").alias("freq"), F.collect_set("_p").alias("_in")).checkpoint(eager=True)
    longest = bits.agg(F.max("_n")).first()[0] or 0
    short = max(1, -(-least * longest // n)) - 1
    absent = F.array_except(F.sequence(F.lit(0).cast("long"), F.lit(n_parts - 1).cast("long")), F.col("_in"))
    open_ = sums.where(F.col("freq") + (F.lit(n_parts) - F.size("_in")) * F.lit(short) >= least)
    missing = open_.select("items", F.explode(absent).alias("_p"))
    more = (bits.groupBy("_p").cogroup(missing.groupBy("_p"))
            .applyInArrow(_counted, f"items {dict(sums.dtypes)['items']}, freq long"))
    return (open_.select("items", "freq").unionByName(more).groupBy("items").agg(F.sum("freq").alias("freq"))
            .where(F.col("freq") >= least))


def frequent_itemsets(mined: Mined, size: int | None = None) -> DataFrame:
    """``(items sorted array, freq long, size int)``, of one ``size`` only if given."""
    out = mined.itemsets.select("items", "freq", F.size("items").alias("size"))
    return out if size is None else out.where(F.col("size") == size)


def association_rules(mined: Mined) -> DataFrame:
    """Rules with one consequent: ``(antecedent, consequent, confidence, lift, support)``.

    ``confidence = freq(A∪c)/freq(A)``, ``lift = confidence / (freq(c)/n)``,
    ``support = freq(A∪c)/n``.
    """
    fi, n = mined.itemsets, F.lit(float(max(mined.n, 1)))
    union = fi.where(F.size("items") > 1).select("items", F.col("freq").alias("_fu"), F.posexplode("items").alias("_at", "consequent"))
    union = union.withColumn("antecedent", F.filter("items", lambda x, i: i != F.col("_at")))
    union = union.withColumn("_ak", F.array_join("antecedent", _SEP))
    whole = fi.select(F.array_join("items", _SEP).alias("_ak"), F.col("freq").alias("_fa"))
    single = fi.where(F.size("items") == 1).select(F.get("items", 0).alias("consequent"), F.col("freq").alias("_fc"))
    confidence = F.col("_fu") / F.col("_fa").cast("double")
    return (union.join(whole, "_ak").join(single, "consequent").where(confidence >= mined.min_confidence)
            .select("antecedent", "consequent", confidence.alias("confidence"), (confidence / (F.col("_fc") / n)).alias("lift"),
                    (F.col("_fu") / n).alias("support")))


def itemsets_wide(itemsets: DataFrame, width: int = 4, keep_freq: bool = True) -> DataFrame:
    """Itemsets as ``item1..item{width}`` nullable columns next to the full set,
    ``items`` (comma-separated): sets longer than ``width`` stay distinct there."""
    cols = [slot(F.array_sort("items"), i).alias(f"item{i + 1}") for i in range(width)]
    cols.append(joined(F.array_sort("items")).alias("items"))
    if keep_freq:
        cols.append(F.col("freq"))
    return itemsets.select(*cols)


def rules_wide(rules: DataFrame, width: int = 4) -> DataFrame:
    """Rules as ``antecedent1..{width}, consequent, confidence`` and the full
    ``antecedent`` (comma-separated)."""
    cols = [slot(F.array_sort("antecedent"), i).alias(f"antecedent{i + 1}") for i in range(width)]
    return rules.select(*cols, "consequent", "confidence", joined(F.array_sort("antecedent")).alias("antecedent"))


def itemset_summary(itemsets: DataFrame) -> DataFrame:
    """Number of itemsets and summed frequency per itemset size."""
    return (itemsets.groupBy(F.size("items").alias("size"))
            .agg(F.count(F.lit(1)).alias("n_itemsets"), F.sum("freq").alias("total_freq")))


def rule_summary(rules: DataFrame) -> DataFrame:
    """Number of rules per antecedent size."""
    return rules.groupBy(F.size("antecedent").alias("size")).agg(F.count(F.lit(1)).alias("n_rules"))


def rule_text(rules: DataFrame, style: str = "brackets") -> DataFrame:
    """One-line rule text: ``[a,b]-->[c],conf`` or ``a,b-->c-->conf``."""
    ante = joined("antecedent")
    conf = F.col("confidence").cast("string")
    if style == "brackets":
        txt = F.concat(F.lit("["), ante, F.lit("]-->["), F.col("consequent"), F.lit("],"), conf)
    else:
        txt = F.concat(ante, F.lit("-->"), F.col("consequent"), F.lit("-->"), conf)
    return rules.select(txt.alias("value"))


def rule_candidates(rules: DataFrame, pairs: DataFrame, basket: str = "sno", item: str = "cno") -> DataFrame:
    """``(basket, antecedent, consequents)`` of the baskets that hold the antecedent's rarest
    item (fewest baskets), each antecedent once. ``pairs`` has distinct (basket, item) rows."""
    held = pairs.groupBy(F.col(item).alias("_i")).agg(F.count(F.lit(1)).alias("_n"))
    by_antecedent = (rules.groupBy(joined("antecedent", _SEP).alias("_ak"))
                     .agg(F.first("antecedent").alias("antecedent"), F.collect_set("consequent").alias("consequents")))
    items = by_antecedent.select("_ak", F.explode("antecedent").alias("_i")).join(held, "_i", "left")
    rarest = items.groupBy("_ak").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)), "_i")).alias("_r")).select("_ak", F.col("_r._i").alias("_i"))
    keyed = by_antecedent.join(rarest, "_ak").select("_i", "antecedent", "consequents")
    return pairs.select(F.col(basket), F.col(item).alias("_i")).join(keyed, "_i").drop("_i")


def recommend_from_rules(rules: DataFrame, pairs: DataFrame, basket: str = "sno",
                         item: str = "cno", distinct: bool = False) -> DataFrame:
    """Consequents of every rule whose antecedent lies inside a basket, minus
    items already in the basket, de-duplicated: ``(basket, item)``.

    A rule meets a basket only by its antecedent's rarest item; the rest of the
    antecedent is verified on the basket's item set, which also tells the
    consequents that are new. ``distinct``: the pairs are distinct and stored already.
    """
    # The distinct pairs are read three times (item counts, rarest items, sets).
    checkpoint_dir(pairs.sparkSession)
    p = pairs.select(F.col(basket).alias("_b"), F.col(item).alias("_i"))
    if not distinct:
        p = p.distinct().checkpoint(eager=True)
    sets = p.groupBy("_b").agg(F.collect_list("_i").alias("_items"))
    met = rule_candidates(rules, p, "_b", "_i").join(sets, "_b")
    met = met.where(F.size(F.array_except("antecedent", "_items")) == 0)
    new = met.select("_b", F.explode(F.array_except("consequents", "_items")).alias("_i")).distinct()
    return new.select(F.col("_b").alias(basket), F.col("_i").alias(item))
