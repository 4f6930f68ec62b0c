"""Item-item similarity: co-occurrence, cosine, and boosted variants.

Plan (for ``cosine``; ``cooccurrence`` is the same with counts as weights):

1. pre-aggregate ``a[u, i] = Σ weight`` per (user, item) — partial aggregation
   map-side, shuffle on (user, item), so a heavy user is spread by item — and
   checkpoint it (it feeds every later branch; the source runs once);
2. norms ``n[i] = Σ_u a[u, i]²`` straight from ``a``, attached to its rows;
3. dot products ``d[i, j] = Σ_u a[u, i]·a[u, j]`` for ``i < j`` only (half of
   the matrix, no diagonal) through a self-join on the user; the pair aggregate
   keeps both items' norms by ``max``, so the pair table is exchanged once and
   never joined;
4. ``sim = d / sqrt(n_i·n_j)``;
5. mirror each pair so both (i, j) and (j, i) are returned.

Heavy users: a user with ``D`` items emits ``D²/2`` pairs. The items of users with
more than ``heavy_items`` are dealt to ``ceil(D / heavy_items)`` blocks and the
self-join runs on ``(user, block_x, block_y)``, so a task's share of one user is
about ``heavy_items²`` pairs whatever the degree, at the price of sending each row
once per block. Light users keep one block (no replication). The heavy-user list is
counted first: none → plain self-join; at most ``HEAVY_BROADCAST_LIMIT`` → broadcast;
more → shuffle join. Blocks change only the task layout, never the result.

The self-join's tasks are as many as its pairs ask for (``PAIRS_A_TASK``): a task's pair
table would otherwise be as large as the rows that AQE puts together times the degree.

Duplicates of a (user, item) grade add up (retakes): with pre-aggregation the
result equals the reference's self-join over raw rows, because
``Σ_{r∈u,i} Σ_{s∈u,j} w_r w_s = a[u,i]·a[u,j]``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions import cosine as cosine_expr
from affinity.functions import unordered_pairs
from affinity.session import checkpoint_dir

HEAVY_ITEMS = 2000
HEAVY_BROADCAST_LIMIT = 200_000  # heavy users broadcast only below this checked count
PAIRS_A_TASK = 1_000_000


def pair_sides(a: DataFrame, user: str, heavy_items: int = HEAVY_ITEMS, blocks: int | None = None):
    """The two sides of the self-join of ``a(user, item, v, n, ...)``, as ``item1, v1, ...`` and
    ``item2, v2, ...``, and their keys.

    ``blocks``: blocks of a heavy user; by default as many as its degree asks for, 1 for none.
    """
    degrees = a.groupBy(user).agg(F.count(F.lit(1)).alias("_deg"))
    n_heavy, n_pairs = degrees.agg(F.count_if(F.col("_deg") > heavy_items),
                                   F.coalesce(F.sum(F.col("_deg").cast("double") * (F.col("_deg") - 1) / 2), F.lit(0.0))).first()
    tasks = max(1, math.ceil(n_pairs / PAIRS_A_TASK))
    heavy = None
    if blocks != 1 and n_heavy:  # bounded by |a| / heavy_items; checked before any broadcast
        n_blocks = F.ceil(F.col("_deg") / F.lit(max(heavy_items, 1))) if blocks is None else F.lit(blocks)
        heavy = degrees.where(F.col("_deg") > heavy_items).select(user, n_blocks.cast("int").alias("_nb"))
        if n_heavy <= HEAVY_BROADCAST_LIMIT:
            heavy = F.broadcast(heavy)
    one, two = ([F.col(user), *[F.col(c).alias(f"{c}{k}") for c in a.columns if c != user]] for k in (1, 2))
    if heavy is None:
        dealt, keys = a.repartition(tasks, user), [user]
        return dealt.select(*one), dealt.select(*two), keys
    a2 = a.join(heavy, user, "left")
    nb = F.coalesce(F.col("_nb"), F.lit(1))
    blk = F.pmod(F.xxhash64("item"), nb.cast("long")).cast("int")
    fan = F.explode(F.sequence(F.lit(0), nb - 1))
    keys = [user, "_bx", "_by"]
    return (a2.select(*one, blk.alias("_bx"), fan.alias("_by")).repartition(tasks, *keys),
            a2.select(*two, blk.alias("_by"), fan.alias("_bx")).repartition(tasks, *keys), keys)


def _normalised(a: DataFrame, user: str, blocks: int | None, heavy_items: int, towards: DataFrame | None = None) -> DataFrame:
    # The stored ``a`` feeds the norms, and with them both join sides and the degrees; that form
    # too is written once to the shared checkpoint folder so nothing below it is computed twice.
    norms = a.groupBy("item").agg(F.sum(F.col("v") * F.col("v")).alias("n"))
    if towards is not None:
        wanted = towards.toDF("item").distinct().withColumn("to", F.lit(True))
        norms = norms.join(wanted, "item", "left").withColumn("to", F.coalesce("to", F.lit(False)))
    x, y, keys = pair_sides(a.join(norms, "item").checkpoint(eager=True), user, heavy_items, blocks)
    pairs = x.join(y, keys).where(F.col("item1") < F.col("item2"))
    to = []
    if towards is not None:
        pairs = pairs.where(F.col("to1") | F.col("to2"))
        to = [F.max("to1").alias("to1"), F.max("to2").alias("to2")]
    half = (pairs.groupBy("item1", "item2")
            .agg(F.sum(F.col("v1") * F.col("v2")).alias("dot"), F.max("n1").alias("n1"), F.max("n2").alias("n2"), *to)
            .withColumn("sim", cosine_expr("dot", "n1", "n2")).where(F.col("sim").isNotNull()))
    both = [F.struct(F.col("item1").alias("i"), F.col("item2").alias("j")),
            F.struct(F.col("item2").alias("i"), F.col("item1").alias("j"))]
    if towards is not None:
        both = [F.when(F.col("to2"), both[0]), F.when(F.col("to1"), both[1])]
    out = half.select(F.explode(F.array_compact(F.array(*both)) if to else F.array(*both)).alias("_p"), "sim")
    return out.select(F.col("_p.i").alias("item1"), F.col("_p.j").alias("item2"), "sim")


def pair_weights(df: DataFrame, user: str, item: str, weight: str) -> DataFrame:
    return df.groupBy(user, F.col(item).alias("item")).agg(F.sum(F.col(weight).cast("double")).alias("v"))


def cosine(df: DataFrame, user: str = "sno", item: str = "cno", weight: str = "weight",
           blocks: int | None = None, heavy_items: int = HEAVY_ITEMS, towards: DataFrame | None = None,
           summed: bool = False) -> DataFrame:
    """Cosine similarity ``Σ w_i w_j / sqrt(Σ w_i² Σ w_j²)`` over users.

    Returns ``(item1, item2, sim)`` for every co-rated pair in both orders,
    without the diagonal. Items with a zero norm produce no rows. With ``towards``
    (one column of items) only the rows whose ``item2`` is among them. ``summed``: ``df`` has
    one row for each (user, item) and is stored already.
    """
    if summed:
        a = df.select(user, F.col(item).alias("item"), F.col(weight).cast("double").alias("v"))
    else:
        # feeds the norms and the join sides: written once
        checkpoint_dir(df.sparkSession)
        a = pair_weights(df, user, item, weight).checkpoint(eager=True)
    return _normalised(a, user, blocks, heavy_items, towards)


def cooccurrence(df: DataFrame, user: str = "sno", item: str = "cno",
                 blocks: int | None = None, heavy_items: int = HEAVY_ITEMS) -> DataFrame:
    """Co-occurrence similarity ``n_ij / sqrt(n_i n_j)`` (ratings ignored).

    ``n_ij`` counts (row, row) matches per user, so a repeated (user, item)
    row counts with its multiplicity, as in a self-join of the raw rows.
    """
    checkpoint_dir(df.sparkSession)
    a = (df.groupBy(user, F.col(item).alias("item"))
         .agg(F.count(F.lit(1)).cast("double").alias("v"))).checkpoint(eager=True)
    return _normalised(a, user, blocks, heavy_items)


def itemset_pair_support(itemsets: DataFrame, items: str = "items", freq: str = "freq") -> DataFrame:
    """``(a < b, cnt)``: summed frequency of the itemsets containing both a and b."""
    pairs = itemsets.select(F.explode(unordered_pairs(items)).alias("_p"), freq)
    return (pairs.select(F.least("_p.a", "_p.b").alias("a"), F.greatest("_p.a", "_p.b").alias("b"),
                         F.col(freq).cast("double").alias("f"))
            .groupBy("a", "b").agg(F.sum("f").alias("cnt")))


def boost_by_itemsets(sim: DataFrame, itemsets: DataFrame, weight: float = 32.0,
                      items: str = "items", freq: str = "freq") -> DataFrame:
    """``sim + weight · cnt / total`` for every pair.

    ``cnt`` is the summed frequency of the frequent itemsets containing both
    items (0 when none), ``total`` the summed frequency of all frequent
    itemsets, singletons included. With no itemsets the boost is 0.
    """
    total = itemsets.agg(F.sum(F.col(freq).cast("double"))).scalar()
    support = itemset_pair_support(itemsets, items, freq)
    key1 = F.least("item1", "item2")
    key2 = F.greatest("item1", "item2")
    j = sim.join(support, (key1 == support.a) & (key2 == support.b), "left")
    share = F.coalesce(F.try_divide(F.coalesce(F.col("cnt"), F.lit(0.0)), total), F.lit(0.0))
    return j.select("item1", "item2", (F.col("sim") + share * F.lit(float(weight))).alias("sim"))


def boost_by_pairs(sim: DataFrame, pairs: DataFrame, a: str = "a", b: str = "b",
                   value: str = "value") -> DataFrame:
    """``sim + value`` where ``(item1, item2)`` matches an unordered pair.

    A pair listed more than once (in either order) adds the sum of its values.
    """
    p = (pairs.select(F.least(a, b).alias("_a"), F.greatest(a, b).alias("_b"),
                      F.col(value).cast("double").alias("_v"))
         .groupBy("_a", "_b").agg(F.sum("_v").alias("_v")))
    j = sim.join(p, (F.least("item1", "item2") == p._a) & (F.greatest("item1", "item2") == p._b), "left")
    return j.select("item1", "item2", (F.col("sim") + F.coalesce("_v", F.lit(0.0))).alias("sim"))
