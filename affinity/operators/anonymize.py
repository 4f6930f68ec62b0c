"""Band-wise microaggregation: replace each value by its cluster centre.

Per attribute and grade band the values are clustered in one dimension with
``k`` tried from 3 down: the largest ``k`` whose clusters (those with the least squared
error) all have at least ``min_size`` members wins (k = 1, the band mean, always qualifies, even for a
single value — that value is then released as is, with ``cluster_size`` 1).

Fixed values (from the reference): bands ``<60, [60,70), [70,80), [80,90),
>=90``; training uses ``[90,100)`` for the top band while every value ``>=90``
is assigned there (when a top band has no training value its own values
train it); ``min_size`` 2; output precision 3 decimals.

Plan: bands and clusters are taken from the raw values; only a released centre
is rounded, by the caller. One histogram ``(attr, band, q, n)`` is built
with a partial aggregation; :func:`affinity.operators.clustering.exact_split` gives the
split of every (attr, band) and k with the least squared error; the chosen centres — at
most ``attrs × 5`` rows of 3 numbers — are joined back to the cells, by whatever join
their measured size allows. No group of rows is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions import fixed, nearest_index_k
from affinity.operators.clustering import exact_split
from affinity.session import checkpoint_dir

BAND_CUTS = (60.0, 70.0, 80.0, 90.0)
TOP = 100.0
KMAX = 3
MIN_SIZE = 2
DECIMALS = 3


def to_long(wide: DataFrame, id_col: str = "id", attrs: list[str] | None = None) -> DataFrame:
    """Wide sheet ``(id, a1..an)`` → ``(id, attr, value)`` (NULL cells dropped)."""
    attrs = attrs or [c for c in wide.columns if c != id_col]
    long = wide.unpivot(id_col, attrs, "attr", "value")
    return long.where(F.col("value").isNotNull())


def to_wide(cells: DataFrame, id_col: str = "id", attrs: list[str] | None = None,
            value: str = "value") -> DataFrame:
    """Long ``(id, attr, value)`` → one row per id, one column per attribute."""
    g = cells.groupBy(id_col)
    p = g.pivot("attr", attrs) if attrs is not None else g.pivot("attr")
    return p.agg(F.first(value))


def format_sheet(wide: DataFrame, attrs: list[str], id_col: str = "id", digits: int = DECIMALS) -> DataFrame:
    """Text lines of the anonymised sheet: fixed-point values, tab separated,
    with a trailing tab (the reference's print format); the id is kept as a
    separate column."""
    cells = [F.coalesce(fixed(F.col(f"`{a}`"), digits), F.lit("")) for a in attrs]
    return wide.select(id_col, F.concat(F.concat_ws("\t", *cells), F.lit("\t")).alias("value"))


def band(v) -> F.Column:
    """Grade band of a raw value: 0 for < 60, ... 4 for >= 90."""
    b = F.lit(len(BAND_CUTS))
    for i in reversed(range(len(BAND_CUTS))):
        b = F.when(v < F.lit(BAND_CUTS[i]), F.lit(i)).otherwise(b)
    return b


def microaggregate(cells: DataFrame, id_col: str = "id", attr: str = "attr", value: str = "value",
                   kmax: int = KMAX, min_size: int = MIN_SIZE,
                   suppress: bool = False) -> DataFrame:
    """``(id, attr, value, band, k, cluster, center, cluster_size)`` per cell.

    ``suppress=True`` turns centres of clusters smaller than ``min_size`` into
    NULL instead of releasing them.
    """
    checkpoint_dir(cells.sparkSession)
    raw = F.col(value).cast("double")
    c = (cells.select(F.col(id_col).alias("id"), F.col(attr).alias("attr"),
                      raw.alias("q"), band(raw).alias("band"),
                      (raw < TOP).alias("_in_range"))
         .where(F.col("q").isNotNull()))
    # Cells are read twice (histogram, then replacement): materialise them
    # once in the shared checkpoint folder instead of recomputing the source.
    c = c.checkpoint(eager=True)
    # Histogram of all cells: (attr, band, q, n), partial-aggregated; it feeds
    # training, sizes and selection, so it is materialised once as well.
    hist_all = (c.groupBy("attr", "band", "q", "_in_range").agg(F.count(F.lit(1)).alias("n"))
                .checkpoint(eager=True))
    eligible = (F.col("band") < len(BAND_CUTS)) | F.col("_in_range")
    # Does the band hold any training value? One row per (attr, band).
    has = hist_all.groupBy("attr", "band").agg(F.max(eligible.cast("int")).alias("_has"))
    hist = (hist_all.join(has, ["attr", "band"])
            .where(eligible | (F.col("_has") == 0))
            .select("attr", "band", F.col("q").cast("double").alias("v"), "n"))
    splits = exact_split(hist, kmax, ["attr", "band"])
    ok = (F.col("k") == 1) | (F.array_min("sizes") >= min_size)
    # Chosen centres: one row per (attr, band).
    chosen = (splits.where(ok).groupBy("attr", "band").agg(F.max(F.struct("k", "centres")).alias("b"))
              .select("attr", "band", "b.k", "b.centres").checkpoint(eager=True))
    cluster = nearest_index_k(F.col("q").cast("double"), "centres", kmax)
    # Cluster sizes over all cells: at most attributes × 5 × kmax rows.
    sizes = (hist_all.join(chosen, ["attr", "band"])
             .groupBy("attr", "band", cluster.alias("cluster"))
             .agg(F.sum("n").alias("cluster_size"))
             .checkpoint(eager=True))
    out = (c.join(chosen, ["attr", "band"])
           .withColumn("cluster", cluster)
           .withColumn("center", F.get(F.col("centres"), F.col("cluster")))
           .join(sizes, ["attr", "band", "cluster"]))
    if suppress:
        out = out.withColumn("center", F.when(F.col("cluster_size") >= min_size, F.col("center")))
    return out.select("id", "attr", F.col("q").alias("value"),
                      F.col("band").cast("int").alias("band"), F.col("k").cast("int").alias("k"),
                      F.col("cluster").cast("int").alias("cluster"), "center",
                      F.col("cluster_size").cast("long").alias("cluster_size"))
