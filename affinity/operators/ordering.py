"""Global order as a distributed operation: rows with their position, running sums.

``with_positions`` range-partitions the rows by the order, sorts each partition, writes
the rows once with (partition, place inside it), counts the partitions and adds up the
counts before each: position = offset + place. No task sees more than its range, and only
one row per partition (its count) is prefix-summed.

``running_sums`` does the same per group: rows are range-partitioned by (group, order), so a
group larger than a range spans several; each range sums its own rows, and the sums of a
group's earlier ranges (one row per range and group) are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.session import scratch_path

_PLACE_BITS = 33  # monotonically_increasing_id: partition above, row number below


def with_positions(df: DataFrame, *order: Column | str, position: str = "position",
                   partitions: int | None = None) -> DataFrame:
    """``df`` with ``position`` (1, 2, 3, ... in ``order``).

    The order's columns are the range keys as well, so a hot leading key (one user with a
    third of the rows) is split by the following ones; end with a column that tells rows
    apart. Rows equal in all of them get neighbouring positions in no defined order. An
    empty table gives no rows. ``partitions``: ranges, by default the shuffle partitions.
    """
    if not order:
        raise ValueError("with_positions needs an order")
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    if position in df.columns:
        raise ValueError(f"the input has a column {position!r} already")
    place, at, n_rows, offset = (_free(c, df.columns) for c in ("_place", "_part", "_n", "_offset"))
    path = scratch_path(spark, "ordered")
    (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .withColumn(place, F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path)
    part = F.shiftright(F.col(place), _PLACE_BITS)
    counts = rows.groupBy(part.alias(at)).agg(F.count(F.lit(1)).alias(n_rows))  # one row per range
    before = Window.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(at, F.coalesce(F.sum(n_rows).over(before), F.lit(0)).alias(offset))
    inside = F.col(place).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    # at most ``partitions`` rows of two numbers
    out = rows.join(F.broadcast(offsets), part == F.col(at))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(offset) + inside + 1).alias(position))


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def running_sums(df: DataFrame, group_cols: list[str], order: str, sums: dict[str, Column],
                 position: str = "pos", partitions: int | None = None) -> DataFrame:
    """``df`` with ``position`` (1, 2, ... inside its group by ``order``) and, for every name
    of ``sums``, the sum of that column expression over the group's rows so far.

    ``order`` must tell the rows of a group apart.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = _free("_part", df.columns)
    path = scratch_path(spark, "running")
    (df.select("*", *[c.alias(name) for name, c in sums.items()]).repartitionByRange(n, *group_cols, order)
     .withColumn(part, F.spark_partition_id()).write.parquet(path))
    rows = spark.read.parquet(path)
    inside = Window.partitionBy(part, *group_cols).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select(*df.columns, part, F.row_number().over(Window.partitionBy(part, *group_cols).orderBy(order)).alias(position),
                        *[F.sum(name).over(inside).alias(name) for name in sums])
    before = Window.partitionBy(*group_cols).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(part, *group_cols).agg(F.count(F.lit(1)).alias(position), *[F.sum(name).alias(name) for name in sums])
    earlier = totals.select(F.col(part).alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group_cols)],
                            *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_b{i}") for i, c in enumerate([position, *sums])])
    on = [local[part] == earlier["_p"], *[local[g].eqNullSafe(earlier[f"_g{i}"]) for i, g in enumerate(group_cols)]]
    return local.join(earlier, on).select(*df.columns, *[(F.col(c) + F.col(f"_b{i}")).alias(c) for i, c in enumerate([position, *sums])])
