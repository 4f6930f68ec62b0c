"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def deficit(score, cut: float) -> Column:
    """Weight of a (user, item) grade: how far below ``cut`` it is."""
    return F.lit(float(cut)) - col(score).cast("double")


def cosine(dot, norm1, norm2) -> Column:
    """``dot / sqrt(norm1 * norm2)``; NULL (not an error) for a zero norm."""
    return F.try_divide(col(dot), F.sqrt(col(norm1) * col(norm2)))


def joined(arr, sep: str = ",") -> Column:
    """Sorted array rendered as one string, for reports and comparisons."""
    return F.array_join(F.array_sort(col(arr)), sep)


def slot(arr, i: int) -> Column:
    """Element ``i`` (0-based) of an array or NULL when the array is shorter."""
    return F.get(col(arr), i)


def unordered_pairs(arr) -> Column:
    """Array of structs ``(a, b)`` for every pair of positions i < j.

    Used on small arrays only (frequent itemsets); the caller explodes it.
    """
    return F.expr(
        f"flatten(transform(sequence(1, size({arr})), i -> "
        f"transform(slice({arr}, i + 1, size({arr})), b -> "
        f"named_struct('a', element_at({arr}, i), 'b', b))))"
    )


def nearest_index(value, centres) -> Column:
    """Index of the centre closest to ``value``; ties go to the later centre.

    ``centres`` is an array column (one entry per cluster, NULL = absent);
    the result is NULL when no centre is present.
    """
    v = col(value)
    c = col(centres)
    idx = F.aggregate(
        F.sequence(F.lit(0), F.size(c) - 1),
        F.lit(-1),
        lambda acc, i: F.when(F.get(c, i).isNull(), acc)
        .when(acc < 0, i)
        .when(F.abs(v - F.get(c, i)) <= F.abs(v - F.get(c, acc)), i)
        .otherwise(acc),
    )
    return F.when(v.isNotNull() & (idx >= 0), idx)  # NULL without a value or a centre


def nearest_index_k(value, centres, kmax: int) -> Column:
    """:func:`nearest_index` for arrays of at most ``kmax`` centres, as a plain
    CASE chain (whole-stage codegen, compiled once when the centres are a
    column rather than literals). Same result: the last closest centre."""
    v = col(value)
    c = col(centres)
    out = F.lit(None).cast("int")
    for i in range(kmax):
        ci = F.get(c, i)
        cond = ci.isNotNull()
        for j in range(kmax):
            if j == i:
                continue
            cj = F.get(c, j)
            closer = F.abs(v - ci) < F.abs(v - cj) if j > i else F.abs(v - ci) <= F.abs(v - cj)
            cond = cond & (cj.isNull() | closer)
        out = F.when(cond, F.lit(i)).otherwise(out)
    return out


def fixed(x, digits: int = 3) -> Column:
    """Fixed-point text, e.g. ``%1.3f`` in the score sheets (NULL stays NULL)."""
    return F.when(col(x).isNotNull(), F.format_string(f"%.{digits}f", col(x)))


def squash(x, how: str | None) -> Column:
    """Optional monotone squash of a prediction (``'atan'``)."""
    if how is None:
        return col(x)
    if how == "atan":
        return F.atan(col(x))
    raise ValueError(f"unknown squash {how!r}")
