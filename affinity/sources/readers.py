"""File and JDBC readers for the grade / basket inputs.

All parsing is done with built-in column functions (``split``, ``try_cast``,
``get``) so a malformed line becomes NULLs that are filtered out instead of a
task failure; nothing is parsed in Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.operators.ordering import with_positions

SCORE_SCHEMA = T.StructType([
    T.StructField("sno", T.StringType()),
    T.StructField("cno", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("term", T.StringType()),
    T.StructField("cohort", T.StringType()),
])


def key_predicates(key: str, bounds: list[str] | None = None, *, parts: int | None = None,
                   hash_expr: str = "CRC32({key})") -> list[str]:
    """WHERE texts that split a table by a string key into disjoint parts that cover every row.

    ``bounds`` (ascending, n of them) gives n + 1 ranges, NULL keys with the first one;
    ``parts`` deals keys by a hash the database computes (``hash_expr``, a number that may be
    negative; CRC32 as MySQL has it), NULL keys to part 0.
    """
    if (bounds is None) == (parts is None):
        raise ValueError("give either bounds or parts")
    if parts is not None:
        if parts < 1:
            raise ValueError(f"parts must be positive, got {parts}")
        part = f"MOD(ABS({hash_expr.format(key=key)}), {parts})"
        return [f"({part} = {i} " + (f"OR {key} IS NULL)" if i == 0 else f"AND {key} IS NOT NULL)") for i in range(parts)]
    if any(a >= b for a, b in zip(bounds, bounds[1:])):
        raise ValueError("bounds must ascend")
    quoted = ["'" + b.replace("'", "''") + "'" for b in bounds]
    if not quoted:
        return [f"({key} IS NULL OR {key} IS NOT NULL)"]
    inner = [f"({key} >= {a} AND {key} < {b})" for a, b in zip(quoted, quoted[1:])]
    return [f"({key} < {quoted[0]} OR {key} IS NULL)", *inner, f"({key} >= {quoted[-1]})"]


def key_bounds(keys: DataFrame, key: str, parts: int) -> list[str]:
    """Bounds of ``parts`` ranges with about equally many rows, from a table of the keys
    (an earlier extract or an index): ``parts - 1`` values reach the driver."""
    ranked = with_positions(keys.select(key).where(F.col(key).isNotNull()), key, position="_at")
    total = ranked.count()
    at = [total * i // parts + 1 for i in range(1, parts)]
    return sorted({r[key] for r in ranked.where(F.col("_at").isin(at)).collect()}) if total else []


def _jdbc(spark: SparkSession, url: str, table: str, properties: dict | None, split: dict) -> DataFrame:
    """A JDBC read, one query per range of a numeric column or per predicate of a string key."""
    opts = dict(properties or {})
    if split.get("predicates") is not None:
        return spark.read.jdbc(url, table, predicates=split["predicates"], properties=opts)
    if split.get("column") is not None:
        return spark.read.jdbc(url, table, column=split["column"], lowerBound=split["lower"], upperBound=split["upper"],
                               numPartitions=split["parts"] or 1, properties=opts)
    if split.get("key") is not None:
        return spark.read.jdbc(url, table, predicates=key_predicates(split["key"], split["bounds"], parts=None if split["bounds"] else split["parts"] or 1),
                               properties=opts)
    return spark.read.jdbc(url, table, properties=opts)


def read_scores(spark: SparkSession, path: str | None = None, fmt: str = "parquet", *,
                jdbc_url: str | None = None, table: str | None = None,
                properties: dict | None = None, partition_column: str | None = None,
                lower_bound: int | None = None, upper_bound: int | None = None,
                num_partitions: int | None = None, partition_key: str | None = None,
                key_bounds: list[str] | None = None, sep: str = ",") -> DataFrame:
    """Score table ``(sno, cno, score, term, cohort)`` from files or JDBC.

    JDBC reads are parallel when ``partition_column`` and bounds are given
    (one range query per partition) or a string ``partition_key`` (split by ``key_bounds``,
    else by hash into ``num_partitions``, see :func:`key_predicates`); filters and column
    pruning applied later are pushed into the generated SQL by Spark.
    """
    if jdbc_url is not None:
        return _typed_scores(_jdbc(spark, jdbc_url, table, properties, {
            "column": partition_column, "lower": lower_bound, "upper": upper_bound, "parts": num_partitions,
            "key": partition_key, "bounds": key_bounds}))
    if fmt == "parquet":
        return _typed_scores(spark.read.parquet(path))
    if fmt in ("csv", "tsv"):
        # Course file: positional (_, cno, score) or the full five columns.
        raw = spark.read.csv(path, sep="\t" if fmt == "tsv" else sep, header=False,
                             ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
        cols = raw.columns
        if len(cols) >= 5:
            df = raw.select(*[F.col(c) for c in cols[:5]]).toDF("sno", "cno", "score", "term", "cohort")
        else:
            df = raw.select(F.col(cols[0]).alias("sno"), F.col(cols[1]).alias("cno"),
                            F.col(cols[2]).alias("score"),
                            F.lit(None).cast("string").alias("term"),
                            F.lit(None).cast("string").alias("cohort"))
        return _typed_scores(df)
    raise ValueError(f"unsupported format {fmt!r}")


def _typed_scores(df: DataFrame) -> DataFrame:
    cols = df.columns
    if len(cols) < 3:
        raise ValueError(f"a score table has at least 3 columns (sno, cno, score), got {cols}")
    pick = {c.lower(): c for c in cols}
    for at, name in ((3, "term"), (4, "cohort")):  # by position where the names differ
        if name not in pick and len(cols) > at:
            pick[name] = cols[at]
    out = df.select(
        F.col(pick.get("sno", cols[0])).cast("string").alias("sno"),
        F.col(pick.get("cno", cols[1])).cast("string").alias("cno"),
        F.expr(f"try_cast(`{pick.get('score', cols[2])}` as double)").alias("score"),
        (F.col(pick["term"]).cast("string") if "term" in pick else F.lit(None).cast("string")).alias("term"),
        (F.col(pick["cohort"]).cast("string") if "cohort" in pick else F.lit(None).cast("string")).alias("cohort"),
    )
    return out.where(F.col("sno").isNotNull() & F.col("cno").isNotNull() & F.col("score").isNotNull())


def read_features(spark: SparkSession, path: str | None = None, *, key: str = "cno",
                  features: list[str] | None = None, fmt: str = "parquet",
                  jdbc_url: str | None = None, table: str | None = None,
                  properties: dict | None = None, header: bool = True, keyed: bool = False,
                  predicates: list[str] | None = None, num_partitions: int | None = None,
                  key_bounds: list[str] | None = None) -> DataFrame:
    """Feature table ``(key, f1..fn)`` (course profiles for k-means).

    Text input may be whitespace-padded and tab separated; blank fields are
    skipped and every remaining field must parse as a double (``keyed=True``: all
    but the first, which is the key). JDBC reads are split by the string key
    (``num_partitions`` hash parts, or ranges between ``key_bounds``) or by ``predicates``.
    """
    if jdbc_url is not None:
        df = _jdbc(spark, jdbc_url, table, properties, {
            "predicates": predicates, "key": key if num_partitions or key_bounds else None, "parts": num_partitions, "bounds": key_bounds})
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "text":
        # n doubles per line, tab separated, blanks dropped, header line skipped.
        lines = spark.read.text(path)
        # A header line does not parse as doubles and is dropped with that.
        parts = F.filter(F.transform(F.split("value", "\t"), lambda s: F.trim(s)), lambda s: s != "")
        fields = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))) if keyed else parts
        vals = F.transform(fields, lambda s: s.try_cast("double"))
        arr = lines.select(F.get(parts, 0).alias("k"), vals.alias("v")).where(~F.exists("v", lambda x: x.isNull()) & (F.size("v") > 0))
        if features is None:
            width = arr.agg(F.max(F.size("v"))).first()[0] or 0
            features = [f"f{i + 1}" for i in range(width)]
        n = features
        return arr.select(*([F.col("k").alias(key)] if keyed else []), *[F.get("v", i).alias(c) for i, c in enumerate(n)])
    else:
        df = spark.read.csv(path, sep="\t", header=header, inferSchema=False,
                            ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    cols = df.columns
    feats = features or [c for i, c in enumerate(cols) if c != key and (key in cols or i > 0)]
    out = df.select(F.col(key if key in cols else cols[0]).cast("string").alias(key),
                    *[F.col(c).try_cast("double").alias(c) for c in feats])
    cond = F.lit(True)
    for c in feats:
        cond = cond & F.col(c).isNotNull()
    return out.where(cond)


def read_pairs(spark: SparkSession, path: str, *, basket: str = "basket", item: str = "item",
               sep: str = "\t") -> DataFrame:
    """``basket<TAB>item`` lines without header; short lines dropped."""
    parts = F.split(F.col("value"), sep, -1)
    df = spark.read.text(path).select(F.get(parts, 0).alias(basket), F.get(parts, 1).alias(item))
    return df.where(F.col(basket).isNotNull() & F.col(item).isNotNull())


def read_ratings(spark: SparkSession, path: str, sep: str = ",", *, user: str = "sno",
                 item: str = "cno", value: str = "score") -> DataFrame:
    """``user<sep>item<sep>rating`` lines; ``sep`` is a regular expression."""
    parts = F.split(F.col("value"), sep, -1)
    df = spark.read.text(path).select(
        F.get(parts, 0).alias(user), F.get(parts, 1).alias(item),
        F.get(parts, 2).try_cast("double").alias(value))
    return df.where(F.col(user).isNotNull() & F.col(item).isNotNull() & F.col(value).isNotNull())


def read_wide_scores(spark: SparkSession, path: str, *, id_col: str | None = None,
                     sep: str = "\t") -> DataFrame:
    """Header-bearing score sheet: an id column then one double per attribute."""
    df = spark.read.csv(path, sep=sep, header=True, inferSchema=False,
                        ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    cols = df.columns
    idc = id_col or cols[0]
    return df.select(F.col(idc).alias("id"),
                     *[F.col(c).try_cast("double").alias(c) for c in cols if c != idc])


def read_baskets(spark: SparkSession, path: str, sep: str = " ", *, basket: str = "basket",
                 items: str = "items") -> DataFrame:
    """One basket per line, items separated by ``sep``; duplicates removed."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    arr = F.array_distinct(F.filter(F.split(F.trim(F.col("value")), sep, -1), lambda s: s != ""))
    return lines.select(F.monotonically_increasing_id().cast("string").alias(basket),
                        F.array_sort(arr).alias(items))
