"""Writers for predictions, rules, itemsets, labels and text reports.

Writes are batched by Spark (``batchsize`` for JDBC) and a failed partition
fails the job: no row is dropped silently. Text output is coalesced to one
file only when ``single_file=True`` (meant for small reports).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREDICTION_COLS = ["sno", "cno", "pre_score"]
RULE_COLS = ["antecedent1", "antecedent2", "antecedent3", "antecedent4", "consequent", "confidence", "antecedent"]
ITEMSET_COLS = ["item1", "item2", "item3", "item4", "items", "freq"]
LABEL_COLS = ["cno", "label"]
_OPTIONAL = {"antecedent", "items", "freq"}  # written whenever the input has them


def _write(df: DataFrame, cols: list[str], path: str | None, table: str | None, jdbc_url: str | None,
           properties: dict | None, mode: str, fmt: str, batch_size: int) -> None:
    out = df.select(*[c for c in cols if c in df.columns or c not in _OPTIONAL])
    if jdbc_url is not None:
        props = dict(properties or {})
        props.setdefault("batchsize", str(batch_size))
        out.write.mode(mode).jdbc(jdbc_url, table, properties=props)
    elif table is not None and path is None:
        out.write.mode(mode).saveAsTable(table)
    else:
        out.write.mode(mode).format(fmt).save(path)


def write_predictions(df: DataFrame, path: str | None = None, *, table: str | None = None,
                      jdbc_url: str | None = None, properties: dict | None = None,
                      mode: str = "append", fmt: str = "parquet", batch_size: int = 10_000) -> None:
    """``(sno, cno, pre_score)`` rows; the target table is the caller's choice."""
    _write(df, PREDICTION_COLS, path, table, jdbc_url, properties, mode, fmt, batch_size)


def write_rules(df: DataFrame, path: str | None = None, **kw) -> None:
    """Wide rules ``(antecedent1..4, consequent, confidence, antecedent)``: the four slots and the whole set."""
    _write(df, RULE_COLS, path, kw.pop("table", None), kw.pop("jdbc_url", None), kw.pop("properties", None),
           kw.pop("mode", "append"), kw.pop("fmt", "parquet"), kw.pop("batch_size", 10_000))


def write_itemsets(df: DataFrame, path: str | None = None, **kw) -> None:
    """Wide itemsets ``(item1..item4, items, freq)``: the four slots, the whole set and its support."""
    _write(df, ITEMSET_COLS, path, kw.pop("table", None), kw.pop("jdbc_url", None), kw.pop("properties", None),
           kw.pop("mode", "append"), kw.pop("fmt", "parquet"), kw.pop("batch_size", 10_000))


def write_labels(df: DataFrame, path: str | None = None, **kw) -> None:
    """Cluster labels ``(cno, label)``."""
    _write(df, LABEL_COLS, path, kw.pop("table", None), kw.pop("jdbc_url", None), kw.pop("properties", None),
           kw.pop("mode", "append"), kw.pop("fmt", "parquet"), kw.pop("batch_size", 10_000))


def write_scores(df: DataFrame, path: str, partition_by: tuple[str, ...] = ("cohort",),
                 mode: str = "overwrite") -> None:
    """Grade table as parquet partitioned by cohort: the held-out / preview
    cohort filters then prune whole directories (``PartitionFilters``)."""
    cols = [c for c in df.columns if c not in partition_by] + list(partition_by)
    df.select(*cols).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_files(df: DataFrame, path: str, fmt: str = "parquet", sep: str = "\t", single_file: bool = False,
                mode: str = "overwrite", header: bool = False) -> None:
    """Plain files: parquet by default, or tab-separated text / csv.

    ``single_file`` coalesces to one task — only for small reports.
    """
    out = df.coalesce(1) if single_file else df
    if fmt == "parquet":
        out.write.mode(mode).parquet(path)
    elif fmt in ("csv", "tsv"):
        out.write.mode(mode).option("header", header).csv(path, sep=sep if fmt == "tsv" else ",")
    elif fmt == "text":
        cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
        out.select(F.concat_ws(sep, *cols).alias("value")).write.mode(mode).text(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
