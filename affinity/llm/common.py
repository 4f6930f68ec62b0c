"""Helpers shared by the corpus operators: word rule, table access, scratch tables."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# A word is a run of anything but space, tab, LF, VT, FF, CR.
SPACE = r"\x20\x09-\x0D"
SPACES = rf"[{SPACE}]+"
WORD = rf"[^{SPACE}]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's code to the Python workers, once per application: they
    need not have it installed, nor share a working folder with the driver."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="affinity-code-")) / "affinity_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words of ``text`` (NULL: empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def lines_of(text: Column) -> Column:
    """Array of the \\n-separated lines (NULL or empty text: one empty line)."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def own_prefix(df: DataFrame) -> str:
    """A prefix that no column of ``df`` has, for working columns beside its own."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: a result used
    more than once is computed once and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unit_hash(*cols: Column) -> Column:
    """Deterministic uniform number in (0, 1) from the MD5 of the columns' text."""
    text = F.concat_ws("\x1f", *[c.cast("string") for c in cols])
    h = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return (h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
