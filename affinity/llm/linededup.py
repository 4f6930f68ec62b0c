"""Line dedup on levelled sorted runs of line hashes.

A run is a Parquet table sorted by key with one row per line key: the number of
documents of its batch that hold it and the largest of their ids. Batches come by
falling doc_id. The distinct keys of a batch are merge-anti-joined with the runs: those
that no run has are added as the batch's own run at level 0, and their largest id is the
largest of all, because later batches have smaller ones. Keys that a run has only add to
that key's tally. So every key stands in one run, and tallies hold repeated keys alone.
``fanout`` runs of a level are merged into one run of the next, so a key is rewritten once
per level and a batch reads few runs.

Lines are counted by key before they are shuffled, so a common line is one row per task;
the keys held often enough (few, and counted before they are sent) go to the lines, which
are never shuffled by key. Texts are never compared or moved for any of that.

Keys: the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased,
hashed by MD5 (128 bits). Lines with shorter keys than ``min_chars`` are kept.

Defined results: NULL or empty text is one empty line, kept; a NULL doc_id holds
no line for the counts and loses none; repeated rows count as one document and
each gets a row; an empty table gives no rows; further columns are kept by
``drop_lines`` and ignored by ``digest``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import SPACE_CHARS, lines_of, own_prefix, stored

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 3
BROADCAST_KEYS = 1_000_000  # common line keys (24 bytes each) sent to every task; beyond, lines are shuffled to them
_RUN = "key binary, n_docs bigint, last_doc bigint"


def lower_ascii(x: Column) -> Column:
    """A-Z to a-z, other characters as they are."""
    return F.when(F.octet_length(x) == F.length(x), F.lower(x)).otherwise(
        F.translate(x, string.ascii_uppercase, string.ascii_lowercase))


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, version, pos, key) of every line long enough; ``version`` tells
    rows of one doc_id with different texts apart."""
    text = F.coalesce("text", F.lit(""))
    lines = docs.filter("doc_id IS NOT NULL").select(
        "doc_id", F.xxhash64(text).alias("version"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    stripped = lines.withColumn("line", F.btrim("line", F.lit(SPACE_CHARS))).filter(F.length("line") >= min_chars)
    return stripped.select("doc_id", "version", "pos", F.unhex(F.md5(lower_ascii(F.col("line")))).alias("key"))


class LineRuns:
    """Levelled sorted runs of line keys in the shared scratch folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = [[]]
        self.tallies: list[str] = []

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], _RUN)
        return self.spark.read.schema(_RUN).parquet(*paths)

    def _runs(self) -> DataFrame:
        """Every key once: (key, n_docs, last_doc) of the batch that brought it."""
        return self._read([p for level in self.levels for p in level])

    def _write(self, run: DataFrame, level: int) -> None:
        path = scratch_path(self.spark, f"line-run-{level}")
        run.sort("key").write.parquet(path)
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(path)

    def unseen(self, lines: DataFrame) -> DataFrame:
        """Merge-anti-join: the rows whose key is in no run."""
        return lines.join(self._runs().select("key"), "key", "left_anti")

    def add(self, lines: DataFrame) -> DataFrame:
        """Add the line keys of one batch, whose doc_ids are in no earlier batch: new keys as
        a run, the others to the tallies. Returns the new keys (key, n_docs, last_doc)."""
        own = stored(lines.groupBy("key").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("last_doc")), "line-batch")
        earlier = self._runs().select("key")
        known = own.join(earlier, "key", "left_semi")
        path = scratch_path(self.spark, "line-tally")
        known.write.parquet(path)
        self._write(self.unseen(own), 0)
        fresh = self._read([self.levels[0][-1]])
        self.tallies.append(path)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._read(full), level + 1)
            level += 1
        return fresh

    def keys(self) -> DataFrame:
        """(key, n_docs, last_doc) over all batches."""
        more = self._read(self.tallies).groupBy("key").agg(F.sum("n_docs").alias("more"), F.max("last_doc").alias("later"))
        return self._runs().join(more, "key", "left").select(
            "key", (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"), F.greatest("last_doc", "later").alias("last_doc"))

    def admit(self, lines: DataFrame) -> DataFrame:
        """Lines of a new batch that no earlier batch holds; the batch is then added."""
        fresh = stored(self.unseen(lines), "fresh-lines")
        self.add(lines)
        return fresh

    def surplus(self, lines: DataFrame, min_docs: int = MIN_DOCS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
        """The lines that at least ``min_docs`` documents hold, except each key's in its last document."""
        common = stored(self.keys().filter(F.col("n_docs") >= min_docs).select(F.col("key").alias("k"), "last_doc"), "common-lines")
        if common.count() <= broadcast_keys:
            common = F.broadcast(common)
        return lines.join(common, (F.col("key") == F.col("k")) & (F.col("doc_id") < F.col("last_doc")), "left_semi")


def _judged(docs: DataFrame, name: str, min_chars: int, min_docs: int, batches: int, broadcast_keys: int) -> DataFrame:
    """docs with {name}l (lines) and {name}keep (positions that stay)."""
    lines = stored(line_keys(docs, min_chars), "lines")
    cuts = lines.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)])).first()[0] if batches > 1 else None
    bounds = sorted({*(cuts or [])}, reverse=True)
    runs, doc = LineRuns(docs.sparkSession), F.col("doc_id")
    for high, low in zip([None, *bounds], [*bounds, None], strict=True):
        batch = lines if high is None else lines.filter(doc <= high)
        runs.add(batch if low is None else batch.filter(doc > low))
    dropped = runs.surplus(lines, min_docs, broadcast_keys).groupBy(F.col("doc_id").alias(f"{name}d"), F.col("version").alias(f"{name}v")).agg(
        F.collect_set("pos").alias(f"{name}drop"))
    out = docs.withColumn(f"{name}l", lines_of(F.col("text"))).join(
        dropped, (F.col("doc_id") == F.col(f"{name}d")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(f"{name}v")), "left")
    positions = F.sequence(F.lit(0), F.size(f"{name}l") - 1)
    return out.withColumn(f"{name}keep", F.when(F.col(f"{name}drop").isNotNull(), F.array_except(positions, f"{name}drop"))) \
        .drop(f"{name}d", f"{name}v", f"{name}drop")


def _kept_text(name: str) -> Column:
    lines = F.col(f"{name}l")
    return F.when(F.col(f"{name}keep").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform(f"{name}keep", lambda i: lines[i]), "\n"))


def digest(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES,
           broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256."""
    judged = _judged(docs.select("doc_id", "text"), "__", min_chars, min_docs, batches, broadcast_keys)
    n = F.size("__l").cast("long")
    return judged.select("doc_id", n.alias("n_lines"),
                         F.when(F.col("__keep").isNull(), F.lit(0)).otherwise(n - F.size("__keep")).cast("long").alias("n_dropped"),
                         F.sha2(_kept_text("__"), 256).alias("kept_sha256"))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES,
               broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """The documents with the surplus lines taken out of ``text`` (``n_chars`` follows); texts that lose none stay as they are."""
    p = own_prefix(docs)
    judged = _judged(docs, p, min_chars, min_docs, batches, broadcast_keys)
    text = F.when(F.col(f"{p}keep").isNull(), F.col("text")).otherwise(_kept_text(p))
    cols = {c: F.col(f"`{c}`") for c in docs.columns} | {"text": text}
    if "n_chars" in cols:
        cols["n_chars"] = F.when(F.col(f"{p}keep").isNull(), F.col("n_chars")).otherwise(F.length(_kept_text(p))).cast(
            docs.schema["n_chars"].dataType)
    return judged.select(*[c.alias(n) for n, c in cols.items()])
