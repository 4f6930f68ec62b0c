"""Quality rules by weak supervision (DataFrame and SQL functions only).

Every rule votes +1 (good), -1 (bad) or 0 (abstains) on a document.
Expectation-maximisation over the counts of the vote patterns (at most 3^rules
rows, whatever the corpus size) estimates, without labels, how often each rule
votes or abstains on good and on bad documents, hence its accuracy; a document is kept when its posterior
probability of being good is at least ``threshold`` and it passes the base rule.

Defined results: NULL text is an empty text (no words, base rule fails, no
votes); repeated rows each get a row; an empty table gives no rows; other
columns of the input are ignored by ``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACES, lines_of, stored, words_of

WINDOW = 8
ITERATIONS = 25
START = 0.9  # first posterior of documents with more good votes than bad ones
SMOOTHING = 1.0  # pseudo-votes behind every (rule, class, vote)

# Rules as SQL over the base numbers: name -> (condition, vote).
RULES: dict[str, tuple[str, int]] = {
    "symbols": ("n_words > 0 AND 5 * n_symbols >= n_words", -1),
    "table": ("n_words > 0 AND 5 * n_bars >= n_words", -1),
    "shouting": ("n_upper > 0 AND 5 * n_upper >= 2 * word_chars", -1),
    "exclaiming": ("n_words > 0 AND 2 * n_exclaim >= n_words", -1),
    "copied_lines": ("n_text_lines >= 4 AND 5 * n_dup_lines >= 2 * n_text_lines", -1),
    "copied_words": ("n_words > 0 AND 4 * n_repeat_words >= n_words", -1),
    "few_words": ("n_words >= 50 AND 4 * n_distinct_words < n_words", -1),
    "word_lengths": ("n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)", -1),
    "sentences": ("n_text_lines > 0 AND 5 * n_ended_lines >= 3 * n_text_lines AND 50 * n_symbols <= n_words", 1),
    "prose": ("n_words > 0 AND 2 * word_chars >= 7 * n_words AND word_chars <= 8 * n_words AND 50 * n_symbols <= n_words", 1),
    "calm": ("n_words > 0 AND n_symbols = 0 AND 10 * n_exclaim <= n_words AND 5 * n_upper <= word_chars", 1),
}


@dataclass(frozen=True)
class Model:
    """Share of good documents; per rule the probabilities of the votes
    -1, 0, +1 on good and then on bad documents."""

    good: float
    votes: tuple[tuple[float, ...], ...]

    def accuracies(self) -> dict[str, float]:
        """Per rule, the share of its votes that agree with the estimated class."""
        out = {}
        for (name, (_, value)), p in zip(RULES.items(), self.votes, strict=True):
            on_good, on_bad = self.good * p[value + 1], (1 - self.good) * p[value + 4]
            out[name] = (on_good if value > 0 else on_bad) / (on_good + on_bad)
        return out


def base_numbers(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The counts the rules use, one row per input row; no shuffle.

    Repeated 8-word windows are found per document on window hashes: texts
    without a repeated hash stop there, the others sort (hash, position).
    """
    w = WINDOW
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select(*keep, text.alias("__t")).select(
        *keep, "__t", words_of(F.col("__t")).alias("__w"),
        F.filter(lines_of(F.col("__t")), lambda x: x.rlike(rf"[^{SPACE}]")).alias("__l"))
    out = out.select(
        *keep,
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("__t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("__t") - F.length(F.regexp_replace("__t", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.size("__l").cast("long").alias("n_text_lines"),
        F.size(F.filter("__l", lambda x: x.rlike(rf'[.!?"][{SPACE}]*\z'))).cast("long").alias("n_ended_lines"),
        (F.length("__t") - F.length(F.regexp_replace("__t", r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        (F.length("__t") - F.length(F.replace(F.col("__t"), F.lit("!"), F.lit("")))).cast("long").alias("n_exclaim"),
        F.size(F.filter("__w", lambda x: x == "|")).cast("long").alias("n_bars"),
        F.size(F.array_distinct("__w")).cast("long").alias("n_distinct_words"),
        F.transform("__w", lambda x: F.xxhash64(x)).alias("__h"))
    h = F.col("__h")
    out = out.withColumn("__h", F.when(
        F.size(h) >= w,
        F.transform(F.sequence(F.lit(0), F.size(h) - w), lambda i: F.xxhash64(*[h[i + k] for k in range(w)])))
        .otherwise(F.array().cast("array<bigint>")))
    out = out.withColumn("__s", F.when(
        F.size(F.array_distinct("__h")) < F.size("__h"),
        F.sort_array(F.transform("__h", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    s, last = F.col("__s"), F.size("__s") - 1
    out = out.withColumn("__p", F.when(s.isNotNull(), F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), last),
                 lambda k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["x"] == s[k]["x"]))
                 | ((k < last) & (s[F.least(k + 1, last)]["x"] == s[k]["x"]))),
        lambda k: s[k]["i"]))))
    p = F.col("__p")
    end = F.size("__p") - 1
    covered = F.aggregate(
        F.sequence(F.lit(0), end), F.lit(0).cast("long"),
        lambda a, k: a + F.when(k == end, F.lit(w)).otherwise(F.least(F.lit(w), p[F.least(k + 1, end)] - p[k])))
    return out.withColumn("n_repeat_words", F.when(p.isNotNull(), covered).otherwise(F.lit(0).cast("long"))) \
        .drop("__h", "__s", "__p")


def vote(name: str) -> Column:
    condition, value = RULES[name]
    return F.when(F.expr(condition), F.lit(value)).otherwise(F.lit(0))


def fit(numbers: DataFrame) -> Model:
    """Expectation-maximisation on the vote-pattern counts, as one SQL expression.

    The state is one array: the share of good documents, then for every rule the
    probabilities of the votes -1, 0, +1 given good and given bad.
    """
    m = len(RULES)
    patterns = numbers.select(F.array(*[vote(r) for r in RULES]).alias("v")).groupBy("v").agg(F.count("*").alias("n"))
    pats = patterns.agg(F.sort_array(F.collect_list(F.struct("v", F.col("n").cast("double").alias("n")))).alias("pats"))

    def weighted(p, good):
        return F.struct(p["v"].alias("v"), p["n"].alias("n"), good.alias("g"))

    def by_majority(p):
        votes = F.aggregate(p["v"], F.lit(0), lambda a, x: a + x)
        return weighted(p, F.when(votes > 0, F.lit(START)).when(votes < 0, F.lit(1 - START)).otherwise(F.lit(0.5)))

    def by_state(state, p):
        def ratio(j):
            at = 6 * (j - 1) + 2 + p["v"][j - 1]
            return F.log(state[at]) - F.log(state[at + 3])

        score = F.aggregate(F.sequence(F.lit(1), F.lit(m)), F.log(state[0]) - F.log(1 - state[0]), lambda a, j: a + ratio(j))
        return weighted(p, 1 / (1 + F.exp(-score)))

    def total(rows, f):
        return F.aggregate(rows, F.lit(0.0), lambda a, r: a + f(r))

    def maximise(rows):
        everyone = total(rows, lambda r: r["n"])
        good = total(rows, lambda r: r["n"] * r["g"])

        def probability(k):
            j, bad, value = F.floor(k / 6), F.floor(k / 3) % 2 == 1, k % 3 - 1
            weight = F.when(bad, everyone - good).otherwise(good)
            hits = total(rows, lambda r: F.when(r["v"][j.cast("int")] == value, r["n"] * F.when(bad, 1 - r["g"]).otherwise(r["g"]))
                         .otherwise(F.lit(0.0)))
            return (hits + SMOOTHING) / (weight + 3 * SMOOTHING)

        return F.concat(F.array((good + SMOOTHING) / (everyone + 2 * SMOOTHING)),
                        F.transform(F.sequence(F.lit(0), F.lit(6 * m - 1)), probability))

    def let(value, f):
        return F.transform(F.array(value), f)[0]

    start = let(F.transform("pats", by_majority), maximise)
    state = pats.select(F.aggregate(
        F.sequence(F.lit(2), F.lit(ITERATIONS)), start,
        lambda st, _: let(F.transform(F.col("pats"), lambda p: by_state(st, p)), maximise)).alias("s")).first()["s"]
    return Model(state[0], tuple(tuple(state[1 + 6 * j:7 + 6 * j]) for j in range(m)))


def verdict(numbers: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Add base_failed, posterior and kept to the base numbers."""
    score = F.lit(math.log(model.good) - math.log(1 - model.good))
    for (condition, value), p in zip(RULES.values(), model.votes, strict=True):
        cast, silent = (math.log(p[v + 1]) - math.log(p[v + 4]) for v in (value, 0))
        score = score + F.when(F.expr(condition), F.lit(cast)).otherwise(F.lit(silent))
    failed = F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    return (numbers.withColumn("base_failed", failed)
            .withColumn("posterior", F.round(1 / (1 + F.exp(-score)), 6))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)))


def score(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, the base numbers, base_failed, kept, posterior."""
    numbers = stored(base_numbers(docs), "quality")
    return verdict(numbers, fit(numbers), threshold).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents the rules keep, with their own columns. The model is fitted
    on one pass; a second pass filters in place, so no text is shuffled."""
    model = fit(stored(base_numbers(docs, ()), "quality"))
    keep = tuple(docs.columns)
    if len(set(keep)) != len(keep):
        raise ValueError("column names must be distinct")
    own = docs.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in keep]))
    judged = verdict(base_numbers(own, ("__row",)), model, threshold)
    # explode() drops the others; a filter would be moved down and repeat all expressions
    return judged.select("__row", F.explode(F.when(F.col("kept"), F.array(F.lit(1))))).select("__row.*")
