"""Quality rules with risk-controlled cutoffs.

A rule is a score of a text (higher: worse) cut at a threshold. Thresholds are not guessed: for each
stratum and rule, a labelled holdout gives, for every possible cutoff, the number k of good documents
(of n) that the cutoff would reject. A cutoff is certified if

    P(Binomial(n, risk / rules) <= k) <= confidence error / (rules * strata)

which is the exact (Clopper-Pearson) test of "the true false-rejection rate exceeds risk / rules". The
cutoffs of one rule are tested from the loosest inward and the first failure ends the sequence (k only
grows, so does the p-value), hence no further correction inside a rule; rules and strata are corrected
by Bonferroni. With probability 1 - error, every stratum loses at most `risk` of its good documents to
the rules. Among certified cutoffs the one with the best (bad rejected - harm * good rejected) wins; a
rule without a positive one stays off. A stratum with too few labels certifies nothing.

Only DataFrame functions are used. The counts per (stratum, rule, cutoff) are pre-aggregated; a cutoff
is one of 1001 values, so no group of the later windows holds more than 1001 rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickscope.llm.common import broadcast_if_small, hidden, let, once, settle, shown, words_of

WINDOW = 5  # words of a repeated passage
SCALE = 1000  # cutoffs are thousandths
RULES = ("symbols", "capitals", "exclaims", "dup_lines", "repeats")


@dataclass(frozen=True)
class RiskParams:
    risk: float = 0.025  # share of good documents that all rules together may reject
    error: float = 0.05  # probability that the guarantee fails anywhere
    harm: float = 10.0  # rejecting one good document costs as much as keeping this many bad ones


def _repeat_words(words: Column) -> Column:
    """Words covered by 5-word windows that occur twice or more (first occurrences included).

    Windows are compared by a 64-bit hash chained over their words. One sort per text at most:
    O(n log n) for the longest document, and only if some window repeats.
    """
    n = F.size(words)
    windows = F.when(n >= WINDOW, F.transform(
        F.slice(words, 1, F.greatest(n - (WINDOW - 1), F.lit(1))),
        lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)])))

    def covered(h):
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = let(ordered, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"])))
        return let(starts, lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.coalesce(F.least(F.get(p, j + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0).cast("long"), lambda a, x: a + x))

    return let(windows, lambda h: F.when(
        h.isNull() | (F.size(F.array_distinct(h)) == F.size(h)), F.lit(0).cast("long")).otherwise(covered(h)))


def with_features(rows: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_capitals, n_exclaims,
    base_failed and one score column s_<rule> (0 to 1000) per rule. A null text counts as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    first = once(rows, _words=words_of(F.col(text)),
                 _lines=F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    counted = once(first, **{
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": _repeat_words(F.col("_words")),
        "n_capitals": F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long"),
        "n_exclaims": F.regexp_count(t, F.lit(r"[!?]")).cast("long"),
    }).drop("_words", "_lines")

    def share(num, den):
        return F.least(F.expr(f"({SCALE} * {num}) div greatest({den}, 1)"), F.lit(SCALE)).cast("int")

    return counted.withColumns({
        "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
        "s_symbols": share("n_symbols", "word_chars"),
        "s_capitals": share("n_capitals", "word_chars"),
        "s_exclaims": share("n_exclaims", "n_words"),
        "s_dup_lines": share("n_dup_lines", "n_lines"),
        "s_repeats": share("n_repeat_words", "n_words"),
    })


def _ln_factorial(n: Column) -> Column:
    """Exact table up to 20!, Stirling's series beyond (relative error under 1e-13)."""
    x = n.cast("double")
    big = (x * F.log(x) - x + 0.5 * F.log(2 * F.pi() * x) + 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5))
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(big)


def binomial_cdf(k: Column, n: Column, rate: float) -> Column:
    """P(Binomial(n, rate) <= k), summed downwards from k; 1 where k is above the mean (no test passes there).

    Terms fall geometrically below the mean, so the sum over the 40 standard deviations kept is exact
    to double precision.
    """
    log_pmf = (_ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k)
               + k * F.log(F.lit(rate)) + (n - k) * F.log1p(F.lit(-rate)))
    terms = F.least(k, (40 * F.sqrt(n * rate) + 100).cast("long"))
    steps = F.when(terms > 0, F.sequence(k, k - terms + 1, F.lit(-1).cast("long"))).otherwise(F.array().cast("array<long>"))
    one = F.lit(1.0)
    tail = F.aggregate(
        steps, F.struct(one.alias("t"), one.alias("s")),
        lambda a, j: let(a["t"] * j * (1 - rate) / ((n - j + 1) * rate),
                         lambda t: F.struct(t.alias("t"), (a["s"] + t).alias("s"))),
        lambda a: a["s"])
    return F.when(k > n * rate, F.lit(1.0)).otherwise(F.least(F.exp(log_pmf) * tail, F.lit(1.0)))


def thresholds(features: DataFrame, labels: DataFrame, stratum: str, params: RiskParams) -> DataFrame:
    """One row per stratum with its cutoff per rule (null: rule off).

    features: doc_id, the stratum column, base_failed and the scores. labels: doc_id, quality. A document
    labelled more than once is good only if every label says 1; null labels and ids are ignored. Documents
    that fail the base rules are no part of the holdout.
    """
    good = (labels.where("doc_id is not null and quality is not null")
            .groupBy(F.col("doc_id").alias("_label_id")).agg(F.min("quality").alias("_quality")))
    held = (features.where(~F.col("base_failed"))
            .join(good, features["doc_id"] == good["_label_id"])
            .select(F.col(stratum).alias("stratum"), (F.col("_quality") == 1).alias("good"),
                    F.posexplode(F.array(*[F.col(f"s_{r}") for r in RULES])).alias("rule", "cut")))
    counts = settle(held.groupBy("stratum", "rule", "cut").agg(
        F.sum(F.col("good").cast("long")).alias("good"),
        F.sum((~F.col("good")).cast("long")).alias("bad")), "quality-counts")
    strata = max(1, counts.select("stratum").distinct().count())
    group = Window.partitionBy("stratum", "rule")
    beyond = group.orderBy(F.col("cut").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rate = params.risk / len(RULES)
    tested = (counts
              .withColumns({"n": F.sum("good").over(group),
                            "k": F.sum("good").over(beyond), "hit": F.sum("bad").over(beyond)})
              # a score of 0 or a constant score says nothing; rejecting by it is never considered
              .where("cut > 0")
              .withColumn("p", binomial_cdf(F.col("k"), F.col("n"), rate))
              .where(F.col("p") <= params.error / (len(RULES) * strata))
              .withColumn("net", F.col("hit") - params.harm * F.col("k"))
              .where("net > 0"))
    best = (tested.groupBy("stratum", "rule")
            .agg(F.max_by("cut", F.struct("net", "cut")).alias("cut")))
    return best.groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == i, F.col("cut"))).alias(f"cut_{r}") for i, r in enumerate(RULES)])


def judge(features: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """Add `kept`: false if the base rules fail or a score reaches its stratum's cutoff."""
    cut = broadcast_if_small(settle(cutoffs, "quality-cutoffs").withColumnRenamed("stratum", "_stratum"))
    hit = F.lit(False)
    for r in RULES:
        hit = hit | F.coalesce(F.col(f"s_{r}") >= F.col(f"cut_{r}"), F.lit(False))
    return (features.join(cut, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
            .withColumn("kept", ~F.col("base_failed") & ~hit)
            .drop("_stratum", *[f"cut_{r}" for r in RULES]))


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang",
                     params: RiskParams = RiskParams(), carried: bool = True) -> DataFrame:
    """One row per document: doc_id, its stratum as _lang, its counts, base_failed, its scores and `kept`; the
    input's columns come along hidden if `carried`.

    Every document is measured once, into a table; the holdout joins its ids and scores with the labels, so no
    text is shuffled. Null stratum: a stratum of its own. Null and empty texts have no word, so they fail the
    base rules. Empty table: empty result. Repeated rows: judged alike. Columns of `docs` other than doc_id, text
    and the stratum take no part.
    """
    rows = docs.select(*(hidden(docs) if carried else []), F.col("doc_id"), F.col("text").alias("_text"),
                       F.col(stratum).alias("_lang"))
    measured = settle(with_features(rows, "_text").drop("_text"), "quality-scores")
    holdout = measured.select("doc_id", "_lang", "base_failed", *[f"s_{r}" for r in RULES])
    return judge(measured, thresholds(holdout, labels, "_lang", params), "_lang")


def quality_filter(docs: DataFrame, labels: DataFrame, stratum: str = "lang",
                   params: RiskParams = RiskParams()) -> DataFrame:
    """The rows of `docs` that the rules keep, with their own columns; special cases as in quality_verdicts."""
    return quality_verdicts(docs, labels, stratum, params).where("kept").select(*shown(docs))
