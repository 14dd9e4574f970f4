"""Quality rules with risk-controlled cutoffs: exact binomial bounds on labelled documents, in each stratum."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sedimart.session import stage

SPACE = r"[\x20\x09-\x0D]+"
#: Share of clean documents that the rules of a stratum may reject together, and the chance that they reject more.
RISK, FAILURE = 0.05, 0.05
#: Candidate cutoffs of each measure, most lenient first. A document fails where its measure is above the cutoff.
CUTOFFS: dict[str, list[float]] = {
    "symbol_ratio": [5.0, 3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.4, 0.3, 0.2],
    "exclaim_ratio": [2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1],
    "upper_ratio": [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2],
    "dup_line_ratio": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15],
    "repeat_ratio": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2],
    "word_length": [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0, 11.0, 10.0],
}


def _word_windows(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in windows of three words that the text has twice or more.

    Windows are told apart by a 64-bit hash. Only a text with equal windows sorts them: by hash,
    with their places, so that equal ones are neighbours; a window covers its words up to the next
    repeated one. All of it stays in the row, so no text is shuffled. Each step is a column of its
    own, as lambdas refer to it at every element.
    """
    words, keys, sorted_, at = F.col("words"), F.col("__keys"), F.col("__sorted"), F.col("__at")
    hashed = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    df = df.withColumn("__keys", F.slice(hashed, 1, F.greatest(F.size(words) - 2, F.lit(0))))
    pairs = F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i")))
    df = df.withColumn("__sorted", F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.sort_array(pairs)))
    twice = F.filter(sorted_, lambda e, i: (e["k"] == F.get(sorted_, i - 1)["k"]) | (e["k"] == F.get(sorted_, i + 1)["k"]))
    df = df.withColumn("__at", F.sort_array(F.transform(twice, lambda e: e["i"])))
    covered = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("__keys", "__sorted", "__at")


def measures(df: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", carry: Sequence[str] = ()) -> DataFrame:
    """One row for each document: key, stratum, the columns of ``carry``, counts of its whole text, and the measures of ``CUTOFFS``.

    Words are runs of characters other than blanks and tabs to carriage returns; a null text has
    none. A measure with nothing to divide by is 0.
    """
    body = df.select(F.col(key).alias("key"), F.col(stratum).cast("string").alias("stratum"), F.coalesce(F.col(text), F.lit("")).alias("text"), *carry)
    seen = lambda line: F.trim(line, F.lit(" \t\n\x0b\x0c\r")) != ""
    body = body.select(
        "key", "stratum", *carry,
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), seen).alias("lines"),
        F.regexp_replace("text", r"[^A-Z#*$%&|<>!]+", "").alias("marks"),
    )
    without = lambda chars: F.length("marks") - F.length(F.translate("marks", chars, ""))
    counted = _word_windows(body).select(
        "key", "stratum", *carry,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        without("#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("lines").alias("n_lines"), without("!").alias("n_exclaim"), without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
    )
    share = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)
    return counted.select(
        "key", "stratum", *carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("n_symbols", "n_words").alias("symbol_ratio"),
        share("n_exclaim", "n_words").alias("exclaim_ratio"),
        share("n_upper", "word_chars").alias("upper_ratio"),
        share("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        share("n_repeat_words", "n_words").alias("repeat_ratio"),
        share("word_chars", "n_words").alias("word_length"),
    )


def _log_gamma(x: Column) -> Column:
    """ln of the gamma function for x of 1 or more: Stirling's series eight further on, and back."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    back = x
    for i in range(1, 8):
        back = back * (x + i)
    return series - F.log(back)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X of n draws with chance p each, where k is below the mean; else 1, an upper bound.

    The likeliest term comes first, at k; each further one is the last times a ratio below 1, and
    those beyond twelve standard deviations can't be told from 0.
    """
    n, k = n.cast("double"), k.cast("double")
    at_k = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    terms = F.least(k, 60 + 12 * F.sqrt(n * p)).cast("long")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def add(acc: Column, j: Column) -> Column:
        i = k - j + 1
        term = acc["term"] * i * (1 - p) / ((n - i + 1) * p)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    steps = F.when(terms >= 1, F.sequence(F.lit(1).cast("long"), terms)).otherwise(F.array().cast("array<long>"))
    total = F.aggregate(steps, start, add, lambda acc: acc["sum"])
    return F.when(k < n * p, F.least(F.lit(1.0), F.exp(at_k) * total)).otherwise(1.0)


def certified_cutoffs(measured: DataFrame, labels: DataFrame, cutoffs: dict[str, list[float]], risk: float, failure: float, key: str) -> DataFrame:
    """One row for each stratum with a cutoff: stratum and, by measure, the cutoff or null.

    Labelled documents are a holdout: no measure is fitted to them. In each stratum, a cutoff of a
    measure is certified if so few of the n clean ones lie above it that, were its true share of
    false rejections above risk / number of measures, so few or fewer would come up with a chance of
    at most failure / number of tests (the exact binomial tail; Bonferroni over strata, measures and
    cutoffs). So with a chance of 1 - failure no stratum's rules together reject more than ``risk``
    of its clean documents. Of the certified cutoffs of a measure the one that rejects most bad
    documents is taken, of these the most lenient.

    Of a document with several labels the largest counts; labels of null or without document are
    not used, nor those of an id that several rows have, as each label is one trial of the bound.
    """
    label = labels.filter(F.col("quality").isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max("quality").alias("quality"))
    # cutoffs fall, so a document is above a measure's last so many: their number says which
    above = lambda m, steps: F.size(F.filter(F.array(*map(F.lit, steps)), lambda c: F.col(m) > c))
    levels = [F.struct(F.lit(m).alias("measure"), F.lit(len(steps)).alias("steps"), above(m, steps).alias("above")) for m, steps in cutoffs.items()]
    trials = measured.join(label, "key").groupBy("key").agg(F.count("*").alias("rows"), *[F.first(c).alias(c) for c in ("stratum", "quality", *cutoffs)]).filter("rows = 1")
    counts = (
        trials.select("stratum", "quality", F.explode(F.array(*levels)).alias("level"))
        .groupBy("stratum", "level.measure", "level.steps", "level.above")
        .agg(F.count_if(F.col("quality") > 0).alias("clean"), F.count_if(F.col("quality") <= 0).alias("bad"))
    )
    counts = stage(counts, "levels")
    strata = counts.select("stratum").distinct().count()
    rejects = F.col("above") >= F.col("steps") - F.col("step")
    tests = (
        counts.withColumn("step", F.explode(F.sequence(F.lit(0), F.col("steps") - 1)))
        .groupBy("stratum", "measure", "step")
        .agg(F.sum("clean").alias("n"), F.sum(F.when(rejects, F.col("clean")).otherwise(0)).alias("k"), F.sum(F.when(rejects, F.col("bad")).otherwise(0)).alias("caught"))
    )
    chance = binomial_tail(F.col("n"), F.col("k"), risk / len(cutoffs))
    limit = failure / (max(strata, 1) * sum(map(len, cutoffs.values())))
    best = F.max(F.struct("caught", (-F.col("step")).alias("lenient")))
    chosen = tests.filter(chance <= limit).groupBy("stratum", "measure").agg((-best["lenient"]).alias("step"))
    values = {m: F.element_at(F.array(*map(F.lit, steps)), F.max(F.when(F.col("measure") == m, F.col("step") + 1))).alias(f"{m}_cutoff") for m, steps in cutoffs.items()}
    return chosen.groupBy("stratum").agg(*values.values())


def judge_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang",
    cutoffs: dict[str, list[float]] | None = None, risk: float = RISK, failure: float = FAILURE, carry: Sequence[str] = (),
) -> DataFrame:
    """One row for each document: key, n_words, the four counts, base_failed, kept and the columns of ``carry``.

    A document fails the base rules with fewer than 50 words, or with more than half of its words in
    repeated windows. It is kept if it passes them and is above no cutoff that ``labels`` (key,
    quality: above 0 is clean) certify for its stratum; a null stratum is one of its own. A stratum
    with too few labels for any certificate has no cutoffs, so its documents stand by the base rules.

    The measures are staged, narrow, so the texts are read once. Null and empty texts have no words.
    Repeated documents and null keys give a row each; empty tables give no rows, or no cutoffs.
    Other columns are not read. No Python runs on executors.
    """
    cutoffs = cutoffs or CUTOFFS
    measured = stage(measures(docs, key, text, stratum, carry), "measures")
    found = certified_cutoffs(measured, labels, cutoffs, risk, failure, key).withColumnRenamed("stratum", "of")
    fails = [F.coalesce(F.col(m) > F.col(f"{m}_cutoff"), F.lit(False)) for m in cutoffs]
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = measured.join(found, F.col("stratum").eqNullSafe(F.col("of")), "left")
    return judged.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~F.greatest(*fails)).alias("kept"), *carry,
    )
