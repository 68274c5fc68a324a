"""Abbreviations learned from a corpus, by a log-likelihood ratio over word counts.

A word type is likely an abbreviation if it nearly always ends with a period. The ratio of the two hypotheses
(it does so as often as any word, or 99 times in 100) is scaled by the three factors that Kiss and Strunk
(2006) use for unsupervised sentence boundaries: short words, inner periods, and few uses without a period.
"""

from pyspark.sql import functions as F

from ..functions.sentences import core, split_tokens
from ..session import shared_dir

#: Share of an abbreviation's uses that end with a period.
WITH_PERIOD = 0.99
#: Least scaled ratio of an abbreviation.
LEAST_SCORE = 0.3


def period_counts(texts, text_col="text"):
    """Uses of each word type with and without a period at its end, over all texts.

    One pass with partial sums, so a word that is everywhere is added up before the shuffle. Types are lower
    case, have a letter and no digit; null texts have no words.
    """
    token = F.explode(split_tokens(F.col(text_col))).alias("token")
    found = texts.select(token).select(core(F.col("token")).alias("core"))
    word = F.lower(F.regexp_replace("core", r"\.+$", ""))
    typed = found.select(word.alias("word"), F.col("core").endswith(".").alias("ends"))
    return (
        typed.filter(F.col("word").rlike(r"\p{L}") & ~F.col("word").rlike("[0-9]"))
        .groupBy("word")
        .agg(F.count_if("ends").alias("n_with"), F.count_if(~F.col("ends")).alias("n_without"))
    )


def abbreviation_scores(counts):
    """Scaled ratio of each type that ends with a period at least once, and whether it is an abbreviation.

    `counts` is a table of `period_counts`, which may be merged from those of several parts by adding up. The
    corpus-wide share is a scalar subquery over that table, so it is written to the shared folder first.
    """
    shared_dir(counts.sparkSession)
    counts = counts.checkpoint()
    uses = F.col("n_with") + F.col("n_without")
    share = counts.agg(F.sum("n_with") / F.sum(uses)).scalar()
    found = counts.filter("n_with > 0").withColumn("share", share)
    ratio = 2 * (
        F.col("n_with") * F.log(WITH_PERIOD / F.col("share"))
        # a corpus in which every word ends with a period has no abbreviations to tell
        + F.col("n_without") * F.log((1 - WITH_PERIOD) / F.greatest(1 - F.col("share"), F.lit(1e-9)))
    )
    inner = F.length("word") - F.length(F.replace("word", F.lit("."), F.lit("")))
    length = F.length("word") - inner
    scaled = ratio * F.exp(-length) * (inner + 1) * F.pow(length, -F.col("n_without"))
    score = F.when((F.col("share") < WITH_PERIOD) & (scaled > 0), scaled).otherwise(0.0)
    return found.select(
        "word", "n_with", "n_without", score.alias("score"), (score >= LEAST_SCORE).alias("abbreviation")
    )


def read_abbreviations(scores, max_words=50_000):
    """Abbreviations as a sorted list; raises if there are more than allowed.

    The list becomes part of the plan, so its size is checked before it is read.
    """
    rows = scores.filter("abbreviation").select("word").limit(max_words + 1).collect()
    if len(rows) > max_words:
        raise ValueError(f"more than {max_words} abbreviations")
    return sorted(row.word for row in rows)
