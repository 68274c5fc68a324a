"""Word-level features of text columns, computed row by row where the text lies."""

from pyspark.sql import functions as F

from ..functions.html import clean_html_nocode
from ..functions.profile import NAMES, pair_profile, word_profile
from ..functions.words import sentence_count
from .votes import KEY, questions_of


def text_features(df, text_col, prefix, lexicon=None):
    """Add sentence, word, distinct-stem and word-class counts of a text, and its stems."""
    text = F.col(text_col)
    counted = df.withColumn("_profile", word_profile(lexicon)(text))
    return counted.withColumns(
        {
            f"{prefix}_n_sentences": sentence_count(text),
            **{f"{prefix}_n_{name}": F.col("_profile")[name] for name in NAMES},
            f"{prefix}_stems": F.col("_profile.stems"),
        }
    ).drop("_profile")


def with_nlp(df, body="body_clean_nocode", title="title", lexicon=None):
    """Add the word features of body and title, and the share of title stems in the body."""
    # generated ahead of the profile, so that no row waits for its word counts with its text
    split = df.select("*", F.explode(F.array(sentence_count(F.col(body)))).alias("body_n_sentences"))
    counted = split.withColumn("_profile", pair_profile(lexicon)(F.col(body), F.col(title)))
    names = [f"{side}_n_{name}" for side in ("body", "title") for name in NAMES]
    shared = F.try_divide(F.col("_profile.n_shared"), F.col("_profile.title_n_distinct_words"))
    return counted.withColumns(
        {
            **{name: F.col("_profile")[name] for name in names},
            "title_in_body_perc": shared,
        }
    ).drop("_profile")


def questions_nlp(posts, lexicon=None):
    """One row per question: cleaned body, title and their word features."""
    asked = questions_of(posts).select(
        "dataset_name",
        F.col("id").alias("post_id"),
        clean_html_nocode(F.col("body")).alias("body_clean_nocode"),
        "title",
    )
    counts = [f"{side}_n_{name}" for side in ("body", "title") for name in NAMES]
    return with_nlp(asked, lexicon=lexicon).select(
        *KEY, "body_clean_nocode", "title", "body_n_sentences", *counts, "title_in_body_perc"
    )
