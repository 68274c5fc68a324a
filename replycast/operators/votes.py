"""Votes and question features."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import functions as F

from ..functions.html import body_lengths, html_flags, title_flags
from ..functions.scalars import date_parts, n_tags, presence_flag, with_defaults, within_days
from ..schemas import DOWN_VOTE, QUESTION, UP_VOTE

KEY = ["dataset_name", "post_id"]


class Texts(NamedTuple):
    """Where the texts of questions are: the columns of the posts that tell it, and what adds body and title to
    rows that have those columns.

    By default the posts hold them. Texts that lie elsewhere are brought last, so no join shuffles them.
    """

    columns: tuple = ("body", "title")
    attach: Callable = lambda rows: rows


def questions_of(posts):
    return posts.where(F.col("post_type_id") == QUESTION)


def daily_votes(votes, kinds):
    """Votes per post and day, one count column per vote type in `kinds` ({name: type}).

    A post has at most one row per day of its life, so the counts can be joined on the post
    however many votes it has.
    """
    kind = F.col("vote_type_id")
    return (
        votes.where(kind.isin(list(kinds.values())))
        .groupBy("dataset_name", "post_id", F.to_date("creation_date").alias("vote_day"))
        .agg(*[F.count(F.when(kind == value, 1)).alias(name) for name, value in kinds.items()])
    )


def net_votes(start, day, horizon):
    """Sum of up minus down votes within `horizon` days of `start`."""
    return F.sum(
        F.when(within_days(start, day, horizon), F.col("n_up") - F.col("n_down")).otherwise(0)
    )


def question_scores(posts, votes, horizons=(1, 30)):
    """Net votes of each question that has any, per horizon."""
    asked = questions_of(posts).select(
        "dataset_name", F.col("id").alias("post_id"), "creation_date"
    )
    daily = daily_votes(votes, {"n_up": UP_VOTE, "n_down": DOWN_VOTE})
    return (
        asked.join(daily, KEY)
        .groupBy(*KEY)
        .agg(
            *[
                net_votes(F.col("creation_date"), F.col("vote_day"), n).alias(f"post_score_{n}d")
                for n in horizons
            ]
        )
    )


def asked_texts(posts, texts=Texts()):
    """One row per question with what its own row tells, texts (or where they are) as they are."""
    return questions_of(posts).select(
        "dataset_name",
        F.col("id").alias("post_id"),
        F.col("creation_date").alias("post_datetime"),
        *texts.columns,
        "tags",
        n_tags(F.col("tags")).alias("n_tags"),
        presence_flag(F.col("closed_date")).alias("post_closed_flag"),
        F.col("score").alias("post_score"),
    )


def described(asked):
    """Add the features of body, title and date."""
    return title_flags(html_flags(body_lengths(date_parts(asked, "post_datetime"))))


def with_scores(texts, posts, votes, horizons=(1, 30), kept=lambda df, name: df):
    """Add the net votes per horizon to question rows, 0 for questions without votes; `kept` is what becomes of the
    votes before that."""
    joined = texts.join(kept(question_scores(posts, votes, horizons), "scores"), KEY, "left")
    return with_defaults(joined, {f"post_score_{n}d": 0 for n in horizons})


def question_features(posts, votes, horizons=(1, 30), texts=Texts(), kept=lambda df, name: df):
    """One row per question: cleaned texts, body, title, date and vote features.

    The votes are joined to the texts as they are, so each text is shuffled once and cleaned after; `texts`
    that are not in the posts are not shuffled. `kept` is as in `with_scores`.
    """
    scored = with_scores(asked_texts(posts, texts), posts, votes, horizons, kept)
    return described(texts.attach(scored)).select(
        *KEY,
        "post_datetime",
        "post_hour",
        "post_dayofweek",
        "post_month",
        "post_year",
        "body",
        "body_clean",
        "body_clean_nocode",
        "body_n_characters",
        "body_nocode_n_characters",
        "body_code_perc",
        "body_code_flag",
        "body_image_flag",
        "body_link_flag",
        "body_bold_flag",
        "title",
        "title_upper_flag",
        "title_question_flag",
        "title_n_characters",
        "tags",
        "n_tags",
        "post_closed_flag",
        "post_score",
        *[f"post_score_{n}d" for n in horizons],
    )
