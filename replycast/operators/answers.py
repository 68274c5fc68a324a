"""Answers of each question: counts, flags and scores per horizon."""

from pyspark.sql import functions as F

from ..functions.scalars import within_days
from ..schemas import ACCEPTED, ANSWER, DOWN_VOTE, UP_VOTE
from .votes import KEY, daily_votes, net_votes, questions_of

SCORE_DAYS = (1, 30)


def answer_scores(posts, votes, horizons=(1, 7, 14, 30)):
    """One row per question and answer that its asker did not write.

    A question without answers has one row with a null answer. A question whose answers are all
    its asker's own has none. If the asker is unknown, only answers by unknown authors count.
    """
    asked = questions_of(posts).select(
        "dataset_name",
        F.col("id").alias("post_id"),
        F.col("owner_user_id").alias("user_id"),
        F.col("creation_date").alias("post_datetime"),
    )
    answers = posts.where((F.col("post_type_id") == ANSWER) & F.col("parent_id").isNotNull())
    answers = answers.select(
        "dataset_name",
        F.col("parent_id").alias("post_id"),
        F.col("id").alias("answer_id"),
        F.col("creation_date").alias("answer_datetime"),
        F.coalesce(F.col("score"), F.lit(0)).alias("answer_score"),
        F.col("owner_user_id").alias("answerer"),
    )
    paired = answers.join(asked, KEY)
    by_others = paired.where(
        F.col("answerer").isNull() | (F.col("answerer") != F.col("user_id"))
    ).drop("answerer")
    unanswered = asked.join(answers.select(*KEY).distinct(), KEY, "left_anti").select(
        "*",
        F.lit(None).cast("bigint").alias("answer_id"),
        F.lit(None).cast("timestamp").alias("answer_datetime"),
        F.lit(0).cast("bigint").alias("answer_score"),
    )
    daily = daily_votes(votes, {"n_accept": ACCEPTED, "n_up": UP_VOTE, "n_down": DOWN_VOTE})
    voted = by_others.join(
        daily.withColumnRenamed("post_id", "answer_id"), ["dataset_name", "answer_id"], "left"
    )

    asked_at, day, accepts = F.col("post_datetime"), F.col("vote_day"), F.col("n_accept")
    named = {"answer_accepted_flag": accepts > 0}
    for n in horizons:
        named[f"answer_accepted_{n}d_flag"] = (accepts > 0) & within_days(asked_at, day, n)
    columns = ["answer_id", *KEY, "user_id", "post_datetime", "answer_datetime", "answer_score"]
    scored = voted.groupBy("dataset_name", *[c for c in columns if c != "dataset_name"]).agg(
        *[F.max(F.when(test, 1).otherwise(0)).alias(name) for name, test in named.items()],
        *[net_votes(asked_at, day, n).alias(f"answer_score_{n}d") for n in SCORE_DAYS],
    )
    zeros = unanswered.select(
        *columns,
        *[F.lit(0).alias(name) for name in named],
        *[F.lit(0).cast("bigint").alias(f"answer_score_{n}d") for n in SCORE_DAYS],
    )
    return scored.select(zeros.columns).unionByName(zeros)


def answer_features(posts, votes, horizons=(1, 7, 14, 30)):
    """One row per question of `answer_scores`: answer counts, flags and best scores."""
    scored = answer_scores(posts, votes, horizons)
    answer = F.col("answer_id")

    def in_time(n):
        return within_days(F.col("post_datetime"), F.col("answer_datetime"), n)

    def flag(test):
        return F.max(F.when(test, 1).otherwise(0))

    accepted = ["answer_accepted_flag", *[f"answer_accepted_{n}d_flag" for n in horizons]]
    return scored.groupBy(*KEY, "user_id").agg(
        F.count(answer).alias("n_answers"),
        *[F.count(F.when(in_time(n), answer)).alias(f"n_answers_{n}d") for n in SCORE_DAYS],
        flag(answer.isNotNull()).alias("answered_flag"),
        *[flag(in_time(n)).alias(f"answered_{n}d_flag") for n in horizons],
        F.max("answer_score").alias("answer_max_score"),
        *[F.max(f"answer_score_{n}d").alias(f"answer_max_score_{n}d") for n in SCORE_DAYS],
        *[F.max(c).alias(c) for c in accepted],
    )
