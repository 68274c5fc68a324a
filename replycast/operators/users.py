"""Author features: status and badges, and posting history, as of each question."""

from pyspark.sql import functions as F

from ..functions.scalars import age_days, presence_flag
from ..schemas import ANSWER, QUESTION
from .skew import running_totals
from .votes import questions_of

USER = ["dataset_name", "user_id"]
BADGES = ["n_badges", "n_badges_class_1", "n_badges_class_2", "n_badges_class_3"]


def badge_marks():
    """0/1 columns per badge: any, and one per class; a badge without a name does not count."""
    named = F.col("name").isNotNull()
    tests = [named] + [named & (F.col("class") == level) for level in (1, 2, 3)]
    return {out: F.when(test, 1).otherwise(0) for out, test in zip(BADGES, tests)}


def profile(users):
    """Key, name and profile flags of each user."""
    return users.select(
        "dataset_name",
        F.col("id").alias("user_id"),
        F.col("display_name").alias("user_display_name"),
        F.col("creation_date").alias("user_since"),
        presence_flag(F.col("website_url")).alias("user_website_flag"),
        presence_flag(F.col("location")).alias("user_location_flag"),
        presence_flag(F.col("about_me")).alias("user_about_me_flag"),
    )


def user_status(posts, users, badges, totals=running_totals):
    """Per question with a known author: profile, age and badges held at the time of asking.

    Badges and questions form one event list per user; a running total up to and including the
    event's time replaces a join of each question to all earlier badges. `totals` may be `prefix_totals` with
    a path and a part, for the posts and badges of a new part.
    """
    asked = questions_of(posts).where(F.col("owner_user_id").isNotNull()).select(
        "dataset_name",
        F.col("owner_user_id").alias("user_id"),
        F.col("id").alias("post_id"),
        F.col("creation_date").alias("at"),
        *[F.lit(0).alias(b) for b in BADGES],
    )
    earned = badges.where(F.col("user_id").isNotNull() & F.col("date").isNotNull()).select(
        *USER,
        F.lit(None).cast("bigint").alias("post_id"),
        F.col("date").alias("at"),
        *[mark.alias(out) for out, mark in badge_marks().items()],
    )
    counted = totals(
        asked.unionByName(earned),
        USER,
        "at",
        {b: F.col(b) for b in BADGES},
        inclusive=True,
        wanted=F.col("post_id").isNotNull(),
    )
    known = counted.join(profile(users), USER)
    return known.select(
        "dataset_name",
        "post_id",
        "user_id",
        "user_display_name",
        age_days(F.col("user_since"), F.col("at")).alias("user_age_days"),
        "user_website_flag",
        "user_location_flag",
        "user_about_me_flag",
        *BADGES,
    )


def history_measures():
    """What is counted and summed over an author's posts, as columns of `posts`.

    Scores, answer counts and accepted marks are the values in the dump, not those at the time.
    """
    kind, score = F.col("post_type_id"), F.coalesce(F.col("score"), F.lit(0))

    def mark(test):
        return F.when(test, 1).otherwise(0)

    def part(value):
        return F.when(kind == value, score).otherwise(0)

    return {
        "n_user_posts": F.lit(1),
        "n_user_questions": mark(kind == QUESTION),
        "n_user_answers": mark(kind == ANSWER),
        "n_user_answered_questions": mark(F.col("answer_count") > 0),
        "n_user_accepted_answers": mark(F.col("accepted_answer_id").isNotNull()),
        "user_score": score,
        "user_question_score": part(QUESTION),
        "user_answer_score": part(ANSWER),
    }


def _history_columns():
    none_yet = {
        "user_first_post": F.col("n_user_posts") == 0,
        "user_first_question": F.col("n_user_questions") == 0,
    }
    flags = [F.when(test, 1).otherwise(0).alias(name) for name, test in none_yet.items()]
    names = list(history_measures())
    return [*names[:3], *flags, *names[3:]]


def user_history(posts, totals=running_totals):
    """Per question: what its author had posted strictly before it; zeros for unknown authors.

    `totals` may be `prefix_totals` with a path and a part, for the posts of a new part.
    """
    # of the accepted answer only the mark is used, and a mark is narrower than an id
    accepted = F.when(F.col("accepted_answer_id").isNotNull(), 1)
    measures = {out: column.cast("bigint") for out, column in history_measures().items()}
    asking = F.col("post_type_id") == QUESTION
    slim = posts.select(
        "dataset_name",
        F.col("owner_user_id").alias("user_id"),
        F.col("id").alias("post_id"),
        "post_type_id",
        F.col("creation_date").alias("at"),
        "score",
        "answer_count",
        accepted.alias("accepted_answer_id"),
    )
    counted = totals(slim.where(F.col("user_id").isNotNull()), USER, "at", measures, wanted=asking)
    unknown = slim.where(F.col("user_id").isNull() & asking).withColumns(
        {out: F.lit(0).cast("bigint") for out in measures}
    )
    asked = counted.unionByName(unknown)
    return asked.select("dataset_name", "post_id", "user_id", *_history_columns())


def user_totals(posts):
    """Per author: the measures of `user_history` over all posts."""
    owned = posts.where(F.col("owner_user_id").isNotNull())
    sums = [F.sum(column).cast("bigint").alias(out) for out, column in history_measures().items()]
    totals = owned.groupBy("dataset_name", F.col("owner_user_id").alias("user_id")).agg(*sums)
    return totals.select(*USER, *_history_columns())
