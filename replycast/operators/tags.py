"""Tag features: how much and how long the tags of a question had been in use."""

from pyspark.sql import functions as F

from ..functions.scalars import age_days
from .skew import running_totals
from .votes import KEY, questions_of

TAG = ["dataset_name", "tag"]


def question_tags(posts):
    """One row per question and tag occurrence; questions without tags have none."""
    return questions_of(posts).select(
        "dataset_name", F.col("id").alias("post_id"), "creation_date", F.explode("tags").alias("tag")
    )


def tag_start(posts):
    """First use of each tag."""
    return question_tags(posts).groupBy(*TAG).agg(F.min("creation_date").alias("tag_start_date"))


def tag_features(posts, horizons=(30, 365), totals=running_totals):
    """Per question: maximum and mean over its tags of earlier uses and of tag age.

    Uses within n days are all earlier uses less those at least n days older. A tag that a post
    repeats counts that many times, both as a use and in the counts of its own post. `totals` may be
    `prefix_totals` with a path and a part, for the posts of a new part.
    """
    tags = F.col("tags")
    uses = questions_of(posts).select(
        "dataset_name",
        F.col("id").alias("post_id"),
        "creation_date",
        F.explode(F.array_distinct(tags)).alias("tag"),
        "tags",
    )
    uses = uses.withColumn(
        "uses", F.size("tags") - F.size(F.array_remove(tags, F.col("tag")))
    ).drop("tags")
    counted = totals(
        uses,
        TAG,
        "creation_date",
        {"n_tag_posts": F.col("uses")},
        lags={f"older_{n}": (F.col("uses"), n) for n in horizons},
        first="tag_start_date",
    )
    times = F.col("uses")
    measures = {"n_tag_posts": F.col("n_tag_posts") * times}
    for n in horizons:
        measures[f"n_tag_posts_{n}d"] = (F.col("n_tag_posts") - F.col(f"older_{n}")) * times
    measures["tag_age_days"] = age_days(F.col("tag_start_date"), F.col("creation_date"))

    def named(measure, kind):
        head, _, days = measure.partition("n_tag_posts_")
        return f"n_tag_posts_{kind}_{days}" if days else f"{measure}_{kind}"

    per_tag = counted.select(*KEY, *[column.alias(out) for out, column in measures.items()])
    return per_tag.groupBy(*KEY).agg(
        *[F.max(m).alias(named(m, "max")) for m in measures],
        *[F.avg(m).alias(named(m, "avg")) for m in measures],
    )
