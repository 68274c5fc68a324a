"""The training table, and a report of the questions that do not reach it."""

from functools import reduce

from pyspark.sql import functions as F

from ..functions.html import clean_html
from ..functions.scalars import pos_share
from ..operators.answers import answer_features
from ..operators.forums import forum_flags, forum_list
from ..operators.nlp import with_nlp
from ..operators.tags import tag_features
from ..operators.users import user_history, user_status
from ..operators.votes import KEY, Texts, asked_texts, described, questions_of, with_scores
from ..schemas import ANSWER
from ..session import written
from .names import (
    ANSWER_NAMES,
    HISTORY_NAMES,
    QUESTION_NAMES,
    STATUS_NAMES,
    TAG_NAMES,
    WORD_CLASSES,
)


def renamed(names):
    return [F.col(old).alias(new) for old, new in names.items()]


def word_columns():
    """Word features under their training names, 0 where there are no words."""

    def side(name, counts):
        words = F.col(f"{name}_n_words")
        return [
            *[
                F.coalesce(F.col(f"{name}_n_{c}"), F.lit(0)).alias(f"post_{name}_{out}_count")
                for c, out in counts.items()
            ],
            *[
                pos_share(F.col(f"{name}_n_{c}"), words).alias(f"post_{name}_{out}_perc")
                for c, out in WORD_CLASSES.items()
            ],
        ]

    title = {"words": "word", "distinct_words": "word_distinct"}
    return [
        *side("body", {"sentences": "sentence", **title}),
        *side("title", title),
        F.coalesce("title_in_body_perc", F.lit(0.0)).alias("post_title_in_body_perc"),
    ]


def _narrow(status, history, tags, answers, kept=lambda df, name: df):
    """The narrow tables under their training names, joined; `kept` is what becomes of each one before that."""
    parts = {
        "status": status.select(*KEY, "user_id", *renamed(STATUS_NAMES)),
        "history": history.select(*KEY, *renamed(HISTORY_NAMES)),
        "tags": tags.select(*KEY, *renamed(TAG_NAMES)),
        "answers": answers.select(*KEY, *renamed(ANSWER_NAMES)),
    }
    return reduce(lambda left, right: left.join(right, KEY), [kept(df, name) for name, df in parts.items()])


def _training_columns(joined, forums):
    kept = joined.where((F.col("body_n_characters") > 0) & (F.col("title_n_characters") > 0))
    table = kept.select(
        *KEY,
        "post_datetime",
        "post_hour",
        "post_dayofweek",
        "post_month",
        "post_year",
        *renamed(QUESTION_NAMES),
        *word_columns(),
        *TAG_NAMES.values(),
        "user_id",
        *STATUS_NAMES.values(),
        *HISTORY_NAMES.values(),
        "post_closed_flag",
        "post_score",
        "post_score_1d",
        "post_score_30d",
        *ANSWER_NAMES.values(),
    )
    return table if forums == [] else forum_flags(table, forums)


def assemble_model_data(questions, status, history, tags, answers, nlp=None, forums=None):
    """Training table: one row per question that all feature tables know.

    `questions` may already hold the word features; otherwise pass them as `nlp`. The narrow
    tables are joined first, so that body and title go through one join only. Without `forums`
    the forum flags are taken from the data.
    """
    narrow = _narrow(status, history, tags, answers)
    if nlp is not None:
        narrow = narrow.join(nlp.drop("body_clean_nocode", "title"), KEY)
    return _training_columns(questions.join(narrow, KEY), forums)


def build_model_data(posts, votes, users, badges, lexicon=None, forums=None, texts=Texts()):
    """Training table from the entity tables.

    All joins are on the same key, so texts that the posts hold are shuffled once. Texts that are elsewhere are
    brought when all else is joined, and not shuffled. The narrow tables are written to the shared folder one after
    another, so that the shuffle files of one are gone before the next one needs room. Without `forums`, all forums
    that ask questions get a flag.
    """
    if forums is None:
        forums = forum_list(questions_of(posts))
    narrow = _narrow(
        user_status(posts, users, badges),
        user_history(posts),
        tag_features(posts),
        answer_features(posts, votes),
        kept=written,
    )
    joined = with_scores(asked_texts(posts, texts), posts, votes, kept=written).join(narrow, KEY)
    return _training_columns(with_nlp(described(texts.attach(joined)), lexicon=lexicon), forums)


def drop_reasons(posts, users):
    """Questions per reason for not reaching the training table; the first that holds counts.

    Each reason is looked up by itself: the author among the users, the answers among the posts.
    """
    length = F.length(clean_html(F.col("body")))
    asked = questions_of(posts).select(
        "dataset_name",
        F.col("id").alias("post_id"),
        F.col("owner_user_id").alias("user_id"),
        (F.size("tags") > 0).alias("has_tags"),
        (length > 0).alias("has_body"),
        (F.length("title") > 0).alias("has_title"),
    )
    authors = users.select("dataset_name", F.col("id").alias("user_id")).distinct()
    answers = posts.where(F.col("post_type_id") == ANSWER).select(
        "dataset_name", F.col("parent_id").alias("post_id"), F.col("owner_user_id").alias("answerer")
    )
    by_other = F.col("answerer").isNull() | (F.col("answerer") != F.col("user_id"))
    answered = (
        answers.join(asked.select(*KEY, "user_id"), KEY)
        .groupBy(*KEY)
        .agg(F.max(F.coalesce(by_other, F.lit(False))).alias("by_others"))
    )
    joined = asked.join(authors.withColumn("known", F.lit(True)), ["dataset_name", "user_id"], "left")
    joined = joined.join(answered, KEY, "left")
    reason = (
        F.when(F.col("user_id").isNull(), "no author")
        .when(F.col("known").isNull(), "unknown author")
        .when(~F.coalesce("has_tags", F.lit(False)), "no tags")
        .when(~F.coalesce("by_others", F.lit(True)), "only own answers")
        .when(~F.coalesce("has_body", F.lit(False)), "empty body")
        .when(~F.coalesce("has_title", F.lit(False)), "empty title")
        .otherwise("kept")
    )
    return joined.groupBy(reason.alias("reason")).agg(F.count("*").alias("n_questions"))
