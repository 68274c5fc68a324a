import pytest
from pyspark.sql import functions as F

from checks import registry, views
from replycast.operators import answers, forums, skew, tags, users, votes
from replycast.plans import features, scoring, snapshot
from tests.conftest import at

SMALL = "/root/testdata/sf0.001"


def same(one, other):
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


@pytest.fixture(scope="session")
def entities(spark):
    t = views.tables(spark, SMALL)
    return {name: t(name) for name in ("posts", "votes", "users", "badges")}


def vote(spark, *rows):
    schema = "post_id long, vote_type_id long, creation_date timestamp, dataset_name string"
    return spark.createDataFrame([(*r, "f") for r in rows], schema)


# --- running totals and lookups -----------------------------------------------------------------


def test_repeated_requests_are_answered_alike(spark, entities):
    asked = scoring.parse_requests(registry.requests(spark, SMALL)).drop("body", "title")
    known = registry._snapshots(spark, SMALL)
    once = scoring.enrich_requests(asked, *known).withColumn("tag_found", F.to_json("tag_found"))
    twice = scoring.enrich_requests(asked.union(asked), *known)
    twice = twice.withColumn("tag_found", F.to_json("tag_found"))
    assert same(twice, once.union(once))


def test_running_totals_with_some_hot_keys_and_ties(spark):
    """One key holds a third of the rows, with equal times and gaps of 29 and 30 days."""
    rows = [("hot", f"2020-01-{1 + i % 28:02d} {i % 24:02d}:00:00", i) for i in range(40)]
    rows += [("hot", "2020-03-01 10:00:00", 40), ("hot", "2020-03-01 10:00:00", 41)]
    rows += [(f"k{i % 30}", f"2020-02-{1 + i % 28:02d} 05:00:00", 100 + i) for i in range(80)]
    events = spark.createDataFrame(rows, "k string, t string, id int").select(
        "k", F.to_timestamp("t").alias("t"), "id"
    )
    got = skew.running_totals(
        events,
        ["k"],
        "t",
        {"n": F.lit(1), "ids": F.col("id")},
        lags={"old": (F.lit(1), 30)},
        first="since",
    )
    assert got.count() == events.count()
    b = events.select("k", F.col("t").alias("u"), F.col("id").alias("other"))
    pairs = events.join(b, "k").groupBy("k", "t", "id").agg(
        F.sum(F.when(F.col("u") < F.col("t"), 1).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("u") < F.col("t"), F.col("other")).otherwise(0)).alias("ids"),
        F.sum(F.when(F.datediff("t", "u") >= 30, 1).otherwise(0)).alias("old"),
        F.min("u").alias("since"),
    )
    assert same(got.select(pairs.columns), pairs)


def test_running_totals_of_events_without_a_time(spark):
    events = spark.createDataFrame([("a", None, 1), ("a", at("2020-01-01"), 2)], "k string, t timestamp, id int")
    got = skew.running_totals(events, ["k"], "t", {"n": F.lit(1)}, inclusive=True, first="since")
    assert sorted((r.id, r.n, r.since) for r in got.collect()) == [(1, 0, None), (2, 1, at("2020-01-01"))]


def test_running_totals_of_wanted_events_alone(spark):
    """Totals as of all events, keys and times that are null included; hours without a wanted event go early."""
    rows = [(k, t, i) for i, (k, t) in enumerate(
        (k, t) for k in ("a", "b", None) for t in ("2020-01-01 05:10:00", "2020-01-01 05:20:00", "2020-01-02 07:00:00", None)
        for _ in range(3)
    )]
    events = spark.createDataFrame(rows, "k string, t string, id int").withColumn("t", F.to_timestamp("t"))
    args = ["k"], "t", {"n": F.lit(1), "ids": F.col("id")}
    wanted = F.when(F.col("id") % 5 == 0, True)
    assert same(skew.running_totals(events, *args, wanted=wanted), skew.running_totals(events, *args).where(wanted))


def test_author_history_shuffles_no_measures(spark, make_posts):
    """What is shuffled for the posts are the four columns that the eight measures are made of."""
    history = users.user_history(make_posts({"id": 1, "owner_user_id": 2, "creation_date": at("2020-01-01")}))
    plan = history._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join LeftOuter"):].splitlines()[1:]
    posts = next(line for line in joined if "Project" in line)
    assert "n_user_" not in posts and "accepted_answer_id" in posts and "_asked" in posts


# --- rules ------------------------------------------------------------------------------------


def test_votes_count_by_calendar_day(spark, make_posts):
    posts = make_posts({"id": 1, "creation_date": at("2020-01-01 23:59"), "title": "t"})
    ballots = vote(
        spark,
        (1, 2, at("2020-01-01 00:00")),
        (1, 2, at("2020-01-02 00:00")),
        (1, 3, at("2020-01-31 00:00")),
        (1, 5, at("2020-01-01 00:00")),
        (2, 2, at("2020-01-01 00:00")),
    )
    row = votes.question_features(posts, ballots).head()
    assert (row.post_score_1d, row.post_score_30d) == (1, 2)


def answer(i, parent, owner, time, score=0):
    return {
        "id": i,
        "post_type_id": 2,
        "parent_id": parent,
        "owner_user_id": owner,
        "creation_date": at(time),
        "score": score,
    }


def test_own_answers_do_not_count(spark, make_posts):
    asked = {"creation_date": at("2020-01-01 12:00"), "title": "t"}
    posts = make_posts(
        {"id": 1, "owner_user_id": 7, **asked},
        {"id": 2, "owner_user_id": 7, **asked},
        {"id": 3, "owner_user_id": 7, **asked},
        {"id": 4, "owner_user_id": None, **asked},
        {"id": 5, "owner_user_id": None, **asked},
        answer(11, 1, 7, "2020-01-02 12:00"),
        answer(21, 2, 7, "2020-01-02 12:00"),
        answer(22, 2, 8, "2019-12-01 12:00", score=4),
        answer(41, 4, 8, "2020-01-02 12:00"),
        answer(51, 5, None, "2020-01-05 12:00"),
    )
    ballots = vote(spark, (22, 1, at("2020-01-04 00:00")))
    found = {r.post_id: r for r in answers.answer_features(posts, ballots).collect()}
    assert sorted(found) == [2, 3, 5]
    assert (found[2].n_answers, found[2].answered_1d_flag, found[2].answer_max_score) == (1, 1, 4)
    assert (found[2].answer_accepted_1d_flag, found[2].answer_accepted_7d_flag) == (0, 1)
    assert (found[3].n_answers, found[3].answered_flag, found[3].answer_max_score) == (0, 0, 0)
    assert (found[5].n_answers_1d, found[5].n_answers_30d, found[5].answered_7d_flag) == (0, 1, 1)


def test_history_is_strictly_earlier(make_posts):
    posts = make_posts(
        {"id": 1, "owner_user_id": 7, "creation_date": at("2020-01-01 12:00"), "score": 3,
         "answer_count": 1, "accepted_answer_id": 9},
        {"id": 2, "owner_user_id": 7, "creation_date": at("2020-01-02 12:00")},
        {"id": 3, "owner_user_id": 7, "creation_date": at("2020-01-02 12:00")},
        {"id": 4, "owner_user_id": None, "creation_date": at("2020-01-05 12:00")},
        answer(5, 1, 7, "2020-01-01 13:00", score=2),
    )
    found = {r.post_id: r for r in users.user_history(posts).collect()}
    assert [found[i].n_user_posts for i in (1, 2, 3, 4)] == [0, 2, 2, 0]
    assert [found[i].user_first_post for i in (1, 2, 3, 4)] == [1, 0, 0, 1]
    row = found[2]
    assert (row.user_score, row.user_question_score, row.user_answer_score) == (5, 3, 2)
    assert (found[2].n_user_answered_questions, found[2].n_user_accepted_answers) == (1, 1)


def test_repeated_tags_multiply(make_posts):
    posts = make_posts(
        {"id": 1, "creation_date": at("2020-01-01 12:00"), "tags": ["a", "a"]},
        {"id": 2, "creation_date": at("2020-01-31 12:00"), "tags": ["a", "a", "b"]},
        {"id": 3, "creation_date": at("2020-02-01 12:00"), "tags": None},
    )
    found = {r.post_id: r for r in tags.tag_features(posts).collect()}
    assert sorted(found) == [1, 2]
    row = found[2]
    assert (row.n_tag_posts_max, row.n_tag_posts_avg) == (4, 2.0)
    assert (row.n_tag_posts_max_30d, row.n_tag_posts_max_365d) == (0, 4)
    assert (row.tag_age_days_max, row.tag_age_days_avg) == (30, 15.0)


def test_forum_flags(spark):
    df = spark.createDataFrame([("b-com",), ("a-b-com",)], "dataset_name string")
    assert forums.forum_list(df) == ["a-b-com", "b-com"]
    flagged = forums.forum_flags(df).orderBy("dataset_name").collect()
    assert [(r.a_b_com_flag, r.b_com_flag) for r in flagged] == [(1, 0), (0, 1)]
    assert forums.forum_flags(df, ["c-com"]).columns == ["dataset_name", "c_com_flag"]


# --- properties on the small tables -----------------------------------------------------------


def test_model_data(spark, entities):
    table = features.build_model_data(*[entities[n] for n in ("posts", "votes", "users", "badges")])
    assert len(table.columns) == 84 + 5
    kinds = ["answer", "answer_accepted"]
    for kind in kinds:
        flags = [f"{kind}_{n}d_flag" for n in (1, 7, 14, 30)] + [f"{kind}_flag"]
        for a, b in zip(flags, flags[1:]):
            assert table.where(F.col(a) > F.col(b)).isEmpty()
    both = F.col("user_question_count") + F.col("user_answer_count")
    assert table.where(both > F.col("user_post_count")).isEmpty()


def test_separate_word_table_gives_the_same(spark, entities):
    from replycast.operators.nlp import questions_nlp

    posts, ballots = entities["posts"], entities["votes"]
    parts = (
        users.user_status(posts, entities["users"], entities["badges"]),
        users.user_history(posts),
        tags.tag_features(posts),
        answers.answer_features(posts, ballots),
    )
    asked = votes.question_features(posts, ballots)
    apart = features.assemble_model_data(asked, *parts, nlp=questions_nlp(posts))
    fused = features.build_model_data(posts, ballots, entities["users"], entities["badges"])
    assert same(apart, fused)
    kept = features.drop_reasons(posts, entities["users"]).where("reason = 'kept'").head().n_questions
    assert kept == fused.count()


def test_snapshot_has_every_user(entities):
    snap = snapshot.user_snapshot(entities["users"], entities["badges"], entities["posts"])
    assert snap.count() == entities["users"].count()
    assert snap.where(F.col("user_post_count") == 0).where("user_first_post_flag <> 1").isEmpty()
