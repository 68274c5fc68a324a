"""Registered queries: name to (spark, sf_dir) -> DataFrame over the whole driver tables.

Arrays and maps are shown as text, and computed means of doubles are rounded, so that results can
be compared with the SQL of `oracle.py`.
"""

from functools import lru_cache, partial, reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replycast.functions import html, scalars, sentences, words
from replycast.functions.pos import COUNTED
from replycast.operators import abbreviations, answers, forums, nlp, prefix, tags, users, votes
from replycast.plans import explore, features, model, ranks, scoring, snapshot
from replycast.plans.names import STATUS_NAMES, HISTORY_NAMES, TARGET, TARGETS
from replycast.session import shared_dir, shuffles_freed, written
from replycast.sources import dump, importing, manifest, snapshots
from replycast.streaming import snapshots as stream_snapshots

from .oracle import FIXTURE_FORUMS
from .views import badges_view, tables, texts, users_view, _driver_tables


def _entities(spark, sf_dir, *names):
    t = tables(spark, sf_dir)
    return [t(name) for name in names or ("slim_posts", "votes", "users", "badges")]


def _text(df, *names):
    return df.withColumns({n: F.array_join(n, ",") for n in names})


def _rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


def _new_path(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


# --- text, dates, keys -----------------------------------------------------------------------


def html_clean(spark, sf_dir):
    pages = tables(spark, sf_dir)("pages")
    return html.body_lengths(pages, "html").drop("url", "html")


def html_flags(spark, sf_dir):
    pages = tables(spark, sf_dir)("pages")
    return html.html_flags(pages, "html").drop("url", "html")


def _questions(spark, sf_dir):
    return votes.questions_of(tables(spark, sf_dir)("posts"))


def title_flags(spark, sf_dir):
    asked = _questions(spark, sf_dir).select(F.col("id").alias("post_id"), "title")
    return html.title_flags(asked)


def date_parts(spark, sf_dir):
    posts = tables(spark, sf_dir)("slim_posts")
    return scalars.date_parts(
        posts.select(F.col("id").alias("post_id"), "creation_date"), "creation_date"
    )


def null_flags(spark, sf_dir):
    names = ("website_url", "user_website"), ("location", "user_location"), (
        "about_me",
        "user_about_me",
    )
    flags = [scalars.presence_flag(F.col(c)).alias(f"{out}_flag") for c, out in names]
    return tables(spark, sf_dir)("users").select("id", "dataset_name", *flags)


def composite_key(spark, sf_dir):
    key = scalars.composite_key(F.col("dataset_name"), F.col("id"))
    return tables(spark, sf_dir)("users").select(key.alias("id"), "display_name")


def split_tags(spark, sf_dir):
    marked = F.concat(F.lit("<"), F.replace("p_name", F.lit(" "), F.lit("><")), F.lit(">"))
    parts = tables(spark, sf_dir)("part").select("p_partkey", marked.alias("marked"))
    split = parts.select("p_partkey", scalars.split_tags(F.col("marked")).alias("tags"))
    return _text(split.withColumn("n_tags", scalars.n_tags(F.col("tags"))), "tags")


# --- dump files ------------------------------------------------------------------------------


def _as_dump(df, entity, times, path, by=()):
    """Write a table as compressed dump rows: one attribute per column, times as text; a folder for each value of `by`."""
    attributes = {name: attr for attr, name, _ in dump.ENTITIES[entity].fields}
    columns = []
    for name in (c for c in df.columns if c in attributes):
        col = F.col(name)
        if name in times:
            col = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSS")
        elif name == "tags":
            col = F.concat(F.lit("<"), F.array_join(col, "><"), F.lit(">"))
        columns.append(col.alias("_" + attributes[name]))
    writer = df.select(*columns, *by).write.partitionBy(*by)
    with shuffles_freed(df.sparkSession):
        writer.format("xml").options(rootTag=entity, rowTag="row", compression="gzip").save(path)


def _round_trip(spark, df, entity, times):
    """A table written as dump files that are named after their forum, and read again."""
    path, named = _new_path(spark, entity), _new_path(spark, f"{entity}-named")
    _as_dump(df, entity, times, path, ["dataset_name"])
    Path = spark._jvm.org.apache.hadoop.fs.Path
    files = Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(Path(named))
    for folder in files.globStatus(Path(f"{path}/dataset_name=*")):
        forum = folder.getPath().getName().removeprefix("dataset_name=")
        for number, file in enumerate(files.listStatus(folder.getPath())):
            files.rename(file.getPath(), Path(f"{named}/{forum}.{entity}.{number}.xml.gz"))
    return dump.read_entity(spark, entity, named)


def ingest_posts(spark, sf_dir):
    """All posts, questions and answers, with every column the driver tables can fill."""
    posts = tables(spark, sf_dir)("posts").drop("creation_year")
    read = _round_trip(spark, posts, "posts", ("creation_date", "closed_date"))
    return _text(
        read.select(
            "id",
            "post_type_id",
            "parent_id",
            "accepted_answer_id",
            "creation_date",
            "score",
            "body",
            "owner_user_id",
            "title",
            "tags",
            "answer_count",
            "closed_date",
            "creation_year",
            "dataset_name",
        ),
        "tags",
    )


def ingest_votes(spark, sf_dir):
    ballots = tables(spark, sf_dir)("votes").drop("creation_year")
    read = _round_trip(spark, ballots, "votes", ("creation_date",))
    return read.select("post_id", "vote_type_id", "creation_date", "creation_year", "dataset_name")


def ingest_users(spark, sf_dir):
    people = users_view(_driver_tables(spark, sf_dir))
    read = _round_trip(spark, people, "users", ("creation_date",))
    kept = ["id", "creation_date", "display_name", "website_url", "location", "about_me"]
    return read.select(*kept, "creation_year", "dataset_name")


def ingest_badges(spark, sf_dir):
    t = _driver_tables(spark, sf_dir)
    read = _round_trip(spark, badges_view(t, users_view(t)), "badges", ("date",))
    return read.select("id", "user_id", "name", "date", "class", "year", "dataset_name")


def ingest_increment(spark, sf_dir):
    """All votes, from two deliveries of dump files and three runs of the import."""
    ballots = tables(spark, sf_dir)("votes").drop("creation_year")
    source, target, progress = (_new_path(spark, f"votes-{part}") for part in ("dumps", "table", "progress"))
    first = F.pmod(F.xxhash64("post_id"), F.lit(2)) == 0
    for number, part in enumerate((ballots.where(first), ballots.where(~first))):
        _as_dump(part, "votes", ("creation_date",), f"{source}/delivery={number}")
        for _ in range(1 + number):
            importing.import_new(spark, "votes", f"{source}/delivery=*", target, progress, 3).awaitTermination()
    return spark.read.parquet(target).select("post_id", "vote_type_id", "creation_date", "creation_year")


def ingest_audit(spark, sf_dir):
    """How many rows of a dump of all posts have a problem: cut ones, and bad or missing values."""
    key = F.col("id")

    def attribute(name, value):
        return F.concat(F.lit(f' {name}="'), value.cast("string"), F.lit('"'))

    start = F.concat(
        F.when(key % 19 == 0, "").otherwise(attribute("Id", key)), attribute("PostTypeId", F.col("post_type_id"))
    )
    rest = F.concat(
        attribute("Score", F.when(key % 13 == 0, "many").otherwise(F.coalesce("score", F.lit(0)).cast("string"))),
        attribute(
            "CreationDate",
            F.when(key % 11 == 0, "long ago").otherwise(F.date_format("creation_date", "yyyy-MM-dd'T'HH:mm:ss.SSS")),
        ),
    )
    cut = key % 17 == 0
    row = F.concat(F.lit("<row"), start, F.when(cut, ' Sco').otherwise(F.concat(rest, F.lit(" />"))))
    path = _new_path(spark, "broken-posts")
    tables(spark, sf_dir)("posts").select(row.alias("value")).write.text(path)
    audited = dump.audit_entity(spark, "posts", path)
    found = audited.select(F.explode(F.concat(F.array(F.lit("rows")), "problems")).alias("problem"))
    return found.groupBy("problem").agg(F.count("*").alias("n_rows"))


def pending_files(spark, sf_dir):
    t = tables(spark, sf_dir)
    name = F.concat("c_name", F.lit(".7z")).alias("file_name")
    people = t("customer").select("c_custkey", name, (F.col("c_custkey") + 1000).alias("size"))
    urgent = t("orders").where(F.col("o_orderpriority") == "1-URGENT")
    there = urgent.select(F.col("o_custkey").alias("c_custkey")).join(people, "c_custkey")
    return manifest.pending_files(people.drop("c_custkey"), there)


# --- feature tables --------------------------------------------------------------------------


def question_features(spark, sf_dir):
    posts, ballots = _entities(spark, sf_dir, "slim_posts", "votes")
    return _text(votes.question_features(posts, ballots, texts=texts(spark, sf_dir), kept=written), "tags")


def user_status(spark, sf_dir):
    posts, people, badges = _entities(spark, sf_dir, "slim_posts", "users", "badges")
    return users.user_status(posts, people, badges)


def user_history(spark, sf_dir):
    return users.user_history(tables(spark, sf_dir)("slim_posts"))


def answer_scores(spark, sf_dir):
    posts, ballots = _entities(spark, sf_dir, "slim_posts", "votes")
    return answers.answer_scores(posts, ballots)


def answer_features(spark, sf_dir):
    posts, ballots = _entities(spark, sf_dir, "slim_posts", "votes")
    return answers.answer_features(posts, ballots)


def question_tags(spark, sf_dir):
    return tags.question_tags(tables(spark, sf_dir)("slim_posts"))


def tag_start(spark, sf_dir):
    return tags.tag_start(tables(spark, sf_dir)("slim_posts"))


def tag_features(spark, sf_dir):
    return tags.tag_features(tables(spark, sf_dir)("slim_posts"))


#: Days on which the parts of a merged history begin.
PART_DAYS = ("1995-01-01", "1997-01-01", "1999-07-01")


def _in_parts(spark, sf_dir, name, build, compact_keys=None):
    """A history built part by part: `build(part of the posts, first and last day, totals)` for each."""
    path, posts = _new_path(spark, name), tables(spark, sf_dir)("slim_posts")
    found = []
    for start, stop in zip(PART_DAYS, (*PART_DAYS[1:], "2100-01-01")):
        if compact_keys and start == PART_DAYS[2]:
            prefix.compact(spark, path, start, *compact_keys)
        within = lambda at, a=start, b=stop: (F.col(at) >= F.lit(a)) & (F.col(at) < F.lit(b))
        totals = partial(prefix.prefix_totals, path, start)
        found.append(build(posts.where(within("creation_date")), within, totals))
    return reduce(DataFrame.unionByName, found)


def user_history_merged(spark, sf_dir):
    """Author histories from three parts, each added to what is kept of the ones before."""
    return _in_parts(
        spark, sf_dir, "user-history", lambda posts, _, totals: users.user_history(posts, totals), (users.USER, "at")
    )


def user_status_merged(spark, sf_dir):
    """Author status from three parts of posts and badges."""
    t = tables(spark, sf_dir)

    def build(posts, within, totals):
        return users.user_status(posts, t("users"), t("badges").where(within("date")), totals)

    return _in_parts(spark, sf_dir, "user-status", build)


def tag_features_merged(spark, sf_dir):
    """Tag features from three parts of the questions, the first two of them compacted."""
    return _in_parts(
        spark,
        sf_dir,
        "tag-features",
        lambda posts, _, totals: tags.tag_features(posts, totals=totals),
        (tags.TAG, "creation_date", 365),
    )


def as_of_date(spark, sf_dir):
    return snapshot.as_of(tables(spark, sf_dir)("slim_posts"))


def user_snapshot(spark, sf_dir):
    posts, people, badges = _entities(spark, sf_dir, "slim_posts", "users", "badges")
    return snapshot.user_snapshot(people, badges, posts)


def tag_snapshot(spark, sf_dir):
    return snapshot.tag_snapshot(tables(spark, sf_dir)("slim_posts"))


def snapshot_upsert(spark, sf_dir):
    t = tables(spark, sf_dir)
    path = _new_path(spark, "last-event")
    start = t("customer").select(F.col("c_custkey").alias("id"), F.lit("none").alias("last_event"))
    events = t("events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("last_event"), "event_id"
    )
    snapshots.upsert_snapshot(start, path)
    return snapshots.upsert_snapshot(events, path, version="event_id")


def snapshot_stream(spark, sf_dir):
    """Last event of each customer, kept up by a stream of the events in eight files, in no order of time."""
    start = _new_path(spark, "event-files")
    t = tables(spark, sf_dir)
    events = t("events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("last_event"), F.col("event_id").alias("version")
    )
    events.withColumn("part", F.pmod(F.xxhash64("version"), F.lit(8))).repartition(8, "part").write.partitionBy(
        "part"
    ).parquet(start)
    path = _new_path(spark, "event-snapshot")
    unknown = t("customer").select(
        F.col("c_custkey").alias("id"), F.lit("none").alias("last_event"), F.lit(-1).cast("bigint").alias("version")
    )
    stream_snapshots.apply_batch(unknown, path, "customers", 0)
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{start}/part=*")
    stream = stream_snapshots.upsert_stream(feed, path, "events", _new_path(spark, "event-progress"), every=3)
    stream.awaitTermination()
    return stream_snapshots.read_snapshot(spark, path).drop("version")


# --- words -----------------------------------------------------------------------------------


def _documents(spark, sf_dir, **columns):
    return tables(spark, sf_dir)("documents").select(
        "doc_id", *[c.alias(name) for name, c in columns.items()]
    )


def token_counts(spark, sf_dir):
    return _documents(spark, sf_dir, n_words=words.token_count(words.tokens(F.col("text"))))


def stopword_counts(spark, sf_dir):
    kept = words.without_stop_words(words.tokens(F.col("text")))
    return _documents(spark, sf_dir, n_content_words=F.size(kept))


def sentence_counts(spark, sf_dir):
    return _documents(spark, sf_dir, n_sentences=words.sentence_count(F.col("text")))


def _abbreviations(spark, sf_dir):
    return abbreviations.abbreviation_scores(abbreviations.period_counts(tables(spark, sf_dir)("documents")))


def abbreviation_scores(spark, sf_dir):
    return _abbreviations(spark, sf_dir).withColumn("score", F.round("score", 4))


def sentence_boundaries(spark, sf_dir):
    known = abbreviations.read_abbreviations(_abbreviations(spark, sf_dir))
    # a column of its own, so that a text is split once for both figures
    found = _documents(spark, sf_dir, found=sentences.sentences(F.col("text"), known))
    longest = F.array_max(F.transform("found", F.length))
    return found.select("doc_id", F.size("found").alias("n_sentences"), longest.alias("longest"))


def _profiled(spark, sf_dir):
    return nlp.text_features(_documents(spark, sf_dir, text=F.col("text")), "text", "text")


def stem_features(spark, sf_dir):
    return _profiled(spark, sf_dir).select(
        "doc_id",
        F.col("text_n_distinct_words").alias("n_distinct_stems"),
        F.array_join(F.array_sort("text_stems"), " ").alias("stems"),
    )


def pos_features(spark, sf_dir):
    words_of = F.col("text_n_words")
    return _profiled(spark, sf_dir).select(
        "doc_id",
        words_of.alias("n_words"),
        *[F.col(f"text_n_{name}").alias(f"n_{name}") for name in COUNTED],
        *[
            scalars.pos_share(F.col(f"text_n_{name}"), words_of).alias(f"{name}_share")
            for name in COUNTED
        ],
    )


def questions_nlp(spark, sf_dir):
    return nlp.questions_nlp(tables(spark, sf_dir)("posts"))


# --- training table and exploration ----------------------------------------------------------


def forum_list(spark, sf_dir):
    return forums.forum_names(tables(spark, sf_dir)("users"))


def forum_flags(spark, sf_dir):
    return forums.forum_flags(tables(spark, sf_dir)("users").select("id", "dataset_name"))


def model_data(spark, sf_dir):
    table = features.build_model_data(*_entities(spark, sf_dir), texts=texts(spark, sf_dir))
    return _text(table, "post_tags")


def drop_reasons(spark, sf_dir):
    posts, people = _entities(spark, sf_dir, "posts", "users")
    return features.drop_reasons(posts, people)


@lru_cache
def _saved_model_data(application, spark, sf_dir):
    path = f"{shared_dir(spark)}/replycast-{application}{sf_dir}/model_data"
    table = features.build_model_data(*_entities(spark, sf_dir), texts=texts(spark, sf_dir))
    with shuffles_freed(spark):
        table.drop("post_body", "post_title").write.mode("overwrite").parquet(path)
    return path


def _training(spark, sf_dir):
    """The training table, written once per session as a real run would, without the texts that no query reads."""
    path = _saved_model_data(spark.sparkContext.applicationId, spark, sf_dir.rstrip("/"))
    return spark.read.parquet(path)


CANDIDATES = model.candidate_features(FIXTURE_FORUMS)
XS = model.model_features(FIXTURE_FORUMS)


def null_audit(spark, sf_dir):
    return explore.null_audit(_training(spark, sf_dir))


def target_rates(spark, sf_dir):
    return explore.target_rates(_training(spark, sf_dir), TARGETS)


def forum_rates(spark, sf_dir):
    return explore.forum_rates(_training(spark, sf_dir), TARGET)


def class_means(spark, sf_dir):
    means = explore.class_means(_training(spark, sf_dir), CANDIDATES, TARGET)
    return _rounded(means, "mean_0", "mean_1", "diff")


def spearman_pairs(spark, sf_dir):
    return _rounded(explore.spearman_pairs(_training(spark, sf_dir), CANDIDATES), "cor")


def spearman_sketch(spark, sf_dir):
    return _rounded(ranks.spearman_sketch(_training(spark, sf_dir), CANDIDATES), "cor")


# --- model -----------------------------------------------------------------------------------


def _parts(spark, sf_dir):
    return model.split(_training(spark, sf_dir), key=votes.KEY)


@lru_cache
def _fitted(application, spark, sf_dir):
    train, _ = _parts(spark, sf_dir)
    return model.fit_gbt(train, XS, TARGET)


def _model(spark, sf_dir):
    return _fitted(spark.sparkContext.applicationId, spark, sf_dir.rstrip("/"))


def _predicted(spark, sf_dir):
    return _model(spark, sf_dir).transform(_parts(spark, sf_dir)[1])


def split_counts(spark, sf_dir):
    table = _training(spark, sf_dir)
    return model.split_counts(table, *_parts(spark, sf_dir), TARGET)


def gbt_metrics(spark, sf_dir):
    return model.metrics(_predicted(spark, sf_dir))


def confusion(spark, sf_dir):
    return model.confusion(_predicted(spark, sf_dir))


def _given_prediction(spark, sf_dir):
    """A prediction that the tables hold: large quantities as the score of returned lines."""
    quantity = F.col("l_quantity").cast("double")
    return tables(spark, sf_dir)("lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        (quantity / 50).alias("rawPrediction"),
        (quantity > 25).cast("double").alias("prediction"),
    )


def given_metrics(spark, sf_dir):
    return _rounded(model.metrics(_given_prediction(spark, sf_dir)), "value")


def given_confusion(spark, sf_dir):
    return _rounded(model.confusion(_given_prediction(spark, sf_dir)), "share")


def importances(spark, sf_dir):
    return model.importances(_model(spark, sf_dir), XS, spark)


def parameters(spark, sf_dir):
    return model.parameters(_model(spark, sf_dir), spark)


def cv_best(spark, sf_dir):
    train, _ = _parts(spark, sf_dir)
    return model.cv_results(model.tune_gbt(train, XS, TARGET, parallelism=8, key=votes.KEY), spark)


# --- scoring ---------------------------------------------------------------------------------


def requests(spark, sf_dir):
    """Every question as a JSON request, some with an unknown author or tag."""
    key, at = F.col("id"), F.col("creation_date")
    fields = F.struct(
        F.initcap(F.replace("dataset_name", F.lit("-"), F.lit("."))).alias("forumName"),
        F.when(key % 10 == 0, F.concat(F.lit("u"), key.cast("string")))
        .otherwise(F.coalesce(F.col("owner_user_id").cast("string"), F.lit("none")))
        .alias("userId"),
        F.col("title").alias("postTitle"),
        F.col("body").alias("postBody"),
        F.concat(
            F.coalesce(F.array_join("tags", ", "), F.lit("no-tag")),
            F.when(key % 4 == 0, ", no-such-tag").otherwise(""),
        ).alias("postTags"),
        F.date_format(at, "yyyy-MM-dd").alias("postDate"),
        F.date_format(at, "HH:mm").alias("postTime"),
    )
    return _questions(spark, sf_dir).select(
        key.alias("request_id"), F.to_json(fields).alias("request")
    )


def _snapshots(spark, sf_dir):
    return user_snapshot(spark, sf_dir), tag_snapshot(spark, sf_dir)


def _map_text(col):
    return F.array_join(
        F.transform(F.map_entries(col), lambda e: F.concat(e.key, F.lit("="), e.value)), ","
    )


def _looked_up(found):
    return found.select(
        "request_id",
        "dataset_name",
        "user_id",
        "user_display_name",
        *STATUS_NAMES.values(),
        *HISTORY_NAMES.values(),
        *scoring.TAG_MEANS,
        _map_text("tag_found").alias("tag_found"),
    )


def request_lookup(spark, sf_dir):
    asked = scoring.parse_requests(requests(spark, sf_dir))
    return _looked_up(scoring.enrich_requests(asked, *_snapshots(spark, sf_dir)))


def indexed_lookup(spark, sf_dir):
    """The same from snapshots that were published for look-ups."""
    paths = [_new_path(spark, name) for name in ("user-snapshot", "tag-snapshot")]
    for rows, path in zip(_snapshots(spark, sf_dir), paths):
        snapshots.publish_indexed(rows, path)
    asked = scoring.parse_requests(requests(spark, sf_dir))
    narrow = scoring.narrow_requests(asked)
    return _looked_up(scoring.enrich_requests(asked, *scoring.lookup_tables(narrow, *paths), narrow))


def score_requests(spark, sf_dir):
    asked = scoring.parse_requests(requests(spark, sf_dir))
    fitted = _model(spark, sf_dir)
    scored = scoring.score_requests(asked, *_snapshots(spark, sf_dir), fitted, FIXTURE_FORUMS)
    return scored.withColumn("tags", _map_text("tags"))


QUERIES = {
    f.__name__: f
    for f in (
        html_clean,
        html_flags,
        title_flags,
        date_parts,
        null_flags,
        composite_key,
        split_tags,
        ingest_posts,
        ingest_votes,
        ingest_users,
        ingest_badges,
        ingest_increment,
        ingest_audit,
        pending_files,
        question_features,
        user_status,
        user_history,
        answer_scores,
        answer_features,
        question_tags,
        tag_start,
        tag_features,
        user_history_merged,
        user_status_merged,
        tag_features_merged,
        as_of_date,
        user_snapshot,
        tag_snapshot,
        snapshot_upsert,
        snapshot_stream,
        token_counts,
        stopword_counts,
        sentence_counts,
        abbreviation_scores,
        sentence_boundaries,
        stem_features,
        pos_features,
        questions_nlp,
        forum_list,
        forum_flags,
        model_data,
        drop_reasons,
        null_audit,
        target_rates,
        forum_rates,
        class_means,
        spearman_pairs,
        spearman_sketch,
        split_counts,
        gbt_metrics,
        confusion,
        given_metrics,
        given_confusion,
        importances,
        parameters,
        request_lookup,
        indexed_lookup,
        score_requests,
        cv_best,  # the longest by far: 135 fits
    )
}
