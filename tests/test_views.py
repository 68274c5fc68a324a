"""The derived tables: written when asked for, without texts, which no shuffle carries either."""

import glob
import os
import re
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from checks import registry, views
from replycast import session
from replycast.plans import features, scoring
from replycast.sources import dump

SMALL = "/root/testdata/sf0.001"
ROWS = {
    "customer": "select 1L c_custkey, 'AUTO' c_mktsegment, 'n' c_name, 1.0 c_acctbal",
    "part": "select 0L p_partkey, 'red tin' p_name",
    "orders": "select 3L o_orderkey, 1L o_custkey, 'O' o_orderstatus, 50000.0 o_totalprice, timestamp_ntz'1995-01-01 00:00:00' o_orderdate",
    "lineitem": "select 3L l_orderkey, 1 l_linenumber, 1L l_partkey, 1L l_suppkey, 5.0 l_quantity, 'A' l_returnflag",
    "documents": "select * from values (0L, 'a'), (0L, 'b'), (0L, 'b'), (0L, null), (9L, 'c'), (9L, 'd') t(doc_id, text)",
    "benchmark": "select 0L item_id, 'Why\nso' text",
    "events": "select 0L event_id, 1L user_id, 'click' event_type",
}


@pytest.fixture
def odd(spark, tmp_path):
    for name, sql in ROWS.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_texts_with_one_id_are_told_apart(spark, odd):
    spark.sql(ROWS["orders"].replace("3L", "6L")).write.mode("overwrite").parquet(f"{odd}/orders.parquet")
    posts = views.tables(spark, odd)("posts")
    asked = sorted((r.body or "", r.title) for r in posts.where("post_type_id = 1").collect())
    around = "<p>{}</p><code>x = 6;\ny</code>"
    assert asked == [("", "Why so?")] + [(around.format(t), "Why so?") for t in ("a", "b", "b")]
    assert tuple(posts.columns) == views.POSTS
    assert posts.where("post_type_id = 2").isEmpty()


def test_a_driver_table_is_read_without_writing_any(spark, odd):
    before = views._written.cache_info().currsize
    assert views.tables(spark, odd)("part").count() == 1
    assert registry.split_tags(spark, odd).head().tags == "red,tin"
    assert views._written.cache_info().currsize == before


def test_no_text_is_written(spark):
    for name in ("questions", "answers"):
        assert not {"body", "title"} & set(views._read(spark, SMALL, name).columns)
    assert not {"post_body", "post_title"} & set(registry._training(spark, SMALL).columns)


@pytest.mark.parametrize("name", ["user_history", "user_status", "tag_features", "answer_features"])
def test_narrow_queries_read_no_documents(spark, name):
    df = getattr(registry, name)(spark, SMALL)
    assert not [f for f in df.inputFiles() if "documents" in f]


def test_posts_without_their_texts_read_no_documents(spark):
    posts = views.tables(spark, SMALL)("posts").select("id", "owner_user_id")
    assert "documents.parquet" not in posts._jdf.queryExecution().optimizedPlan().toString()
    assert "doc_hash" not in posts._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["question_features", "model_data", "drop_reasons", "title_flags"])
def test_no_exchange_carries_question_texts(spark, name):
    df = getattr(registry, name)(spark, SMALL)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert shuffled
    assert not [s for s in shuffled if re.search(r"\b(body|title|body_clean\w*)#", s)]
    assert df.where(F.lit(True)).count() > 0


def test_no_exchange_carries_request_texts(spark):
    asked = scoring.described_requests(scoring.parse_requests(registry.requests(spark, SMALL)))
    found = scoring.enrich_requests(asked, *registry._snapshots(spark, SMALL))
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert shuffled
    assert not [s for s in shuffled if re.search(r"\b(body|title|body_clean\w*|request|postBody)#", s)]


def test_texts_are_split_into_sentences_once(spark):
    plan = registry.sentence_boundaries(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_join") == 1


def test_dumps_are_compressed_and_read_again(spark, tmp_path):
    votes = views.tables(spark, SMALL)("votes").drop("creation_year")
    registry._as_dump(votes, "votes", ("creation_date",), f"{tmp_path}/votes")
    files = [f for f in os.listdir(f"{tmp_path}/votes") if f.startswith("part")]
    assert files and all(f.endswith(".xml.gz") for f in files)
    assert dump.read_entity(spark, "votes", f"{tmp_path}/votes").count() == votes.count()


def test_derived_tables_are_written_as_their_rows_lie(spark):
    for name, (view, key) in views.WRITTEN.items():
        rows = spark.range(3).select("id", F.current_timestamp().alias(key))
        dated, years = views._by_year(rows, key)
        plan = dated._jdf.queryExecution().optimizedPlan().toString()
        assert years == dated.columns[-1] and "Rebalance" not in plan, name


def test_word_queries_write_no_derived_table(spark):
    before = views._written.cache_info().currsize
    for name in ("pos_features", "abbreviation_scores"):
        assert registry.QUERIES[name](spark, f"{SMALL}//").count() > 0
    assert views._written.cache_info().currsize == before


def test_question_words_shuffle_no_body(spark):
    """Texts are joined to the places of the questions; past that join there is no shuffle."""
    plan = registry.questions_nlp(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("ArrowEvalPython")]
    assert "Exchange" not in above


def test_indexed_lookup_reads_the_texts_once_for_all_its_lookups(spark, monkeypatch):
    read, parse = [], scoring.read_matching
    monkeypatch.setattr(scoring, "read_matching", lambda spark, path, keys: read.append(keys) or parse(spark, path, keys))
    found = registry.indexed_lookup(spark, SMALL)
    plans = [keys._jdf.queryExecution().optimizedPlan().toString() for keys in read]
    assert len(plans) == 2 and not any("from_json" in p for p in plans) and found.count() > 0


def _shuffle_files(spark):
    folders = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())
    places = [f"{d}/{inner}blockmgr-*/*/shuffle_*.data" for d in folders.split(",") for inner in ("", "*/")]
    return {f for place in places for f in glob.glob(place)}


def _settled(spark, before):
    for _ in range(50):  # executors delete them a little later
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    return _shuffle_files(spark) - before


def test_a_derived_table_leaves_no_shuffle_files(spark):
    views._written.cache_clear()
    before, setting = _shuffle_files(spark), spark.conf.get(session.FREED)
    assert views.tables(spark, SMALL)("votes").columns
    assert not _settled(spark, before) and spark.conf.get(session.FREED) == setting


def test_narrow_tables_of_the_training_table_are_written_one_by_one(spark, monkeypatch):
    seen = []

    def written(df, name):
        seen.append((name, _shuffle_files(spark)))
        df = session.written(df, name)
        assert not _settled(spark, seen[-1][1])
        return df

    monkeypatch.setattr(features, "written", written)
    table = registry.model_data(spark, SMALL)
    assert [name for name, _ in seen] == ["status", "history", "tags", "answers", "scores"]
    assert "Window" not in table._jdf.queryExecution().optimizedPlan().toString()


def test_score_requests_reads_the_texts_once(spark, monkeypatch):
    seen, narrow = [], scoring.narrow_requests
    monkeypatch.setattr(scoring, "narrow_requests", lambda requests: seen.append(requests) or narrow(requests))
    monkeypatch.setattr(scoring, "score", lambda model, features: features.withColumn("probability", F.lit(0.5)))
    asked = scoring.parse_requests(registry.requests(spark, SMALL))
    scored = scoring.score_requests(asked, *registry._snapshots(spark, SMALL), None, registry.FIXTURE_FORUMS)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (*seen, scored)]
    assert len(plans) == 2 and not any("from_json" in p or "postBody" in p for p in plans)
    assert scored.count() == asked.count()
