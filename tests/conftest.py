import datetime as dt

import pytest

from replycast.session import build_session

POSTS = (
    "id long, post_type_id long, parent_id long, accepted_answer_id long, creation_date timestamp,"
    " score long, body string, owner_user_id long, title string, tags array<string>,"
    " answer_count long, closed_date timestamp, dataset_name string"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = build_session("tests", "local[4]", conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def make_posts(spark):
    """Posts from dictionaries; missing columns get defaults."""

    def make(*rows):
        names = [part.split()[0] for part in POSTS.replace(",", ", ").split(", ")]
        base = {"post_type_id": 1, "score": 0, "body": "", "dataset_name": "f"}
        full = [{**dict.fromkeys(names), **base, **row} for row in rows]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in full], POSTS)

    return make
