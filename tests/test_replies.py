"""A request gets one reply, however often and in whatever batches it arrives."""

import json

import pytest
from pyspark.sql import functions as F

from replycast.streaming import scoring


@pytest.fixture
def plain_scores(monkeypatch):
    """The stream alone is tested: scores are constants."""
    monkeypatch.setattr(scoring, "parse_requests", lambda raw: raw)
    monkeypatch.setattr(
        scoring, "score_requests", lambda asked, *_: asked.select("request_id", "request", F.lit(0.5).alias("probability"))
    )


def _send(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"request_id": i, "request": text}) for i, text in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


def _run(spark, tmp_path, check="check", **options):
    source = spark.readStream.schema("request_id long, request string").json(str(tmp_path / "in"))
    query = scoring.score_stream(
        source, lambda: (None, None), None, [], str(tmp_path / "out"), str(tmp_path / check), **options
    )
    query.awaitTermination(200)
    assert query.exception() is None
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    return sorted((r["request_id"] or 0, r["request"]) for r in rows)


@pytest.mark.parametrize("options", [{"remember": "2 days"}, {"once": True}, {"remember": "2 days", "once": True}])
def test_one_reply_for_a_request_sent_again(spark, tmp_path, plain_scores, options):
    _send(tmp_path / "in", "a.json", (1, "x"), (1, "x"), (2, "y"), (None, "n"), (None, "n"), (None, "m"))
    first = [(0, "m"), (0, "n"), (1, "x"), (2, "y")]
    assert _run(spark, tmp_path, **options) == first
    _send(tmp_path / "in", "b.json", (2, "y"), (3, "z"), (1, "x"))
    assert _run(spark, tmp_path, **options) == [*first, (3, "z")]
    _send(tmp_path / "in", "c.json", (3, "z"))
    assert _run(spark, tmp_path, **options) == [*first, (3, "z")]


def test_answered_twice_without_either(spark, tmp_path, plain_scores):
    _send(tmp_path / "in", "a.json", (1, "x"), (1, "x"))
    assert _run(spark, tmp_path) == [(1, "x"), (1, "x")]


def test_ledger_is_that_of_earlier_batches(spark, tmp_path, plain_scores):
    out = str(tmp_path / "out")
    batch = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], "request_id long, request string")
    assert scoring.unanswered(batch, out, 0).count() == 3
    for k, ids in enumerate([[1], [2], [7]]):
        spark.createDataFrame([(i,) for i in ids], "request_id long").write.parquet(f"{out}/batch={k}")
    # run again, the batch does not see its own replies or later ones
    found = {k: {r["request_id"] for r in scoring.unanswered(batch, out, k).collect()} for k in range(3)}
    assert found == {0: {1, 2, None}, 1: {2, None}, 2: {None}}
