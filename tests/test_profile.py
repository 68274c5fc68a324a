"""Word profiles of batches whose texts are too many bytes to be counted together."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import registry
from replycast.functions import html, profile, words

SMALL = "/root/testdata/sf0.001"


def test_a_batch_is_counted_in_pieces_of_few_bytes():
    texts = pa.array([None, "a" * 6_000_000, "", "b" * 6_000_000, "c" * 18_000_000, None, "d"])
    pieces = [piece for piece, in profile._pieces(texts)]
    assert pa.concat_arrays(pieces) == texts
    for piece in pieces:
        sizes = [len(t or "") for t in piece.to_pylist()]
        assert sum(sizes) - sizes[-1] <= profile.MOST_BYTES or max(sizes) == 18_000_000


def test_pieces_give_what_the_whole_batch_gives(spark, monkeypatch):
    rows = [(i, None if i % 7 == 0 else "Running dogs ran quickly " * (i % 3) + f"word{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, text string").coalesce(1)

    def counted():
        found = df.select("id", profile.word_profile()("text").alias("p"), profile.pair_profile()("text", "text").alias("q"))
        return [(r.id, r.p[:-1], sorted(r.p.stems), r.q) for r in found.orderBy("id").collect()]

    whole = counted()
    monkeypatch.setattr(profile, "MOST_BYTES", 50)
    assert counted() == whole


def test_an_empty_batch_has_no_counts():
    assert list(profile._pieces(pa.array([], pa.string()))) == []


def test_characters_of_words_are_kept_as_by_the_pattern(spark):
    rng = random.Random(7)
    chars = "aZ09_'\"-.,;é中\U0001f600\u2028\xa0 \t\n\x0b\x0c\r\x00<>"
    texts = ["".join(rng.choices(chars, k=rng.randrange(30))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = [r.t for r in df.select(words.word_text(F.col("t")).alias("t")).collect()]
    for part in (pa.array(texts), pa.array(texts, pa.large_string())):
        assert profile._word_texts(part).to_pylist() == want
        assert profile._word_texts(part.slice(5, 290)).to_pylist() == want[5:295]


def test_a_word_is_tagged_once_by_a_worker(monkeypatch):
    looked = []
    monkeypatch.setattr(profile._Words, "look_up", lambda self, word: looked.append(word) or (0, word))
    lookup = profile._Words([], None)
    for _ in range(3):
        classes, stems = lookup.all(pa.array(["a", "b"]))
    assert looked == ["a", "b"] and (classes.tolist(), stems.tolist()) == ([0, 0], [0, 1])
    monkeypatch.setitem(profile.sys.modules, "replycast_known_words", profile.ModuleType("replycast_known_words"))
    assert profile._remembered(None) is profile._remembered(None)
    assert profile._remembered({"a": "NN"}) is not profile._remembered({"a": "NN"})


def test_a_text_is_cleaned_once_whatever_is_filtered_later(spark):
    plan = registry.model_data(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" in plan and not re.search(r"Filter \(length\(trim", plan)


def test_markup_is_found_as_by_the_places_of_both_marks(spark):
    bodies = [None, "", "<b>", "</b><b>", "é<b>x</b>", "<b>é</b", "<strong></strong>", "<img", "<img src='é'>", "x> <img"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    found = html.html_flags(df).collect()
    assert [r.body_bold_flag for r in found] == [0, 0, 0, 0, 1, 0, 1, 0, 0, 0]
    assert [r.body_image_flag for r in found] == [0] * 8 + [1, 0]


def test_stems_shared_by_title_and_body_are_counted_without_hashing_the_body(spark, monkeypatch):
    monkeypatch.setattr(profile.np, "isin", lambda *_: pytest.fail("all stems are hashed"))
    bodies = pa.array(["cats run", "", None, "dogs", "zebra cat dog"])
    titles = pa.array(["running cat bird", "cat", "x", "", "dogs and cats"])
    assert profile.pair_profile().func(bodies, titles).field("n_shared").to_pylist() == [2, 0, 0, 0, 2]
