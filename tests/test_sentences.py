"""Sentence ends by learned abbreviations."""

import math
import random

import pytest
from pyspark.sql import functions as F

from replycast.functions import sentences
from replycast.operators import abbreviations


def _split(spark, text, known=()):
    return spark.createDataFrame([(text,)], "t string").select(sentences.sentences(F.col("t"), known)).first()[0]


def test_abbreviations_do_not_end_sentences(spark):
    text = 'Ask Dr. Smith, e.g. at 3.5 p.m. or J. R. Doe (approx. two). "Really?!" he said... No. Yes! '
    assert _split(spark, text, ["dr", "approx"]) == [
        "Ask Dr. Smith, e.g. at 3.5 p.m. or J. R. Doe (approx. two).", '"Really?!" he said...', "No.", "Yes!",
    ]
    assert _split(spark, "It was the Dr.", ["dr"]) == ["It was the Dr."]
    # without the list, a plain word ends its sentence
    assert _split(spark, "Ask Dr. Smith.") == ["Ask Dr.", "Smith."]


@pytest.mark.parametrize("text", [None, "", " \n\t", "...", "! . ?"])
def test_nothing_to_split(spark, text):
    assert _split(spark, text, ["dr"]) == []


def test_tokens_of_each_sentence(spark):
    row = spark.createDataFrame([("One  two.\nThree!",)], "t string")
    assert row.select(sentences.sentence_tokens(F.col("t"))).first()[0] == [["One", "two."], ["Three!"]]


def _corpus():
    rng = random.Random(3)
    plain = ["river", "stone", "walks", "green", "over", "under", "light", "no", "it"]
    rows = []
    for _ in range(600):
        words = [rng.choice(plain) for _ in range(rng.randint(4, 9))]
        words.insert(rng.randrange(len(words)), rng.choice(["Dr.", "etc.", "e.g.", "(cf."]))
        rows.append(" ".join(words).capitalize() + ".")
    return [" ".join(rows[i : i + 6]) for i in range(0, 600, 6)] + [None, ""]


def test_learned_from_counts(spark):
    texts = _corpus()
    table = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    scores = abbreviations.abbreviation_scores(abbreviations.period_counts(table))
    rows = {r["word"]: r for r in scores.collect()}
    tokens = [t.strip("(").lower() for text in texts for t in (text or "").split()]
    share = sum(t.endswith(".") for t in tokens) / len(tokens)
    for word, row in rows.items():
        n, k = sum(t.rstrip(".") == word for t in tokens), sum(t.rstrip(".") == word and t.endswith(".") for t in tokens)
        assert (row["n_with"], row["n_without"]) == (k, n - k)
        ratio = 2 * (k * math.log(0.99 / share) + (n - k) * math.log(0.01 / (1 - share)))
        letters = len(word.replace(".", ""))
        want = ratio * math.exp(-letters) * (word.count(".") + 1) * float(letters) ** -(n - k) if ratio > 0 else 0.0
        assert row["score"] == pytest.approx(want)
    known = abbreviations.read_abbreviations(scores)
    assert known == ["cf", "dr", "e.g", "etc"]
    with pytest.raises(ValueError):
        abbreviations.read_abbreviations(scores, max_words=3)
    found = table.select(F.size(sentences.sentences(F.col("text"), known)).alias("n")).collect()
    # six to a text, less those whose last word is an abbreviation
    assert sum(r["n"] for r in found) == sum(
        1 for text in texts if text for i, t in enumerate(text.split())
        if t.endswith(".") and (i == len(text.split()) - 1 or t.strip("(.").lower() not in known)
    )


def test_empty_corpus(spark):
    table = spark.createDataFrame([], "text string")
    scores = abbreviations.abbreviation_scores(abbreviations.period_counts(table))
    assert abbreviations.read_abbreviations(scores) == []
