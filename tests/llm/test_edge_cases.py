"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import glob
import hashlib
import os
import tempfile
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from replycast.llm import (
    bpe, classifier, common, exact, langid, lines, merkle, mixing, packing, pii, quality_rules, resampling, simhash, substrings,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "wort " * 30_000 + "ende"
ROWS = [
    (1, "the first line of the text is here\nand the second one follows it", "en", "a", 5),
    (2, "the first line of the text is here\nand the second one follows it", "en", "a", 5),
    (2, "the first line of the text is here\nand the second one follows it", "en", "a", 5),
    (2, "same id, another text", "en", None, 5),
    (3, None, "en", "a", None),
    (4, "", None, "b", 0),
    (5, " \n\t ", "de", "b", 4),
    (None, "no id here, but a text of its own", "de", None, 1),
    (None, None, None, None, None),
    (6, LONG, "de", "b", 5),
    (7, "123 ... !!! 😀 \x00 \x1c", "fr", "b", 5),
]
LABELS = [(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, None, None), (None, 1, 1), (6, 0, 0), (99, 1, 0)]
#: Names that operators use inside.
CLASHING = (
    "h1", "h2", "k", "k1", "k2", "row", "size", "words", "body", "first", "n", "hash", "value", "key", "cell",
    "tree", "position", "digest", "changed", "steps", "block", "leaf", "rank", "weight", "n_features", "n_words",
    "at", "start", "length", "units", "sequence_id", "upto", "before", "_size",
    "fingerprint", "copies", "target", "bucket", "label", "score", "kept", "rest", "removed", "line", "no", "ids",
)

PATTERN = public_tokenizers.PATTERN
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def _classify(spark, docs, labels):
    model = classifier.fit(docs, _labels(spark, labels))
    return docs.select("doc_id", classifier.score_column(spark, model).alias("score"))


#: Operators that give one row for each document.
PER_DOCUMENT = {
    "mixing": lambda spark, docs: mixing.mix(docs, mixing.cycled_weights(docs)),
    "language": lambda spark, docs: langid.identify(docs, langid.fit(docs)),
    "lines": lambda spark, docs: lines.line_dedup(docs),
    "pii": lambda spark, docs: pii.find_pii(docs),
    "simhash": lambda spark, docs: simhash.simhash_dedup(docs),
    "exact": lambda spark, docs: exact.exact_dedup(docs),
    "substrings": lambda spark, docs: substrings.substring_dedup(docs),
    "rules": lambda spark, docs: quality_rules.quality_rules(docs),
    "bpe": lambda spark, docs: bpe.decode(bpe.encode(docs, VOCABULARY, PATTERN), VOCABULARY, PATTERN),
    "classifier": lambda spark, docs: _classify(spark, docs, LABELS),
    "resampling": lambda spark, docs: resampling.resample(docs, docs),
    "manifest": lambda spark, docs: merkle.manifest(docs, changed=merkle.lower_cased()),
    "packing": lambda spark, docs: packing.pack(docs, WORDS).filter("start = 0"),
}
#: Operators that give rows of documents with their own columns.
ROWS_OUT = {
    "mixed": lambda docs: mixing.mixed(docs, mixing.cycled_weights(docs)),
    "without_removed": lines.without_removed,
    "without_removed by words": lambda docs: lines.without_removed(docs, share=lines.SHARE),
    "keep_first": simhash.keep_first,
    "keep_unlike": simhash.keep_unlike,
}


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.withColumns({name: F.lit(name) for name in CLASHING})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda i: (i is None, i or 0))


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_for_each_document(spark, docs, name):
    rows = PER_DOCUMENT[name](spark, docs).collect()
    assert _ids(rows) == [1, 2, 2, 2, 3, 4, 5, 6, 7, None, None]


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_empty_table(spark, empty, name):
    assert PER_DOCUMENT[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", ROWS_OUT)
def test_rows_keep_their_columns(docs, empty, name):
    rows = ROWS_OUT[name](docs)
    assert rows.columns == docs.columns
    assert all(r["h1"] == "h1" and r["row"] == "row" for r in rows.collect())
    assert ROWS_OUT[name](empty).collect() == []


def test_classifier_without_labels(spark, docs):
    rows = _classify(spark, docs, []).collect()
    assert {r["score"] for r in rows} == {0.5}


def test_null_texts_are_empty_ones(spark, docs):
    nothing = hashlib.sha256(b"").hexdigest()
    found = {r["doc_id"]: r for r in exact.exact_dedup(docs).filter("doc_id in (3, 4, 5)").collect()}
    # null, empty and blank texts are equal; the blank one is the longest
    assert {i: (r["keep_id"], r["group_size"], r["kept"]) for i, r in found.items()} == {
        3: (5, 4, False), 4: (5, 4, False), 5: (5, 4, True),
    }
    assert {r["text_sha256"] for r in found.values()} == {nothing}
    prints = simhash.simhash_dedup(docs).filter("doc_id in (3, 4, 5)").collect()
    assert {(r["fingerprint"], r["component_id"]) for r in prints} == {(0, 3)}
    spans = pii.find_pii(docs).filter("doc_id in (3, 4)").collect()
    assert {r["email_spans"] for r in spans} == {""}
    langs = langid.identify(docs, langid.fit(docs)).filter("doc_id in (3, 4, 5, 7)").collect()
    assert {(r["lang_pred"], r["score"]) for r in langs} == {("und", 0.0)}
    rules = quality_rules.quality_rules(docs).filter("doc_id in (3, 4, 5)").collect()
    assert {(r["n_words"], r["kept"]) for r in rules} == {(0, False)}


def test_lines_of_nulls_and_copies(docs):
    rows = {(r["doc_id"], r["n_lines"]): r["removed"] for r in lines.line_dedup(docs).collect()}
    # rows that repeat id and text are one document, so both lose what the smaller id has
    assert rows[(1, 2)] == []
    assert rows[(2, 2)] == [0, 1]
    assert rows[(3, 0)] == []
    kept = lines.without_removed(docs).filter("doc_id = 3").collect()
    assert [r["text"] for r in kept] == [None]


def test_one_of_each_component_stays(docs):
    kept = simhash.keep_first(docs).collect()
    texts = [r["text"] for r in kept]
    assert texts.count(ROWS[0][1]) == 1
    assert sum(not (t or "").strip() for t in texts) == 1
    assert _ids(kept)[0] == 1


def test_nothing_to_draw_or_to_gain(spark, docs, empty):
    rows = {(r["doc_id"], r["n_features"]): r for r in resampling.resample(docs, empty).collect()}
    # a null text and one without words have no features, weight 0, and are never drawn
    assert all(rows[(i, 0)]["weight"] == 0 and rows[(i, 0)]["rank"] is None for i in (3, 4, 5, None))
    assert resampling.resample(empty, docs).collect() == []


def test_manifest_of_nulls_and_repeated_rows(docs):
    found = merkle.manifest(docs).collect()
    assert len({r["root"] for r in found}) == 1 and {r["folded_root"] for r in found} == {found[0]["root"]}
    # a null source has a tree of its own, and a null id comes first in its source
    assert len({r["subroot"] for r in found}) == 3
    assert {r["position"] for r in found if r["source"] is None} == {0, 1, 2}
    assert {r["position"] for r in found if r["doc_id"] is None} <= {0, 1}


def test_null_and_empty_texts_are_one_id(docs):
    rows = packing.pack(docs, WORDS).filter("doc_id in (3, 4, 5)").collect()
    assert {(r["length"], r["doc_tokens"], bytes(r["ids"])) for r in rows} == {(1, 1, b"\x01\0\0\0")}


def test_the_classifier_makes_no_table_of_values():
    """Values are made from the buckets when they are used, so the fit needs less than the buckets take once more."""
    rng = np.random.default_rng(1)
    samples = [rng.integers(0, 1 << classifier.BITS, 20_000).astype(np.int32) for _ in range(300)]
    ratios = rng.normal(size=1 << classifier.BITS)
    tracemalloc.start()
    classifier.fit_hinge(samples, np.arange(300) % 2, ratios, rng)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < sum(b.nbytes for b in samples) / 2


def test_levels_of_near_lines_are_no_part_of_the_last_plan(spark):
    """A group of near lines so large that it is cut and split again and again."""
    texts = ["the same long line of very many words with one odd sign at the end " + chr(0x4E00 + i) for i in range(40)]
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "line string, first int")
    table = lines.saved(rows.select(*lines._hashes(F.col("line")), "line", "first"))
    found = lines.near_earlier(table)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 2 and plan.count("Generate") <= 0
    assert found.count() == 39


def test_line_dedup_leaves_no_shuffle_files_of_its_steps(spark):
    folders = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())

    def files():
        places = [f"{d}/{inner}blockmgr-*/*/shuffle_*.data" for d in folders.split(",") for inner in ("", "*/")]
        return {f for place in places for f in glob.glob(place)}

    line = "a line of words that is long enough"
    docs = spark.createDataFrame([(i, f"{line} {i % 3}\n{line}s {i}") for i in range(30)], "doc_id long, text string")
    before, setting = files(), spark.conf.get(common.FREED)
    found = lines.removed_lines(docs, share=lines.SHARE)
    for _ in range(50):  # executors delete them a little later
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(common.FREED) == setting
    assert found.count() == found.count() > 0
