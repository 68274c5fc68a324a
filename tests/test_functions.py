import pytest
from pyspark.sql import functions as F

from replycast.functions import html, scalars, words
from replycast.functions.pos import read_lexicon, tag_word
from replycast.functions.stem import porter
from replycast.operators.nlp import text_features, with_nlp


def one(spark, column, **values):
    columns = [F.lit(v).alias(n) for n, v in values.items()]
    return spark.range(1).select(*columns).select(column.alias("r")).head().r


@pytest.mark.parametrize(
    "body, clean, nocode",
    [
        ("<p>Hi&nbsp;there <code>x=1</code></p>", "Hi there x=1", "Hi there"),
        ("<p>a\nb   c</p>", "a b c", "a b c"),
        ("<code>1\n2</code>", "1 2", ""),
        ("<not\nclosed>x", "<not closed>x", "<not closed>x"),
        ("", "", ""),
    ],
)
def test_clean_html(spark, body, clean, nocode):
    row = html.body_lengths(spark.createDataFrame([(body,)], "body string")).head()
    assert (row.body_clean, row.body_clean_nocode) == (clean, nocode)
    assert row.body_n_characters == len(clean)
    assert one(spark, html.clean_html_nocode(F.col("b")), b=body) == nocode


def test_code_share_of_empty_body_is_null(spark):
    row = html.body_lengths(spark.createDataFrame([("<p></p>",)], "body string")).head()
    assert row.body_n_characters == 0 and row.body_code_perc is None


def test_html_flags_need_the_pieces_in_order(spark):
    rows = [("</code><code>",), ("<b>\nx</b><img src=a>",), ('<a href="u">l</a>',)]
    found = html.html_flags(spark.createDataFrame(rows, "body string")).collect()
    flags = [
        (r.body_code_flag, r.body_image_flag, r.body_link_flag, r.body_bold_flag) for r in found
    ]
    assert flags == [(0, 0, 0, 0), (0, 1, 0, 1), (0, 0, 1, 0)]


def test_title_flags(spark):
    rows = spark.createDataFrame([("Why?",), ("why",), ("",), ("Äh",)], "title string")
    found = html.title_flags(rows).collect()
    flags = [(r.title_upper_flag, r.title_question_flag, r.title_n_characters) for r in found]
    assert flags == [(1, 1, 4), (0, 0, 3), (0, 0, 0), (0, 0, 2)]


def test_split_tags(spark):
    assert one(spark, scalars.split_tags(F.col("t")), t="<a><b-c>") == ["a", "b-c"]
    assert one(spark, scalars.split_tags(F.lit(None).cast("string"))) is None


def test_n_tags_of_null_is_zero(spark):
    assert one(spark, scalars.n_tags(F.lit(None).cast("array<string>"))) == 0


def test_within_days_counts_calendar_days_and_earlier_events(spark):
    start = F.to_timestamp(F.lit("2020-01-01 23:59:00"))

    def within(text, n):
        return one(spark, scalars.within_days(start, F.to_timestamp(F.lit(text)), n))

    assert within("2020-01-01 00:00:00", 1)
    assert within("2019-06-01 00:00:00", 1)
    assert not within("2020-01-02 00:00:00", 1)
    assert within("2020-01-30 23:00:00", 30) and not within("2020-01-31 00:00:00", 30)


def test_forum_names(spark):
    assert one(spark, scalars.forum_key(F.lit("Unix.StackExchange.com"))) == "unix-stackexchange-com"
    assert scalars.forum_flag_name("askubuntu-com") == "askubuntu_com_flag"


def test_title_in_body(spark):
    title, body = F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"))
    assert one(spark, scalars.title_in_body(title, body)) == 0.5
    assert one(spark, scalars.title_in_body(F.array().cast("array<string>"), body)) is None


def test_tokens_and_sentences(spark):
    text = "It's a test_case, v1.2! Über\tall...  Done"
    assert one(spark, words.tokens(F.col("t")), t=text) == [
        "It's", "a", "testcase", "v12", "ber", "all", "Done",
    ]
    assert one(spark, words.sentence_count(F.col("t")), t=text) == 3
    assert one(spark, words.sentence_count(F.col("t")), t="...") == 0
    assert one(spark, words.tokens(F.lit(None).cast("string"))) == []
    kept = words.without_stop_words(words.tokens(F.col("t")))
    assert one(spark, kept, t="The cat IS on the mat mat") == ["cat", "mat", "mat"]


# known pairs of the published algorithm
@pytest.mark.parametrize(
    "word, stem",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("feed", "feed"),
        ("agreed", "agre"), ("plastered", "plaster"), ("bled", "bled"), ("motoring", "motor"),
        ("sing", "sing"), ("conflated", "conflat"), ("sized", "size"), ("hopping", "hop"),
        ("falling", "fall"), ("hissing", "hiss"), ("filing", "file"), ("happy", "happi"),
        ("sky", "sky"), ("relational", "relat"), ("conditional", "condit"), ("rational", "ration"),
        ("digitizer", "digit"), ("operator", "oper"), ("hopefulness", "hope"),
        ("formalize", "formal"), ("electrical", "electr"), ("goodness", "good"),
        ("revival", "reviv"), ("adjustable", "adjust"), ("replacement", "replac"),
        ("adoption", "adopt"), ("probate", "probat"), ("cease", "ceas"), ("controll", "control"),
        ("roll", "roll"), ("generalizations", "gener"), ("oscillators", "oscil"), ("IS", "is"),
    ],
)
def test_porter(word, stem):
    assert porter(word) == stem


def test_tag_word():
    tags = [tag_word(w) for w in ("They", "quickly", "running", "2020", "cats", "class", "zebra")]
    assert tags == ["PRP", "RB", "VBG", "CD", "NNS", "NN", "NN"]
    assert tag_word("zebra", {"zebra": "JJ"}) == "JJ"


def test_text_features(spark):
    rows = spark.createDataFrame(
        [(1, "The cats quickly chased cats. They ran!"), (2, ""), (3, None)], "id int, t string"
    )
    first, empty, missing = text_features(rows, "t", "t").orderBy("id").collect()
    assert (first.t_n_sentences, first.t_n_words) == (2, 7)
    assert (first.t_n_pronouns, first.t_n_adverbs) == (1, 1)
    assert sorted(first.t_stems) == ["cat", "chase", "quickli", "ran"]
    assert first.t_n_distinct_words == len(first.t_stems)
    assert (empty.t_n_words, empty.t_stems, missing.t_n_words) == (0, [], 0)


def test_with_nlp_shares_title_stems(spark):
    rows = spark.createDataFrame(
        [("Cats are running here", "Run cat fast"), ("x", ""), ("", "x")], "b string, title string"
    )
    found = with_nlp(rows, "b").collect()
    assert [r.title_in_body_perc for r in found] == [2 / 3, None, 0.0]
    assert [r.title_n_words for r in found] == [3, 0, 1]


def test_lexicon_size_is_checked(spark):
    table = spark.createDataFrame([("Zebra", "JJ"), ("b", "NN")], "token string, tag string")
    assert read_lexicon(table) == {"zebra": "JJ", "b": "NN"}
    with pytest.raises(ValueError):
        read_lexicon(table, max_words=1)
