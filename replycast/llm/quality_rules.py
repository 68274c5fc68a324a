"""Quality rules: thresholds from mergeable quantile sketches per language and source.

A null text has no words and fails. Null languages and sources are groups of their own. Repeated rows
count as often as they occur. An empty table gives an empty table. A very long text is measured whole, by
array functions over its words. Only the named columns are read.

A sketch holds counts of logarithmic bins: bin b has the values in (G^(b-1), G^b], so that a quantile is
off by a factor of G at most. Sketches merge by adding counts, in any order, with the same result. Rates are
smoothed, so that a text without symbols or repeats has a value as well: the spread of a measure is never
that of zeros alone, and one symbol in a short text is not the rate of a long text full of them.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import saved, without_blanks, words

GROWTH = 1.005
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Measures of documents with words, all above zero.
MEASURES = {
    "symbol_rate": "(n_symbols + 1) / (word_chars + 100)",
    "exclamation_rate": "(n_exclamations + 1) / (n_words + 20)",
    "dup_line_rate": "(n_dup_lines + 1) / (n_lines + 5)",
    "repeat_rate": "(n_repeat_words + 1) / (n_words + 20)",
    "stutter_rate": "(n_stutters + 1) / (n_words + 20)",
    "word_length": "word_chars / n_words",
}
#: Measures that can also be too low.
BOTH_SIDES = ("word_length",)
#: Distance of a fence from its quartile, in distances between the quartiles, on the logarithmic scale.
FENCE = 3
#: A source with fewer documents has the fences of its language, a language with fewer those of all.
MIN_GROUP = 50


def _shingles(list_col, size):
    """Hashes of all runs of `size` words (a power of two) of an array column."""
    step, hashes = 1, F.col(list_col)
    n = F.size(list_col)
    while step < size:
        hashes = F.zip_with(hashes, F.slice(hashes, step + 1, n), lambda a, b: F.xxhash64(a, b))
        step *= 2
    return F.when(n >= size, F.slice(hashes, 1, n - size + 1)).otherwise(
        F.array().cast("array<bigint>")
    )


def _placed(hashes):
    """Sorted pairs of hash and place."""
    return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _covered(placed_col, size):
    """Words in the runs whose hash occurs twice or more, from a column of `_placed`."""

    def repeated(run, k):
        alike = [
            F.coalesce(F.get(F.col(placed_col), n)["h"] == run["h"], F.lit(False)) for n in (k - 1, k + 1)
        ]
        return alike[0] | alike[1]

    starts = F.sort_array(F.transform(F.filter(placed_col, repeated), lambda run: run["i"]))
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(
            (i + size).alias("end"), (a["n"] + i + size - F.greatest(a["end"], i)).alias("n")
        ),
        lambda a: a["n"],
    )


def measure(docs, id_col="doc_id", text_col="text", lang_col="lang", source_col="source"):
    """Counts of each document: words, their characters, symbols, repeated lines and words.

    A stutter is a word that equals the next one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"),
        text.alias("text"),
        words(text).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.length(without_blanks(x)) > 0).alias("lines"),
    )
    stutters = F.zip_with("words", F.slice("words", 2, F.size("words")), lambda a, b: a.eqNullSafe(b))
    removed = lambda pattern: F.length("text") - F.length(F.regexp_replace("text", pattern, ""))
    rows = rows.withColumn("runs", _shingles("words", WINDOW))
    repeats = F.size(F.array_distinct("runs")) < F.size("runs")
    rows = rows.withColumn("placed", F.when(repeats, _placed(F.col("runs"))))
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.length(without_blanks(F.col("text"))),
        "n_symbols": removed("[#*$%&|<>]"),
        "n_exclamations": F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit(""))),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.coalesce(_covered("placed", WINDOW), F.lit(0)),
        "n_stutters": F.size(F.array_remove(stutters, False)),
    }
    return rows.select(
        "doc_id", "lang", "source", *(c.cast("long").alias(n) for n, c in counts.items())
    )


def _bins():
    """Bin of each measure; null for a document without words."""
    return {
        name: F.when(F.col("n_words") > 0, F.ceil(F.log(F.expr(value)) / math.log(GROWTH)).cast("int"))
        for name, value in MEASURES.items()
    }


def sketch(rows):
    """Counts of bins: the sketches of each measure for each language and source."""
    bins = _bins()
    named = [F.struct(F.lit(n).alias("name"), F.col(f"_{n}").alias("bin")) for n in MEASURES]
    return (
        rows.filter("n_words > 0")
        .select("lang", "source", *(b.alias(f"_{n}") for n, b in bins.items()))
        .select("lang", "source", F.inline(F.array(*named)))
        .groupBy("lang", "source", "name", "bin")
        .agg(F.count("*").alias("n"))
    )


def merged(sketches):
    """Sketches of each source (level 0), each language (level 1) and all documents (level 2)."""
    nothing = F.lit(None).cast("string")
    levels = [
        F.struct(F.lit(k).alias("level"), lang.alias("lang"), source.alias("source"))
        for k, (lang, source) in enumerate(
            [(F.col("lang"), F.col("source")), (F.col("lang"), nothing), (nothing, nothing)]
        )
    ]
    return (
        sketches.select(F.inline(F.array(*levels)), "name", "bin", "n")
        .groupBy("level", "lang", "source", "name", "bin")
        .agg(F.sum("n").alias("n"))
    )


def fences(sketches):
    """Lowest and highest bin allowed in each group of `merged` sketches, and its number of documents.

    They lie `FENCE` times the distance between the quartiles beyond these. Both quartiles stay those of the
    good documents as long as fewer than a quarter of a group are bad on one side. A group has no more bins
    than the range of a measure, however many documents it has.
    """
    group = Window.partitionBy("level", "lang", "source", "name")
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bin")))
    quartiles = (
        sketches.withColumn("upto", F.sum("n").over(group.orderBy("bin")))
        .withColumn("total", F.sum("n").over(group))
        .groupBy("level", "lang", "source", "name")
        .agg(at(0.25).alias("first"), at(0.75).alias("third"), F.first("total").alias("total"))
    )
    beyond = FENCE * (F.col("third") - F.col("first"))
    ends = {"low": F.col("first") - beyond, "high": F.col("third") + beyond}
    per_name = [
        F.max(F.when(F.col("name") == n, end)).alias(f"{n}_{side}")
        for n in MEASURES
        for side, end in ends.items()
        if side == "high" or n in BOTH_SIDES
    ]
    return quartiles.groupBy("level", "lang", "source").agg(F.max("total").alias("n_docs"), *per_name)


def group_fences(sketches):
    """For each language and source, its own fences or those of the group it is pooled with."""
    found = saved(fences(merged(sketches)))
    langs = found.filter("level = 1").select(F.col("lang").alias("l"), F.col("n_docs").alias("n_lang"))
    level = F.when(F.col("n_docs") >= MIN_GROUP, 0).when(F.col("n_lang") >= MIN_GROUP, 1).otherwise(2)
    groups = (
        found.filter("level = 0")
        .join(langs, F.col("lang").eqNullSafe(F.col("l")))
        .select("lang", "source", level.alias("level"))
    )
    pooled = found.withColumnsRenamed({"level": "k", "lang": "l", "source": "s"})
    of_level = (
        (F.col("level") == F.col("k"))
        & F.when(F.col("level") < 2, F.col("lang")).eqNullSafe(F.col("l"))
        & F.when(F.col("level") < 1, F.col("source")).eqNullSafe(F.col("s"))
    )
    return groups.join(pooled, of_level).drop("k", "l", "s")


def quality_rules(docs, id_col="doc_id", text_col="text", lang_col="lang", source_col="source"):
    """Counts of each document, `base_failed` by fixed cutoffs, `kept` by both these and the fences.

    The fences of a language and source come from all its documents, or from those of a wider group if they
    are few. The table of counts is written once and read twice: for the sketches and for the filter joined
    to the fences.
    """
    rows = saved(measure(docs, id_col, text_col, lang_col, source_col))
    limits = group_fences(sketch(rows)).drop("level", "n_docs").withColumnsRenamed({"lang": "l", "source": "s"})
    joined = rows.join(
        limits,
        F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")),
        "left",
    )
    inside = F.lit(True)
    for name, measured in _bins().items():
        inside &= measured <= F.col(f"{name}_high")
        if name in BOTH_SIDES:
            inside &= measured >= F.col(f"{name}_low")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return joined.select(
        *rows.columns, failed.alias("base_failed"), (~failed & F.coalesce(inside, F.lit(False))).alias("kept")
    )
