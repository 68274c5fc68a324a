"""Line dedup: equal lines by hash, almost equal ones by a segment-partition edit join.

Lines are what stands between line feeds; those of fewer than `MIN_CHARS` code points are left alone. A
line goes if the same line, or one within `DISTANCE` edits, stands earlier: at a smaller id (null last),
with equal ids at a smaller text hash, or further up in the text. A null text has no lines and stays
null. Rows that repeat id and text count as one document. An empty table gives an empty table. Other
columns may have any names.

The join splits a line into one segment more than edits are allowed, so a line within that distance has
one of them unchanged, and not far from its place. The index holds a line's segments by length, number
and content; a line probes it for its own length and the shorter ones, at the few places that an
alignment with the edits left can give. Groups with few lines are paired, and pairs are verified. In a
large group the matched segment is cut out, and what is left is split and joined in the same way, which
cannot lose a pair: what is left of two lines is within the distance if the lines are. That ends when
hardly a character is left. With a distance of 1 cuts lie at one place in both lines, so lines whose rests
match are within it, and all lines with the same rest are one. With larger distances these last groups,
whose lines agree in all but a few characters, are paired and verified like the others.

With `share`, a line also goes if an earlier one is within one edit of whole words for each `share` words of
the longer of the two. These lines meet by their least common runs of `RUN` words: k edits change at most
`RUN` * k of a line's runs, so of that many and one more, taken in the same order from both lines, one is
common to both. A passage that many lines have is thus a key only of lines with little else. What meets is
verified by its words, in large groups with the first lines first, until an earlier one is near.
"""

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from . import alike
from .common import saved, saved_alone, shuffles_freed, words  # noqa: F401 (tests use saved)
from .ordering import placed

MIN_CHARS = 20
DISTANCE = 1
SECOND_SEED = 7
#: Groups are paired if that gives at most this many pairs for each entry.
FEW = 16
#: Words for each word edit.
SHARE = 20
#: Words of the runs by which lines meet.
RUN = 2
#: Runs that are known as common, bits of their table, and one line in so many is counted for it.
COMMON = 1 << 17
BITS = 19
EVERY = 8
#: Earlier lines of a large group that are compared next, for each one compared before.
BATCH = 4

ID = ["h1", "h2"]


def _bucketed(df, columns):
    """`df` as a compressed table in the shared folder, in buckets, so that joins needn't shuffle it.

    The table's name is given up at once; its files stay in the shared folder.
    """
    spark, name = df.sparkSession, f"llm_{uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_freed(spark):
        writer = df.select("*").write.option("compression", "zstd").option("path", f"{shared_dir(spark)}/{name}")
        writer.bucketBy(buckets, *columns).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def _written(df):
    """`df` as compressed files in the shared folder, so that it is computed once."""
    path = f"{shared_dir(df.sparkSession)}/lines-{uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.select("*").write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _hashes(column):
    return [F.xxhash64(column).alias("h1"), F.xxhash64(F.lit(SECOND_SEED), column).alias("h2")]


def _occurrences(docs, id_col, text_col, *more):
    """Each long enough line with its place: id, hash of the text, number in the text."""
    lines = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("k"),
        F.posexplode(F.split(F.col(text_col), "\n")).alias("no", "line"),
    ).filter(F.length("line") >= MIN_CHARS)
    return lines.select("doc_id", "k", "no", *_hashes(F.col("line")), *more)


def _place():
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k", "no")


def _entries(rows, distance):
    """Index and probe entries of `rows`: base, id, what is left of a line as `rest`, `l`, `role`, `cuts`.

    `l` is the length of the indexed line that a row is about, so a row probes for one length; a row with
    `role` is of that length and is indexed too. An entry is a key, the length left to the indexed line,
    its role, and the cut taken out: place in the upper, length in the lower half of a number.
    """
    parts = distance + 1
    kept = [c for c in rows.columns if c in (*ID, "id", "n", "cuts")]
    # a segment has few places; steps in small expressions, so that each compiles on its own
    choices = [
        F.struct(F.lit(i).alias("i"), F.lit(step).alias("step"))
        for i in range(1, parts + 1)
        for step in range(2 * min(i - 1, parts - i) + 1)
    ]
    rows = rows.withColumn("longer", F.length("rest") - F.col("l")).select("*", F.inline(F.array(*choices)))
    # even segments, the longer ones last
    rows = rows.withColumns(
        {"short": F.expr(f"int(l div {parts})"), "few": F.expr(f"{parts} - l % {parts}")}
    )
    rows = rows.withColumns(
        {
            "width": F.expr("short + int(i > few)"),
            "at": F.expr("1 + (i - 1) * short + greatest(0, i - 1 - few)"),
        }
    )
    rows = rows.withColumn("place", F.expr(f"greatest(1, at - (i - 1), at + longer - ({parts} - i)) + step"))
    rows = rows.filter("width > 0").filter(
        f"place <= least(l + longer - width + 1, at + (i - 1), at + longer + ({parts} - i))"
    )
    segment = F.expr("substring(rest, place, width)")
    return rows.select(
        *kept,
        F.xxhash64("base", "l", "i", segment).alias("key"),
        (F.col("l") - F.col("width")).alias("l"),
        F.expr("role AND longer = 0 AND place = at").alias("role"),
        F.expr("shiftleft(bigint(place), 32) | width").alias("cut"),
    )


def _first_rows(lines, distance):
    """Each line once for every length it can be matched with."""
    shorter = F.explode(F.sequence(F.lit(0), F.lit(distance)))
    rows = lines.select(*ID, F.col("line").alias("rest"), shorter.alias("less"))
    return rows.select(
        *ID, "rest", F.lit(0).cast("long").alias("base"), (F.length("rest") - F.col("less")).alias("l"),
        (F.col("less") == 0).alias("role"),
    )


def _rest(line, cuts):
    """Line without what was cut out of it, one cut after the other."""

    def without(text, cut):
        at = F.shiftright(cut, 32).cast("int")
        width = cut.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
        return F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + width, F.length(text)))

    return F.aggregate(cuts, line, without)


def _pairs(entries):
    """Pairs of an indexed line and another one with the same key."""
    a = entries.filter("role").select("key", F.col("h1").alias("a1"), F.col("h2").alias("a2"))
    b = entries.select("key", F.col("h1").alias("b1"), F.col("h2").alias("b2"))
    return a.join(b, "key").filter("a1 != b1 OR a2 != b2").drop("key").distinct()


def _candidates(lines, distance):
    """Pairs of lines with a common segment and, of the groups split to the end, ids of lines with an earlier one.

    Both are written level by level, so that no plan holds the joins of all the levels.
    """
    entries = _entries(_first_rows(lines, distance), distance)
    entries = entries.withColumn("cuts", F.lit(None).cast("array<bigint>"))
    pairs, ends = [], []
    while True:
        sizes = entries.groupBy("key").agg(
            F.count(F.when(F.col("role"), 1)).alias("n_index"), F.count("*").alias("n")
        )
        sizes = sizes.filter("n_index > 0 AND n > 1")
        # cuts of earlier levels and the one of this level
        cuts = F.concat(F.coalesce("cuts", F.array().cast("array<bigint>")), F.array("cut"))
        groups = saved_alone(entries.join(sizes, "key").withColumn("cuts", cuts).drop("cut"))
        few = F.col("n_index") * F.col("n") <= FEW * F.col("n")
        pairs.append(saved_alone(_pairs(groups.filter(few))))
        large = groups.filter(~few).drop("n_index", "n")
        if large.isEmpty():
            return pairs, ends
        rows = large.withColumnRenamed("key", "base").join(lines.select(*ID, "line", "first"), ID)
        rows = rows.withColumn("rest", _rest(F.col("line"), F.col("cuts"))).drop("line")
        if not large.filter(F.col("l") <= distance).isEmpty():
            last = rows.filter(F.col("l") <= distance)
            if distance == 1:
                ends.append(saved_alone(_ended(last, distance)))
            else:
                pairs.append(saved_alone(_pairs(last.withColumnRenamed("base", "key"))))
        entries = _entries(rows.filter(F.col("l") > distance).drop("first"), distance)


def _let(value, function):
    """`function` of a value that is computed once."""
    return F.transform(F.array(value), function)[0]


def _without_common_ends(a, b):
    """Two texts without what both begin or end with, which does not change their distance.

    Ends go in pieces of falling size, so up to a few characters can be left.
    """
    sizes = F.array(*(F.lit(1 << k) for k in range(14, 2, -1)))

    def shorten(piece, rest):
        def step(s, size):
            same = (piece(s["a"], size) == piece(s["b"], size)) & (
                F.least(F.length(s["a"]), F.length(s["b"])) >= size
            )
            return F.when(same, F.struct(*(rest(s[c], size).alias(c) for c in "ab"))).otherwise(s)

        return step

    begun = F.aggregate(
        sizes,
        F.struct(a.alias("a"), b.alias("b")),
        shorten(F.left, lambda text, size: F.right(text, F.length(text) - size)),
    )
    return F.aggregate(
        sizes, begun, shorten(F.right, lambda text, size: F.left(text, F.length(text) - size))
    )


def within(a, b, distance):
    """Whether two texts are at most `distance` edits apart: a banded automaton kept in bits.

    Common ends are cut off first. Bit k of the e-th number says that e edits can lead to the diagonal k - `distance`, where the place
    in the one text is that much ahead of the place in the other. A step takes one character of `b`: a
    match and a substitution stay on a diagonal, an insertion leaves it downwards, a deletion upwards.
    """
    everywhere = (1 << (2 * distance + 1)) - 1
    names = [f"r{e}" for e in range(distance + 1)]

    def bits(column):
        return column.bitwiseAND(F.lit(everywhere).cast("long"))

    def matches(x, state, char):
        found = F.lit(0).cast("long")
        for k in range(2 * distance + 1):
            same = F.get(x, state["i"] + (k - distance)) == char
            found = found + F.when(same, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
        return F.struct(found.alias("m"), *(state[r].alias(r) for r in names))

    def moved(state):
        new = []
        for e, r in enumerate(names):
            value = state[r].bitwiseAND(state["m"])
            if e:
                left = state[names[e - 1]]
                value = value.bitwiseOR(left).bitwiseOR(F.shiftright(left, 1))
                value = value.bitwiseOR(bits(F.shiftleft(new[-1], 1)))
            new.append(value)
        return [value.alias(r) for value, r in zip(new, names)]

    def step(x, state, char):
        # the last number has every diagonal that the others have
        dead = state[names[-1]] == 0
        after = _let(matches(x, state, char), lambda s: F.struct((state["i"] + 1).alias("i"), *moved(s)))
        return F.when(dead, state).otherwise(after)

    start = [sum(1 << (distance + d) for d in range(e + 1)) for e in range(distance + 1)]
    state = F.struct(
        F.lit(0).alias("i"), *(F.lit(v).cast("long").alias(r) for v, r in zip(start, names))
    )

    def accepted(texts):
        end = F.size(texts["x"]) - F.size(texts["y"]) + distance

        def finish(state):
            ever = state[names[-1]]
            set_bits = [
                F.shiftright(ever, k).bitwiseAND(F.lit(1).cast("long")) == 1 for k in range(2 * distance + 1)
            ]
            return F.coalesce(F.get(F.array(*set_bits), end), F.lit(False))

        return F.aggregate(texts["y"], state, lambda s, c: step(texts["x"], s, c), finish)

    def rest_within(rest):
        shorter, longer = (f(F.length(rest["a"]), F.length(rest["b"])) for f in (F.least, F.greatest))
        texts = F.struct(F.split(rest["a"], "").alias("x"), F.split(rest["b"], "").alias("y"))
        return F.when(shorter == 0, longer <= distance).otherwise(_let(texts, accepted))

    return _let(_without_common_ends(a, b), rest_within)


def _ended(rows, distance):
    """Lines of groups split to the end that have an earlier one within the distance.

    What is left of the lines has at most `distance` characters, or twice as many of a longer line. Lines
    of a group with the same rest are one; their rests are compared, and each line with the first one of
    all that match.
    """
    key = ["base", "l", "role", "rest"]
    classes = rows.groupBy(*key).agg(F.min("first").alias("least"))
    sides = {
        side: classes.select(*(F.col(c).alias(f"{side}_{c}") for c in (*key, "least"))) for side in "ab"
    }
    met = sides["a"].join(
        sides["b"],
        (F.col("a_base") == F.col("b_base")) & (F.col("a_l") == F.col("b_l"))
        & (F.col("a_role") | F.col("b_role")),
    ).filter(F.levenshtein("a_rest", "b_rest") <= distance)
    met = met.groupBy(*(F.col(f"a_{c}").alias(c) for c in key)).agg(F.min("b_least").alias("least"))
    return rows.join(met, key).filter("least < first").select(*ID)


def near_earlier(lines, distance=DISTANCE):
    """Ids of the lines (h1, h2, line, first) with an earlier line within `distance` edits."""
    pairs, ends = _candidates(lines, distance)
    every = pairs[0]
    for more in pairs[1:]:
        every = every.unionByName(more)
    a = lines.select(
        F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("line").alias("a_line"),
        F.col("first").alias("a_first"),
    )
    b = lines.select(
        F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("line").alias("b_line"),
        F.col("first").alias("b_first"),
    )
    checked = every.distinct().join(a, ["a1", "a2"]).join(b, ["b1", "b2"])
    checked = checked.filter(within(F.col("a_line"), F.col("b_line"), distance))
    later = F.col("a_first") > F.col("b_first")
    found = checked.select(
        F.when(later, F.col("a1")).otherwise(F.col("b1")).alias("h1"),
        F.when(later, F.col("a2")).otherwise(F.col("b2")).alias("h2"),
    )
    for ids in ends:
        found = found.unionByName(ids)
    return found.distinct()


def _as_characters(tokens):
    """A text with one character for each word, by 20 bits of a hash of the word."""
    points = F.transform(
        tokens, lambda w: F.lpad(F.hex(F.pmod(F.xxhash64(w), F.lit(1 << 20)) + (1 << 16)), 8, "0")
    )
    return F.decode(F.unhex(F.array_join(points, "")), "UTF-32")


def _runs(line):
    """Hashes of the different two-word runs of a line."""

    def paired(hashes):
        following = F.slice(hashes, 2, F.size(hashes))
        pairs = F.zip_with(hashes, following, lambda a, b: F.xxhash64(a, b))
        return F.array_distinct(F.slice(pairs, 1, F.greatest(F.size(hashes) - 1, F.lit(0))))

    return _let(F.transform(words(line), lambda w: F.xxhash64(w)), paired)


def _common(lines):
    """How common the `COMMON` most frequent runs are, in half powers of two, by the last bits of their hashes.

    One line in `EVERY` is counted. It says which of a line's runs are looked up, not which lines are found.
    """
    runs = lines.filter(F.pmod("id", F.lit(EVERY)) == 0).select(F.explode(_runs(F.col("line"))).alias("run"))
    counted = runs.groupBy("run").agg(F.count("*").alias("n")).filter("n > 1")
    counted = counted.orderBy(F.desc("n"), "run").limit(COMMON)
    table = bytearray(1 << BITS)
    for run, level in counted.select("run", F.floor(2 * F.log2("n")).cast("int")).collect():  # at most COMMON
        place = run & ((1 << BITS) - 1)
        table[place] = max(table[place], level)
    return F.lit(bytes(table))


def _word_entries(lines, share):
    """Entries (key, id, n) under which lines within the word edits of `share` meet: a line's least common runs.

    k edits change at most `RUN` * k of a line's different runs, and not all of them. Of both lines that many and
    one more are entered, the first in an order that is the same for all lines, or all if there are fewer; so one
    is common to both. Of the shorter one, too, k is at most the `share` - 1st part of its words.
    """
    if share <= 2 * RUN:
        raise ValueError(f"share is too small for runs of {RUN} words")
    long = lines.filter(F.col("n") >= share - 1)
    table = _common(long)

    def ranked(run):
        place = run.bitwiseAND(F.lit((1 << BITS) - 1).cast("long")).cast("int") + 1
        return F.struct(F.substring(table, place, F.lit(1)).alias("level"), run.alias("key"))

    runs = F.array_sort(F.transform(_runs(F.col("line")), ranked))
    taken = F.slice(runs, 1, (RUN * F.floor(F.col("n") / (share - 1)) + 1).cast("int"))
    return long.select("id", "n", F.explode(taken).alias("run")).select("run.key", "id", "n")


def _word_edits(a, b, edits):
    """Whether two arrays of words are within so many edits: words as characters by their place in both."""
    both = F.array_distinct(F.concat(a, b))

    def text(tokens, vocabulary):
        points = F.transform(
            tokens, lambda w: F.lpad(F.hex(F.array_position(vocabulary, w) + (1 << 16)), 8, "0")
        )
        return F.decode(F.unhex(F.array_join(points, "")), "UTF-32")

    return _let(both, lambda v: F.levenshtein(text(a, v), text(b, v)) <= edits)


def _checked_by_words(lines, wanted, share):
    """A function that leaves of pairs (a_h1, a_h2, b_h1, b_h2) of `wanted` lines those within the word edits.

    Pairs whose words differ by 20 bits of a hash already are left out; the others' words are compared.
    """
    texts = lines.join(wanted.distinct(), ID, "left_semi")
    texts = _bucketed(texts.select(*ID, "n", "line", _as_characters(words(F.col("line"))).alias("text")), ID)

    def side(name, *columns):
        return texts.select(*(F.col(c).alias(f"{name}_{c}") for c in (*ID, *columns)))

    def brought(pairs, *columns):
        for name in "ab":
            pairs = pairs.join(side(name, *columns), [f"{name}_{c}" for c in ID])
        return pairs.withColumn("edits", F.floor(F.greatest("a_n", "b_n") / share).cast("int"))

    def check(pairs):
        ends = pairs.columns
        near = brought(pairs, "n", "text").filter("levenshtein(a_text, b_text, edits) >= 0").select(*ends)
        near = brought(saved_alone(near), "n", "line")
        a, b = (words(F.col(f"{name}_line")) for name in "ab")
        return near.filter(_word_edits(a, b, F.col("edits"))).select(*ends)

    return check


def near_earlier_by_words(lines, share=SHARE, settled=None):
    """Ids of the lines (h1, h2, line, first, id, n) with an earlier line within the word edits of `share`.

    Lines of `settled` are only compared as earlier ones. In a group of up to `alike.FEW` entries each line is
    compared with all earlier ones. In a larger one it is compared with the first few, then with `BATCH` times
    as many that follow, and so on, until it is near one: only lines with none are compared with all.
    """
    entries = _written(_word_entries(lines, share))
    sizes = entries.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    groups = entries.join(sizes, "key").join(lines.select("id", "first", *ID), "id").drop("id")
    groups = saved_alone(groups)

    def met(later, earlier, place):
        """Pairs of a line and an earlier one with the same key and about as many words."""
        a, b = (
            rows.select("key", *(F.col(c).alias(f"{name}_{c}") for c in (*ID, "n", place)))
            for name, rows in (("a", earlier), ("b", later))
        )
        near_size = F.least("a_n", "b_n") >= (1 - 1 / share) * F.greatest("a_n", "b_n") - 1e-6
        pairs = a.join(b, "key").filter(near_size & (F.col(f"a_{place}") < F.col(f"b_{place}")))
        return pairs.select(*(f"{name}_{c}" for name in "ab" for c in ID)).distinct()

    def unsettled(rows, found):
        return rows if found is None else rows.join(found, ID, "left_anti")

    few = groups.filter(F.col("size") <= alike.FEW)
    pairs = saved_alone(met(unsettled(few, settled), few, "first"))
    large = placed(groups.filter(F.col("size") > alike.FEW), ["first"], ["key"], name="rank")
    large = saved_alone(large.select("key", "n", "rank", *ID))
    wanted = [pairs.select(*(F.col(f"{name}_{c}").alias(c) for c in ID)) for name in "ab"]
    check = _checked_by_words(lines, reduce(DataFrame.union, wanted, large.select(*ID)), share)

    def later(pairs):
        return saved_alone(check(pairs).select(*(F.col(f"b_{c}").alias(c) for c in ID)).distinct())

    found = later(pairs)
    left = unsettled(unsettled(large, settled), found)
    start, stop = 0, alike.FEW
    while True:
        left = saved_alone(left.filter(F.col("rank") > start))
        if left.isEmpty():
            return found
        more = later(saved_alone(met(left, large.filter(F.col("rank").between(start, stop - 1)), "rank")))
        found, left = found.unionByName(more), unsettled(left, more)
        start, stop = stop, stop * BATCH


def removed_lines(docs, id_col="doc_id", text_col="text", distance=DISTANCE, share=None):
    """`doc_id`, `k` (hash of the text) and the `removed` line numbers, `n_exact` and `n_near`, of texts
    that lose a line."""
    lines = _occurrences(docs, id_col, text_col, "line")
    lines = lines.groupBy(*ID).agg(
        F.first("line").alias("line"), F.min(_place()).alias("first"), F.count("*").alias("n")
    )
    if share is not None:
        # a number for each line, made as the table is written, and the size in words
        lines = lines.withColumns({"id": F.monotonically_increasing_id(), "n_words": F.size(words(F.col("line")))})
    lines = _bucketed(lines, ID)
    near = near_earlier(lines, distance)
    if share is not None:
        numbered, near = lines.drop("n").withColumnRenamed("n_words", "n"), saved_alone(near)
        near = near.unionByName(near_earlier_by_words(numbered, share, near)).distinct()
    near = near.withColumn("near", F.lit(True))
    repeated = lines.select(*ID, "first", "n").join(near, ID, "left").filter("near OR n > 1")
    # written, so that the join reads shuffles on both sides and a line in very many places is split
    repeated = saved_alone(repeated.select(*ID, "first", F.coalesce("near", F.lit(False)).alias("near")))
    found = _occurrences(docs, id_col, text_col).join(repeated, ID)
    found = found.withColumn("later", _place() > F.col("first")).filter("later OR near")
    return found.groupBy("doc_id", "k").agg(
        F.collect_set("no").alias("removed"),
        F.count_distinct(F.when(F.col("later"), F.col("no"))).alias("n_exact"),
        F.count_distinct(F.when(~F.col("later"), F.col("no"))).alias("n_near"),
    )


def line_dedup(docs, id_col="doc_id", text_col="text", distance=DISTANCE, share=None):
    """Of each document `n_lines`, `n_exact`, `n_near` and the numbers of `removed` lines, from 0."""
    removed = removed_lines(docs, id_col, text_col, distance, share).withColumnsRenamed({"doc_id": "r", "k": "rk"})
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("k"),
        F.coalesce(F.size(F.split(F.col(text_col), "\n")), F.lit(0)).cast("long").alias("n_lines"),
    )
    joined = rows.join(removed, F.col("doc_id").eqNullSafe(F.col("r")) & (F.col("k") == F.col("rk")), "left")
    return joined.select(
        "doc_id",
        "n_lines",
        F.coalesce("n_exact", F.lit(0)).alias("n_exact"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.sort_array(F.coalesce("removed", F.array().cast("array<int>"))).alias("removed"),
    )


def without_removed(docs, id_col="doc_id", text_col="text", distance=DISTANCE, share=None):
    """The rows of `docs`, their texts without the removed lines; other columns stay as they are."""
    removed = removed_lines(docs, id_col, text_col, distance, share).withColumnsRenamed({"doc_id": "r", "k": "rk"})
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("k")
    )
    joined = rows.join(removed, F.col("doc_id").eqNullSafe(F.col("r")) & (F.col("k") == F.col("rk")), "left")
    text = F.col("row")[text_col]
    kept = F.filter(F.split(text, "\n"), lambda line, no: ~F.array_contains("removed", no))
    text = F.when(F.col("removed").isNull(), text).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns)
    )
