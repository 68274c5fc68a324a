"""Packing of token ids into sequences: cutting-stock patterns by column generation, and a stream for the rest.

A text's ids, and one that ends it, are cut into pieces that stand in sequences of at most `LENGTH` ids. A
sequence is full but for the last few, whose lengths are powers of two, so none needs padding.

A null text is an empty one and has the ending id alone; very long texts count whole. Repeated rows are
texts of their own, null ids included. An empty table gives an empty table. Other columns may have any
names. The strings of special tokens are ordinary text.

1. Words between blanks are encoded by the vocabulary, once in a while for each distinct one: no token spans
   a blank. Ids are written to the shared folder, and only lengths are handled until the end.
2. What fills whole sequences is cut off the front. The rests are counted by length in units of `UNIT` ids,
   rounded down: a histogram of 2,048 / `UNIT` numbers whatever the size of the corpus.
3. A linear program over patterns, lists of lengths that add up to a sequence, uses as many of the rests as
   there are. Its columns are generated: dual prices of the lengths come from a revised simplex, the best
   pattern at these prices from a knapsack by dynamic programming, until the bound that the prices give is
   met. Uses are rounded down, then up where rests are left.
4. Rests of a length are ranked, and a pattern's uses take ranges of ranks. Rounding down makes a sequence
   a few ids too long: these are cut off its end.
5. What was cut off, and the few rests that no pattern took, form a stream that is cut into sequences.
"""

import os
from itertools import chain
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import shared_dir
from .common import saved, slices, travels, worker_memory
from .ordering import placed

travels(__name__)

LENGTH = 2048
END = 1
UNIT = 8
#: Where texts are cut before encoding, beside blanks: between a letter and the stops at a word's end. No
#: token of the vocabulary spans these places; it may know more of them.
AFTER_LETTER = "([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?]+)(?:[ \\t\\n\\r]|$)"
#: Words of letters that need nothing but lower case before the vocabulary's merges.
PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
#: Bytes as the characters that stand for them in the vocabulary: the others than these follow from 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in SHOWN)} | {32: 32}
#: Bytes of text that are encoded at once.
TOGETHER = 4 << 20
#: Bytes that the words and ids a worker remembers may take, their index aside.
KNOWN = 32 << 20
#: The program ends when its value is within this share of the bound, or after so many pivots.
GAP = 1e-4
PIVOTS = 5000


class Known:
    """Ids of the words that a worker has met, as Arrow and numpy arrays; emptied when it has grown."""

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.clear()

    def clear(self):
        self.words = pa.array([], pa.string())
        self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        # hashes of the words in order, and the words' places
        self.hashes, self.places_of = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _encoded(self, words):
        """Ids of each word. Plain ones are in lower case and one token group, so the merges alone are left."""
        model = self.tokenizer.model
        for word, is_plain in zip(words.to_pylist(), pc.match_substring_regex(words, PLAIN).to_pylist()):
            if not is_plain:
                yield self.tokenizer.encode(word, add_special_tokens=False).ids
                continue
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(BYTES)
            yield [token.id for token in model.tokenize(shown)]

    def _found(self, words, hashes):
        """Place of each word that is known, and whether it is: words are compared, not hashes alone."""
        if not len(self.hashes):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        places = self.places_of[at]
        same = pc.equal(self.words.take(pa.array(places)), words).to_numpy(zero_copy_only=False)
        return places, same.astype(bool)

    def places(self, words):
        """Place of each of an array's words in the arrays."""
        if self.words.nbytes + self.ids.nbytes > KNOWN:
            self.clear()
        hashes = pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)
        places, known = self._found(words, hashes)
        if known.all():
            return places
        # of words with one hash the first is looked up; another one is met as a new one each time
        missing = words.filter(pa.array(~known))
        new = pc.unique(missing)
        ids = list(self._encoded(new))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        ids = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        new_places = len(self.words) + np.arange(len(new))
        places[~known] = new_places[pc.index_in(missing, value_set=new).to_numpy()]
        self.words = pa.concat_arrays([self.words, new])
        self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
        hashes = pd.util.hash_array(new.to_numpy(zero_copy_only=False), categorize=False)
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.hashes, hashes[order], side="right")
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.places_of = np.insert(self.places_of, at, new_places[order])
        return places


def _known(path):
    memory = worker_memory()
    if ("known", path) not in memory:
        memory["known", path] = Known(path)
    return memory["known", path]


def encode_texts(texts, known, end=END):
    """Ids of each text of an Arrow array as one array, and the number of ids of each text."""
    spaced = pc.replace_substring_regex(pc.fill_null(texts, ""), AFTER_LETTER, "\\1 \\2 ")
    parts = pc.ascii_split_whitespace(spaced)
    coded = pc.dictionary_encode(pc.list_flatten(parts))
    plain = pc.match_substring_regex(coded.dictionary, PLAIN)
    places = known.places(pc.if_else(plain, pc.utf8_lower(coded.dictionary), coded.dictionary))
    begins = np.cumsum(known.sizes) - known.sizes

    # every text ends with one more word, that of the ending id
    sizes = np.append(known.sizes[places], 1)
    begins = np.append(begins[places], len(known.ids))
    ids = np.append(known.ids, np.uint32(end))
    ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))
    words = np.insert(coded.indices.to_numpy().astype(np.int64), ends, len(places))
    taken = sizes[words]
    upto = np.cumsum(taken)
    places = np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(begins[words] - (upto - taken), taken)
    text_ends = upto[ends + np.arange(len(ends))]
    return ids[places], np.diff(text_ends, prepend=0)


def tokens(docs, path, id_col="doc_id", text_col="text", end=END):
    """`row`, `doc_id`, `ids` (four little-endian bytes each) and `n` of them, written to the shared folder."""

    def encode(batches):
        for batch in batches:
            for part in slices(batch, limit=TOGETHER):
                ids, sizes = encode_texts(part.column(1), _known(path), end)
                offsets = np.concatenate([[0], np.cumsum(sizes)]) * 4
                data = pa.Array.from_buffers(
                    pa.binary(),
                    len(sizes),
                    [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(ids.astype("<u4"))],
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), data, pa.array(sizes)], names=["doc_id", "ids", "n"]
                )

    texts = docs.select(F.col(id_col).alias("doc_id"), text_col)
    encoded = texts.mapInArrow(encode, "doc_id long, ids binary, n long")
    place = f"{shared_dir(docs.sparkSession)}/tokens-{uuid4().hex}"
    encoded.select(F.monotonically_increasing_id().alias("row"), "*").write.option("compression", "zstd").parquet(
        place
    )
    return docs.sparkSession.read.parquet(place)


def _cheapest(prices, capacity):
    """Least price of lengths that add up to `capacity`, and how often each length is taken."""
    best = np.full(capacity + 1, np.inf)
    best[0], last = 0.0, np.zeros(capacity + 1, np.int64)
    for total in range(1, capacity + 1):
        options = best[total - 1 :: -1][: len(prices)][:total] + prices[:total]
        last[total] = np.argmin(options) + 1
        best[total] = options[last[total] - 1]
    taken, left = np.zeros(len(prices), np.int64), capacity
    while left:
        taken[last[left] - 1] += 1
        left -= last[left]
    return best[capacity], taken


def patterns(counts, capacity, gap=GAP, pivots=PIVOTS):
    """Patterns of lengths 1, 2, ... that add up to `capacity`, and how often each is used.

    `counts` says how many items there are of each length, from 1 to `capacity` - 1. The linear program has the
    most full sequences; its first basis leaves all items over. Prices below 0 are mended by the item of
    that length that is left over. Counts are made unequal by tiny shares so that pivots do not cycle.
    """
    n = len(counts)
    room = counts + np.arange(1, n + 1) * 1e-7
    inverse, values, gain = np.eye(n), room.copy(), np.zeros(n)
    basis = [None] * n
    for _ in range(pivots):
        prices = gain @ inverse
        low = int(np.argmin(prices))
        if prices[low] < -1e-9:
            column, worth, pattern = inverse[:, low], 0.0, None
        else:
            cost, pattern = _cheapest(np.maximum(prices, 0.0), capacity)
            value = gain @ values
            # prices over the cheapest pattern's cost are feasible, so they give a bound
            if cost >= 1 - 1e-9 or cost > 0 and prices @ room <= cost * value * (1 + gap):
                break
            column, worth = inverse @ pattern, 1.0
        ratios = np.where(column > 1e-9, values / np.where(column > 1e-9, column, 1.0), np.inf)
        out = int(np.argmin(ratios))
        if not np.isfinite(ratios[out]):
            break
        step = ratios[out]
        values = np.maximum(values - step * column, 0.0)
        values[out] = step
        pivot_row = inverse[out] / column[out]
        inverse = inverse - np.outer(column, pivot_row)
        inverse[out] = pivot_row
        gain[out], basis[out] = worth, pattern
    found = [(pattern, use) for pattern, use in zip(basis, values) if pattern is not None]
    uses = [int(np.floor(use + 1e-6)) for _, use in found]
    left = counts - sum((use * pattern for use, (pattern, _) in zip(uses, found)), np.zeros(n, np.int64))
    # largest fractions first; a use more as long as there are items
    for i in sorted(range(len(found)), key=lambda i: uses[i] - found[i][1]):
        while True:
            more = left - found[i][0]
            if (more < 0).any():
                break
            uses[i], left = uses[i] + 1, more
    return [(pattern, use) for (pattern, _), use in zip(found, uses) if use]


def _assigned(rests, length, unit):
    """Rests with the `sequence` of a pattern that takes them, null for those left over, and the patterns' uses."""
    spark = rests.sparkSession
    counts = np.zeros(length // unit - 1, np.int64)
    for units, n in rests.filter("units > 0").groupBy("units").agg(F.count("*")).collect():  # bounded by unit
        counts[units - 1] = n
    ranges, next_rank, sequences = [], np.zeros(len(counts), np.int64), 0
    for pattern, use in patterns(counts, length // unit):
        for units in np.flatnonzero(pattern):
            each = int(pattern[units])
            first = int(next_rank[units])
            ranges.append((int(units) + 1, first, first + each * use, each, sequences))
            next_rank[units] += each * use
        sequences += use
    schema = "units int, first long, stop long, each long, sequence_from long"
    ranges = F.broadcast(spark.createDataFrame(ranges, schema))  # at most patterns x lengths, about 10^4 rows
    ranked = placed(rests, ["row"], ["units"], name="rank")
    taken = ranked.join(
        ranges.withColumnRenamed("units", "u"),
        (F.col("units") == F.col("u")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("stop")),
        "left",
    )
    sequence = F.col("sequence_from") + F.floor((F.col("rank") - F.col("first")) / F.col("each"))
    return taken.select("row", "start", "length", sequence.cast("long").alias("sequence_id")), sequences


def _ends(total, length):
    """Where the sequences of the end of a stream lie: powers of two, the largest first."""
    at, left, ends = total - total % length, total % length, []
    while left:
        size = 1 << (left.bit_length() - 1)
        ends.append((at, at + size))
        at, left = at + size, left - size
    return ends


def _streamed(items, length, first_sequence):
    """Items laid end to end and cut where sequences end."""
    items = saved(placed(items, ["row", "start"], size="length", name="at"))
    total = items.agg(F.sum("length")).first()[0] or 0
    full = total // length
    last = [F.struct(*(F.lit(v).cast("long") for v in end)) for end in _ends(total, length)]
    kind = "array<struct<lo:bigint,hi:bigint>>"
    # the sequences that an item meets: the full ones by number, those at the end by their few places
    upto = F.least(F.floor((F.col("at") + F.col("length") - 1) / length), F.lit(full - 1))
    whole = F.when(
        F.floor(F.col("at") / length) <= upto, F.sequence(F.floor(F.col("at") / length), upto)
    ).otherwise(F.array().cast("array<bigint>"))
    whole = F.transform(whole, lambda k: F.struct((k * length).alias("lo"), ((k + 1) * length).alias("hi")))
    tail = F.array(*last).cast(kind) if last else F.array().cast(kind)
    tail = F.filter(tail, lambda e: (e["lo"] < F.col("at") + F.col("length")) & (e["hi"] > F.col("at")))
    met = items.withColumn("end", F.explode(F.concat(whole.cast(kind), tail)))
    lo, hi = F.greatest("at", "end.lo"), F.least(F.col("at") + F.col("length"), F.col("end.hi"))
    tails = {at: full + i for i, (at, _) in enumerate(_ends(total, length))}
    number = F.floor(F.col("end.lo") / length)
    for at, k in tails.items():
        number = F.when(F.col("end.lo") == at, F.lit(k)).otherwise(number)
    return met.select(
        "row",
        (F.col("start") + lo - F.col("at")).alias("start"),
        (hi - lo).alias("length"),
        (number + first_sequence).cast("long").alias("sequence_id"),
        (lo - F.col("end.lo")).alias("offset"),
    )


def pack_lengths(sizes, length=LENGTH, unit=UNIT):
    """Pieces (`row`, `start`, `length`, `sequence_id`, `offset`) of rows with `n` ids each."""
    fronts = placed(
        sizes.select("row", F.floor(F.col("n") / length).alias("k")).filter("k > 0"), ["row"], size="k", name="s"
    )
    fronts = saved(fronts)
    n_fronts = fronts.agg(F.sum("k")).first()[0] or 0
    fronts = fronts.select("row", "s", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("i"))
    fronts = fronts.select(
        "row",
        (F.col("i") * length).alias("start"),
        F.lit(length).cast("long").alias("length"),
        (F.col("s") + F.col("i")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )

    rest = F.col("n") % length
    rests = sizes.select(
        "row", (F.col("n") - rest).alias("start"), rest.alias("length"), F.floor(rest / unit).cast("int").alias("units")
    ).filter("length > 0")
    rests, n_patterns = _assigned(rests, length, unit)
    rests = saved(rests)
    in_sequence = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "row")
    upto = F.sum("length").over(in_sequence.rowsBetween(Window.unboundedPreceding, 0))
    taken = rests.filter(F.col("sequence_id").isNotNull()).withColumn("upto", upto)
    taken = taken.withColumn("offset", F.col("upto") - F.col("length"))
    kept = F.least(F.lit(length) - F.col("offset"), F.col("length"))
    held = taken.filter(kept > 0).select(
        "row", "start", kept.alias("length"), (F.col("sequence_id") + n_fronts).alias("sequence_id"), "offset"
    )
    off = F.greatest(kept, F.lit(0))
    over = taken.filter(off < F.col("length")).select(
        "row", (F.col("start") + off).alias("start"), (F.col("length") - off).alias("length")
    )
    left = rests.filter(F.col("sequence_id").isNull()).select("row", "start", "length")
    stream = _streamed(saved(over.unionByName(left)), length, n_fronts + n_patterns)
    return fronts.unionByName(held).unionByName(stream)


def pack(docs, path, id_col="doc_id", text_col="text", length=LENGTH, unit=UNIT, end=END):
    """Pieces of all texts: `doc_id`, `start`, `length`, their `ids`, `doc_tokens`, `sequence_id`, `offset`."""
    if length % unit:
        raise ValueError("the unit must divide the length")
    rows = tokens(docs, path, id_col, text_col, end)
    pieces = pack_lengths(rows.select("row", "n"), length, unit)
    # a very long text is one row with thousands of pieces; each piece takes its own part of it
    joined = rows.join(pieces, "row")
    first = (F.col("start") * 4 + 1).cast("int")
    ids = F.substring("ids", first, (F.col("length") * 4).cast("int"))
    return joined.select(
        "doc_id", "start", "length", ids.alias("ids"), F.col("n").alias("doc_tokens"), "sequence_id", "offset"
    )
