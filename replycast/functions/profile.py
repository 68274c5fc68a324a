"""Word counts, word classes and distinct stems of text columns, batch by batch in Arrow.

Texts are reduced to the characters of words as bytes, and the words of an Arrow batch to its distinct ones; only
those are tagged and stemmed in Python, and a worker remembers them from task to task. The counts per row are
array operations, and no word is shuffled.
"""

import sys
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import pos, stem
from .words import STOP_WORDS

# this code travels inside the task, so executors need not have the package installed
for _module in (sys.modules[__name__], pos, stem):
    cloudpickle.register_pickle_by_value(_module)

MOST_KNOWN = 500_000  # words a worker remembers, about 150 MB
MOST_BYTES = 8 << 20  # bytes of text whose words are counted at a time; one longer text is counted by itself

EMPTY = len(pos.COUNTED) + 1  # class number of the empty word
NAMES = ["words", "distinct_words", *pos.COUNTED]
COUNTS = [T.StructField(name, T.IntegerType()) for name in NAMES]
STEMS = T.StructField("stems", T.ArrayType(T.StringType()))


class _Words:
    """Class number (0 for none) and stem number (-1 for stop words) of words, remembered."""

    def __init__(self, stops, lexicon):
        self.stops, self.lexicon = set(stops), lexicon
        self.prefixes = list(enumerate(pos.COUNTED.values(), 1))
        self.forget()

    def forget(self):
        self.words, self.numbers = pa.array([], pa.string()), {}
        self.classes, self.stems = np.empty(0, np.int64), np.empty(0, np.int64)

    def look_up(self, word):
        if not word:
            return EMPTY, None
        tag, low = pos.tag_word(word, self.lexicon), word.lower()
        number = next((i for i, prefix in self.prefixes if tag.startswith(prefix)), 0)
        return number, None if low in self.stops else stem.porter(low)

    def add(self, words):
        """Tag and stem words that are not known yet."""
        found = [self.look_up(word) for word in words.to_pylist()]
        stems = [-1 if s is None else self.numbers.setdefault(s, len(self.numbers)) for _, s in found]
        self.words = pa.concat_arrays([self.words, words])
        self.classes = np.concatenate([self.classes, np.array([c for c, _ in found], np.int64)])
        self.stems = np.concatenate([self.stems, np.array(stems, np.int64)])

    def all(self, words):
        """Class numbers and stem numbers of an array of distinct words."""
        known = pc.index_in(words, value_set=self.words)
        if known.null_count:
            self.add(words.filter(pc.is_null(known)))
            known = pc.index_in(words, value_set=self.words)
        at = known.to_numpy(zero_copy_only=False)
        return self.classes[at], self.stems[at]


def _remembered(lexicon):
    """Words as the Python worker knows them from earlier tasks; those of a lexicon stay with the task."""
    if lexicon is not None:
        return _Words(STOP_WORDS, lexicon)
    kept = vars(sys.modules.setdefault("replycast_known_words", ModuleType("replycast_known_words")))
    if "words" not in kept:
        kept["words"] = _Words(STOP_WORDS, None)
    return kept["words"]


#: Letters, digits, apostrophes and white space: all that `word_text` keeps of a text, byte by byte.
_KEPT = np.zeros(256, bool)
_KEPT[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789' \t\n\x0b\x0c\r")] = True


def _word_texts(texts):
    """`word_text` of an array of strings; a null stays one."""
    if not len(texts):
        return texts
    wide = pa.types.is_large_string(texts.type)
    _, offsets, values = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    chars = np.frombuffer(values or b"", np.uint8)[ends[0] : ends[-1]]
    kept = _KEPT[chars]
    before = np.zeros(len(chars) + 1, np.int32)
    np.cumsum(kept, out=before[1:], dtype=np.int32)
    new_ends = before[ends - ends[0]]
    nulls = pc.is_valid(texts).buffers()[1] if texts.null_count else None
    return pa.Array.from_buffers(pa.string(), len(texts), [nulls, pa.py_buffer(new_ends), pa.py_buffer(chars[kept])])


def _count(texts, lookup):
    """Counts per row, and the distinct (row, stem number) pairs, of an array of texts."""
    n = len(texts)
    lists = pc.ascii_split_whitespace(_word_texts(texts))
    flat = pc.list_flatten(lists).dictionary_encode()
    class_of, stem_of = lookup.all(flat.dictionary)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    row, word = np.repeat(np.arange(n), sizes), flat.indices.to_numpy(zero_copy_only=False)

    per_class = np.bincount(row * (EMPTY + 1) + class_of[word], minlength=n * (EMPTY + 1))
    per_class = per_class.reshape(n, EMPTY + 1)[:, :EMPTY]
    stems = stem_of[word]
    stemmed = stems >= 0
    pairs = _distinct(row[stemmed], stems[stemmed])
    counts = [per_class.sum(axis=1), np.bincount(pairs[0], minlength=n)]
    return [*counts, *per_class.T[1:]], pairs


def _pieces(*texts):
    """Slices of arrays of the same length, each of about `MOST_BYTES` at most: a batch has rows, not bytes."""
    sizes = sum(pc.fill_null(pc.binary_length(t), 0).cast(pa.int64()).to_numpy(zero_copy_only=False) for t in texts)
    piece = (np.cumsum(sizes) - sizes) // MOST_BYTES
    starts = np.flatnonzero(np.diff(piece, prepend=-1))
    for start, stop in zip(starts, [*starts[1:], len(sizes)]):
        yield [t.slice(start, stop - start) for t in texts]


def _by_pieces(count, lexicon, *texts):
    """One array from what `count` makes of each slice of a batch."""
    lookup, found = _remembered(lexicon), []
    for piece in _pieces(*texts) if len(texts[0]) else [texts]:
        if len(lookup.words) > MOST_KNOWN:
            lookup.forget()
        found.append(count(lookup, *piece))
    return pa.concat_arrays(found)


def _distinct(row, number):
    """Distinct pairs, sorted; sorting is several times faster than hashing them."""
    span = int(number.max(initial=0)) + 1
    both = np.sort(row * span + number)
    both = both[np.diff(both, prepend=-1) > 0]
    return both // span, both % span


def _among(numbers, known):
    """Which numbers are among the known ones, which are sorted; several times faster than hashing those."""
    at = np.searchsorted(known, numbers)
    there = at < len(known)
    there[there] = known[at[there]] == numbers[there]
    return there


def _ints(columns):
    return [pa.array(c.astype(np.int32)) for c in columns]


def word_profile(lexicon=None):
    """Column function: text to a struct of counts and the distinct stems."""

    def count(lookup, texts):
        counts, (row, number) = _count(texts, lookup)
        names = list(lookup.numbers)
        used, at = np.unique(number, return_inverse=True)
        stems = pa.array([names[k] for k in used], pa.string()).take(pa.array(at))
        ends = np.bincount(row, minlength=len(texts)).cumsum()
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, stems)
        return pa.StructArray.from_arrays([*_ints(counts), lists], names=[*NAMES, "stems"])

    @F.arrow_udf(T.StructType([*COUNTS, STEMS]))
    def profile(texts: pa.Array) -> pa.Array:
        return _by_pieces(count, lexicon, texts)

    return profile


def pair_profile(lexicon=None):
    """Column function: texts of body and title to the counts of both.

    The stems that a title shares with its body are counted here, so no stems leave the task.
    """
    names = [f"{side}_n_{name}" for side in ("body", "title") for name in NAMES]

    def count(lookup, body, title):
        body_counts, (body_row, body_stem) = _count(body, lookup)
        title_counts, (title_row, title_stem) = _count(title, lookup)
        span = len(lookup.numbers) + 1
        shared = _among(title_row * span + title_stem, body_row * span + body_stem)
        n_shared = np.bincount(title_row[shared], minlength=len(body))
        columns = _ints([*body_counts, *title_counts, n_shared])
        return pa.StructArray.from_arrays(columns, names=[*names, "n_shared"])

    @F.arrow_udf(T.StructType([T.StructField(n, T.IntegerType()) for n in (*names, "n_shared")]))
    def profile(body: pa.Array, title: pa.Array) -> pa.Array:
        return _by_pieces(count, lexicon, body, title)

    return profile
