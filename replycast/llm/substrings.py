"""Substring dedup: documents are factored against blocks of all documents, long factors are duplicates.

Words are runs without white space; a null text has none. A factor is a run of words all of whose windows
of `WINDOW` words start somewhere else too. Texts shorter than a window have no factor. Rows with the same
text are copies of each other whatever their ids, so repeated rows are removed like other copies. An empty
table gives an empty table. Only the id and text columns are read.

The reference blocks are named by anchors: the run of `ANCHOR` words with the smallest hash in a window.
Equal windows have equal anchors at the same place, so a window can only occur elsewhere if its anchor
does. Parsing takes two rounds over the distinct texts:

1. The index of anchors tells which of a text's anchors also start elsewhere; all other blocks end there.
2. The windows around those anchors are looked up in the index of windows. Greedy parsing extends a factor
   as long as the next window is found, so at a factor's boundaries every single window has been checked.

Both indexes are one shuffle by hash. Hashes that repeat within a part of a task are added up there: they
go on as one entry, and their places as runs, so no reader gets all places of a frequent hash.
"""

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import travels

travels(__name__)

WINDOW = 35
ANCHOR = 8
SECOND_SEED = 7
#: Hashes that are added up at once in a task.
PART = 1 << 19

MIX = np.uint64(0x9E3779B97F4A7C15)


def split(text):
    """Words of a text, as bytes; splitting bytes goes by the six ASCII blanks."""
    return (text or "").encode().split()


def _mixed(x):
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def run_hashes(hashes, size):
    """Hash of every run of `size` values, put together from runs of powers of two."""
    found, length, power, width = None, 0, hashes, 1
    while True:
        if size & width:
            if found is None:
                found, length = power, width
            else:
                after = power[length:]
                found = _mixed(found[: len(after)] * np.uint64(3) + after[: len(found)])
                length += width
        if width * 2 > size:
            return found
        power = _mixed(power[:-width] * np.uint64(5) + power[width:])
        width *= 2


def anchors(words):
    """Place of the anchor of each window of the words, hashes of anchors, hashes of words."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    runs = run_hashes(hashes, ANCHOR)
    span = WINDOW - ANCHOR + 1
    places = sliding_window_view(runs, span).argmin(axis=1) + np.arange(len(runs) - span + 1)
    return places, runs, hashes


class _Entries:
    """Index entries of a task: a hash with where it is, or runs of places known to repeat."""

    NAMES = ("hash", "k1", "k2", "start", "length", "known")

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, k1, k2, hashes, places):
        self.parts.append((k1, k2, hashes, places))
        self.size += len(hashes)
        if self.size >= PART:
            yield from self.flush()

    def flush(self):
        if not self.size:
            return
        hashes = np.concatenate([p[2] for p in self.parts])
        places = np.concatenate([p[3] for p in self.parts]).astype(np.int32)
        text = np.repeat(np.arange(len(self.parts)), [len(p[2]) for p in self.parts])
        keys = np.array([p[:2] for p in self.parts], np.int64)
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        same = np.zeros(len(ordered) + 1, bool)
        same[1:-1] = ordered[1:] == ordered[:-1]
        repeated = np.zeros(len(hashes), bool)
        repeated[order] = same[1:] | same[:-1]
        self.parts, self.size = [], 0
        single = ~repeated
        n = int(single.sum())
        one, none = np.ones(n, np.int32), np.zeros(n, bool)
        yield self._batch(hashes[single], keys[text[single]], places[single], one, none)
        # one entry stands for all places of a hash that repeats here
        marks = ordered[:][same[1:] & ~same[:-1]]
        n = len(marks)
        if not n:
            return
        zero = np.zeros(n, np.int32)
        yield self._batch(marks, np.zeros((n, 2), np.int64), zero, zero, np.ones(n, bool))
        text, places = text[repeated], places[repeated]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (places[1:] != places[:-1] + 1)
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(text))).astype(np.int32)
        own = keys[text[first]]
        # the hash of a known run only deals the runs out evenly
        dealt = _mixed(own[:, 0].view(np.uint64) + places[first].astype(np.uint64))
        yield self._batch(dealt, own, places[first], length, np.ones(len(first), bool))

    def _batch(self, hashes, keys, start, length, known):
        keys = np.ascontiguousarray(keys.T)
        columns = [hashes.view(np.int64), keys[0], keys[1], start, length, known]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=self.NAMES)


SCHEMA = "hash long, k1 long, k2 long, start int, length int, known boolean"


def _rows(batch):
    """Rows of an Arrow batch, a few texts at a time."""
    for start in range(0, batch.num_rows, 256):
        part = batch.slice(start, 256)
        yield from zip(*(part.column(i).to_pylist() for i in range(part.num_columns)))


def _anchor_entries(batches):
    entries = _Entries()
    for batch in batches:
        for k1, k2, text in _rows(batch):
            words = split(text)
            if len(words) >= WINDOW:
                places, runs, _ = anchors(words)
                places = np.unique(places)
                yield from entries.add(k1, k2, runs[places], places)
    yield from entries.flush()


def _marked(runs, size):
    """Boolean array of `size` with the runs (start, length) set."""
    marks = np.zeros(size + 1, np.int32)
    if runs:
        starts = np.array([r["start"] for r in runs])
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + np.array([r["length"] for r in runs]), -1)
    return np.cumsum(marks[:size]) > 0


def _window_entries(batches):
    entries = _Entries()
    for batch in batches:
        for k1, k2, text, found in _rows(batch):
            words = split(text)
            places, _, hashes = anchors(words)
            tested = np.flatnonzero(_marked(found, len(words))[places])
            yield from entries.add(k1, k2, run_hashes(hashes, WINDOW)[tested], tested)
    yield from entries.flush()


def _elsewhere(entries):
    """Places whose hash is in the index more than once, as lists of runs for each text."""
    group = Window.partitionBy("hash")
    counted = entries.withColumns(
        {"n": F.count("*").over(group), "any": F.max("known").over(group)}
    )
    found = counted.filter("length > 0 AND (n > 1 OR any)")
    return found.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "length")).alias("found"))


def factors(found, size):
    """Factors (start, end) in words from the windows found elsewhere: greedy, so the longest ones."""
    windows = _marked(found, max(size - WINDOW + 1, 0))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], windows, [0]])))
    merged = []
    for start, end in zip(edges[::2].tolist(), (edges[1::2] + WINDOW - 1).tolist()):
        # windows apart can still overlap in words
        if merged and start <= merged[-1][1]:
            merged[-1][1] = end
        else:
            merged.append([start, end])
    return merged


def _parsed(batches):
    for batch in batches:
        out = []
        for k1, k2, text, copies, found in _rows(batch):
            words = split(text)
            whole = copies > 1 and len(words) >= WINDOW
            spans = [[0, len(words)]] if whole else factors(found, len(words))
            kept, at = [], 0
            for start, end in spans:
                kept += words[at:start]
                at = end
            kept += words[at:]
            out.append((k1, k2, len(words), len(words) - len(kept), spans, b" ".join(kept).decode()))
        columns = list(zip(*out)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["k1", "k2", "n_words", "n_removed", "factors", "kept_text"],
        )


def substring_dedup(docs, id_col="doc_id", text_col="text", derive=None):
    """`doc_id`, `n_words`, `n_removed`, `factors` and `kept_text` of each document.

    `factors` lists [start, end) in words; `kept_text` joins the other words by one space. `derive` maps
    names to columns over these to be returned in place of the last two, before texts are shuffled again.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit(SECOND_SEED), text).alias("k2"),
    )
    texts = rows.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    key = ["k1", "k2"]
    marked = _elsewhere(texts.select(*key, "text").mapInArrow(_anchor_entries, SCHEMA))
    around = texts.join(marked, key).select(*key, "text", "found")
    found = _elsewhere(around.mapInArrow(_window_entries, SCHEMA))
    parsed = (
        texts.join(found, key, "left")
        .select(*key, "text", "copies", "found")
        .mapInArrow(
            _parsed,
            "k1 long, k2 long, n_words long, n_removed long, factors array<array<long>>, kept_text string",
        )
    )
    derive = derive or {"factors": F.col("factors"), "kept_text": F.col("kept_text")}
    parsed = parsed.select(*key, "n_words", "n_removed", *(c.alias(n) for n, c in derive.items()))
    return rows.select("doc_id", *key).join(parsed, key).drop(*key)
