"""SimHash near-dedup with a Gray-order hierarchical index.

Texts without words, null ones included, have fingerprint 0 and are linked like any other. Repeated rows
share their fingerprint. A null id sorts after all others: it names a component only if no row of that has
an id. An empty table gives an empty table. Only the id and text columns are read.

Few bits of a fingerprint change only between texts that are nearly equal: at a similarity of 0.8, about 10
of 64. `keep_unlike` therefore takes pairs from two sources, linked fingerprints and common bands of least
shingle hashes, and verifies each by the exact Jaccard similarity of the shingle sets. A pair at 0.8 misses
all bands with a chance of (1 - 0.8^`BAND_ROWS`)^`BANDS`, about two in a million.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .alike import checked_pairs
from .common import row_hashes, saved, travels
from .components import components

travels(__name__)

SEED = 42
WORDS = 4
#: Fingerprints of a group are dealt into parts of about this size; each pair of parts is one cell.
PART = 2048
#: Children of a node of the index.
FANOUT = 16
#: Pairs of nodes looked at at once.
FRONT = 1 << 18
#: Words of a shingle and least similarity of the texts that `keep_unlike` takes as near copies.
SHINGLE = 5
SIMILAR = 0.8
#: Bands of least hashes, and least hashes of a band.
BANDS = 25
BAND_ROWS = 4


def fingerprint(text, size=WORDS):
    """Fingerprint of a text, as a signed 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], SEED) for a, b in zip(starts, ends)]
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(ones).view(">i8")[0])


def fingerprint_column(text_col, size=WORDS):
    """Fingerprints of a text column."""

    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        return pa.array((fingerprint(text.as_py(), size) for text in texts), pa.int64())

    return fingerprints(F.col(text_col))


def _masks(blocks, equal):
    """Bit masks of all choices of `equal` of `blocks` runs of bits."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    runs = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(choice) - ((sum(choice) >> 63) << 64) for choice in combinations(runs, equal)]


def _gray_rank(value):
    """Place of a 64-bit number in Gray order: the running exclusive-or of its bits from the top."""
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value


class GrayIndex:
    """Index over fingerprints in Gray order.

    A node stands for a run of neighbours in that order. It holds the bits they have in common (`ones`:
    set in all of them, `any`: set in at least one), so the bits shared by a group are compared once.
    """

    def __init__(self, values):
        self.values = values
        self.levels = [(values, values)]
        while len(self.levels[-1][0]) > FANOUT:
            ones, any_ = self.levels[-1]
            at = np.arange(0, len(ones), FANOUT)
            self.levels.append((np.bitwise_and.reduceat(ones, at), np.bitwise_or.reduceat(any_, at)))

    def links(self, distance):
        """Links (i, j) that connect what is connected by pairs within `distance`.

        Pairs of nodes go down from the top. A pair is dropped if the bits that each side shares differ
        in more than `distance` places, linked as a whole if no more places than that can differ, and
        not followed if both sides are known to be connected already.
        """
        n = len(self.values)
        near = np.bitwise_count(self.values[1:] ^ self.values[:-1]) <= distance
        root = np.concatenate([[0], np.cumsum(~near)])
        firsts = np.concatenate([[0], np.flatnonzero(~near) + 1])
        found = [(int(i), int(i) + 1) for i in np.flatnonzero(near)]
        parent = list(range(len(firsts)))

        def top(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def connect(i, j):
            pairs, where = np.unique(np.stack([root[i], root[j]]), axis=1, return_index=True)
            for (a, b), k in zip(pairs.T.tolist(), where.tolist()):
                a, b = top(a), top(b)
                if a != b:
                    parent[b] = a
                    found.append((int(i[k]), int(j[k])))

        def settled(level, i, j):
            """Pairs of nodes whose members are all in one component."""
            span = FANOUT**level
            roots = np.array([top(x) for x in range(len(firsts))])[root] if len(firsts) > 1 else root * 0
            low = np.minimum.reduceat(roots, np.arange(0, n, span))
            high = np.maximum.reduceat(roots, np.arange(0, n, span))
            return (low[i] == high[i]) & (low[j] == high[j]) & (low[i] == low[j])

        last = len(self.levels) - 1
        size = len(self.levels[last][0])
        stack = [(last, *np.triu_indices(size))]
        while stack:
            level, i, j = stack.pop()
            if len(i) > FRONT:
                stack.append((level, i[FRONT:], j[FRONT:]))
                i, j = i[:FRONT], j[:FRONT]
            ones, any_ = self.levels[level]
            differ = (ones[i] & ~any_[j]) | (ones[j] & ~any_[i])
            keep = np.bitwise_count(differ) <= distance
            keep &= ~settled(level, i, j)
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            span = FANOUT**level
            free = (any_[i] | any_[j]) & ~(ones[i] & ones[j])
            alike = np.bitwise_count(free) <= distance
            for a, b in zip(i[alike].tolist(), j[alike].tolist()):
                for node in {a, b}:
                    members = np.arange(node * span, min(n, (node + 1) * span))
                    connect(np.full(len(members), a * span), members)
            i, j = i[~alike], j[~alike]
            if not level or not len(i):
                continue
            below = len(self.levels[level - 1][0])
            down = np.arange(FANOUT)
            a = (i[:, None, None] * FANOUT + down[:, None] + 0 * down).ravel()
            b = (j[:, None, None] * FANOUT + 0 * down[:, None] + down).ravel()
            inside = (a < below) & (b < below) & (a <= b)
            stack.append((level - 1, a[inside], b[inside]))
        return found


def _cells(values, masks):
    """Each fingerprint once for every mask, with the cell of its group that it is compared in.

    Groups of more than `PART` fingerprints are dealt into parts, and each fingerprint goes to the cells
    of its part with every part, so a cell stays small however large the group is.
    """
    keys = [
        F.struct(F.lit(c).alias("mask"), F.col("value").bitwiseAND(F.lit(m)).alias("key"))
        for c, m in enumerate(masks)
    ]
    rows = values.select("value", F.inline(F.array(*keys)))
    large = rows.groupBy("mask", "key").count().filter(F.col("count") > PART)
    parts = F.ceil(F.col("count") / PART).cast("int")
    large = large.select("mask", "key", parts.alias("parts"))
    rows = rows.join(large, ["mask", "key"], "left")
    parts = F.coalesce("parts", F.lit(1))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("value"), parts).cast("int"))
    others = F.sequence(F.lit(0), parts - 1)
    rows = rows.select("value", "mask", "key", "part", F.explode(others).alias("other"))
    return rows.select(
        "value",
        F.xxhash64("mask", "key", F.least("part", "other"), F.greatest("part", "other")).alias("cell"),
        _gray_rank(F.col("value")).alias("rank"),
    )


def near_links(values, distance=4, blocks=6):
    """Links `a`, `b` that connect all fingerprints of the column `value` within `distance`.

    Of `blocks` runs of bits, two fingerprints within `distance` agree in `blocks - distance` or more, so
    each pair meets in the group of some choice of that many runs. A task reads its cells in order, one
    at a time, and gives at most as many links for a cell as it has fingerprints.
    """
    if blocks <= distance:
        raise ValueError("blocks must be more than distance")

    def joined(batches):
        def cell_links(values):
            index = GrayIndex(values)
            pairs = index.links(distance)
            if pairs:
                i, j = np.array(pairs).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[i].view(np.int64)), pa.array(values[j].view(np.int64))],
                    names=["a", "b"],
                )

        held, held_cell = [], None
        for batch in batches:
            cells = batch.column(0).to_numpy(zero_copy_only=False)
            values = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            cuts = [0, *(np.flatnonzero(cells[1:] != cells[:-1]) + 1).tolist(), len(cells)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if cells[a] != held_cell:
                    if sum(map(len, held)) > 1:
                        yield from cell_links(np.concatenate(held))
                    held, held_cell = [], cells[a]
                held.append(values[a:b])
        if sum(map(len, held)) > 1:
            yield from cell_links(np.concatenate(held))

    cells = _cells(values, _masks(blocks, blocks - distance))
    dealt = cells.repartition("cell").sortWithinPartitions("cell", "rank").select("cell", "value")
    return dealt.mapInArrow(joined, "a long, b long")


def near_dedup(rows, distance=4, tie=()):
    """`fingerprint`, `first` for every fingerprint of `rows` (doc_id, fingerprint and the `tie` columns).

    `first` is the smallest (no_id, doc_id, *tie) among the rows that can be reached over links.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *tie))
    classes = saved(rows.groupBy("fingerprint").agg(first.alias("first")))
    links = near_links(classes.select(F.col("fingerprint").alias("value")), distance)
    roots = components(links).withColumnRenamed("node", "fingerprint")
    rooted = classes.join(roots, "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rooted.select("fingerprint", "root").join(firsts, "root").select("fingerprint", "first")


def simhash_dedup(docs, id_col="doc_id", text_col="text", distance=4, size=WORDS):
    """`doc_id`, `fingerprint` (a long) and `component_id`, the smallest id linked to it."""
    rows = saved(
        docs.select(
            F.col(id_col).alias("doc_id"), fingerprint_column(text_col, size).alias("fingerprint")
        )
    )
    found = near_dedup(rows, distance)
    return rows.join(found, "fingerprint").select(
        "doc_id", "fingerprint", F.col("first.doc_id").alias("component_id")
    )


def keep_first(docs, id_col="doc_id", text_col="text", distance=4, size=WORDS):
    """The rows of `docs`, one of each component: that with the smallest id.

    Of several texts with that id, the one with the smallest hash stays, and one row of those that repeat
    id and text.
    """
    hashes = row_hashes(id_col, text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), fingerprint_column(text_col, size).alias("fingerprint"), *hashes
    )
    firsts = near_dedup(saved(rows), distance, ("h1", "h2")).select("first.h1", "first.h2").distinct()
    whole = docs.select(F.struct("*").alias("row"), *hashes)
    whole = whole.groupBy("h1", "h2").agg(F.first("row").alias("row"))
    return whole.join(firsts, ["h1", "h2"]).select("row.*")


def shingles(text, size=SHINGLE):
    """Set of the runs of `size` words of a text; of a shorter text all its words."""
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def band_keys(found):
    """A key for each band of least hashes of a set of shingles."""
    hashes = np.array([xxhash.xxh64_intdigest(x, SEED) for x in found] or [0], np.uint64)
    rng = np.random.default_rng(SEED)
    draws = rng.integers(1 << 63, size=(BANDS, BAND_ROWS, 2), dtype=np.uint64)
    keys = []
    for band, row_draws in enumerate(draws):
        least = [((hashes ^ x) * (y | np.uint64(1))).min() for x, y in row_draws]
        keys.append(xxhash.xxh64_intdigest(np.array(least).tobytes(), band))
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _described(docs, id_col, text_col, size):
    """Of each row its id, `r1`, `r2` of id and text, `h1`, `h2` of its words, fingerprint, `n`, `keys`."""

    def describe(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = []
                for text in part.column(3).to_pylist():
                    found, line = shingles(text, size), b" ".join((text or "").encode().lower().split())
                    ids = [np.uint64(xxhash.xxh64_intdigest(line, s)).view(np.int64) for s in (SEED, SEED + 1)]
                    rows.append((*map(int, ids), fingerprint(text, size), len(found), band_keys(found)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                told = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], *told],
                    names=["doc_id", "r1", "r2", "h1", "h2", "fingerprint", "n", "keys"],
                )

    r1, r2 = (h.alias(f"r{n}") for n, h in enumerate(row_hashes(id_col, text_col), 1))
    rows = docs.select(F.col(id_col).alias("doc_id"), r1, r2, F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(
        describe,
        f"doc_id {kind}, r1 long, r2 long, h1 long, h2 long, fingerprint long, n long, keys array<long>",
    )


def _similar(size, least):
    """Column function: whether two texts' shingle sets have a Jaccard similarity of `least` or more."""

    @F.arrow_udf("boolean")
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b):
            x, y = shingles(x.as_py(), size), shingles(y.as_py(), size)
            common = len(x & y)
            out.append(common >= least * (len(x) + len(y) - common) - 1e-9)
        return pa.array(out, pa.bool_())

    return similar


def keep_unlike(docs, id_col="doc_id", text_col="text", size=SHINGLE, least=SIMILAR, distance=4):
    """The rows of `docs`, one of each component of similar texts, chosen as by `keep_first`.

    Texts are similar if the sets of their `size`-word shingles have a Jaccard similarity of `least` or
    more. Texts with the same words are one; candidates are pairs of these.
    """
    rows = saved(_described(docs, id_col, text_col, size))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "r1", "r2")
    classes = rows.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.first("n").alias("n"), F.first("fingerprint").alias("fingerprint")
    )
    classes = saved(classes)
    whole = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), *row_hashes(id_col, text_col))
    whole = whole.withColumnsRenamed({"h1": "r1", "h2": "r2"})
    similar = _similar(size, least)

    def check(pairs):
        pairs = saved(pairs)
        ids = [pairs.select(F.col(f"{s}1").alias("h1"), F.col(f"{s}2").alias("h2")) for s in "ab"]
        places = ids[0].unionByName(ids[1]).distinct().join(classes, ["h1", "h2"])
        places = places.select("h1", "h2", F.col("first.r1").alias("r1"), F.col("first.r2").alias("r2"))
        texts = places.join(whole.select("r1", "r2", "text"), ["r1", "r2"])
        texts = saved(texts.groupBy("h1", "h2").agg(F.first("text").alias("text")))
        for s in "ab":
            ends = texts.select(*(F.col(c).alias(f"{s}{c[1]}") for c in ("h1", "h2")), F.col("text").alias(s))
            pairs = pairs.join(ends, [f"{s}1", f"{s}2"])
        return pairs.filter(similar("a", "b")).select("a1", "a2", "b1", "b2")

    keys = rows.groupBy("h1", "h2").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    entries = keys.select("h1", "h2", "n", F.explode("keys").alias("key"))
    found = checked_pairs(entries, check, least)
    prints = classes.groupBy("fingerprint").agg(F.min(F.struct("h1", "h2")).alias("p"))
    linked = near_links(prints.select(F.col("fingerprint").alias("value")), distance)
    for s in "ab":
        ends = prints.select(
            F.col("fingerprint").alias(s), F.col("p.h1").alias(f"{s}1"), F.col("p.h2").alias(f"{s}2")
        )
        linked = linked.join(ends, s).drop(s)
    found = found.unionByName(check(linked.select("a1", "a2", "b1", "b2").distinct()))
    links = found.select(
        *(F.struct(F.col(f"{s}1").alias("h1"), F.col(f"{s}2").alias("h2")).alias(s) for s in "ab")
    )
    roots = components(links).select("node.h1", "node.h2", "root")
    own = F.struct("h1", "h2")
    rooted = classes.join(roots, ["h1", "h2"], "left").withColumn("root", F.coalesce("root", own))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.r1", "first.r2")
    kept = whole.select("r1", "r2", "row").groupBy("r1", "r2").agg(F.first("row").alias("row"))
    return kept.join(firsts, ["r1", "r2"]).select("row.*")
