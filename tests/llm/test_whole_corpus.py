"""Resampling, manifest and packing against plain brute-force versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from replycast.llm import lines, merkle, ordering, packing, resampling

DOCS = "doc_id long, source string, lang string, n_chars long, text string"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _texts(rng, n, longest=60):
    words = ["Wort", "der", "Ünder", "a1", "B2", "it's", "日本", "x", "no_way", "\x00q", "É"]
    return [
        rng.choice([" ", "\n", "\t ", ", "]).join(rng.choice(words) for _ in range(rng.randint(0, longest)))
        for _ in range(n)
    ]


# places in an order


def test_places_and_sums_of_a_hot_group(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aaaab"), i, rng.randint(0, 9)) for i in rng.sample(range(10_000), 700)]
    table = spark.createDataFrame(rows, "g string, i long, w long").repartition(7)
    found = ordering.placed(table, ["i"], ["g"], size="w").collect()
    sums = Counter()
    for g, i, w in sorted(rows):
        rows[rows.index((g, i, w))] = (g, i, w, sums[g])
        sums[g] += w
    assert sorted(tuple(r) for r in found) == sorted(rows)


# importance resampling


def _features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def _resampled(docs, target, percent=25, buckets=10_000):
    features = {i: _features(t) for i, t in docs.items()}
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, found in features.values():
        s.update(map(bucket, found))
    for text in target:
        t.update(map(bucket, _features(text)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))

    rows = {}
    for i, (n_words, found) in features.items():
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows[i] = (n_words, len(found), weight, score)
    enough = sorted((i for i in rows if rows[i][0] >= 20), key=lambda i: (-rows[i][3], i))
    rank = {i: k for k, i in enumerate(enough[: percent * len(enough) // 100], 1)}
    return {i: (n, w, s, rank.get(i)) for i, (_, n, w, s) in rows.items()}


def test_resampling_equals_plain_loops(spark):
    rng = random.Random(5)
    docs = dict(enumerate([None, "", *_texts(rng, 300)]))
    target = _texts(rng, 20) + ["der der", None]
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = {
        r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"])
        for r in resampling.resample(table, wanted).collect()
    }
    assert found == _resampled(docs, target)


def test_longer_runs_share_the_hash_of_their_beginning():
    import pyarrow as pa

    text = "one two three four two three"
    for order, (found, parent) in enumerate(resampling.feature_buckets(pa.array([None, text, "one"]), 3, 997), 1):
        words = text.split()
        runs = [" ".join(words[i : i + order]) for i in range(len(words) - order + 1)]
        want = [zlib.crc32(r.encode()) % 997 for r in runs + ["one"] * (order == 1)]
        assert found.tolist() == want
        assert parent.tolist() == [1] * len(runs) + [2] * (order == 1)


def test_drawn_rows_come_near_the_target(spark):
    rng = random.Random(6)
    old, new = ["alt", "grau", "blass"], ["neu", "hell", "klar"]
    docs = [(i, " ".join(rng.choices(new if i % 4 == 0 else old, k=40))) for i in range(400)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    wanted = spark.createDataFrame([(" ".join(rng.choices(new, k=200)),)], "text string")
    drawn = resampling.drawn_rows(table, resampling.resample(table, wanted)).collect()
    assert len(drawn) == 100
    assert sum(r["doc_id"] % 4 == 0 for r in drawn) > 80


# manifest


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_h(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def _way(levels, place):
    for nodes in levels[:-1]:
        run = place - place % 16
        yield nodes[run:place], nodes[place + 1 : run + 16]
        place //= 16


def _manifest(rows):
    sources = defaultdict(list)
    for row in rows:
        doc_id, source, lang, n_chars, text = row
        plain = _leaf(row)
        new = plain
        if zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None:
            new = _leaf((doc_id, source, lang, n_chars, re.sub("[A-Z]", lambda m: m[0].lower(), text)))
        sources[source].append((doc_id, plain, new))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _levels([leaf for _, leaf, _ in sorted(sources[s])]) for s in order}
    top = _levels([trees[s][-1][0] for s in order])
    for s in order:
        for place, (doc_id, plain, new) in enumerate(sorted(sources[s])):
            steps = [*_way(trees[s], place), *_way(top, order.index(s))]
            folded = new
            for left, right in steps:
                folded = _h(*left, folded, *right)
            proof = _h(*(d for left, right in steps for d in left + right))
            yield doc_id, plain, trees[s][-1][0], top[-1][0], proof, folded


def _found(table):
    rows = merkle.manifest(table, changed=merkle.lower_cased())
    rows = rows.withColumn("proof", F.sha2("proof", 256))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root").collect()


def _documents(rng, sizes):
    names = [s for s, n in sizes.items() for _ in range(n)]
    ids = rng.sample(range(10 * len(names)), len(names))
    texts = [rng.choice([None, "", "plain", "Ab", "ÄB c", "x" * 50 + "Y"]) for _ in names]
    return [
        (i, s, rng.choice(["en", None]), None if t is None else len(t), t) for i, s, t in zip(ids, names, texts)
    ]


@pytest.mark.parametrize(
    "sizes",
    [
        {"only": 1},
        {None: 17, "": 16, "é": 1, "z": 257, "Z": 2},
        {"hot": 2 * 4096 + 1, "full": 4096, "b": 3, **{f"s{i:03}": 1 for i in range(300)}},
    ],
)
def test_manifest_equals_plain_loops(spark, sizes):
    rows = _documents(random.Random(7), sizes)
    table = spark.createDataFrame(rows, DOCS).repartition(6)
    assert sorted(tuple(r) for r in _found(table)) == sorted(_manifest(rows))


def test_versions_share_all_but_their_way_up(spark):
    rows = _documents(random.Random(8), {"a": 40, "b": 300, "c": 1})
    table = spark.createDataFrame(rows, DOCS)
    found = merkle.manifest(table, changed=(F.col("doc_id") % 3 == 0, {"text": F.lit("NEW")})).collect()
    for r in found:
        assert (r["copies"] is not None) == (r["doc_id"] % 3 == 0)
        assert (r["folded_root"] == r["root"]) == (r["copies"] is None)
        if r["copies"]:
            levels = {"a": 2, "b": 3, "c": 0}[r["source"]] + 1
            assert len(r["copies"]) == levels and r["copies"][-1] == r["folded_root"]


# packing


def test_encoding_equals_the_library():
    import pyarrow as pa

    rng = random.Random(9)
    texts = [None, "", " ", "Á ́x", "ΑΣ ΣΑ.", "a b c", "<|endoftext|> x", "don't 12'S", "q" * 5000]
    texts += ["".join(rng.choices("ab .'\n\t éÉßſ日0!Σ́<|>", k=rng.randint(0, 80))) for _ in range(400)]
    library = Tokenizer.from_file(VOCABULARY)
    library.encode_special_tokens = True
    ids, sizes = packing.encode_texts(pa.array(texts), packing.Known(VOCABULARY))
    want = [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def _program_value(counts, capacity):
    """Most full sequences that whole items can give, by trying all patterns, for a few lengths."""
    kinds = [i + 1 for i, c in enumerate(counts) if c]

    def lists(left, at):
        if left == 0:
            yield ()
        for k in range(at, len(kinds)):
            if kinds[k] <= left:
                for more in lists(left - kinds[k], k):
                    yield (kinds[k], *more)

    options = [Counter(p) for p in lists(capacity, 0)]
    best = {}

    def most(left):
        if left not in best:
            stock = dict(zip(kinds, left))
            best[left] = max(
                (1 + most(tuple(stock[k] - p[k] for k in kinds)) for p in options if all(stock[k] >= p[k] for k in kinds)),
                default=0,
            )
        return best[left]

    return most(tuple(counts[k - 1] for k in kinds))


def test_patterns_come_near_the_best_whole_solution():
    rng = random.Random(10)
    for _ in range(30):
        counts = np.zeros(15, np.int64)
        for k in rng.sample(range(15), 4):
            counts[k] = rng.randint(1, 9)
        found = packing.patterns(counts, 16)
        assert all(pattern @ np.arange(1, 16) == 16 for pattern, _ in found)
        used = sum((use * pattern for pattern, use in found), np.zeros(15, np.int64))
        assert (used <= counts).all()
        uses, best = sum(use for _, use in found), _program_value(counts.tolist(), 16)
        assert best - 2 <= uses <= best


def _check_packed(pieces, lengths, size=2048):
    per_row, per_sequence = defaultdict(list), defaultdict(list)
    for row, start, length, sequence, offset in pieces:
        per_row[row].append((start, length))
        per_sequence[sequence].append((offset, length))
    for parts, whole in ((per_row[r], n) for r, n in lengths.items()):
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == whole
    filled = []
    for parts in per_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        filled.append(at)
    # no padding anywhere: full, or one of the last few powers of two
    assert all(f == size or f & (f - 1) == 0 for f in filled) and max(filled, default=0) <= size
    assert sum(f != size for f in filled) <= 11
    assert sorted(per_sequence) == list(range(len(per_sequence)))


@pytest.mark.parametrize("n", [0, 1, 40, 3000])
def test_pieces_cover_all_and_leave_no_padding(spark, n):
    rng = random.Random(n)
    lengths = {i: max(1, int(rng.lognormvariate(5.5, 1.3))) for i in range(n)}
    table = spark.createDataFrame(list(lengths.items()), "row long, n long").repartition(5)
    pieces = packing.pack_lengths(table, 2048, 8).collect()
    _check_packed([tuple(p) for p in pieces], lengths)
    if n == 3000:  # most rests stay whole
        whole = sum(p["length"] % 2048 == lengths[p["row"]] % 2048 for p in pieces)
        assert whole > 0.6 * n


def test_equal_lengths_are_packed_whole(spark):
    table = spark.range(0, 4096).select(F.col("id").alias("row"), F.lit(512).cast("long").alias("n"))
    pieces = packing.pack_lengths(table, 2048, 8).collect()
    assert {p["length"] for p in pieces} == {512} and len({p["sequence_id"] for p in pieces}) == 1024


def test_packed_ids_are_those_of_the_texts(spark):
    rng = random.Random(11)
    texts = [None, "", *_texts(rng, 60, 900), " ".join(rng.choices("abcdefgh", k=9000))]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    library = Tokenizer.from_file(VOCABULARY)
    library.encode_special_tokens = True
    want = [library.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
    rows = packing.pack(table, VOCABULARY).collect()
    _check_packed(
        [(r["doc_id"], r["start"], r["length"], r["sequence_id"], r["offset"]) for r in rows],
        {i: len(w) for i, w in enumerate(want)},
    )
    for r in rows:
        part = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert np.frombuffer(r["ids"], "<u4").tolist() == part and r["doc_tokens"] == len(want[r["doc_id"]])


def test_unlike_lines_with_a_common_passage_are_no_group(spark):
    """A passage of 40 words in lines with 60 words of their own, and near copies with more edits than allowed."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(2000)]
    passage, copied = rng.choices(vocabulary, k=40), rng.choices(vocabulary, k=80)
    rows = [" ".join(rng.choices(vocabulary, k=30) + passage + rng.choices(vocabulary, k=30)) for _ in range(150)]
    for _ in range(150):
        tokens = list(copied)
        for at in rng.sample(range(80), 9):
            tokens[at] = rng.choice(vocabulary)
        rows.append(" ".join(tokens))
    near = list(rows[7].split())
    near[3] = "other"
    rows.append(" ".join(near))
    table = spark.createDataFrame([(i, r, i, len(r.split())) for i, r in enumerate(rows)], "id long, line string, first int, n int")
    table = table.select("*", *lines._hashes(F.col("line"))).cache()
    sizes = [r["count"] for r in lines._word_entries(table, lines.SHARE).groupBy("key").count().collect()]
    assert sum(size * size for size in sizes) < 20 * len(rows)
    found = lines.near_earlier_by_words(table)
    assert [r["id"] for r in table.join(found, lines.ID).collect()] == [300]
    table.unpersist()


@pytest.mark.parametrize("collide", [False, True])
def test_known_words_are_looked_up_and_not_hashed_again(monkeypatch, collide):
    """New words cost what they are, however many are known; also if all words have one hash."""
    path, sizes, index_in = public_tokenizers.path("word_bpe_49k.json"), [], packing.pc.index_in

    def counted(values, value_set):
        sizes.append(len(value_set))
        return index_in(values, value_set=value_set)

    monkeypatch.setattr(packing.pc, "index_in", counted)
    if collide:
        monkeypatch.setattr(packing.pd.util, "hash_array", lambda v, **_: np.zeros(len(v), np.uint64))
    known, tokenizer = packing.Known(path), Tokenizer.from_file(path)
    texts = [" ".join(f"wörd{chr(97 + i % 26)}{chr(97 + i // 26)}x A{i}, über" for i in range(300)), "the end", "a new one. The end"]
    for text in texts:
        ids, taken = packing.encode_texts(pa.array([text, None, text]), known)
        want = [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END]
        assert ids.tolist() == [*want, packing.END, *want] and taken.tolist() == [len(want), 1, len(want)]
    assert max(sizes[1:]) < 10
