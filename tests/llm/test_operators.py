"""Each operator against a plain brute-force version on small tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from replycast.llm import (
    alike, bpe, classifier, components, exact, langid, lines, mixing, pii, quality_rules, simhash, substrings,
)

WORD = re.compile("[^ \t-\r]+")
DOCS = "doc_id long, text string, lang string, source string"


def _union_find(n, links):
    parent = list(range(n))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[top(a)] = top(b)
    return [top(x) for x in range(n)]


# mixing


def _water_filling(sizes, weights, epochs, total):
    """Clamp and reshare until none is above; plain floats."""
    target, clamped = {}, set()
    while True:
        left = total - sum(epochs * sizes[s] for s in clamped)
        free = sum(weights[s] for s in sizes if s not in clamped)
        for s in sizes:
            target[s] = epochs * sizes[s] if s in clamped else left * weights[s] / free
        over = {s for s in sizes if s not in clamped and target[s] > epochs * sizes[s]}
        if not over:
            return target
        clamped |= over


def test_targets_are_the_water_level(spark):
    rng = random.Random(1)
    sizes = {f"s{i}": rng.choice([0, 5, 40, 300, 9000]) + rng.randint(1, 9) for i in range(25)}
    weights = {s: rng.choice([0.5, 1, 2, 30]) for s in sizes}
    table = spark.createDataFrame(
        [(s, sizes[s], float(weights[s])) for s in sizes], "source string, size long, weight double"
    )
    want = _water_filling(sizes, weights, 3.0, sum(sizes.values()))
    got = {r["source"]: r["target"] for r in mixing.targets(table).collect()}
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_targets_above_all_caps(spark):
    table = spark.createDataFrame([("a", 10, 1.0), ("b", 20, 1.0)], "source string, size long, weight double")
    got = {r["source"]: r["target"] for r in mixing.targets(table, 2.0, total=1000).collect()}
    assert got == {"a": 20.0, "b": 40.0}


def test_mix_is_near_its_targets_and_stable(spark):
    rng = random.Random(2)
    rows = [
        (i, "w " * rng.randint(0, 60), "en", rng.choice(["a", "a", "a", "a", "b", "c", None])) for i in range(600)
    ]
    docs = spark.createDataFrame(rows, DOCS)
    weights = mixing.cycled_weights(docs)
    assert {r["source"]: r["weight"] for r in weights.collect()} == {"a": 1.0, "b": 2.0, "c": 3.0, None: 1.0}
    first = mixing.mix(docs, weights).collect()
    again = mixing.mix(docs.repartition(7), weights).collect()
    assert {r["doc_id"]: r["copies"] for r in first} == {r["doc_id"]: r["copies"] for r in again}
    taken, target = Counter(), {}
    for r in first:
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3
    for source, goal in target.items():
        assert abs(taken[source] - goal) <= 30
    whole = mixing.mixed(docs, weights).collect()
    assert Counter(r["doc_id"] for r in whole) == Counter({r["doc_id"]: r["copies"] for r in first if r["copies"]})


# language ID


def _speech(rng, syllables, n):
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


SYLLABLES = {"x": ["ka", "to", "mi", "ru"], "y": ["sch", "ein", "ung", "ä"], "z": ["eau", "oi", "que", "é"]}


def test_language_mixtures(spark):
    rng = random.Random(3)
    rows = [(i, _speech(rng, SYLLABLES[l], rng.randint(3, 80)), l, "s") for i in range(240) for l in [rng.choice("xyz")]]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.fit(docs, learn=lambda i: i % 4 != 2)
    found = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    right = [found[i]["lang_pred"] == lang for i, _, lang, _ in rows if i % 4 == 2]
    assert sum(right) / len(right) > 0.97
    mixed = [(0, _speech(rng, SYLLABLES["x"], 60) + " " + _speech(rng, SYLLABLES["z"], 30), None, None)]
    row = langid.identify(spark.createDataFrame(mixed, DOCS), model).first()
    assert row["lang_pred"] == "x" and row["score"] == pytest.approx(2 / 3, abs=0.06)
    assert row["mixture"].split(":")[0] == "x" and ",z:" in row["mixture"] and "y" not in row["mixture"]


# line dedup


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _edited(rng, text, n, letters="abé😀"):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            chars.insert(at, rng.choice(letters))
        elif kind == 1 and chars:
            chars.pop(min(at, len(chars) - 1))
        elif chars:
            chars[min(at, len(chars) - 1)] = rng.choice(letters)
    return "".join(chars)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_banded_distance(spark, distance):
    rng = random.Random(distance)
    pairs = [("", ""), ("", "a"), ("ab", "")]
    for _ in range(200):
        a = "".join(rng.choices("abé😀", k=rng.randint(0, 12)))
        pairs.append((a, _edited(rng, a, rng.randint(0, 5))))
    table = spark.createDataFrame(pairs, "a string, b string")
    rows = table.select("a", "b", lines.within(F.col("a"), F.col("b"), distance).alias("near")).collect()
    assert all(r["near"] == (_distance(r["a"], r["b"]) <= distance) for r in rows)


def _removed(docs, distance):
    places = sorted(
        ((i is None, i or 0), no, line, i)
        for i, text in docs
        for no, line in enumerate((text or "").split("\n"))
        if len(line) >= lines.MIN_CHARS
    )
    gone, seen = set(), []
    for _, no, line, i in places:
        if any(abs(len(s) - len(line)) <= distance and _distance(s, line) <= distance for s in seen):
            gone.add((i, no))
        if line not in seen:
            seen.append(line)
    return gone


@pytest.mark.parametrize(
    "distance, few, letters", [(1, 16, "abcdefgh "), (1, 0, "ab"), (2, 16, "abcdefgh "), (2, 1, "ab")]
)
def test_line_dedup(spark, monkeypatch, distance, few, letters):
    """Also with groups of any size split to the end (`few` 0 or 1)."""
    monkeypatch.setattr(lines, "FEW", few)
    rng = random.Random(distance * 10 + few)
    base = ["".join(rng.choices(letters, k=rng.randint(19, 26))) for _ in range(10)]
    docs = [
        (i, "\n".join(_edited(rng, rng.choice(base), rng.choice([0, 0, 1, 1, 2, 3])) for _ in range(rng.randint(0, 4))))
        for i in range(30)
    ] + [(None, base[0]), (100, None), (101, "")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], no) for r in lines.line_dedup(table, distance=distance).collect() for no in r["removed"]}
    assert got == _removed(docs, distance)
    texts = {r["doc_id"]: r["text"] for r in lines.without_removed(table, distance=distance).collect()}
    for i, text in docs:
        want = None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if (i, n) not in got)
        assert texts[i] == want


def _removed_by_words(docs, share):
    gone, seen = set(), []
    for i, text in docs:
        for no, line in enumerate(text.split("\n")):
            tokens = line.split()
            if any(
                line == s or _distance(t, tokens) <= max(len(t), len(tokens)) // share
                or abs(len(s) - len(line)) <= 1 and _distance(s, line) <= 1
                for s, t in seen
            ):
                gone.add((i, no))
            seen.append((line, tokens))
    return gone


@pytest.mark.parametrize("few", [16, 1])
def test_line_dedup_by_words(spark, monkeypatch, few):
    """Lines of 18 to 121 words with up to six changed ones; also with every group a large one."""
    monkeypatch.setattr(alike, "FEW", few)
    rng = random.Random(few)
    vocabulary = [f"word{i}" for i in range(400)]
    base = [rng.choices(vocabulary, k=k) for k in (18, 19, 20, 21, 39, 40, 41, 60, 85, 95, 100, 121)]
    base.append(base[-1][:30] + rng.choices(vocabulary, k=30))

    def edited():
        tokens = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 6])):
            at = rng.randrange(len(tokens))
            tokens[at : at + rng.choice([0, 1, 1])] = rng.choice([[], [rng.choice(vocabulary)]])
        return " ".join(tokens)

    docs = [(i, "\n".join(edited() for _ in range(rng.randint(1, 4)))) for i in range(50)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {
        (r["doc_id"], no) for r in lines.line_dedup(table, share=lines.SHARE).collect() for no in r["removed"]
    }
    want = _removed_by_words(docs, lines.SHARE)
    assert got == want
    assert len(want) > len(_removed(docs, 1))


# personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _digits(text):
    return re.sub("[^0-9]", "", text)


def _plain_spans(text):
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(n) <= 255 for n in m[0].split("."))],
        "card": [
            m.span() for m in CARD.finditer(text) if 16 <= len(_digits(m[0])) <= 19 and pii.luhn(_digits(m[0]))
        ],
        "phone": [m.span() for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15],
    }


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(4)
    parts = [
        *"0123456789", "a", "@", ".", ".", "+", "-", " ", "(", ")", "a@b.c", "1.2.3.4", "+1 (2", "é", "😀", "%",
        "4111 1111 1111 1111", "255.", "account: ", "http://a.b ",
    ]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 25)))
        found = pii.spans(text)
        for kind, want in _plain_spans(text).items():
            assert found[kind] == want, text


def test_added_spans(spark):
    text = "see https://example.com/a?b=1, www.x.org. IBAN: DE89370400440532013000 é a.b@mail.example.com"
    found = {kind: [text[a:b] for a, b in at] for kind, at in pii.spans(text).items()}
    assert found["url"] == ["https://example.com/a?b=1", "www.x.org"]
    assert found["account"] == ["DE89370400440532013000"]
    assert found["email"] == ["a.b@mail.example.com"]
    row = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    at = text.index("a.b@")
    assert row["email_spans"] == f"email:{at}:{len(text)}" and row["n_url"] == 2


ANNOUNCED = {
    "IBAN: DE89 3704 0044 0532 0130 00 please": ["DE89 3704 0044 0532 0130 00"],
    "iban de89370400440532013000.": ["de89370400440532013000"],
    "IBAN: GB82 WEST 1234 5698 7654 32": ["GB82 WEST 1234 5698 7654 32"],
    "IBAN: DE00370400440532013000": [],
    "Konto DE89370400440532013000": ["DE89370400440532013000"],
    "account number: 12345678": ["12345678"],
    "Kontonummer 12-345678, Acct No. 87654321": ["12-345678", "87654321"],
    "the account was closed in 1999": [],
    "password: hunter2": ["hunter2"],
    "PASSWORD=correcthorse!": ["correcthorse"],
    'api_key = "sk_live_abc123456"': ["sk_live_abc123456"],
    "Token: abcd, Secret=é😀xy": ["abcd", "é😀xy"],
    "a token of thanks; his secretary: Ann; no password here": [],
    "password:": [],
}


def test_announced_numbers_and_secrets():
    for text, want in ANNOUNCED.items():
        assert [text[a:b] for a, b in pii.spans(text)["account"]] == want, text
    text = "İ HTTPS://example.com/x and WWW.x.org"
    assert [text[a:b] for a, b in pii.spans(text)["url"]] == ["HTTPS://example.com/x", "WWW.x.org"]
    long = "password " * 100_000 + "IBAN: " * 100_000 + "account number " * 100_000 + "password=" + "x" * 100_000
    assert [b - a for a, b in pii.spans(long)["account"]] == [100_000]


# simhash


def _fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ("", None, "one", "One TWO three", "a b c d", "É É a b c d e\x0bf \x1c g", "x " * 500, "ÄÖ a B c"):
        assert simhash.fingerprint(text) & (1 << 64) - 1 == _fingerprint(text)


@pytest.mark.parametrize("part", [2048, 8])
def test_near_links_find_every_component(spark, monkeypatch, part):
    """Also with groups dealt into many cells."""
    monkeypatch.setattr(simhash, "PART", part)
    rng = random.Random(5)
    values = {0, (1 << 64) - 1}
    for _ in range(60):
        center = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 5, 40])):
            value = center
            for _ in range(rng.randint(0, 5)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "value long")
    links = [(r["a"], r["b"]) for r in simhash.near_links(table).collect()]
    at = {v: i for i, v in enumerate(signed)}
    assert all((values[at[a]] ^ values[at[b]]).bit_count() <= 64 for a, b in links)
    want = _union_find(
        len(values),
        [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4],
    )
    got = _union_find(len(values), [(at[a], at[b]) for a, b in links])
    assert len({(a, b) for a, b in zip(want, got)}) == len(set(want)) == len(set(got))


@pytest.mark.parametrize("few", [16, 1])
def test_near_copies_go_by_shingles(spark, monkeypatch, few):
    """Copies with some words changed, most of them more than four bits away; also in large groups."""
    monkeypatch.setattr(alike, "FEW", few)
    rng = random.Random(few)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(100, 300))
        for changed in (0, 0, 1, 2, 3, 4, 5, 8):
            tokens = list(base)
            for at in rng.sample(range(len(tokens)), changed):
                tokens[at] = rng.choice(vocabulary)
            texts.append(" ".join(tokens))
    texts += ["", " ", "few words", "Few  WORDS", "few other words"]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[0]), (3, texts[3])], "doc_id long, text string")
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in texts)]
    near = [
        (i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    ]
    groups = _union_find(len(texts), near)
    want = {groups.index(root) for root in groups}
    got = sorted(r["doc_id"] for r in simhash.keep_unlike(docs).collect())
    assert got == sorted(want)
    assert len(got) < simhash.keep_first(docs).count()


def test_index_links_a_group_as_a_whole():
    """A large ball: more members than a node has children, few links."""
    rng = np.random.default_rng(6)
    values = np.unique(np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, (3000, 2), dtype=np.uint64), axis=1))
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    values = values[np.argsort(rank)]
    links = simhash.GrayIndex(values).links(4)
    assert len(links) <= len(values)
    assert len(set(_union_find(len(values), links))) == 1


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 440)]
    table = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(table).collect()}
    tops = _union_find(441, links)
    groups = {}
    for node in got:
        groups.setdefault(tops[node], set()).add(node)
    assert {n for link in links if link[0] != link[1] for n in link} == set(got)
    for members in groups.values():
        assert len({got[n] for n in members}) == 1 and got[min(members)] in members


# exact dedup


def test_exact_dedup(spark):
    rng = random.Random(8)
    base = ["a b c", "d e f g", "h", ""]
    rows = [(i, rng.choice(["", " ", "\n\t"]).join(rng.choice(base)), "en", "s") for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(re.sub("[ \t-\r]", "", text), []).append((-len(text), i))
    want = {
        i: (min(members)[1], len(members), min(members)[1] == i, hashlib.sha256(body.encode()).hexdigest())
        for body, members in groups.items()
        for _, i in members
    }
    got = {
        r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"])
        for r in exact.exact_dedup(docs).collect()
    }
    assert got == want


def test_colliding_hashes_are_told_apart(spark, monkeypatch):
    """With hashes of the text's length, all texts of a length collide."""
    real = exact._hashed

    def weak(*args):
        return real(*args).withColumns({"h1": F.length("body").cast("long"), "h2": F.lit(0).cast("long")})

    monkeypatch.setattr(exact, "_hashed", weak)
    docs = spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "a b"), (4, "xyz")], "doc_id long, text string")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact.exact_dedup(docs).collect()}
    assert got == {1: (3, 2), 3: (3, 2), 2: (2, 1), 4: (4, 1)}


# substring dedup


def _kept(rows, size=35):
    words = {i: WORD.findall(text or "") for i, text in rows}
    counts = Counter(tuple(w[k : k + size]) for w in words.values() for k in range(len(w) - size + 1))
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - size + 1):
            if counts[tuple(w[k : k + size])] > 1:
                gone.update(range(k, k + size))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("part", [1 << 19, 40])
def test_substring_dedup(spark, monkeypatch, part):
    """Also with index entries added up in small parts."""
    monkeypatch.setattr(substrings, "PART", part)
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "a"]
    passages = [" ".join(rng.choices(vocabulary, k=n)) for n in (34, 35, 36, 50, 90, 200)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(passages))
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(parts)))
    rows += [(100, "x " * 100), (101, "x " * 35), (102, "x " * 34), (103, rows[5][1]), (104, None), (105, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in substrings.substring_dedup(docs).collect()}
    assert got == _kept(rows)


# quality rules


def _counts(text):
    words, lines_ = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    seen, covered = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7)), set()
    for i in range(len(words) - 7):
        if seen[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines_) - len(set(lines_)), len(covered),
    )


def test_quality_counts_and_verdicts(spark):
    rng = random.Random(10)
    vocabulary = ["alpha", "beta", "gamma#", "é|x", "d", "word*"] + [f"plain{i}" for i in range(50)]
    rows = []
    for i in range(150):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        if i % 3 == 0:
            words += words[: rng.randint(0, 30)]
        rows.append((i, "".join(w + rng.choice([" ", " ", " ", "\n", "\t"]) for w in words), rng.choice(["x", None]), "s"))
    junk = [(200 + i, " ".join(f"a{i}{k}###" for k in range(40)), "x", "s") for i in range(5)]
    docs = spark.createDataFrame(rows + junk, DOCS)
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs).collect()}
    for i, text, *_ in rows + junk:
        r, want = got[i], _counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])
    assert not any(got[i]["kept"] for i, *_ in junk)
    assert sum(got[i]["kept"] for i, *_ in rows) >= 0.9 * sum(not got[i]["base_failed"] for i, *_ in rows)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_exclamations", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutters"]


def _counted(spark, rows):
    return spark.createDataFrame(rows, f"doc_id long, lang string, source string, {', '.join(n + ' long' for n in COUNTS)}")


def test_sketches_merge_and_are_near_the_quantiles(spark):
    rng = random.Random(11)
    rows = [
        (i, "x", "s", n, n * rng.randint(2, 9), 0, 0, 1, 0, 0, 0) for i in range(400) for n in [rng.randint(20, 90)]
    ]
    table = _counted(spark, rows)
    key = ["lang", "source", "name", "bin"]
    halves = [quality_rules.sketch(table.filter(f"doc_id % 2 = {k}")) for k in (0, 1)]
    merged = halves[0].unionByName(halves[1]).groupBy(*key).agg(F.sum("n").alias("n"))
    whole = quality_rules.sketch(table)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    fence = quality_rules.group_fences(whole).first()
    lengths = sorted(r[4] / r[3] for r in rows)
    first, third = lengths[99], lengths[299]
    want = third * (third / first) ** quality_rules.FENCE
    # two bins off in the distance, three times, and one in the quartile
    assert fence["word_length_high"] == pytest.approx(math.log(want) / math.log(quality_rules.GROWTH), abs=8)
    assert fence["word_length_low"] < math.log(lengths[0]) / math.log(quality_rules.GROWTH)


def test_fences_follow_spread_and_small_groups_are_pooled(spark):
    rng = random.Random(12)
    spreads = {("x", "tight"): (48, 52, 300), ("x", "wide"): (20, 80, 300), ("x", "few"): (48, 52, 5), ("y", "few"): (48, 52, 5)}
    rows = [
        (rng.random(), lang, source, 100, rng.randint(low * 10, high * 10), 0, 0, 1, 0, 0, 0)
        for (lang, source), (low, high, n) in spreads.items() for _ in range(n)
    ]
    table = _counted(spark, [(i, *r[1:]) for i, r in enumerate(rows)])
    sketches = quality_rules.sketch(table)
    got = {(r["lang"], r["source"]): r for r in quality_rules.group_fences(sketches).collect()}
    assert {k: r["level"] for k, r in got.items()} == {("x", "tight"): 0, ("x", "wide"): 0, ("x", "few"): 1, ("y", "few"): 2}
    high = {k: r["word_length_high"] for k, r in got.items()}
    assert high[("x", "tight")] < high[("x", "few")] < high[("x", "wide")]
    levels = {r["level"]: r["n_docs"] for r in quality_rules.fences(quality_rules.merged(sketches)).filter("level > 0 and lang is distinct from 'y'").collect()}
    assert levels == {1: 605, 2: 610}


# byte-level BPE


@pytest.fixture(scope="module")
def vocabulary():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        return bpe.Vocabulary.parse(file.read())


def test_encoding_is_that_of_the_library(vocabulary):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={}
    )
    encoder = bpe.Encoder(vocabulary, public_tokenizers.PATTERN)
    rng = random.Random(12)
    parts = [
        " ", " ", "\n", "\t", "a", "b", "é", "ß", "1", "٣", "!", "'s", "'ll", "\x1c", "\x85", "\xa0", "漢", "字", "😀",
        "  ", "   ", "²", "́", "the", " and", "\r\n", "--", "<|endoftext|>",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(5000)]
    for text in [*texts, "x" * 3000, " " * 1000 + "a", "ab" * 1500]:
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text)
        assert vocabulary.decode(ids) == text.encode()


def test_appends_and_edits(vocabulary):
    rng = random.Random(13)
    letters = "abc the and é 漢 ing "
    for _ in range(30):
        table = bpe.Prefixes(vocabulary)
        for _ in range(4):
            table.append("".join(rng.choices(letters, k=rng.randint(0, 60))).encode())
        for _ in range(4):
            start = rng.randint(0, len(table.data))
            end = rng.randint(start, len(table.data))
            new = "".join(rng.choices(letters, k=rng.randint(0, 9))).encode()
            want = table.data[:start] + new + table.data[end:]
            table.replace(start, end, new)
            assert table.data == want
            assert table.last == bpe.Prefixes(vocabulary, want).last
    long = bpe.Prefixes(vocabulary, b"a line of words that goes on and on " * 40)
    assert long.replace(100, 101, b"Z") < 120


# quality classifier


def test_classifier_on_held_out_documents(spark):
    rng = random.Random(14)
    rows, labels = [], []
    for i in range(300):
        good = rng.random() < 0.8
        words = rng.choices(["alpha", "beta", "gamma", "delta", "Epsilon"], k=rng.randint(5, 60))
        text = " ".join(words) if good else " ".join(rng.choice([f"{w}$$$", w.upper() + "!!"]) for w in words)
        rows.append((i, text, "en", "s"))
        labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, DOCS)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = classifier.fit(docs, table, learn=lambda i: classifier.remainder(i, 3) != 1)
    scored = docs.select(
        "doc_id", (classifier.remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        classifier.score_column(spark, model).alias("score"),
    ).filter("held_out").collect()
    truth = dict((i, q) for i, q, _ in labels)
    assert sum((r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in scored) / len(scored) > 0.98


def test_a_rare_label_stays_in_the_sample(spark):
    labels = spark.createDataFrame([(i, int(i % 1000 > 0)) for i in range(4000)], "doc_id long, quality int")
    rows = classifier._sample(labels, "doc_id", "quality", None, 100).collect()
    assert sum(r["label"] == 0 for r in rows) == 4
    assert 60 <= len(rows) <= 150


def test_dual_coordinate_descent_reaches_the_margin():
    samples = [np.array([0, 1]), np.array([1, 2]), np.array([3, 4]), np.array([4, 5])]
    labels = np.array([1, 1, 0, 0])
    ratios = classifier.log_ratios(samples, labels)
    assert ratios[1] > ratios[0] > 0 > ratios[3] > ratios[4] and ratios[9] == 0
    weights, bias = classifier.fit_hinge(samples, labels, ratios, np.random.default_rng(0))
    values = [ratios[s] / np.sqrt(ratios[s] @ ratios[s]) for s in samples]
    margins = [weights[s] @ v + bias for s, v in zip(samples, values)]
    assert all(m > 0 for m in margins[:2]) and all(m < 0 for m in margins[2:])
