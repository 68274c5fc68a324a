"""Language ID of mixed texts: language shares by expectation-maximisation, the set by penalised likelihood.

A text that is null or has no letter is `und` with score 0, and so is every text if there is nothing to
learn from. Rows with a null language or id are not learned from. Repeated rows count as often as they
occur, an empty table gives an empty table, and only the named columns are read.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import map_texts, travels

travels(__name__)

#: At most about this many documents are learned from, chosen by a hash of their ids.
SAMPLE = 40_000
#: Hash buckets of n-grams, as a power of two. The driver holds one count per bucket and language.
BITS = 16
SMOOTH = 0.5
#: Rounds of expectation-maximisation.
ROUNDS = 10
#: What a further language costs, in logarithms of the number of words.
PENALTY = 3.0

MIX = np.uint64(0x9E3779B97F4A7C15)
LETTER = re.compile(r"[^\W\d_]")
#: ASCII letters stay, as do the bytes of all other letters; the rest becomes space.
TABLE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def word_ngrams(texts):
    """Buckets of the three-byte n-grams of texts, and where words and texts start.

    Returns the buckets, the first bucket of each word and the first word of each text; an n-gram belongs
    to the word of its middle byte. Each text has at least one word, if only an empty one of a space.
    """
    lines = [b" " + t.lower().encode().translate(TABLE) + b" " for t in texts]
    raw = np.frombuffer(b"".join(lines), np.uint8)
    ends = np.cumsum([len(line) for line in lines])
    text_of = np.repeat(np.arange(len(lines)), np.diff(ends, prepend=0))
    middle = np.flatnonzero(raw != 32)
    # the first and last byte of a text are spaces, so both neighbours belong to it
    key = (raw[middle - 1].astype(np.uint64) << np.uint64(16)) | (
        raw[middle].astype(np.uint64) << np.uint64(8)
    )
    key |= raw[middle + 1].astype(np.uint64)
    buckets = ((key * MIX) >> np.uint64(64 - BITS)).astype(np.int64)
    first = np.ones(len(middle), bool)
    first[1:] = np.diff(middle) > 1
    return buckets, np.flatnonzero(first), text_of[middle[first]]


def _loglik(likelihoods, shares):
    """Log-likelihood of each word under language shares, and the languages' parts in it."""
    logs = likelihoods + np.log(np.maximum(shares, 1e-12))
    top = logs.max(axis=1, keepdims=True)
    parts = np.exp(logs - top)
    sums = parts.sum(axis=1, keepdims=True)
    return (top + np.log(sums))[:, 0], parts / sums


def _shares(likelihoods, starts, rounds=ROUNDS):
    """Language shares of each text and its log-likelihood, by expectation-maximisation over words."""
    counts = np.diff(np.append(starts, len(likelihoods)))
    shares = np.full((len(starts), likelihoods.shape[1]), 1 / likelihoods.shape[1])
    for _ in range(rounds):
        _, parts = _loglik(likelihoods, np.repeat(shares, counts, axis=0))
        shares = np.add.reduceat(parts, starts, axis=0) / counts[:, None]
    words, _ = _loglik(likelihoods, np.repeat(shares, counts, axis=0))
    return shares, np.add.reduceat(words, starts)


def _select(likelihoods, single):
    """Shares of one text over the best set of languages, grown as long as it pays.

    A set's worth is its log-likelihood less a penalty for each language beyond the first.
    """
    price = PENALTY * np.log(len(likelihoods) + 1)
    chosen, worth, shares = [int(single.argmax())], single.max(), np.ones(1)
    start = np.zeros(1, np.int64)
    while len(chosen) < likelihoods.shape[1]:
        best = None
        for more in set(range(likelihoods.shape[1])) - set(chosen):
            grown = [*chosen, more]
            found, total = _shares(likelihoods[:, grown], start)
            value = total[0] - price * (len(grown) - 1)
            if value > worth and (best is None or value > best[0]):
                best = value, grown, found[0]
        if best is None:
            break
        worth, chosen, shares = best
    full = np.zeros(likelihoods.shape[1])
    full[chosen] = shares
    return full


def mixtures(texts, table):
    """Language shares of each text: one row for each, zero if it has no word."""
    out = np.zeros((len(texts), table.shape[1]))
    buckets, firsts, text_of = word_ngrams(texts)
    if not len(firsts):
        return out
    likelihoods = np.add.reduceat(table[buckets], firsts, axis=0).astype(np.float64)
    starts = np.flatnonzero(np.diff(text_of, prepend=-1))
    single = np.add.reduceat(likelihoods, starts, axis=0)
    _, best = _shares(likelihoods, starts)
    counts = np.diff(np.append(starts, len(likelihoods)))
    # no set can be likelier than all languages together, so one language is best if that falls short
    alone = best - PENALTY * np.log(counts + 1) <= single.max(axis=1)
    rows = text_of[starts]
    out[rows[alone], single[alone].argmax(axis=1)] = 1.0
    for k in np.flatnonzero(~alone):
        part = likelihoods[starts[k] : starts[k] + counts[k]]
        out[rows[k]] = _select(part, single[k])
    return out


def fit(docs, id_col="doc_id", text_col="text", lang_col="lang", learn=None, sample=SAMPLE):
    """Languages in order and, for each bucket and language, the logarithm of the n-gram's probability.

    Learned from a bounded sample of the documents with a language; `learn` maps an id column to the
    condition for learning from it. Counts are added up per task first.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    ).filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    if learn is not None:
        rows = rows.filter(learn(F.col("doc_id")))
    share = min(1.0, sample / max(rows.count(), 1))
    rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))

    def count(batches):
        totals = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256).to_pydict()
                langs = np.array(part["lang"], dtype=object)
                for lang in set(part["lang"]):
                    texts = [t or "" for t, same in zip(part["text"], langs == lang) if same]
                    buckets = word_ngrams(texts)[0]
                    if lang not in totals:
                        totals[lang] = np.zeros(1 << BITS, np.int64)
                    totals[lang] += np.bincount(buckets, minlength=1 << BITS)
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            # a language without an n-gram still gets a row, so that it is known
            at = at if len(at) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(counts[at])],
                names=["lang", "bucket", "n"],
            )

    counts = rows.select("lang", "text").mapInArrow(count, "lang string, bucket int, n long")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(counts["lang"].to_pylist()))
    table = np.full((1 << BITS, len(names)), SMOOTH)
    place = {name: i for i, name in enumerate(names)}
    column = np.array([place[name] for name in counts["lang"].to_pylist()], np.int64)
    table[counts["bucket"].to_numpy(), column] += counts["n"].to_numpy()
    return names, np.log(table / table.sum(axis=0)).astype(np.float32)


def identify(docs, model, columns=(), id_col="doc_id", text_col="text"):
    """Of each whole text: `lang_pred`, its share as `score`, and all shares as `mixture`.

    `mixture` lists language:share of the selected set, by falling share. The likeliest language is the
    one with the largest share.
    """
    names, table = model
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def rows(keys, texts):
        texts = [t or "" for t in texts]
        lettered = [bool(LETTER.search(t)) for t in texts]
        if names:
            shares = mixtures(texts, shared.value)
        else:
            shares = np.zeros((len(texts), 1))
        best, score, mixed = [], [], []
        for share, known in zip(shares, lettered):
            order = [i for i in np.argsort(-share, kind="stable") if share[i] > 0] if known else []
            # letters that leave no n-gram behind still have a language: the first one learned
            if known and names and not order:
                order = [0]
            best.append(names[order[0]] if order else "und")
            score.append(float(min(1.0, share[order[0]])) if order else 0.0)
            mixed.append(",".join(f"{names[i]}:{share[i]:.3f}" for i in order))
        return keys, best, score, mixed

    kind = dict(docs.dtypes)[id_col].replace("bigint", "long")
    schema = f"doc_id {kind}, lang_pred string, score double, mixture string"
    return map_texts(docs, [F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")], schema, rows)
