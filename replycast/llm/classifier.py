"""Quality classifier: n-gram indicators scaled by log-count ratios, and a linear hinge-loss model.

A null or empty text has no n-grams and gets the score of the bias alone. Of rows that repeat an id in the
labels, the mean decides, a half counting as 1; null labels and null ids are not learned from. Without a
label of either class every score is 0.5. Repeated documents are scored like any other, an empty table
gives an empty table, and only the named columns are read.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from .common import travels

travels(__name__)

#: At most about this many labelled documents are learned from, chosen by a hash of their ids.
SAMPLE = 12_000
#: A label has at least this part of the sample, or all its documents if these are fewer.
LEAST_PART = 1 / 20
#: Hash buckets of n-grams, as a power of two.
BITS = 18
#: Bytes of the n-grams, and lengths of runs of one word that count as n-grams too.
SIZES = (1, 2, 3)
RUNS = (2, 3, 5, 9)
PRIOR = 1.0
COST = 1.0
ROUNDS = 12
#: Share of the sample kept back to turn margins into scores.
HELD_BACK = 5

MIX = np.uint64(0x9E3779B97F4A7C15)


def ngrams(text):
    """Buckets of the n-grams of a text, each once.

    N-grams are runs of bytes, and of equal words in a row whatever the word is.
    """
    data = (text or "").encode()
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    parts = []
    for size in SIZES:
        n = len(raw) - size + 1
        if n <= 0:
            continue
        key = np.full(n, size, np.uint64)
        for i in range(size):
            key = (key << np.uint64(8)) | raw[i : i + n]
        parts.append((key * MIX) >> np.uint64(64 - BITS))
    words = data.split()
    longest = run = 1
    for a, b in zip(words, words[1:]):
        run = run + 1 if a == b else 1
        if run > longest:
            longest = run
    runs = np.array([(1 << 40) + n for n in RUNS if longest >= n], np.uint64)
    parts.append((runs * MIX) >> np.uint64(64 - BITS))
    return np.concatenate(parts).astype(np.int64)


class Unique:
    """Distinct buckets without sorting: of equal ones, the last written place wins."""

    def __init__(self):
        self.place = np.zeros(1 << BITS, np.int32)

    def __call__(self, buckets):
        places = np.arange(len(buckets), dtype=np.int32)
        self.place[buckets] = places
        return buckets[self.place[buckets] == places]


def log_ratios(samples, labels):
    """Logarithm of how much more often a bucket is set in documents of class 1; 0 if never seen."""
    counts = np.full((2, 1 << BITS), PRIOR)
    for buckets, label in zip(samples, labels):
        counts[label, buckets] += 1
    seen = counts.sum(axis=0) > 2 * PRIOR
    counts /= counts.sum(axis=1, keepdims=True)
    return np.where(seen, np.log(counts[1] / counts[0]), 0.0)


def fit_hinge(samples, labels, ratios, rng):
    """Weights and bias of the linear model by dual coordinate descent.

    Each step solves for the multiplier of one document and adds the difference to the weights. Documents
    have length 1 plus a constant for the bias; the rarer class costs as much as the other in all.
    """
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.array([(signs == s).mean() for s in (-1.0, 1.0)])
    bound = np.where(signs > 0, COST / (2 * share[1]), COST / (2 * share[0]))
    lengths = np.empty(len(samples))
    for i, buckets in enumerate(samples):
        v = ratios[buckets]
        lengths[i] = max(np.sqrt(v @ v), 1e-12)

    def value(i):
        """Made anew each time: the values of all samples would take twice the space of their buckets."""
        return ratios[samples[i]] / lengths[i]

    square = np.array([v @ v for v in map(value, range(len(samples)))]) + 1.0
    weights, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(samples))
    for _ in range(ROUNDS):
        for i in rng.permutation(len(samples)):
            buckets, v, sign = samples[i], value(i), signs[i]
            slope = sign * (weights[buckets] @ v + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), bound[i])
            step = (new - alpha[i]) * sign
            if step:
                weights[buckets] += step * v
                bias += step
                alpha[i] = new
    return weights, bias


def fit_scale(margins, labels):
    """Slope and offset of the logistic curve that turns margins into scores, by Newton's method."""
    a, b = 1.0, 0.0
    good = labels.sum()
    # targets are drawn in a little, so the curve stays finite on separable documents
    goal = np.where(labels == 1, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w, d = p * (1 - p) + 1e-9, p - goal
        grad = np.array([d @ margins + 1e-3 * a, d.sum()])
        hess = np.array([[w @ margins**2 + 1e-3, w @ margins], [w @ margins, w.sum()]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    return a, b


def _margin(buckets, gains, squares, bias):
    length = np.sqrt(squares[buckets].sum())
    return gains[buckets].sum() / max(length, 1e-12) + bias


class Model:
    """Fitted tables: what a bucket adds to the margin, its squared ratio, bias, logistic curve."""

    def __init__(self, samples, labels, seed=5):
        self.known = len(set(labels.tolist())) == 2
        if not self.known:
            return
        held = np.arange(len(samples)) % HELD_BACK == 0
        if len(set(labels[~held].tolist())) < 2 or len(set(labels[held].tolist())) < 2:
            held[:] = False
        fit = [s for s, h in zip(samples, held) if not h]
        ratios = log_ratios(fit, labels[~held])
        weights, self.bias = fit_hinge(fit, labels[~held], ratios, np.random.default_rng(seed))
        self.gains = (weights * ratios).astype(np.float32)
        self.squares = (ratios * ratios).astype(np.float32)
        back = held if held.any() else ~held
        tuned = [s for s, h in zip(samples, back) if h]
        margins = np.array([_margin(s, self.gains, self.squares, self.bias) for s in tuned])
        self.slope, self.offset = fit_scale(margins, labels[back])

    def score(self, buckets):
        if not self.known:
            return 0.5
        margin = _margin(buckets, self.gains, self.squares, self.bias)
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def _sample(labels, id_col, label_col, learn, sample):
    """Labels to learn from: one row per id, about `sample` of them at most, by a hash of the id.

    Labels keep their proportions, but for a rare one, which has `LEAST_PART` of the sample if it can.
    """
    rows = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    if learn is not None:
        rows = rows.filter(learn(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    share = min(1.0, sample / max(sum(counts.values()), 1))
    chosen = F.lit(False)
    for label, n in counts.items():
        own = min(1.0, max(share, LEAST_PART * sample / n))
        drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(own * 1_000_000)
        chosen |= (F.col("label") == label) & drawn
    return rows.filter(chosen)


def fit(docs, labels, id_col="doc_id", text_col="text", label_col="quality", learn=None, sample=SAMPLE):
    """Model fitted on a bounded sample of the labelled documents.

    `learn` maps an id column to the condition for learning from it. The sampled labels, bounded by
    `sample`, are the broadcast side of the join; the driver gets the n-gram buckets of these documents.
    """
    chosen = F.broadcast(_sample(labels, id_col, label_col, learn, sample))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = texts.join(chosen, "doc_id").select("doc_id", "label", "text")

    def buckets(batches):
        unique = Unique()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [unique(ngrams(t)).astype(np.int32).tobytes() for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.binary())],
                    names=["doc_id", "label", "buckets"],
                )

    kind = dict(docs.dtypes)[id_col]
    rows = joined.mapInArrow(buckets, f"doc_id {kind}, label int, buckets binary").toArrow()
    # the order alone: a sorted table would be a copy
    order = pc.sort_indices(rows, [("doc_id", "ascending"), ("buckets", "ascending")])
    found = [np.frombuffer(b.as_buffer(), np.int32) for b in rows["buckets"]]
    samples = [found[i] for i in order.to_numpy()]
    return Model(samples, rows["label"].take(order).to_numpy().astype(np.int64))


def score_column(spark, model, text_col="text"):
    """Scores between 0 and 1 of a text column; higher means class 1 is likelier."""
    shared = spark.sparkContext.broadcast(vars(model))

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        unique, model = Unique(), Model.__new__(Model)
        vars(model).update(shared.value)
        return pa.array((model.score(unique(ngrams(t.as_py()))) for t in texts), pa.float64())

    return scores(F.col(text_col))


def remainder(id_col, divisor):
    """CRC-32 of an id's text, modulo `divisor`; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % divisor
