"""Registered queries over the driver tables: a thin one for each operator."""

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, classifier, langid, merkle, packing, pii, resampling
from .exact import exact_dedup
from .lines import line_dedup
from .mixing import cycled_weights, mix
from .quality_rules import quality_rules
from .simhash import simhash_dedup
from .substrings import substring_dedup

#: Rank file of the production vocabulary.
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Vocabulary of the sequences that are packed.
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    mixed = mix(docs, cycled_weights(docs))
    return mixed.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op2_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held_out = lambda id_col: F.coalesce(classifier.remainder(id_col, 4) == 2, F.lit(False))
    model = langid.fit(docs, learn=lambda id_col: ~held_out(id_col))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "mixture")


def op3_line_dedup(spark, sf_dir):
    found = line_dedup(_table(spark, sf_dir, "documents"))
    return found.withColumn("removed", F.array_join(F.col("removed").cast("array<string>"), ","))


def op4_pii(spark, sf_dir):
    found = pii.find_pii(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(f"n_{kind}" for kind in pii.BASE_KINDS),
        F.sha2(pii.joined(pii.BASE_KINDS), 256).alias("base_sha256"),
        pii.joined(pii.KINDS).alias("spans"),
    )


def op5_simhash(spark, sf_dir):
    found = simhash_dedup(_table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.withColumn("fingerprint", digits)


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark, sf_dir):
    digest = {"kept_sha256": F.sha2("kept_text", 256)}
    return substring_dedup(_table(spark, sf_dir, "documents"), derive=digest)


def op8_quality_rules(spark, sf_dir):
    return quality_rules(_table(spark, sf_dir, "documents")).drop("lang", "source")


def op9_bpe(spark, sf_dir):
    pattern = public_tokenizers.PATTERN
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), VOCABULARY, pattern)
    decoded = bpe.decode(encoded, VOCABULARY, pattern)
    return decoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_quality_classifier(spark, sf_dir):
    docs, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    held_out = lambda id_col: F.coalesce(classifier.remainder(id_col, 3) == 1, F.lit(False))
    model = classifier.fit(docs, labels, learn=lambda id_col: ~held_out(id_col))
    scored = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        classifier.score_column(spark, model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_importance_resampling(spark, sf_dir):
    docs, benchmark = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resampling.resample(docs, benchmark)


def op12_merkle_manifest(spark, sf_dir):
    found = merkle.manifest(_table(spark, sf_dir, "documents"), changed=merkle.lower_cased())
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_packing(spark, sf_dir):
    packed = packing.pack(_table(spark, sf_dir, "documents"), WORD_VOCABULARY)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_language_id,
        op3_line_dedup,
        op4_pii,
        op5_simhash,
        op6_exact_dedup,
        op7_substring_dedup,
        op8_quality_rules,
        op9_bpe,
        op10_quality_classifier,
        op11_importance_resampling,
        op12_merkle_manifest,
        op13_packing,
    )
}
