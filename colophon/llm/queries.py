"""The operators here as registered queries, and the SQL that must give the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from colophon.llm import (
    bpe, fingerprints, jaccard_join, language, licenses, mixing, oracles, packing, quality, quotations, search,
    secret_scan, spelling, substring_dedup)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_quality_rules(spark, sf_dir):
    judged = quality.quality_rules(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.concat_ws(",", "rejected_by").alias("rejected_by"))


def op1_secret_scan(spark, sf_dir):
    found = secret_scan.secret_scan(_read(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(
            f"n_{secret_scan.KINDS[kind]}")

    base = F.filter("spans", lambda x: x["kind"] < 3)
    return found.select(
        "doc_id", *(count(kind) for kind in range(4)),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"))


def op2_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_join(_read(spark, sf_dir, "documents")).drop("copy")


def op4_quotation_linking(spark, sf_dir):
    return quotations.link_quotations(_read(spark, sf_dir, "conversations"))


def op5_fingerprints(spark, sf_dir):
    found = fingerprints.fingerprints(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                        *(c for c in found.columns if c not in {"doc_id", "n_chars", "edited"}))


def op6_bpe_codec(spark, sf_dir):
    coded = bpe.encode(_read(spark, sf_dir, "documents"), TOKENIZER)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_substring_dedup(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substring_dedup.dedup_substrings(docs, joined=True)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_language_id(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents")
    model = language.train(language.training_rows(docs))
    named = language.classify(docs.select("doc_id", "text"), model)
    return named.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op10_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(_read(spark, sf_dir, "documents"), TOKENIZER)


def op9_license_scan(spark, sf_dir):
    found = licenses.license_scan(_read(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")}).withColumn(
        "score", F.round("score", 6))


def op11_ranked_search(spark, sf_dir):
    return search.search_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_spelling_variants(spark, sf_dir):
    return spelling.variants(_read(spark, sf_dir, "documents"))


def op13_source_mixing(spark, sf_dir):
    return mixing.words_taken(_read(spark, sf_dir, "documents"))


ENTRIES = {
    "op1_secret_scan": (op1_secret_scan, oracles.OP1),
    "op2_jaccard_join": (op2_jaccard_join, oracles.OP2),
    "op3_quality_rules": (op3_quality_rules, oracles.OP3),
    "op4_quotation_linking": (op4_quotation_linking, None),
    "op5_fingerprints": (op5_fingerprints, None),
    "op6_bpe_codec": (op6_bpe_codec, None),
    "op7_substring_dedup": (op7_substring_dedup, oracles.OP7),
    "op8_language_id": (op8_language_id, None),
    "op9_license_scan": (op9_license_scan, oracles.OP9),
    "op10_best_fit_packing": (op10_best_fit_packing, None),
    "op11_ranked_search": (op11_ranked_search, oracles.OP11),
    "op12_spelling_variants": (op12_spelling_variants, oracles.OP12),
    "op13_source_mixing": (op13_source_mixing, oracles.OP13),
}
