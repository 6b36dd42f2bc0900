"""Each operator over its whole table, with production parameters."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoprec.llm.common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from shoprec.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoprec.llm.common import crc_mod
    from shoprec.llm.quality_classifier import score_quality, with_decision

    held_out = crc_mod(F.col("doc_id"), 5) == 0
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), trains=~held_out)
    return with_decision(scored, held_out)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoprec.llm.warc import archive_pages, histories, read_archives

    files = archive_pages(table(spark, sf_dir, "pages"))
    return histories(read_archives(files)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoprec.llm.quality_rules import quality_by_votes

    return quality_by_votes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.round("posterior", 6).alias("posterior"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoprec.llm.toxicity import learn, score_toxicity

    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, learn(docs, table(spark, sf_dir, "labels")))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoprec.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoprec.llm.jaccard import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoprec.llm.decontamination import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoprec.llm.common import crc_mod
    from shoprec.llm.hmm import language_model_scores

    scored = language_model_scores(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 7) != 2)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoprec.llm.suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), length=200).drop("kept", "carried")


def looped(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where and with which period a document of n words goes on by repeating itself, by the CRC-32 of its
    id; a null id has none and its text stays."""
    if doc_id is None or n == 0:
        return None
    g, kind = divmod(zlib.crc32(str(doc_id).encode()), 10)
    a = g % n
    return (a, 1 + (n - a) // (3 + g % 8)) if kind == 0 else None


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoprec.llm.periodic import run_digests

    return run_digests(table(spark, sf_dir, "documents"), minimum=12, rewrite=looped)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from shoprec.llm.token_files import token_summary, write_tokens

    path = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_summary(spark, path)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shoprec.llm.hard_negatives import hard_negatives

    rows = table(spark, sf_dir, "embeddings")
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    rows = rows.where(finite).select("vec_id", label.alias("label"), vector.alias("vector"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_warc": op3_warc,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_sharding": op6_sharding,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_decontamination": op8_decontamination,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_files": op12_token_files,
    "op13_hard_negatives": op13_hard_negatives,
}
