"""The registered queries of this subpackage; each applies its operator to the whole of its tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewell.llm import (
    decontamination,
    html_text,
    jaccard,
    language,
    lattice,
    packing,
    phrases,
    secrets,
    sentence_spans,
    sharding,
    spelling,
    toxicity,
    vectors,
)
from quotewell.llm.common import fold, texts
from quotewell.llm.oracle import ORACLE_SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.piece_digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer))


def op2_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(fold() != 0))
    return toxicity.score(texts(docs), model).select(
        "doc_id",
        (fold() == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.without_repeats(table(spark, sf_dir, "documents"))


def op4_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(sharding.shard(table(spark, sf_dir, "documents"), shards=24))


def op5_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = "crc32(coalesce(cast(doc_id AS string), '')) % 5 = 1"
    return lattice.score(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), held_out, "lang")


def op6_adaptive_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_components(table(spark, sf_dir, "documents"), size=4, percent=85).drop("doc_hash")


def op7_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op9_multipart_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.span_digest(secrets.find(secrets.numbered(table(spark, sf_dir, "documents"))))


def op10_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("doc_hash")


def op11_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.where(fold(folds=3) != 1))
    found = language.identify(texts(docs), model, ("lang_pred", "score", "rejected"))
    return found.select("doc_id", (fold(folds=3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_hierarchical_packing,
        op2_toxicity_grammar,
        op3_sentence_spans,
        op4_best_fit_shards,
        op5_subword_lattice,
        op6_adaptive_prefixes,
        op7_pca_tiles,
        op8_site_templates,
        op9_multipart_secrets,
        op10_simhash_decontamination,
        op11_compression_language,
        op12_phrase_collocations,
        op13_spelling_variants,
    )
}
__all__ = ["ORACLE_SQL", "QUERIES"]
