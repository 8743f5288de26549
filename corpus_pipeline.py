"""Corpus preparation from raw documents to packed training windows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

from quotewell.llm import decontamination, jaccard, packing, secrets, toxicity
from quotewell.llm.common import stored


def columns_of(docs: DataFrame) -> list[Column]:
    """All columns of ``docs``, whatever their names hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]


def number_of(table: DataFrame) -> Column:
    """``doc_id`` as long: whole numbers as they are, any other id by its number if it is one, else by its hash; null stays null."""
    if isinstance(table.schema["doc_id"].dataType, IntegralType):
        return F.col("doc_id").cast("long")
    as_text = F.col("doc_id").cast("string")
    return F.when(as_text.isNotNull(), F.coalesce(as_text.try_cast("long"), F.xxhash64(as_text)))


def with_long_ids(table: DataFrame) -> DataFrame:
    return table.withColumn("doc_id", number_of(table))


def row_key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``#uid``, a hash of id and text as they stand; equal rows have equal ones."""
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return docs.withColumn("#uid", F.md5(F.concat_ws("\x00", id_text, F.coalesce("text", F.lit(""))).cast("binary")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learnt from the labels of the documents at hand, doesn't find toxic.

    A document goes if its score is 0.5 or more, and more than that of a text
    without any match.  Without labels, or with too few to learn from, nothing
    goes.  Null and empty texts match nothing and stay; repeated rows are judged
    alike; texts of any length are read whole; an empty table stays empty.
    """
    labels = with_long_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    model = toxicity.learn(with_long_ids(docs), labels)
    least = max(0.5, model.score("", {}) + 1e-9)
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # Arrow functions take no dotted names
    scored = toxicity.score(plain, model, "toxicity", f"c{docs.columns.index('text')}")
    return scored.where(F.col("toxicity") < least).drop("toxicity").toDF(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the group's smallest id.

    A group is linked by a similarity of 0.8 on shingles of five words.  Rows
    without shingles (null, empty and blank texts) stay as they are; of repeated
    rows one stays, the first by a hash of all its columns that can be compared.
    Texts of any length are read whole; an empty table stays empty.
    """
    numbers = with_long_ids(docs.select("doc_id", "text"))
    groups = jaccard.similarity_components(numbers, size=5, percent=80)
    kept = (
        groups.where("n_shingles > 0")
        .groupBy("component_id")
        .agg(F.min(F.struct("doc_id", "doc_hash")).alias("doc"))
        .select(F.col("doc.doc_id").alias("#id"), F.col("doc.doc_hash").alias("#hash"))
    )
    ids = groups.where("n_shingles = 0").select(F.col("doc_id").alias("#id"), F.col("doc_hash").alias("#hash")).distinct()
    named = docs.withColumn("#number", number_of(docs)).withColumn("#text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("#number").eqNullSafe(F.col("#id")) & (F.col("#text_hash") == F.col("#hash"))
    plain = [c for c, kind in zip(columns_of(docs), docs.schema.fields) if "map<" not in kind.dataType.simpleString()]
    first = F.row_number().over(Window.partitionBy("#id", "#hash").orderBy(F.xxhash64(F.struct(*plain))))
    unique = named.join(kept, same).withColumn("#row", first).where("`#row` = 1").select(columns_of(docs))
    return unique.unionAll(named.join(ids, same, "left_semi").select(columns_of(docs)))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found.

    Null and empty texts hold none and stay, all rows of an id and text go
    together, texts of any length are read whole; without documents or items
    nothing changes.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    numbered = docs.withColumn("#number", number_of(docs)).withColumn("#text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    gone = decontamination.leaks(with_long_ids(docs.select("doc_id", "text")), items)
    gone = gone.select(F.col("doc_id").alias("#id"), F.col("doc_hash").alias("#hash")).distinct()
    same = F.col("#number").eqNullSafe(F.col("#id")) & (F.col("#text_hash") == F.col("#hash"))
    return numbered.join(gone, same, "left_anti").select(columns_of(docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark; ``n_chars`` follows where the text changed.

    The key of a row is made once of its id and text as they stand, whatever
    their types, so a text keeps no secret for the sake of its id.  Null and
    empty texts have none; repeated rows are masked alike; texts of any length are
    read whole; an empty table stays empty.
    """
    keyed = row_key(docs)
    rows = keyed.select(F.col("#uid").alias("uid"), F.lit(0).cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = secrets.find(rows)
    spans = found.where(F.size("spans") > 0).select(F.col("uid").alias("#uid"), F.col("spans").alias("#spans"))
    changed = F.col("#spans").isNotNull()
    new_text = F.when(changed, secrets.redacted(F.col("text"), F.col("#spans"))).otherwise(F.col("text"))
    joined = keyed.join(spans.dropDuplicates(["#uid"]), "#uid", "left").withColumn("text", new_text)
    if "n_chars" in docs.columns:
        count = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        joined = joined.withColumn("n_chars", F.when(changed, count).otherwise(F.col("n_chars")))
    return joined.select(columns_of(docs))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in packed windows; ids that are not whole numbers by number or hash.

    Null and empty texts are documents of the end token alone; repeated rows are
    packed as often as they occur; texts of any length are cut into pieces; an
    empty table gives no pieces.
    """
    return packing.piece_digest(packing.pack(with_long_ids(docs), public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("packing", pack_windows),
]

#: No SQL states a tokenizer or learnt weights; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written once and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
