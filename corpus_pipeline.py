"""The documents' way through five operators; every stage is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import adaptive_rules, hilbert_pack, hyperminhash, knapsack_mix, pairwise_quality
from tillcast.llm.queries import vocabulary
from tillcast.session import new_path

SHINGLE = 5  # words


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above the quality threshold, repeated rows included.

    Null and empty texts are judged like others, by features of zero.
    """
    return pairwise_quality.preferred(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules of their language and source keep, repeated rows included.

    Null and empty texts fail for want of words; null languages and sources are groups.
    """
    return adaptive_rules.accepted(docs)


def _rows(docs: DataFrame) -> DataFrame:
    """(row, digest): each row as one struct, so that no column name can clash, and its hash.

    The digest is of all columns, 128 bits, nulls told from values; maps count as JSON.
    """
    parts = []
    for field in docs.schema:
        value = docs[field.name]
        parts += [value.isNull(), F.to_json(value) if "map<" in field.dataType.simpleString() else value]
    digest = F.concat_ws("-", *(F.xxhash64(F.lit(k), *parts).cast("string") for k in (0, 1)))
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), digest.alias("digest"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; those without an id stay.

    Where an id comes with several texts, the one with the smallest hash keeps the id as its
    key and the others have keys of their own, so a text goes only for a near copy.  Of rows
    with one id and one text the one with the smallest digest stays.  Null, empty and
    word-free texts are near copies of nothing.
    """
    rows = _rows(docs).withColumn("id", F.col("row.doc_id").cast("long"))
    rows = rows.withColumn("hash", F.xxhash64(F.col("row.text").cast("string")))
    least = rows.where("id is not null").groupBy("id").agg(F.min("hash").alias("least"), F.max("hash").alias("most"))
    least = least.where("least <> most").drop("most")
    key = F.when(F.col("least") != F.col("hash"), F.xxhash64("id", "hash")).otherwise(F.col("id"))
    keyed = rows.join(least, "id", "left").select(key.alias("key"), "row", "digest").where("key is not null")
    found = hyperminhash.near_duplicates(keyed.select(F.col("key").alias("doc_id"), "row.text"), width=SHINGLE)
    ids = found.where("kept").select(F.col("doc_id").alias("key")).distinct()
    one = keyed.join(ids, "key", "left_semi").groupBy("key").agg(F.min_by("row", "digest").alias("row"))
    return one.select("row.*").unionByName(docs.where(docs["doc_id"].isNull()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's budget takes it, at most three times.

    Documents are told apart by all their columns.  Of rows that repeat exactly, which are
    documents of their own to the budget, it does not matter which one is taken: the row
    comes as often as the budget takes any of them.  Null and empty texts have no words
    and are not taken.
    """
    rows = _rows(docs)
    mixed = knapsack_mix.mixed(rows.select(F.col("digest").alias("doc_id"), "row.text", "row.source"))
    times = mixed.where("taken > 0").groupBy(F.col("doc_id").alias("digest"))
    times = times.agg(F.sum(F.col("taken") / F.col("size")).cast("int").alias("times"))
    one = rows.groupBy("digest").agg(F.first("row").alias("row"))
    copies = F.explode(F.sequence(F.lit(1), F.col("times")))
    return one.join(times, "digest").select("row", copies).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, neighbours on the curve side by side.

    Null and empty texts are one token; repeated rows are packed each.
    """
    return hilbert_pack.packed(docs, vocabulary())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of a folder."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, df, sf_dir).write.parquet(path)
        df = spark.read.parquet(path)
    return df


ORACLE_SQL = None
