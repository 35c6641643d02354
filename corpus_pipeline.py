"""A corpus pipeline of four operators; every stage is written as Parquet and read again.

1. quality: documents that the classifier rejects go.
2. near_duplicates: of every group of documents linked by shared shingles of five words
   (Jaccard index 0.8 or more) one stays, the one with the smallest id.
3. mixing: every document occurs as often as the mix holds it; documents it leaves out go.
4. encoding: token ids of the mix, as digests.

All stages but the last return the columns of ``documents``. ``ORACLE_SQL`` is None: neither the
classifier nor the vocabulary can be put into SQL, so the pipeline is tested against a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import bpe, mixing, ngram_join, quality
from wattline.llm.common import others, stored, table
from wattline.llm.vocabularies import public_path

ORACLE_SQL = None
# near duplicates of the stage; op4 has values of its own
WIDTH, PERCENT = 5, 80


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the classifier, fitted on the labelled ones among them, approves."""
    forest = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, forest, keep_text=True)
    return scored.where("predicted = 1").select(*others(docs, ()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: its smallest id. Of repeated rows one row stays.

    Rows that share an id but not the text are decided each by its own text; those that are
    linked collapse. Rows without an id cannot be told apart by one: they all stay.
    """
    joined = ngram_join.similar_documents(docs, width=WIDTH, percent=PERCENT, keys=True)
    wordless = F.when(F.col("part").isNull(), F.struct("k1", "k2"))
    keep = stored(
        joined.where("doc_id = component_id").groupBy("doc_id", "k1", "k2", "part").agg(F.count("*").alias("n"))
        .groupBy("doc_id", "part", wordless.alias("own")).agg(F.min(F.struct("k1", "k2", "n")).alias("row"))
        .select(F.col("row.k1").alias("_k1"), F.col("row.k2").alias("_k2"), F.col("row.n").alias("_n")),
        "pipeline-keep",
    )
    k1, k2 = ngram_join.row_key(F.col("doc_id").cast("long"), F.col("text"))
    named = docs.where("doc_id is not null").withColumn("_k1", k1).withColumn("_k2", k2)
    rest = others(docs, ("doc_id",))
    once = named.join(keep.where("_n = 1"), ["_k1", "_k2"], "left_semi").select(*others(docs, ())).unionByName(
        named.join(keep.where("_n > 1"), ["_k1", "_k2"], "left_semi")
        .groupBy("_k1", "_k2", "doc_id").agg(F.min(F.struct(*rest)).alias("_picked")).select("doc_id", "_picked.*")
    )
    return once.unionByName(docs.where("doc_id is null")).select(*others(docs, ()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix holds them."""
    mixed = mixing.mix(docs.withColumn("_original", F.struct(*others(docs, ()))))
    copies = mixed.where("copies > 0").select(
        F.col("_original"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")
    )
    return copies.select("_original.*")


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text, one row per occurrence."""
    return bpe.digests(bpe.encode(docs.select("doc_id", "text"), public_path("word_bpe_49k.json")))


STAGES = [
    ("quality", filter_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
