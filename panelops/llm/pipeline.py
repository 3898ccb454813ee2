"""Corpus pipeline over ``documents``, made of five of the operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. The result
is written as Parquet under the shared checkpoint folder and read back as the
next stage's ``docs``; the first four stages return the columns of documents.

1. quality classifier: documents scored below 0.7 go;
2. n-gram Jaccard join: of every group of near duplicates the document with
   the smallest id stays;
3. PII: personal data is replaced by its kind, ``n_chars`` follows the text;
4. mixing: each document occurs as often as its source's target wants (0 to 2
   rows);
5. best-fit packing: pieces of at most 1024 tokens with their place.

Defined cases: null texts pass as empty texts; repeated rows of one id are one
node for the join, and all of them stay if it does; rows equal in doc_id,
source and size are mixed as units of their own; texts of any length are taken
whole; an empty table gives no rows at every stage; extra columns are dropped
by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelops.llm import best_fit, jaccard_join, pii_anchors, pivotal_mix, quality_fm
from panelops.llm.queries import MIN_QUALITY, held_out, tokenizer
from panelops.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    model = quality_fm.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    scored = quality_fm.score_documents(docs.select(*COLUMNS), model, "_score")
    return scored.where(F.col("_score") >= MIN_QUALITY).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    linked = jaccard_join.link_documents(docs)
    dropped = linked.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii_anchors.redact(docs.select(*COLUMNS)).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = F.struct("doc_id", "source", "size").alias("_key")
    decided = pivotal_mix.mix(docs).groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("copies").alias("_copies")
    )
    sized = docs.select(*COLUMNS, pivotal_mix.size_of(F.col("text")).alias("size"))
    # Rows of one key share its copies evenly; the join and the window have
    # the same partitioning.
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64("text")))
    each = F.floor(F.col("_copies") / F.col("_n"))
    more = F.when(nth <= F.col("_copies") % F.col("_n"), 1).otherwise(0)
    return (
        sized.select(*COLUMNS, key).join(decided, "_key")
        .select(*COLUMNS, (each + more).cast("int").alias("_times"))
        .select(*COLUMNS, F.explode(F.array_repeat(F.lit(1), F.col("_times"))).alias("_copy"))
        .select(*COLUMNS)
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The workers come from the stages before and have grown with them.
    return best_fit.pack(docs, tokenizer("byte_bpe_50k.json"), max_cached=500_000)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing", mixing),
    ("best-fit packing", packing),
]

# The classifier, the redaction and the tokenizer are outside SQL; every stage
# is tested against a brute-force version in tests/llm/test_similarity.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
