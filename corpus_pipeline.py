"""From raw documents to packed training sequences: five stages, each written out and read again for the next.

A stage takes ``(spark, docs, sf_dir)``. ``docs`` has the columns of ``documents``; all stages but the last return
those, in their order, and extra columns with them. Nulls in any column are allowed: a null text counts as an empty
one and stays null. Rows with the same ``doc_id`` are taken for the same document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import decontaminate, jaccard_join, queries, toxicity
from contrail.llm.secret_scan import mask
from contrail.llm.tables import landed, marked, settled
from contrail.llm.text import unused

TOXIC_FROM = 0.5


def _without(docs: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The documents whose id is not in the column of ``ids``; null is an id like others."""
    gone = unused("gone", docs)
    listed = ids.select(F.col(column).alias(gone)).distinct()
    return docs.join(listed, docs["doc_id"].eqNullSafe(F.col(gone)), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below ``TOXIC_FROM``. The classifier learns from the labels of the documents
    at hand; without labels of both kinds every document stays."""
    model = queries.toxicity_model(spark, docs, sf_dir)
    return docs.filter(toxicity.score(docs, model) < TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, once; documents without words stay.

    Rows without an id cannot be told apart by it: they go if all their groups have an id, and all stay otherwise.
    """
    doubtful = settled(lambda: _doubtful(docs), "doubtful-documents")
    flag = unused("flag", docs)
    flagged = marked(docs, "doc_id", doubtful, "doc", flag)
    # The others are known to stay; only the flagged ones move to be held against the ids.
    sure = flagged.filter(~F.col(flag)).drop(flag)
    left = _without(flagged.filter(flag).drop(flag), doubtful.filter("not stays"), "doc")
    several = doubtful.filter("stays")
    if several.isEmpty():
        return sure.unionByName(left)
    # Repeated ids are few or none; only their rows need a second look.
    name = unused("kept", docs)
    again = left.join(several.select(F.col("doc").alias(name)), left["doc_id"].eqNullSafe(F.col(name)), "left_semi")
    once = again.filter("doc_id is not null").dropDuplicates(["doc_id"])
    return sure.unionByName(_without(left, several, "doc")).unionByName(again.filter("doc_id is null")).unionByName(once)


def _doubtful(docs: DataFrame) -> DataFrame:
    """The ids that go, or that several rows have, and whether they stay."""
    groups = jaccard_join.near_duplicates(docs, "doc_id", "text")
    stays = F.max(F.col("doc").eqNullSafe(F.col("component"))).alias("stays")
    return groups.groupBy("doc").agg(F.count("*").alias("rows"), stays).filter("not stays or rows > 1").select(
        "doc", "stays")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = settled(lambda: decontaminate.contamination(docs, benchmark, "doc_id", "text", "item_id", "text").filter(
        "n_hit > 0").select("doc_id"), "contaminated")
    return _without(docs, found, "doc_id")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked and ``n_chars`` of changed texts counted anew."""
    found = settled(lambda: queries.scanned(docs.select("doc_id", "text")).filter("secret").select(
        "doc", "content", "value"), "secrets")
    before = unused("before", docs)
    masked = mask(docs.withColumn(before, F.col("text")), found, "doc_id", "text")
    changed = ~F.col("text").eqNullSafe(F.col(before))
    count = F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", count).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their sequence and their place in it."""
    return queries.packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

# Learned classifiers and tokenizers have no SQL; tests hold the stages against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
