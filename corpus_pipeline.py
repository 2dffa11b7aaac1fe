"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet into the shared scratch
folder and rereads it as the next stage's docs. All but the last return the columns of documents. A stage starts by
removing the scratch tables of the stages before it, but for those that its docs read: write a stage's result
before the next is called, as `run` does.

Defined results: null text counts as empty and stays null until it is packed as one end token; empty tables pass through
every stage; extra columns are carried by all stages but the last. Rows without id: see each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubstat.llm.jaccard import jaccard_classes
from scrubstat.llm.mixing import mix_documents
from scrubstat.llm.packing import pack_documents
from scrubstat.llm.pii import find_pii, redacted
from scrubstat.llm.quality import score_quality
from scrubstat.session import join_uri, release_scratch, ship_package, write_through


def _start(spark: SparkSession, docs: DataFrame) -> None:
    ship_package(spark)
    release_scratch(spark, docs)


def _resized(docs: DataFrame) -> DataFrame:
    """n_chars, where there is one, follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (operator 9, trained on all labels) does not reject. Rows without id are
    scored like any other."""
    _start(spark, docs)
    labels = spark.read.parquet(join_uri(sf_dir, "labels.parquet"))
    scored = score_quality(docs, labels, F.lit(True), keep_rows=True)
    return scored.where("score >= 0.5").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by a Jaccard similarity of 0.8 or more over
    five-word shingles (operator 5). Documents without words are no copies of each other. A row without id goes if
    its group has a document with an id; else it stays. Of rows equal in id and text one stays."""
    _start(spark, docs)
    classes = jaccard_classes(docs, n=5, percent=80)
    kept = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    stay = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")
    return stay.withColumn("_text", F.sha2("text", 256)).dropDuplicates(["doc_id", "_text"]).drop("_text")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data (operator 3) replaced by its kind in brackets."""
    _start(spark, docs)
    found = find_pii(docs, keep_rows=True)
    cols = [redacted(F.col("row.text"), F.col("spans")).alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns]
    return _resized(found.select(*cols))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weights 5, 2, 1 repeating (operator 8): documents repeat or go, in the order of the mix;
    the last one taken of a source is cut."""
    _start(spark, docs)
    return _resized(mix_documents(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens (operator 1), one row per piece with its token ids."""
    _start(spark, docs)
    return pack_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("pii", pii), ("mixing", mixing), ("packing", packing)]

# A classifier, a trained span model and a tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table documents."""
    docs = spark.read.parquet(join_uri(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
