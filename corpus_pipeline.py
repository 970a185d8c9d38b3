"""Raw documents to packed training sequences: five stages over the whole table.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written to the shared folder as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``. A null
``doc_id`` is a document as any other; rows of one ``doc_id`` are one document, so stages that drop
documents drop or keep them together. An empty table passes through.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from landfall.llm.contamination import contained_items
from landfall.llm.packing import pack
from landfall.llm.quality import THRESHOLD
from landfall.llm.queries import quality_scores, tokenizer_path
from landfall.llm.simhash import near_duplicates
from landfall.llm.tables import stored, table
from landfall.llm.templates import drop_recurring_lines

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keep(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    named = ids.select(F.col("doc_id").alias("__doc_id"))
    return docs.join(named, F.col("doc_id").eqNullSafe(F.col("__doc_id")), how).select(*COLUMNS)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    scores = quality_scores(docs, table(spark, sf_dir, "labels"))
    return _keep(docs, scores.filter(F.col("score") >= THRESHOLD), "left_semi")


def without_template_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates stay in their first document only; what they were all of is gone with them.

    Lines of any length count; a long one is a repeat from its second document on.
    """
    left = drop_recurring_lines(docs)
    left = left.filter((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints link at 2 bits or fewer, as op8 has them, the one of least ``doc_id``."""
    classes = near_duplicates(docs)
    return _keep(docs, classes.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))), "left_semi")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return _keep(docs, contained_items(docs, table(spark, sf_dir, "benchmark")), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, as the packing query returns them."""
    pieces = pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", good_documents),
    ("line_dedup", without_template_lines),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("packing", packed),
]

# The classifier is no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
