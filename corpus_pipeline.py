"""The corpus pipeline: documents through filters and deduplication to packed sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haltgate.llm import packing, quality_classifier, quality_rules, repeats, simhash
from haltgate.llm.common import scratch, write_table
from haltgate.llm.queries import documents, vocabulary
from haltgate.sources.tables import read_table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, predicts to be of quality."""
    return quality_classifier.kept_documents(docs, read_table(spark, sf_dir, "labels"))


def ruled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table."""
    return quality_rules.kept_documents(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates."""
    return simhash.keep_one(docs)


#: Bytes of a string that may occur once only: a passage of some fifty words, whose shortest take five bytes each
#: with the space.
PASSAGE_BYTES = 250


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of passages that occur more than once."""
    return repeats.cut_documents(docs, PASSAGE_BYTES)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences. Workers outlive the stage, so they keep no ids."""
    return packing.pack(docs, vocabulary(), keep_ids=False)


STAGES = [
    ("quality classifier", good),
    ("quality rules", ruled),
    ("simhash near-dedup", distinct),
    ("suffix-array dedup", unrepeated),
    ("packing", packed),
]

#: Trained scores, tokenizers and byte-level matches are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has written is deleted when its result is stored,
    and that when the next one's is."""
    docs, before = documents(spark, sf_dir), []
    for name, stage in STAGES:
        with scratch(spark) as made:
            docs = write_table(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
            made.paths[:0] = before
            before = [made.keep_last()]
    return docs
