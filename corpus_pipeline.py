"""From raw documents to packed training sequences, in five written stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the
last return the columns of ``documents``. No stage has an SQL twin as a whole: the first
learns hashed n-gram models and the last encodes with a tokenizer.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fraclake.llm import decontamination, importance, line_frequency, near_duplicates, packing
from fraclake.llm.frames import stored
from fraclake.llm.queries import VOCABULARY, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return importance.kept_rows(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines their source repeats; near copies, one of which the next
    stage keeps, count once."""
    return line_frequency.without_boilerplate(docs, near=True)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_duplicates.representatives(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.packed(docs, public_tokenizers.path(VOCABULARY))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("MinHash near-dedup", near_copies),
          ("benchmark decontamination", benchmark), ("best-fit packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
