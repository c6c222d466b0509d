"""The corpus pipeline: stages over `documents`, each written and reread as the next one's input.

Every stage but the last returns the columns of its input. Missing columns
other than doc_id, text and source do no harm; extra ones stay. An empty table
passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelens.llm.common import stored
from tablelens.llm.decontaminate import drop_contaminated
from tablelens.llm.jaccard_join import drop_near_copies
from tablelens.llm.line_dedup import dedup_lines
from tablelens.llm.mixing import mixed
from tablelens.llm.registry import table
from tablelens.llm.toxicity import drop_toxic


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines go, and documents that these leave without a word; n_chars follows the text."""
    found = dedup_lines(docs)
    left = found.where("n_removed = 0 or regexp_count(text, '[^\\\\x20\\\\x09-\\\\x0D]') > 0")
    changed = F.col("n_removed") > 0
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return drop_near_copies(docs)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed(docs)


STAGES = [
    ("toxicity", toxic),
    ("line dedup", repeated_lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", contaminated),
    ("mixing sources to target weights", mixture),
]

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
