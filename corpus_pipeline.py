"""The corpus pipeline: quality rules, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``. SQL cannot express the stages; tests compare them with a brute-force
version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import minhash, packing, quality, substrings
from clickloom.llm.tables import stored

ORACLE_SQL = None


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# Texts with a similarity of 0.8 or more. A pair at 0.8 is missed by all bands with a probability of 2e-6, and by the signature check with
# one of about 1e-6.
NEAR = minhash.Settings(percent=80, bands=25, rows=4, agree=60)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines; a document that loses no line keeps its text as it was."""
    return quality.keep_clean(docs.select(*COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (see ``NEAR``): that with the smallest id.

    Rows that share an id are judged by their own texts; of equal ones, one stays. Rows without an id all stay.
    """
    return minhash.keep_first(docs, COLUMNS, settings=NEAR)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that also stand in an earlier passage; others keep their text as it was."""
    found = substrings.remove_repeats(docs, original=True, carry=("lang", "source", "n_chars"))
    size = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return found.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", size.alias("n_chars"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack(stored(packing.measured(docs), "measured"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("substring dedup", substring_dedup),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
