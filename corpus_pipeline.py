"""A corpus from raw documents: language, near copies, benchmark passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and
read again as the next one's docs. All but the last keep the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quadloom.llm import decontamination, language, near_copies, packing, personal_data
from quadloom.llm.tables import table
from quadloom.plans.cut import written


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter (`und`) go. Languages are learned
    from the labelled rows of the stage's input."""
    found = language.identify(docs, carry=True)
    return found.where("lang_pred != 'und'").select("row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return near_copies.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark items make up less than a twentieth, unchanged."""
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=True)
    return found.where("not contaminated").select("row.*")


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars counts the new text."""
    found = personal_data.find(docs, with_text=True, carry=True)
    row = F.col("row").withField("text", F.col("masked"))
    if "n_chars" in docs.columns:
        length = F.char_length("masked").cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(F.size("found") > 0, length).otherwise(F.col("row.n_chars")))
    return found.select(row.alias("row")).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in which training sequence."""
    return packing.pack(docs)


STAGES = [
    ("language", identified),
    ("near_copies", without_copies),
    ("decontamination", decontaminated),
    ("personal_data", masked),
    ("packing", packed),
]

#: XXH64 fingerprints, learned profiles and best fit have no SQL form; tests hold the stages
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
