"""A training-corpus pipeline: toxicity, near-duplicates, contamination, personal data, packing.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the
columns of documents. ``run`` writes each stage's result to the shared folder and reads it back as
the next one's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bagminhash, decontaminate, packing, pii, toxicity
from martloom.llm.common import ready, table
from martloom.llm.queries import WORD_MODEL
from martloom.session import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject."""
    ready(spark)
    model = toxicity.fit(toxicity.labelled_sample(docs, table(spark, sf_dir, "labels")))
    return toxicity.score_toxicity(docs, model).where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    ready(spark)
    return bagminhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    ready(spark)
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found).where("NOT contaminated").select("row.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and ``n_chars`` (where it is a column)
    brought up to date. Documents without personal data are as they were."""
    ready(spark)
    found = pii.find_pii(docs, pii.fit(docs))
    hit = F.size("spans") > 0
    text = F.when(hit, pii.redact(F.col("text"), F.col("spans"))).otherwise(F.col("row.text"))
    found = found.withColumn("new_text", text)
    columns = []
    for name in docs.columns:
        old = F.col(f"row.`{name}`")
        if name == "text":
            old = F.col("new_text")
        elif name == "n_chars":
            size = F.length("new_text").cast(docs.schema[name].dataType)
            old = F.when(hit, size).otherwise(old)
        columns.append(old.alias(name))
    return found.select(*columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces and their places in sequences of 2048."""
    ready(spark)
    return packing.pack(docs, public_tokenizers.path(WORD_MODEL))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

# The classifiers, the signatures and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
