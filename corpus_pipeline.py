"""A corpus in stages: each works on the documents its predecessor kept.

Toxic documents go, one document of each near-duplicate group stays, documents with
benchmark passages go, personal data is replaced, and what is left is packed.

All stages but the last return the columns of their documents, extra ones of any name too, and
keep null ids, null and empty texts, and documents without columns that they don't need. An
empty table stays empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantorel.llm import decontaminate, packing, pii, queries, simhash, storage, toxicity


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, fitted on the folder's labels less the held-out fold, scores below the threshold.

    A null or empty text has no terms, and the score of the bias alone; a score at the threshold
    goes. Repeated rows go or stay together. Without labels nothing goes.
    """
    return toxicity.accepted(docs, queries.toxicity_model(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group.

    Null ids come last; of rows with one id the text with the smallest hash stays, and rows equal
    in id and text are one. Null, empty and blank texts are one group, fingerprint zero.
    """
    return simhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the folder's benchmark.

    A null or empty text holds none and stays; repeated rows go or stay together, and without a
    benchmark nothing goes.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars, where there is one, is that of the new text.

    Every row stays; a null text stays null and has no n_chars.
    """
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of full windows of a tempered mixture of sources.

    A null or empty text is its end alone; null sources are one queue, and repeated rows are packed
    like others. Extra columns are not read.
    """
    return packing.pack(docs, queries.tokenizer_path(), temperature=queries.TEMPERATURE)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash", near_duplicates),
    ("decontamination", decontaminated),
    ("pii", without_pii),
    ("packing", packed),
]

#: No SQL expresses the fitted model, the edit-distance search or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, storage.materialize(stage(spark, docs, sf_dir), name)
        storage.drop(before)  # the operators' own tables go with the driver
    return STAGES[-1][1](spark, docs, sf_dir)
