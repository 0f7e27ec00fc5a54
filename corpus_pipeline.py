"""From raw documents to token files: toxicity, near-dedup, decontamination, mixing, token-ID output.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept; what a stage
returns is written as Parquet in the shared folder and read again by the next. All but the last stage return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabforge.session import stored

# a learned classifier, signatures and a tokenizer cannot be stated in SQL
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    from tabforge.llm.toxicity import accepted

    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    from tabforge.llm.near import without_near_copies

    return without_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark windows, without those words."""
    from tabforge.llm.contamination import decontaminated

    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as they are taken."""
    from tabforge.llm.mixing import mixture

    return mixture(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns what they hold of each document."""
    from tabforge.llm.tokens import token_index

    return token_index(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return stored(STAGES[-1][1](spark, docs, sf_dir))
