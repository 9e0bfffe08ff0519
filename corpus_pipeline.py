"""The corpus pipeline: stages that each apply one operator of ``quadrille.llm``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept,
and returns the kept rows with the columns of ``documents``; the last returns
how often the mix takes each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quadrille.llm import toxicity
from quadrille.llm._store import Scratch
from quadrille.llm.decontaminate import drop_contaminated
from quadrille.llm.exact_dedup import drop_exact_duplicates
from quadrille.llm.ngram_join import drop_near_duplicates
from quadrille.llm.queries import toxicity_model
from quadrille.llm.source_mix import mix_sources


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.5 or more go.

    Whole texts of any length are scored.  Null and empty texts have the score of
    no feature at all; rows with a null id are scored and never learned from;
    repeated rows are judged alike; an empty table stays empty.
    """
    return toxicity.drop_toxic(docs, toxicity_model(spark, docs, sf_dir))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest id stays.

    Null counts as empty, null ids sort last, and of rows equal in id and text
    one stays, whatever their other columns hold; an empty table stays empty.
    """
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the row with the smallest id stays.

    Texts without words and rows with a null id link nothing and stay, as do all
    rows that repeat the id that stays; an empty table stays empty.
    """
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more are in benchmark windows go.

    Texts without words stay, and so does everything if the benchmark has no
    words; repeated rows are judged alike; an empty table stays empty.
    """
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document that is left: one row per row.

    Null and empty texts are taken 0 times, null sources are one source, the
    last, and rows repeated with one id are taken by themselves; an empty table
    gives an empty result.
    """
    return mix_sources(docs)


STAGES = [
    ("reject_toxic", reject_toxic),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
]

#: A fitted classifier and rounding by a hash of Spark's are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``, each written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{number}-{name}")
    return docs
