"""Documents to token ids in stages: each reads what its predecessor kept, and writes what it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll import session
from tillroll.llm import bbit, exact, langid, mixing, pieces
from tillroll.llm.tables import read


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or unlike every language, go; the others get ``lang_pred``. Profiles come from ``docs``."""
    return langid.known(docs, langid.train(docs), lang_col="lang_pred")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact.dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near-duplicate texts the one with the smallest doc_id stays."""
    return bbit.dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, of each language in proportion; those it takes no word of go."""
    return mixing.repeated(docs, part_col="lang_pred")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and recognised language of every document, and whether decoding the ids gives the text back."""
    return pieces.round_trip(docs, pieces.read_model(spark), carried=("lang_pred",))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixed),
    ("pieces", tokens),
]

#: Language ID cannot be written in SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written to the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = session.staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
