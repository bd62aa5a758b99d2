"""The corpus pipeline: documents in, token ids out.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of documents.

In every stage a null text is a text without words, a null id an id like others
unless said otherwise, repeated rows are rows of their own unless said otherwise,
an empty table gives an empty table, and columns beside those that a stage needs
are carried along under their names, whatever these are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from celloom.llm.common import landed, table
from celloom.llm.jaccard import kept_of_each
from celloom.llm.mixing import mixed
from celloom.llm.secrets import without_secrets
from celloom.llm.sentencepiece import round_trip
from celloom.llm.toxicity import not_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, fitted on the labels, predicts toxic go.

    Null and empty texts are scored by the bias alone and stay unless most labels are toxic;
    equal texts have equal scores. Without labels nothing goes.
    """
    return not_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones stays: the one with the smallest id.

    A null id comes after all others. Of repeated rows one stays; texts without
    words, null ones too, link with nothing and all stay.
    """
    return kept_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with its secrets masked; n_chars follows. A null text stays null."""
    return without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights take them, cut where a share ends.

    A null source is a source, the last. Null texts and those without words have
    nothing to take and go. n_chars follows the cut.
    """
    return mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the digest of what they decode to; a null or empty text has none."""
    return round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("secret_scans", mask_secrets),
    ("mixing_sources", mix_sources),
    ("sentencepiece", encode),
]

#: The toxicity machine and the lattice cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = landed(docs, name)
    return docs
