"""The corpus pipeline: five of the corpus operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and reads again as the next stage's docs.  All stages but
the last return the columns of their input:

1. language ID: documents without a recognisable language go;
2. n-gram Jaccard join: of each group of near duplicates the smallest doc_id stays;
3. benchmark decontamination: contaminated documents go;
4. secret scans: the secrets in a text are replaced by a mark;
5. SentencePiece: doc_id, number and digest of the ids, digest of the decoded text.

Every stage keeps rows with null or empty texts out of its decisions as its
operator's docstring says; SQL cannot express stages 1 and 4.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recunify.llm import decontam, jaccard, langid, pieces, queries, secret_scan
from recunify.llm.store import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is ``und`` go; learned from the rows that op4 learns from."""
    return langid.keep_known(docs, langid.fit(docs.filter(~langid.held_out(F.col("doc_id"), 5, 0))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard.keep_first(docs, lambda df: stage(df, "pipeline"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages (one word in twenty or more) go."""
    return decontam.keep_clean(docs, queries.table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    return secret_scan.redact(docs, secret_scan.fit(docs))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining text encoded and decoded."""
    return pieces.digest(docs, queries.piece_model())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what each one keeps is written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The trained stages (1 and 4) have no SQL form; tests compare the run with a brute-force version.
ORACLE_SQL = None
