"""A training corpus from ``documents``: five stages, each over all its predecessor kept.

Every stage takes tables with nulls in any column, empty and very long texts, repeated rows and ids, no rows
at all, and further columns of any name. The first four return the columns they were given, unchanged.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.llm import exact, langid, mixing, simhash
from ringwatch.llm.queries import tokenised
from ringwatch.session import Scratch

#: A language is rejected below this posterior probability.
MIN_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; null texts and texts without letters go.

    Rows are judged one by one, so repeated ones stay or go together. If no labelled text has a letter, all go.
    """
    found, name = langid.identify(docs), langid.language_column(docs)
    known = (F.col(f"{name}.lang") != langid.UNKNOWN) & (F.col(f"{name}.score") >= MIN_LANGUAGE_SCORE)
    return found.filter(known).drop(name)


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id, null ids last; of rows that repeat it exactly one.

    Null texts count as empty ones.
    """
    return exact.drop_exact_duplicates(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of 4-word shingles link at 4 bits: that of the smallest id.

    Null ids come last, of rows that repeat an id one stays. Texts without words are one group.
    """
    return simhash.drop_near_duplicates(docs, shingle=4, bits=4)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order; those without words are never taken.

    A null source is a source. Rows that are equal throughout take each other's places.
    """
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every whole text, and the text decoded from them: ``doc_id, n_tokens, token_ids, decoded``.

    A null text has null ids and 0 of them, an empty one none. Every row has a row.
    """
    return tokenised(docs)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_duplicates),
    ("simhash_dedup", drop_near_duplicates),
    ("mixture", mix_sources),
    ("pieces", encode_pieces),
]

#: Language identification and tokenisation cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; each result is written as Parquet and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
