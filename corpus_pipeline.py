"""The corpus pipeline: documents pass through the stages in order; each writes its result for the next.

quality    documents that the line classifier scores below 0.5 go
language   documents without a letter go, and those whose best language scores below least_score: they are in no language
           that the stage's own input labels
near_dedup of each group of near-duplicates, by 80 % of their shingles, the document of the smallest id stays
pii        personal data is replaced by the name of its kind, and n_chars follows
packing    every document, with its end token, is placed in sequences of at most 2048 tokens

All stages but the last return the columns of documents; other columns, whatever their names, end at the first stage. Each
stage trains or counts on its own input. Defined cases, for every stage: an empty table gives an empty one; nulls in lang,
source, n_chars and doc_id pass; rows that repeat are judged alike, and near_dedup keeps one of them. A null or empty text
is one empty line for quality, has no letter for language, stays once for each id in near_dedup, stays as it is in pii, and
is the end token alone in packing. Texts are read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import language as languages
from tessera.llm import pii as personal
from tessera.llm import quality as qualities
from tessera.llm.common import staged, table
from tessera.llm.minhash import without_near_duplicates
from tessera.llm.packing import pack_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document stays if its best language has at least this part of the way from an even spread over all labels to 1.
LEAST_LANGUAGE = 0.3
#: Near-duplicates share this percentage of their five-word shingles at least.
SIMILAR = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what op9's classifier predicts as 1. Without labels of both kinds every score is 0.5, and all stay."""
    model = qualities.learn(docs, table(spark, sf_dir, "labels"))
    return qualities.score(docs, COLUMNS, model).where("predicted = 1").select(*COLUMNS)


def least_score(languages: int) -> float:
    """The least mean probability that the best of so many languages needs, beside the label for none of them."""
    even = 1 / (languages + 1)
    return even + LEAST_LANGUAGE * (1 - even)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what is in a labelled language. Without labels, keeps every text with a letter."""
    model = languages.learn(docs)
    if model is None:  # no language is known, so none can be told
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    found = languages.predict(docs, COLUMNS, model)
    least = least_score(len(model.languages))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component: of the smallest id, null last, and then by a hash of the text."""
    return without_near_duplicates(docs.select(*COLUMNS), SIMILAR)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every row with spans redacted; overlapping spans become one mark, of the first one's kind."""
    found = personal.redact(docs, ["doc_id", "lang", "source"])
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a piece; equal rows are packed each."""
    return pack_documents(docs)


STAGES = [("quality", quality), ("language", language), ("near_dedup", near_dedup), ("pii", pii), ("packing", packing)]

#: The stages train models, tokenise and link by sketches, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
