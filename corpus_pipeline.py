"""A training corpus from documents: the stages, in order, and their composition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.common import documents, stored
from snapmart.llm.mixing import mixed
from snapmart.llm.packing import pack_documents
from snapmart.llm.pii import redact
from snapmart.llm.quality import keep_good
from snapmart.llm.simhash_dedup import keep_one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.

    A null or empty text has no words and goes; null ids, repeated rows and ties are judged by the
    text alone; other columns, whatever their names, pass through; an empty table stays empty.
    """
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash fingerprints at most 3 bits apart.

    Fingerprints are those of three-word shingles. The document of the smallest id stays (nulls
    last; of equal ids the row with the smaller key; of fully equal rows one). Texts without words,
    null included, share fingerprint zero and are one group; other columns pass through; an empty
    table stays empty.
    """
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind and n_chars, if there, counted anew.

    A null text stays null and has a null count; repeated rows are redacted alike; other columns
    pass through; an empty table stays empty.
    """
    clean = redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them.

    A null source is a source of its own; a text without words has size 0 and comes with the whole
    copies of its source; rows equal in id and text are drawn together; other columns pass through;
    an empty table stays empty.
    """
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its place in a sequence of tokens.

    A null or empty text is one piece with the end token only; copies and repeated rows are packed
    each on its own; columns other than id and text are not kept; an empty table gives no pieces.
    """
    return pack_documents(docs).drop("ids")


#: (name, function of (spark, docs, sf_dir)); each stage works on all that the one before kept.
STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packing", packing),
]

#: Fingerprints, the random field and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
