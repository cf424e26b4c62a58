"""A corpus pipeline: each stage reads what the one before has written.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from courierlake.llm.common import clear_stored, stored, stored_so_far, table
from courierlake.llm.exact_dedup import keep_distinct
from courierlake.llm.ngram_join import keep_one_of_each
from courierlake.llm.packing import pack
from courierlake.llm.quality import keep_good
from courierlake.llm.secret_scan import mask_secrets


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is not predicted to be bad.

    Null text is judged as empty text; rows that repeat a text share its fate; labels of ids that are not
    there, and null labels, teach nothing; without labels of both kinds every score is the share of good ones,
    0.5 without any.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest original, then the smallest id, null last.

    Null and empty texts are one group; of rows that repeat id and text one stays.
    """
    return keep_distinct(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shared shingles link: the smallest id, null last, then the smallest
    SHA-256 of the text.

    Null, empty and blank texts have no shingles and stay, as far as the stage before has left them.
    """
    return keep_one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked and ``n_chars`` brought in line.

    Rows without a secret, null texts included, stay exactly as they are, repeated ones too.
    """
    return mask_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences.

    Null and empty texts are one piece of the end id; repeated rows are packed once each; null ids pass
    through. Without documents there is no piece.
    """
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: A classifier and a linear program are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from ``documents`` on; each result is written and read again.

    When a stage is written, what it has read and what it stored on the way is deleted.
    """
    docs, mark = table(spark, sf_dir, "documents"), stored_so_far()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        clear_stored(spark, since=mark, keep_last=True)
    return docs
