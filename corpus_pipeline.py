"""A corpus from raw documents: filter, deduplicate, mix, pack.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import exact_dedup, mixing, ngram_join, packing, quality
from strata.llm.common import quoted, ship, table
from strata.llm.tokens import vocabulary_path
from strata.session import cut_lineage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labels of these documents, doesn't reject.

    Null and empty texts are scored like others; repeated rows share their score and so their fate; whole texts
    of any length count; an empty table gives no rows; other columns may have any names and pass unchanged.
    """
    ship(spark)
    labels = quality.training_labels(table(spark, sf_dir, "labels"))
    name = "score"
    while name in docs.columns:
        name += "_"
    scored = quality.score(docs, quality.fit(docs, labels, "quality"), name=name)
    return scored.where(F.col(name) >= quality.THRESHOLD).select(*[quoted(c) for c in docs.columns])


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the largest id of each group of equal texts (A-Z lower-cased).

    Null and empty texts are one group; of rows that repeat text and id the first by its JSON text stays; a null
    id is below every id; long texts count whole; an empty table gives no rows; other columns may have any names.
    """
    ship(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each class of near duplicates (five words, Jaccard 0.8 or more).

    Null, empty and wordless texts are one class; a null id is below every id; of rows that repeat id and text the
    first by its JSON text stays; long texts count whole; an empty table gives no rows; any column names.
    """
    ship(spark)
    return ngram_join.drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, the row at a source's cut with its first words.

    Texts without words (null, empty) are not taken; a null source is a source, the last; ties and repeated rows go by
    the hash of their id; long texts count whole; an empty table gives no rows; other columns may have any names.
    """
    ship(spark)
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Null and empty texts are their end id alone; repeated rows and null ids are documents of their own; long texts are cut
    into pieces, none is lost; an empty table gives no rows; other columns are not read.
    """
    ship(spark)
    return packing.pack(docs, vocabulary_path("word_bpe_49k.json"), end=1)


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("packing", pack),
]

#: A trained classifier and Jaccard classes have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, on the documents of ``sf_dir``."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), "stage-" + "".join(c if c.isalnum() else "-" for c in name))
    return STAGES[-1][1](spark, docs, sf_dir)
