"""A corpus pipeline: each stage takes documents and gives documents on.

``run`` writes what a stage gives to the shared scratch folder and reads it
again for the next, so that a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.llm.common import crc_fold, kept, table
from ledgersift.llm.contamination import find_benchmark
from ledgersift.llm.language import fit, predict
from ledgersift.llm.lines import dedup_lines
from ledgersift.llm.ngrams import keep_one
from ledgersift.llm.pieces import encode_pieces


def _apart(docs: DataFrame, *used: str) -> DataFrame:
    """The documents with all columns but those a stage works on under names
    that no operator has for its own."""
    return docs.toDF(*[c if c in used else f"__kept_{k}" for k, c in enumerate(docs.columns)])


def _back(left: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    """What a stage leaves, with the columns of the documents and their names."""
    return left.select(*[c if c in used else f"__kept_{k}" for k, c in enumerate(docs.columns)]).toDF(*docs.columns)


# What holds for all stages: a null text is as an empty one; rows without an id
# are documents of their own; of equal rows each is decided by itself, but for
# near copies, of which one stays; an empty table stays empty; columns of any
# name come through as they were.


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told. Those without a letter, and
    those between two languages, go."""
    model = fit(docs.select("doc_id", "text", "lang"), crc_fold("doc_id") != 0)
    told = predict(_apart(docs, "text"), model)
    return _back(told.where((F.col("lang_pred") != "und") & ~F.col("lang_ambiguous")), docs, "text")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; n_chars is that of
    what is left."""
    used = ("doc_id", "text", "n_chars")
    left = dedup_lines(_apart(docs, *used))
    counted = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return _back(left.withColumn("n_chars", counted), docs, *used)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words,
    similarity 0.8 or more."""
    return _back(keep_one(_apart(docs, "doc_id", "text"), width=5, percent=80), docs, "doc_id", "text")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = find_benchmark(_apart(docs, "text"), table(spark, sf_dir, "benchmark"))
    return _back(found.where(F.size("benchmark_hits") == 0), docs, "text")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces, in place of columns of the names
    piece_ids and n_pieces."""
    return encode_pieces(docs).withColumn("n_pieces", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long"))


STAGES = [
    ("language", language),
    ("line_dedup", lines),
    ("ngram_jaccard", near_copies),
    ("decontamination", decontaminate),
    ("sentencepiece", encode),
]

# Language ID and SentencePiece ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
