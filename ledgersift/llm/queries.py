"""The operators' queries: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.llm.alignment import align, score_links
from ledgersift.llm.chat import format_chats, read_back
from ledgersift.llm.common import crc_fold, table
from ledgersift.llm.contamination import find_benchmark
from ledgersift.llm.language import fit, predict
from ledgersift.llm.lines import dedup_lines
from ledgersift.llm.ngrams import near_duplicates
from ledgersift.llm.pieces import decode_pieces, encode_pieces
from ledgersift.llm.prefix_trie import as_rows, prefix_trie, turn_paths, with_shared_openings
from ledgersift.llm.recompress import dedup_passages
from ledgersift.llm.substrings import dedup_substrings
from ledgersift.llm.toxicity import fit as fit_toxicity
from ledgersift.llm.toxicity import score_toxicity
from ledgersift.llm.vectors import dedup_vectors
from ledgersift.llm.wordpiece import token_counts


def digest(column):
    return F.sha2(F.coalesce(column, F.lit("")), 256)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", digest(F.col("text")).alias("kept_sha256"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they give the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = decode_pieces(encode_pieces(docs))
    ids = F.array_join(F.col("piece_ids"), " ")
    return back.select(
        "doc_id",
        F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_pieces"),
        digest(ids).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    return read_back(format_chats(turns.unionByName(own)))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts come back as words joined by one space, also where none is removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_passages(docs).select("doc_id", "n_words", "n_removed", digest(F.col("text")).alias("kept_sha256"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_vectors(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs, crc_fold("doc_id") != 0)
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (crc_fold("doc_id") == 0).alias("held_out"), "lang_pred", "score", F.col("lang_ambiguous").alias("ambiguous"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs).select("doc_id", "n_words", "n_tokens")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    hits = F.col("benchmark_hits")
    return found.select("doc_id", (F.size(hits) > 0).alias("contaminated"), hits["item_id"].alias("item_ids"), hits["distance"].alias("distances"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.size("removed_spans").cast("long")
    return dedup_substrings(docs).select("doc_id", "n_bytes", "n_removed", spans.alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie(as_rows(with_shared_openings(turn_paths(turns))))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), fold != 2)
    return score_toxicity(docs, model).select("doc_id", (fold == 2).alias("held_out"), "score", "predicted")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = F.when(F.col("token_groups") == "", "").otherwise(F.sha2("token_groups", 256))
    aligned = align(docs, ids=False, keep_text=False).withColumn("groups_sha256", groups).drop("token_groups")
    return score_links(aligned).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {
    f.__name__: f
    for f in (op1_line_dedup, op2_sentencepiece, op3_ngram_jaccard, op4_chat_format, op5_substring_dedup, op6_embedding_dedup, op7_language_id, op8_token_counts, op9_decontamination, op10_suffix_dedup, op11_prefix_trie, op12_toxicity, op13_token_alignment)
}
