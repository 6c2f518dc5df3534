"""The pipeline on tables with clashing columns, missing ids, and none at all."""

import shutil

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgersift.llm.contamination import find_benchmark

CLASHING = {"score": 42.0, "n_lines": -1, "n_dropped": -2, "lang_pred": "xx", "_drop": "d", "_mark": "m", "spans": "s", "benchmark_hits": 7, "_id": "i"}


@pytest.fixture(scope="module")
def folders(spark, sf, tmp_path_factory):
    made = {}
    docs = spark.read.parquet(f"{sf['sf0.001']}/documents.parquet")
    odd = docs.withColumns({n: F.lit(v) for n, v in CLASHING.items()})
    for name, table in (("plain", docs), ("clashing", odd), ("empty", odd.limit(0))):
        root = tmp_path_factory.mktemp(name)
        table.write.parquet(f"{root}/documents.parquet")
        shutil.copy(f"{sf['sf0.001']}/benchmark.parquet", root)
        made[name] = str(root)
    return made


def test_columns_of_any_name_come_through(spark, folders):
    plain = corpus_pipeline.run(spark, folders["plain"]).collect()
    found = corpus_pipeline.run(spark, folders["clashing"]).collect()
    assert sorted((r.doc_id, r.text, r.n_pieces) for r in found) == sorted((r.doc_id, r.text, r.n_pieces) for r in plain)
    assert 100 < len(plain) < 200
    assert all(r[n] == v for r in found for n, v in CLASHING.items())


def test_what_is_left_holds_no_benchmark_item(spark, folders, sf):
    left = corpus_pipeline.run(spark, folders["plain"]).select("doc_id", "text", "n_chars", "piece_ids", "n_pieces")
    found = find_benchmark(left, spark.read.parquet(f"{sf['sf0.001']}/benchmark.parquet"))
    assert found.where(F.size("benchmark_hits") > 0).count() == 0
    assert left.where((F.length("text") != F.col("n_chars")) | (F.size("piece_ids") != F.col("n_pieces"))).count() == 0


def test_an_empty_table_stays_empty(spark, folders):
    assert corpus_pipeline.run(spark, folders["empty"]).collect() == []
