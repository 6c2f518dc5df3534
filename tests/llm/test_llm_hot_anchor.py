"""One anchor with more distinct surroundings than a shard holds."""

import random

from pyspark.sql import functions as F

from ledgersift.llm.substrings import by_heat, dedup_substrings
from test_llm_copies import brute_strings, documents


def test_a_hot_anchor_is_not_one_task(spark):
    rng = random.Random(11)
    line = "".join(rng.choice("abcdefghij") for _ in range(30))
    noise = lambda n: "".join(rng.choice("klmnopqrst") for _ in range(n))
    same = noise(25)
    rows = [(i, noise(70) + (same if i % 20 == 0 else "") + line + (noise(6) if i % 3 else "") + noise(70)) for i in range(200)]
    rows += [(300, rows[0][1]), (301, rows[7][1]), (302, None), (303, line * 5)]
    for shard in (1 << 20, 2000):
        found = dedup_substrings(documents(spark, rows), length=40, shard_bytes=shard)
        got = sorted([(r.doc_id, r.n_bytes, r.n_removed, len(r.removed_spans), bytes(r.kept_bytes)) for r in found.collect()], key=str)
        assert got == brute_strings(rows, 40)


def test_no_shard_holds_a_hot_anchor(spark):
    rows = [(1, bytes([k]), 1, bytes(600)) for k in range(100)] + [(2, b"x", 1, bytes(600))]
    parts = spark.createDataFrame(rows, "anchor long, part binary, n long, bytes binary")
    cold, hot = by_heat(parts, 5000)
    assert hot.count() == 100 and [r.anchor for r in cold.select("anchor").collect()] == [2]
    assert (cold.groupBy("anchor").agg(F.sum(F.length("bytes")).alias("size")).agg(F.max("size")).first()[0] or 0) <= 5000
