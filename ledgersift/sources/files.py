"""Choosing input files by name."""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def qualified(spark: SparkSession, root: str) -> str:
    """The folder as Spark names the files in it: with scheme, without an end slash."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(conf).makeQualified(path).toString().rstrip("/")


def list_entries(spark: SparkSession, root: str, suffix: str | None = ".txt") -> DataFrame:
    """One row per entry directly below ``root``: ``name``, ``path``.

    An entry is a file, or a folder of part files that stands for one
    (as Spark and Hadoop jobs write them). Only file names are read: the
    scan asks for the path column, so no content is opened.
    """
    root = qualified(spark, root)
    below = F.lit(len(root) + 2)
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", F.substring_index(F.substr(F.col("path"), below), "/", 1).alias("name"))
    )
    outside = F.raise_error(F.concat(F.lit(f"not below {root}: "), F.col("path")))
    named = listed.select(F.when(F.col("path").startswith(root + "/"), F.col("name")).otherwise(outside).alias("name"))
    if suffix:
        named = named.filter(F.col("name").endswith(suffix))
    return named.distinct().withColumn("path", F.concat(F.lit(root + "/"), F.col("name")))


def select_files(
    spark: SparkSession, root: str, limit: str | int = "latest", suffix: str | None = ".txt"
) -> list[str]:
    """Paths of the entries to read, in name order.

    ``"all"`` (or an empty text) takes every entry, as one pattern, ``"latest"`` the one
    with the greatest name, a number the first so many by name; a number
    above the total takes all of them and 0 takes none. Spark sorts and
    cuts the listing; only the chosen names reach the driver, which needs
    them to plan the scan.
    """
    text = str(limit)
    entries = list_entries(spark, root, suffix)
    if text in ("all", ""):
        return [] if entries.isEmpty() else [f"{qualified(spark, root)}/*{suffix or ''}"]
    if text == "latest":
        chosen = entries.orderBy(F.col("name").desc()).limit(1)
    elif re.fullmatch("[0-9]+", text):
        chosen = entries.orderBy("name").limit(int(text))
    else:
        raise ValueError(f"unknown file limit: {text!r}")
    return sorted(row.path for row in chosen.select("path").collect())


def total_bytes(spark: SparkSession, paths: str | Sequence[str]) -> int:
    """Size of the files, from their listing alone."""
    wanted = [paths] if isinstance(paths, str) else list(paths)
    if not wanted:
        return 0
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(wanted)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
