"""Text parsed once: a typed copy in shared storage that many reads share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_dir
from .transactions import TRANSACTION_COLUMNS, read_transactions

FILE, TEXT = "__file", "__text"


@dataclass(frozen=True)
class TypedCopy:
    """``rows``: all lines as transactions, unreadable values NULL. ``rejects``:
    ``file`` and ``line`` of those in which something could not be read."""

    rows: DataFrame
    rejects: DataFrame
    path: str

    @property
    def readable(self) -> DataFrame:
        """Rows of lines without a reject; with these every line is once."""
        return self.whole.filter(F.col(TEXT).isNull()).select(*TRANSACTION_COLUMNS)

    @property
    def whole(self) -> DataFrame:
        return self.rows.sparkSession.read.parquet(self.path)


@contextmanager
def typed_copy(spark: SparkSession, paths: str | Sequence[str], ntz: bool = False, path: str | None = None) -> Iterator[TypedCopy]:
    """The lines at ``paths``, parsed once and written with their types, the
    text of unreadable lines and the file each came from.

    The copy lies in the scratch folder, where executors that join or are lost
    do not matter, and goes at the end of the block; with ``path`` it lies
    there and stays. Reports over it read only the columns they need.
    """
    root = path or scratch_dir(spark, "typed")
    lines = read_transactions(spark, paths, ntz=ntz, corrupt_column=TEXT, file_column=FILE)
    if TEXT not in lines.columns:  # no paths
        lines = lines.withColumns({TEXT: F.lit(None).cast("string"), FILE: F.lit(None).cast("string")})
    lines.write.parquet(root)
    copy = spark.read.schema(lines.schema).parquet(root)
    rejects = copy.filter(F.col(TEXT).isNotNull()).select(F.col(FILE).alias("file"), F.col(TEXT).alias("line"))
    try:
        yield TypedCopy(copy.select(*TRANSACTION_COLUMNS), rejects, root)
    finally:
        if path is None:
            folder = spark._jvm.org.apache.hadoop.fs.Path(root)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
