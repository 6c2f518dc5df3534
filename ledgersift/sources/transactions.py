"""The transaction table: headerless delimited text in, Parquet out."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import TIMESTAMP_FORMAT, quoted
from .versions import publish

# Column order and names of the text files.
TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("tx_datetime", T.TimestampType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("terminal_id", T.LongType()),
        T.StructField("tx_amount", T.DoubleType()),
        T.StructField("tx_time_seconds", T.LongType()),
        T.StructField("tx_time_days", T.IntegerType()),
        T.StructField("tx_fraud", T.IntegerType()),
        T.StructField("tx_fraud_scenario", T.IntegerType()),
    ]
)
TRANSACTION_COLUMNS = TRANSACTION_SCHEMA.names
LINE = "__line"


def transaction_schema(ntz: bool = False) -> T.StructType:
    """The declared schema; ``ntz`` keeps event times free of a zone."""
    if not ntz:
        return TRANSACTION_SCHEMA
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampNTZType() if f.name == "tx_datetime" else f.dataType)
            for f in TRANSACTION_SCHEMA
        ]
    )


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """New names for all columns, by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns cannot take {len(names)} names")
    return df.toDF(*names)


def read_transactions(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    infer: bool = False,
    ntz: bool = False,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
    file_column: str | None = None,
) -> DataFrame:
    """Transactions from one path, a glob or a list of paths.

    The types are declared, which saves the pass over the data that
    inference costs; ``infer=True`` brings that pass back. Values are read
    as inference would: times also with a fraction, a ``T`` or without a time
    of day, whole numbers also with a point. A table of another number of
    columns raises. A line with a value that cannot be read, or with another
    number of columns, has NULL for what is unreadable; ``corrupt_column``
    keeps its text, and ``mode="FAILFAST"`` stops the job. ``file_column`` names
    the file each line came from. An empty list gives an empty table.
    """
    schema = transaction_schema(ntz)
    wanted = [paths] if isinstance(paths, str) else list(paths)
    if not wanted:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("header", False).option("comment", "#")
    if infer:
        inferred = reader.option("mode", mode).option("inferSchema", True).csv(wanted)
        return rename_positional(inferred, TRANSACTION_COLUMNS)
    first = reader.csv(wanted).columns  # of the first line
    if first and len(first) != len(schema):
        raise ValueError(f"{len(first)} columns cannot take {len(schema)} names")
    texts = T.StructType([*[T.StructField(n, T.StringType()) for n in schema.names], T.StructField(LINE, T.StringType())])
    lines = reader.option("columnNameOfCorruptRecord", LINE).schema(texts).csv(wanted)
    fits = quoted(LINE).isNull()
    values = {f.name: F.when(fits, _value(quoted(f.name), f.dataType)) for f in schema}
    bad = ~fits
    source = [F.col("_metadata.file_path").alias(file_column)] if file_column else []
    for name, value in values.items():
        bad = bad | (quoted(name).isNotNull() & value.isNull())
    text = F.coalesce(quoted(LINE), F.to_csv(F.struct(*[quoted(n) for n in schema.names])))
    read = lines.select(*[v.alias(n) for n, v in values.items()], F.when(bad, text).alias(corrupt_column or LINE), *source)
    if mode == "FAILFAST":
        said = F.concat(F.lit("malformed line: "), quoted(corrupt_column or LINE))
        read = read.filter(F.when(quoted(corrupt_column or LINE).isNull(), True).otherwise(F.raise_error(said).cast("boolean")))
    return read if corrupt_column else read.drop(LINE)


def _value(text: Column, dtype: T.DataType) -> Column:
    """A field's value, NULL where it cannot be read."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT)).try_cast(dtype), text.try_cast(dtype))
    if isinstance(dtype, T.IntegralType):
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast(dtype))
        return F.coalesce(text.try_cast(dtype), whole)
    return text.try_cast(dtype)


def default_output(input_path: str) -> str:
    return input_path + ".parquet"


def write_clean(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    versioned: bool = False,
    accept: Callable[[], bool] | None = None,
) -> bool:
    """Parquet in place of what ``path`` held.

    The files are written beside it and moved when all are there, so that a
    failed run leaves the earlier ones. With ``partition_by`` the rows are
    rebalanced on those columns first: adaptive execution then joins small
    partitions and splits large ones, so a day holding a third of the rows is
    written by many tasks.

    ``versioned`` writes the next version of a table at ``path`` instead, see
    ``sources/versions.py``: nothing is deleted or moved, so that a reader
    through ``read_current`` sees the old rows or the new ones.

    ``accept`` is asked when the rows are written and not yet in place, say for
    what was counted on the way; if it says no, or raises, all stays as it was.
    Returns whether the rows are in place.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if versioned:
        return publish(df, path, partition_by, accept=accept) is not None
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    new, old = jvm.org.apache.hadoop.fs.Path(beside), jvm.org.apache.hadoop.fs.Path(path)
    files = new.getFileSystem(conf)
    try:
        writer.parquet(beside)
        if accept and not accept():
            files.delete(new, True)
            return False
        files.delete(old, True)
        if not files.rename(new, old):
            raise OSError(f"{beside} could not be moved to {path}")
        return True
    except Exception:
        if files.exists(old):
            files.delete(new, True)
        raise
