"""A Parquet table kept in versions, of which readers see one at a time.

Every write makes a new folder ``v-<number>-<unique>`` below the table's root
and then, in one step, a marker ``_versions/<number>`` that names it. Nothing is
renamed, and the folder a reader has planned on stays for ``keep`` more
versions: readers see the old rows or the new ones, on a file system and on an
object store alike. Of two writers that start from the same version one fails,
since a marker is only ever created.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

MARKERS = "_versions"


class VersionConflict(RuntimeError):
    """Another writer has published since this one looked."""


@dataclass(frozen=True)
class Version:
    number: int
    path: str


def _files(spark: SparkSession, root: str):
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(conf), path


def _markers(spark: SparkSession, root: str) -> list:
    files, path = _files(spark, root)
    folder = path(f"{root.rstrip('/')}/{MARKERS}")
    found = files.listStatus(folder) if files.exists(folder) else []
    return sorted((s for s in found if s.getPath().getName().isdigit()), key=lambda s: -int(s.getPath().getName()))


def versions(spark: SparkSession, root: str) -> list[Version]:
    """What has been published and not yet cleared away, newest first. A marker
    without a name in it is one that its writer has not finished."""
    files, _ = _files(spark, root)
    found = []
    for status in _markers(spark, root):
        if status.getLen() > 0:
            stream = files.open(status.getPath())
            try:
                folder = bytes(stream.readNBytes(4096)).decode()
            finally:
                stream.close()
            found.append(Version(int(status.getPath().getName()), f"{root.rstrip('/')}/{folder}"))
    return found


def _last(spark: SparkSession, root: str) -> int:
    """The highest number a writer has claimed, finished or not."""
    return max((int(s.getPath().getName()) for s in _markers(spark, root)), default=0)


def current(spark: SparkSession, root: str) -> Version | None:
    return next(iter(versions(spark, root)), None)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The newest version's rows."""
    version = current(spark, root)
    if version is None:
        raise FileNotFoundError(f"{root} has no version yet")
    return spark.read.parquet(version.path)


def publish(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    keep: int = 2,
    after: Version | None | str = "current",
    write: Callable[[DataFrame, str], None] | None = None,
    accept: Callable[[], bool] | None = None,
) -> Version | None:
    """Write ``df`` as the next version of the table at ``root``.

    ``after`` is the version the rows were made from, for writers that merge
    into it (None: there was none); if another one has been published since,
    ``VersionConflict`` is raised and nothing changes. A write that fails leaves
    the table as it was. ``write`` replaces the plain Parquet writer;
    ``accept`` is asked before the version is published. Of the versions before the new one ``keep`` stay.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    files, path = _files(spark, root)
    before = current(spark, root) if after == "current" else after
    number = 1 + _last(spark, root)
    folder = f"v-{number:012d}-{uuid.uuid4().hex}"
    new, marker = path(f"{root}/{folder}"), path(f"{root}/{MARKERS}/{number:012d}")
    try:
        if write:
            write(df, f"{root}/{folder}")
        else:
            writer = df.write
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{root}/{folder}")
        if accept and not accept():
            files.delete(new, True)
            return None
        if current(spark, root) != before:
            raise VersionConflict(f"{root} is at {current(spark, root)}, expected {before}")
        _mark(files, marker, folder)
        if _last(spark, root) > number:
            files.delete(marker, False)
            raise VersionConflict(f"{root}: a later version than {number} was published meanwhile")
    except Exception:
        files.delete(new, True)
        raise
    for old in versions(spark, root)[keep + 1 :]:
        # The marker goes first, so that no reader is sent to a folder half gone.
        files.delete(path(f"{root}/{MARKERS}/{old.number:012d}"), False)
        files.delete(path(old.path), True)
    return Version(number, f"{root}/{folder}")


def _mark(files, marker, folder: str) -> None:
    try:
        stream = files.create(marker, False)
    except Exception as error:  # a Java exception of the file system in use
        if files.exists(marker):
            raise VersionConflict(f"{marker.toString()} exists") from error
        raise
    try:
        stream.write(bytearray(folder.encode()))
    finally:
        stream.close()
