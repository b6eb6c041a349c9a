"""Tables that change as a whole: numbered versions, committed by putting one small file that must not exist yet.

A version's rows are written to a folder of their own. The version exists from the moment its pointer
file ``<root>/_versions/<number>`` is renamed into place, which the file system refuses if the number is taken.
So readers never see a half-written version, and of two writers that start from one version the second
reads again, applies its change to the newer rows and takes the next number: no change is lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

ATTEMPTS = 20


class Conflict(Exception):
    """The version that was to be written exists already."""


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, root: str):
    return _path(spark, root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed versions, in order."""
    fs, folder = _files(spark, root), _path(spark, f"{root}/_versions")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def _folder(spark: SparkSession, root: str, version: int) -> str:
    stream = _files(spark, root).open(_path(spark, f"{root}/_versions/{version:012d}"))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _put(spark: SparkSession, root: str, version: int, folder: str) -> None:
    """Name ``folder`` as ``version``, or raise ``Conflict``."""
    jvm, fs = spark.sparkContext._jvm, _files(spark, root)
    draft = _path(spark, f"{root}/_drafts/{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(folder.encode())
    out.close()
    fs.mkdirs(_path(spark, f"{root}/_versions"))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(draft, _path(spark, f"{root}/_versions/{version:012d}"), spark.sparkContext._gateway.new_array(kinds, 0))
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise Conflict(f"{root}: version {version} exists") from None
        raise


def read(spark: SparkSession, root: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The newest version, or the one asked for; no rows if there is none yet."""
    known = versions(spark, root)
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{_folder(spark, root, known[-1] if version is None else version)}")


def commit(spark: SparkSession, root: str, schema: StructType, change: Callable[[DataFrame], DataFrame], attempts: int = ATTEMPTS) -> int:
    """Write ``change(newest rows)`` as the next version; after a conflict, once more from what is newest then."""
    for _ in range(attempts):
        known = versions(spark, root)
        newest = known[-1] if known else 0
        folder = f"rows-{uuid.uuid4().hex}"
        change(read(spark, root, schema, newest or None)).select(*schema.names).write.parquet(f"{root}/{folder}")
        try:
            _put(spark, root, newest + 1, folder)
        except Conflict:
            _files(spark, root).delete(_path(spark, f"{root}/{folder}"), True)
            continue
        return newest + 1
    raise Conflict(f"{root}: {attempts} attempts, each overtaken by another writer")


def compact(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` versions and their rows; returns the numbers that went.

    A pointer goes before its rows, so that no version is left without them. Readers that still use an old version
    must be done. Rows and drafts of writers that ended without a commit are left to a retention rule.
    """
    if keep < 1:
        raise ValueError("compact: keep at least one version")
    gone = versions(spark, root)[:-keep]
    fs = _files(spark, root)
    for version in gone:
        folder = _folder(spark, root, version)
        fs.delete(_path(spark, f"{root}/_versions/{version:012d}"), False)
        fs.delete(_path(spark, f"{root}/{folder}"), True)
    return gone
