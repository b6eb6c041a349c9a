"""Files of the cluster's file system by name: joining sorted parts, moving a folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

_COPY_BYTES = 1 << 20


def path_of(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return path_of(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """Non-empty part files of a written folder, in the order of their names."""
    found = [s for s in file_system(spark, folder).listStatus(path_of(spark, folder)) if s.getPath().getName().startswith("part-")]
    return sorted(s.getPath().toString() for s in found if s.getLen() > 0)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file or folder another name, instead of what is there; the data stays where it is if the store can rename."""
    fs, to = file_system(spark, target), path_of(spark, target)
    fs.delete(to, True)
    fs.mkdirs(to.getParent())
    if not fs.rename(path_of(spark, source), to):
        raise OSError(f"cannot rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(path_of(spark, path), True)


def join_parts(spark: SparkSession, head: str, parts: list[str], target: str) -> None:
    """One file of a first line and the bytes of ``parts`` in order; the parts go.

    A store that can join files does so without copying. Elsewhere the bytes are streamed from file to
    file, one buffer at a time.
    """
    jvm, fs, to = spark.sparkContext._jvm, file_system(spark, target), path_of(spark, target)
    able = fs.hasPathCapability(to, "fs.capability.paths.concat")
    out = fs.create(to, True)
    try:
        out.write(head.encode())
        for part in () if able else parts:
            source = fs.open(path_of(spark, part))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, _COPY_BYTES, False)
            finally:
                source.close()
    finally:
        out.close()
    if able and parts:
        sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
        for k, part in enumerate(parts):
            sources[k] = path_of(spark, part)
        fs.concat(to, sources)
        return
    for part in parts:
        remove(spark, part)
