"""Paths as Hadoop's file systems name them, whichever store they are in."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def qualified(spark: SparkSession, path: str) -> str:
    """Scheme, authority and absolute path: missing parts are those of the default file system, a relative
    path lies in the working directory, and ``.`` and ``..`` are resolved."""
    conf = spark._jsc.hadoopConfiguration()
    parsed = _hadoop_path(spark, path)
    default = spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(conf)
    # Only a relative path needs its file system; an absolute one may name a store that isn't reachable.
    working = _hadoop_path(spark, "/") if parsed.isAbsolute() else parsed.getFileSystem(conf).getWorkingDirectory()
    uri = parsed.makeQualified(default, working).toUri().normalize()
    segments = [part for part in uri.getPath().split("/") if part]
    while segments and segments[0] == "..":
        segments.pop(0)
    return "/".join([f"{uri.getScheme()}://{uri.getAuthority() or ''}", *segments])


def exists(spark: SparkSession, path: str) -> bool:
    parsed = _hadoop_path(spark, path)
    return parsed.getFileSystem(spark._jsc.hadoopConfiguration()).exists(parsed)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a directory and all below it; one that isn't there is no error."""
    parsed = _hadoop_path(spark, path)
    parsed.getFileSystem(spark._jsc.hadoopConfiguration()).delete(parsed, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a directory, sorted; none if it isn't there."""
    parsed = _hadoop_path(spark, path)
    files = parsed.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(parsed)) if files.exists(parsed) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's content, read by the driver."""
    parsed = _hadoop_path(spark, path)
    stream = parsed.getFileSystem(spark._jsc.hadoopConfiguration()).open(parsed)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, content: str) -> None:
    """A new small file; its directory is made."""
    parsed = _hadoop_path(spark, path)
    stream = parsed.getFileSystem(spark._jsc.hadoopConfiguration()).create(parsed, False)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file in one step of its file system; fails, and leaves both, if the target is there."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = hadoop.FileContext.getFileContext(_hadoop_path(spark, target).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(_hadoop_path(spark, source), _hadoop_path(spark, target), options)
