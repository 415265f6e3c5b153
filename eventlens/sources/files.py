"""Small files and folder names on any file system that Spark knows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(sc._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, in order; nothing if there is no folder."""
    where, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    where, fs = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a whole file that is not there yet: false, and no change, if it is.

    The text goes to a file beside it first, which is then renamed, so that nobody reads a part.
    """
    where, fs = _at(spark, path)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    if fs.exists(where):
        return False
    beside = jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}-{jvm.java.util.UUID.randomUUID()}")
    out = fs.create(beside, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(where), options)
    except Exception as failed:
        fs.delete(beside, False)
        if "FileAlreadyExists" in str(failed):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    where, fs = _at(spark, path)
    fs.delete(where, True)
