"""Small files on whatever file system the tables live on, through Hadoop's client."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    context, uri = jvm.org.apache.hadoop.fs.FileContext, target.toUri()
    return (context.getFileContext(uri, conf) if uri.getScheme() else context.getFileContext(conf)), target


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder; none where it does not exist."""
    files, target = _opened(spark, folder)
    if not files.util().exists(target):
        return []
    return [status.getPath().getName() for status in files.util().listStatus(target)]


def read(spark: SparkSession, path: str) -> str:
    files, target = _opened(spark, path)
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    files, target = _opened(spark, path)
    files.delete(target, True)


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file whole; false, and nothing changed, where it exists already.

    It is written under another name, then renamed. HDFS and local file systems refuse to
    rename onto an existing file; an object store needs a committer that does.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs = jvm.org.apache.hadoop.fs
    files, target = _opened(spark, path)
    folder, _, _ = path.rpartition("/")
    draft = fs.Path(f"{folder}/.draft-{uuid4().hex}")
    create_parent = gateway.new_array(fs.Options.CreateOpts, 1)
    create_parent[0] = fs.Options.CreateOpts.createParent()
    stream = files.create(draft, jvm.java.util.EnumSet.of(fs.CreateFlag.CREATE), create_parent)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    refuse = gateway.new_array(fs.Options.Rename, 1)
    refuse[0] = getattr(fs.Options.Rename, "NONE")
    try:
        files.rename(draft, target, refuse)
    except Exception:
        files.delete(draft, False)
        if files.util().exists(target):
            return False
        raise
    return True
