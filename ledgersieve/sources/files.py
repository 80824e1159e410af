"""Small steps on the shared file system that have to be all or nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Taken(RuntimeError):
    """The name is in use already."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where there is no such folder."""
    if not exists(spark, folder):
        return []
    return sorted(s.getPath().getName() for s in _file_system(spark, folder).listStatus(_path(spark, folder)))


def delete(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)


def _rename(spark: SparkSession, source: str, target: str, option: str) -> None:
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(_file_system(spark, target).getUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = getattr(kind, option)
    context.rename(_path(spark, source), _path(spark, target), options)


def publish(spark: SparkSession, source: str, target: str) -> None:
    """Give a finished folder its name in one step. Of two that want the same name, the second is refused."""
    parent = target.rsplit("/", 1)[0]
    _file_system(spark, parent).mkdirs(_path(spark, parent))
    try:
        _rename(spark, source, target, "NONE")
    except Exception as error:
        if exists(spark, target):
            raise Taken(target) from error
        raise


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is none."""
    if not exists(spark, path):
        return None
    stream = _file_system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Readers see the old text or the new one, never a part."""
    draft = f"{path}-{uuid.uuid4().hex}"
    stream = _file_system(spark, draft).create(_path(spark, draft), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    _rename(spark, draft, path, "OVERWRITE")
