"""Small files next to the tables, on whatever file system Spark uses.

Only pointers and sizes go through here, never rows.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: How a file not yet in place ends.
DRAFT = ".draft"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def is_folder(spark: SparkSession, path: str) -> bool:
    return exists(spark, path) and _fs(spark, path).getFileStatus(_path(spark, path)).isDirectory()


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of the entries of a folder; empty if there is none."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)))


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a path."""
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str, replacing: bool = False) -> bool:
    """Put a whole new file in place; False if someone else did so first.

    The text is written under a name of its own and closed before it gets its final
    name, so no reader ever sees a part of it, and a writer that dies leaves only a
    draft.  ``replacing`` takes the place of a file that is there.
    """
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}{DRAFT}"
    out = _fs(spark, path).create(_path(spark, draft), False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    try:
        return _rename(spark, draft, path, replacing)
    finally:
        if exists(spark, draft):
            delete(spark, draft)


def _rename(spark: SparkSession, old: str, new: str, replacing: bool) -> bool:
    """Rename; without ``replacing`` the file system itself refuses a name that is taken."""
    option = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE if replacing else option.NONE
    target = _path(spark, new)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(_path(spark, old), target, options)
    except Py4JJavaError:
        if not replacing and exists(spark, new):
            return False
        raise
    return True


def delete(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).delete(_path(spark, path), True)
