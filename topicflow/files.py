"""Small files in the shared folder: records that a job keeps beside its tables.

Everything goes through Hadoop's file systems, so a folder may be in any store that Spark reads.
A record appears whole or not at all: it is written under another name and renamed.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, hidden names left out; nothing if there is no such folder."""
    where, fs = _place(spark, folder)
    if not fs.exists(where):
        return []
    found = [status.getPath().getName() for status in fs.listStatus(where)]
    return sorted(name for name in found if not name.startswith((".", "_")))


def write_record(spark: SparkSession, path: str, record: Any) -> None:
    """Put a JSON record at ``path``, in place of what is there."""
    where, fs = _place(spark, path)
    fs.mkdirs(where.getParent())
    hidden = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{uuid.uuid4().hex}")
    out = fs.create(hidden, True)
    try:
        out.write(json.dumps(record).encode())
    finally:
        out.close()
    replace = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(replace, 1)
    options[0] = replace.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext
    context.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(hidden), fs.makeQualified(where), options
    )


def read_record(spark: SparkSession, path: str) -> Any:
    """The record at ``path``, or ``None`` if there is none."""
    where, fs = _place(spark, path)
    if not fs.exists(where):
        return None
    found = fs.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(found, "UTF-8"))
    finally:
        found.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds; nothing happens if it is not there."""
    where, fs = _place(spark, path)
    fs.delete(where, True)
