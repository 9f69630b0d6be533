"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from topicflow.session import work_dir

T = TypeVar("T")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows of ``df``, stored in the shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read, not a re-run, and every later use
    reads what was computed once.
    """
    path = work_dir(df.sparkSession, f"llm-{name}")
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def shared(spark: SparkSession, value: T) -> Callable[[], T]:
    """A function for tasks that gives ``value``, sent to each executor once and unpacked once per Python worker.

    It is sent as ``cloudpickle`` packs it, with the classes of this subpackage, so executors need no copy of them.
    """
    sent = spark.sparkContext.broadcast({"packed": cloudpickle.dumps(value)})

    def get() -> T:
        held = sent.value
        if "value" not in held:
            held["value"] = cloudpickle.loads(held.pop("packed"))
        return held["value"]

    return get


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return stem if stem.lower() not in taken else f"{stem}_{uuid.uuid4().hex}"


def utf8(text: str | Column) -> Column:
    """The bytes of a text; those of the empty text for null."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("binary"), F.lit(b""))


def by_batch(
    df: DataFrame, rows: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """Apply ``rows`` to each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield rows(batch)

    return df.mapInArrow(run, schema)
