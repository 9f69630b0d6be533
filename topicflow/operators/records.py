"""Typed records: schemas with defaults, completion, rejected rows, narrower reads.

A record type is a ``StructType``.  A field that has a default carries it in its
metadata under ``default``; a field without one is required.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F, types as T


def field(name: str, data_type: T.DataType, **default) -> T.StructField:
    """``field("salary", IntegerType(), default=100)``; leave the default out for a required field."""
    return T.StructField(name, data_type, nullable=False, metadata=default)


# The record types and their defaults.
PAYMENT = T.StructType(
    [
        field("id", T.StringType()),
        field("name", T.StringType(), default=""),
        field("amount", T.DoubleType(), default=0.0),
        field("profile", T.StringType(), default="developer"),
        field("salary", T.IntegerType(), default=100),
    ]
)
BANK_ACCOUNT = T.StructType(
    [
        field("id", T.IntegerType()),
        field("name", T.StringType(), default=""),
        field("amount", T.DoubleType(), default=0.0),
        field("timestamp", T.LongType()),
    ]
)
FINAL_ACCOUNT = T.StructType(
    [
        field("id", T.IntegerType()),
        field("amount", T.DoubleType()),
        field("timestamp", T.LongType()),
    ]
)
MESSAGE_ENVELOPE = T.StructType(
    [
        field("message", T.StringType()),
        field("message_id", T.StringType()),
        field("group_id", T.StringType()),
        field("custom_headers", T.StringType(), default="{}"),
        field("transaction_id", T.StringType(), default=""),
        field("partition", T.IntegerType()),
    ]
)

# The type promotions a reader schema may ask for.
PROMOTIONS = {
    "int": {"bigint", "float", "double"},
    "bigint": {"float", "double"},
    "float": {"double"},
    "string": {"binary"},
    "binary": {"string"},
}


def _value(df: DataFrame, f: T.StructField) -> Column:
    """The field as written; null where the rows do not have it."""
    return (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType)


def _is_required(f: T.StructField) -> bool:
    return "default" not in f.metadata


def _default(f: T.StructField) -> Column:
    return F.lit(f.metadata["default"]).cast(f.dataType)


def _missing_fields(df: DataFrame, record: T.StructType) -> Column:
    """Names of the required fields that are null in a row."""
    missing = [F.when(_value(df, f).isNull(), F.lit(f.name)) for f in record.fields if _is_required(f)]
    return F.array_compact(F.array(*missing))


def complete_records(df: DataFrame, record: T.StructType, strict: bool = False) -> DataFrame:
    """Fill unset (null or absent) fields with the record type's defaults.

    Rows that lack a required field are left to :func:`rejected_records`, or stop the
    job when ``strict`` is set.  The result has the record's columns in its order.
    """
    columns = []
    for f in record.fields:
        value = _value(df, f)
        if not _is_required(f):
            value = F.coalesce(value, _default(f))
        elif strict:
            value = F.coalesce(value, F.raise_error(F.lit(f"field {f.name} is required")).cast(f.dataType))
        else:
            df = df.where(value.isNotNull())
        columns.append(value.alias(f.name))
    return df.select(columns)


def rejected_records(df: DataFrame, record: T.StructType) -> DataFrame:
    """The rows :func:`complete_records` leaves out, unchanged, with the missing field names."""
    rows = df.withColumn("missing", F.array_join(_missing_fields(df, record), ","))
    return rows.where(F.col("missing") != "")


def project_records(df: DataFrame, reader: T.StructType) -> DataFrame:
    """Read a wider record as ``reader``: fields by name, promoted types, defaults for absent ones.

    A required field that the rows do not have, or a type that cannot be promoted, is an
    error when the plan is built, not when rows arrive.
    """
    columns = []
    for f in reader.fields:
        if f.name not in df.columns:
            if _is_required(f):
                raise ValueError(f"required field {f.name} is not in the written record")
            columns.append(_default(f).alias(f.name))
            continue
        written, wanted = df.schema[f.name].dataType.simpleString(), f.dataType.simpleString()
        if written != wanted and wanted not in PROMOTIONS.get(written, set()):
            raise ValueError(f"field {f.name}: cannot read {written} as {wanted}")
        columns.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(columns)


def avro_schema(record: T.StructType, name: str, namespace: str = "topicflow") -> str:
    """The record type as Avro schema JSON, for ``from_avro`` / ``to_avro``."""
    types = {"string": "string", "int": "int", "bigint": "long", "double": "double", "float": "float", "binary": "bytes"}
    fields = [
        {"name": f.name, "type": types[f.dataType.simpleString()], **f.metadata} for f in record.fields
    ]
    return json.dumps({"type": "record", "namespace": namespace, "name": name, "fields": fields})


def decode_avro(df: DataFrame, reader: T.StructType, name: str, value: str = "value", header_bytes: int = 0) -> DataFrame:
    """Replace an Avro-encoded column by the reader record's fields.

    ``header_bytes`` skips a schema-id header in front of the payload (5 bytes where a
    schema registry is used).  Needs the ``spark-avro`` package on the cluster.
    """
    from pyspark.sql.avro.functions import from_avro

    payload = F.col(value) if not header_bytes else F.substring(F.col(value), header_bytes + 1, 2**31 - 1)
    others = [c for c in df.columns if c != value]
    decoded = from_avro(payload, avro_schema(reader, name))
    return df.select(*others, decoded.alias("_record")).select(*others, "_record.*")


def encode_avro(df: DataFrame, record: T.StructType, name: str, value: str = "value") -> DataFrame:
    """Pack the record's columns into one Avro-encoded column.  Needs ``spark-avro``."""
    from pyspark.sql.avro.functions import to_avro

    packed = to_avro(F.struct(*record.fieldNames()), avro_schema(record, name))
    others = [c for c in df.columns if c not in record.fieldNames()]
    return df.select(*others, packed.alias(value))
