"""Protobuf-encoded messages without the spark-protobuf module.

The message type is given as a list of ``(name, number, kind)`` fields; the
worker builds the message class once per task from a serialized descriptor
and decodes/encodes whole Arrow batches (``mapInArrow``), so no row crosses
into Python one at a time through the JVM boundary.  Where the spark-protobuf
jar is on the classpath, ``pyspark.sql.protobuf.functions.from_protobuf`` does
the same job natively.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbend.session import ship_package

# The transaction message of the protobuf recipe (all optional).
TRANSACTION_FIELDS = (
    ("t_time", 1, "string"),
    ("t_id", 2, "int64"),
    ("t_customer_id", 3, "int64"),
    ("t_amount", 4, "double"),
)

_PB_TYPES = {"string": 9, "int64": 3, "int32": 5, "double": 1, "float": 2, "bool": 8, "bytes": 12}
_SPARK_TYPES = {"string": T.StringType(), "int64": T.LongType(), "int32": T.IntegerType(),
                "double": T.DoubleType(), "float": T.FloatType(), "bool": T.BooleanType(),
                "bytes": T.BinaryType()}
_ARROW_TYPES = {"string": pa.string(), "int64": pa.int64(), "int32": pa.int32(), "double": pa.float64(),
                "float": pa.float32(), "bool": pa.bool_(), "bytes": pa.binary()}


def descriptor_bytes(message: str, fields: Sequence[tuple[str, int, str]], package: str = "riverbend") -> bytes:
    """Serialized FileDescriptorProto holding one message with optional fields."""
    from google.protobuf import descriptor_pb2

    fdp = descriptor_pb2.FileDescriptorProto(name=f"{package}_{message}.proto", package=package,
                                             syntax="proto2")
    msg = fdp.message_type.add(name=message)
    for name, number, kind in fields:
        msg.field.add(name=name, number=number, type=_PB_TYPES[kind],
                      label=descriptor_pb2.FieldDescriptorProto.LABEL_OPTIONAL)
    return fdp.SerializeToString()


def _message_class(desc: bytes, full_name: str):
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    pool = descriptor_pool.DescriptorPool()
    pool.Add(descriptor_pb2.FileDescriptorProto.FromString(desc))
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(full_name))


def spark_schema(fields: Sequence[tuple[str, int, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, _SPARK_TYPES[k], True) for n, _, k in fields])


def descriptor_set_bytes(message: str, fields: Sequence[tuple[str, int, str]], package: str = "riverbend") -> bytes:
    """The message's file descriptor wrapped in a FileDescriptorSet (what
    ``protoc --descriptor_set_out`` writes and ``from_protobuf`` reads)."""
    from google.protobuf import descriptor_pb2

    fds = descriptor_pb2.FileDescriptorSet()
    fds.file.add().MergeFromString(descriptor_bytes(message, fields, package))
    return fds.SerializeToString()


def _native_decode(df: DataFrame, column: str, message: str, fields, package: str) -> DataFrame:
    """Spark's own ``from_protobuf``: decoding stays in the JVM."""
    from pyspark.sql.protobuf.functions import from_protobuf

    decoded = from_protobuf(df[column], f"{package}.{message}", binaryDescriptorSet=descriptor_set_bytes(message, fields, package))
    return df.select(decoded.alias("__m")).select(*[F.col(f"__m.{n}").alias(n) for n, _, _ in fields])


def decode(df: DataFrame, column: str, message: str, fields: Sequence[tuple[str, int, str]],
           package: str = "riverbend", native: bool = False) -> DataFrame:
    """Binary protobuf messages in ``column`` -> one typed column per field.

    Unset optional fields become NULL; an undecodable message fails the task.
    ``native`` uses ``from_protobuf``, which needs the spark-protobuf module on
    the classpath; without it Arrow batches are decoded in Python workers.
    """
    if native:
        return _native_decode(df, column, message, fields, package)
    ship_package(df.sparkSession)
    desc = descriptor_bytes(message, fields, package)
    full = f"{package}.{message}"
    names = [n for n, _, _ in fields]
    arrow_schema = pa.schema([(n, _ARROW_TYPES[k]) for n, _, k in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls = _message_class(desc, full)
        for batch in batches:
            cols = {n: [] for n in names}
            for raw in batch.column(column).to_pylist():
                m = cls.FromString(raw) if raw is not None else None
                for n in names:
                    cols[n].append(getattr(m, n) if m is not None and m.HasField(n) else None)
            yield pa.RecordBatch.from_pydict(cols, schema=arrow_schema)

    return df.select(column).mapInArrow(run, spark_schema(fields))


def encode(df: DataFrame, message: str, fields: Sequence[tuple[str, int, str]], out: str = "value",
           package: str = "riverbend") -> DataFrame:
    """Columns named like the fields -> one binary column ``out`` per row (NULL -> unset)."""
    ship_package(df.sparkSession)
    desc = descriptor_bytes(message, fields, package)
    full = f"{package}.{message}"
    names = [n for n, _, _ in fields]
    arrow_schema = pa.schema([(out, pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls = _message_class(desc, full)
        for batch in batches:
            data = batch.to_pydict()
            encoded = []
            for i in range(batch.num_rows):
                m = cls()
                for n in names:
                    v = data[n][i]
                    if v is not None:
                        setattr(m, n, v)
                encoded.append(m.SerializeToString())
            yield pa.RecordBatch.from_pydict({out: encoded}, schema=arrow_schema)

    return df.select(*names).mapInArrow(run, T.StructType([T.StructField(out, T.BinaryType(), True)]))
