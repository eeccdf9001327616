"""Appending columns computed per Arrow batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.session import ship_package

_ARROW = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(), T.BooleanType(): pa.bool_(), T.BinaryType(): pa.binary()}


def append(df: DataFrame, fields: list[T.StructField], compute: Callable[[pa.RecordBatch], list]) -> DataFrame:
    """``df`` with ``fields`` after its columns; ``compute`` gives a list of values for each field.

    A column of ``df`` named like a new field is replaced by it.
    """
    ship_package(df.sparkSession)
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in {f.name.lower() for f in fields}])
    kinds = [_arrow_type(f.dataType) for f in fields]
    names = [*kept.columns, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(compute(batch), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names)

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *fields]))


def rows(df: DataFrame, schema: T.StructType, produce: Callable[[pa.RecordBatch], Iterator[dict]]) -> DataFrame:
    """Rows made from each batch: ``produce`` yields columns (name to list or array) of any common length."""
    ship_package(df.sparkSession)
    kinds = {f.name: _arrow_type(f.dataType) for f in schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in produce(batch):
                yield pa.RecordBatch.from_arrays([part[n] if isinstance(part[n], pa.Array) else pa.array(part[n], k) for n, k in kinds.items()], list(kinds))

    return df.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, _arrow_type(f.dataType)) for f in kind.fields])
    return _ARROW[kind]


def pick(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
