"""Adding computed columns to rows, batch by batch, in Arrow."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_BYTES = 6 << 20  # of text held as Python objects at a time


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(offset, length) pieces of a string column with about ``most`` bytes each, at least one row."""
    if len(column) == 0:
        return
    if column.nbytes <= most:
        yield 0, len(column)
        return
    step = max(1, len(column) * most // (2 * column.nbytes))
    for at in range(0, len(column), step):
        yield at, min(step, len(column) - at)


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame without the columns that a result is about to replace."""
    gone = {n.lower() for n in names}
    return df.select(*(f"`{c}`" for c in df.columns if c.lower() not in gone))


def packed(names: Sequence[str]) -> Column:
    """Carried columns as one, so that no name of theirs meets a name used inside an operator."""
    fields = [F.col(f"`{c}`").alias(c) for c in names]
    return (F.struct(*fields) if fields else F.lit(None).cast("boolean")).alias("_carried")


def unpacked(names: Sequence[str]) -> list[Column]:
    return [F.col("_carried").getField(c).alias(c) for c in names]


def add_columns(
    df: DataFrame,
    fields: T.StructType,
    compute: Callable[[list, int], list[pa.Array]],
    text: str = "text",
    start: Callable[[], None] | None = None,
) -> DataFrame:
    """All columns of ``df`` and the computed ones, which replace columns of the same name.

    ``compute`` takes the values of column ``text`` (nulls included) of some rows and returns one Arrow
    array per field. Rows keep their order and stay in their partitions.
    """
    kept = without(df, [f.name for f in fields if f.name.lower() != text.lower()])
    schema = T.StructType([*kept.schema.fields, *fields.fields])
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for at, n in slices(column):
                part = batch.slice(at, n)
                made = compute(column.slice(at, n).to_pylist())
                made = [a if a.type == f.type else a.cast(f.type) for a, f in zip(made, arrow)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *made], names=[*batch.schema.names, *arrow.names]
                )

    return kept.mapInArrow(run, schema)
