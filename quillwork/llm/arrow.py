"""Python work on batches of rows in which ids are never looked at, so that any id comes back as it was.

Through pandas a whole-number column that holds a null would come as floating point, which changes ids
above 2 ** 53.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores before it while a column of the frame has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


Answer = tuple[list[int] | None, dict[str, Any]]


def map_rows(docs: DataFrame, id_col: str, inputs: list[Column], out: str,
             answer: Callable[..., Answer], name: str = "doc_id") -> DataFrame:
    """``name`` and the columns ``out`` (a schema) of what ``answer`` makes of each batch.

    ``answer`` takes a list of Python values per input column and returns the row each result row
    belongs to (None: one result a row, in order) and the result's columns.
    """
    kind = docs.schema[id_col].dataType
    fields = to_arrow_schema(T.StructType.fromDDL(out))
    schema = pa.schema([pa.field(name, to_arrow_type(kind)), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            rows, columns = answer(*[c.to_pylist() for c in batch.columns[1:]])
            if rows is not None:
                ids = ids.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids.cast(schema.field(0).type), *[pa.array(columns[f.name], f.type) for f in fields]],
                schema=schema)

    chosen = docs.select(F.col(id_col).alias("i"), *[c.alias(f"c{i}") for i, c in enumerate(inputs)])
    return chosen.mapInArrow(run, f"`{name}` {kind.simpleString()}, {out}")
