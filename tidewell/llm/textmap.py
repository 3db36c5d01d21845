"""Map whole texts to result columns in Arrow batches; no shuffle, no per-row Spark calls."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows and bytes of text handled at once inside a task; both only bound memory.
SLICE_ROWS = 2000
SLICE_CHARS = 4_000_000

_ARROW = {
    T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(), T.BooleanType(): pa.bool_(),
    T.StringType(): pa.string(), T.BinaryType(): pa.binary(), T.ArrayType(T.StringType()): pa.list_(pa.string()),
    T.ArrayType(T.LongType()): pa.list_(pa.int64()), T.ArrayType(T.IntegerType()): pa.list_(pa.int32()),
    T.ArrayType(T.DoubleType()): pa.list_(pa.float64()),
}


def ranges(texts: pa.Array, chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Cut a column into runs of rows with bounded size, as (begin, end); a very long text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin, n = 0, len(texts)
    while begin < n:
        room = (ends[begin - 1] if begin else 0) + chars
        end = min(begin + SLICE_ROWS, max(begin + 1, int(np.searchsorted(ends, room, "right"))))
        end = min(end, n)
        yield begin, end
        begin = end


def slices(texts: pa.Array, chars: int = SLICE_CHARS) -> Iterator[tuple[int, int, list[str | None]]]:
    """The same runs as (begin, end, texts); only the run at hand exists as Python strings."""
    for begin, end in ranges(texts, chars):
        yield begin, end, texts.slice(begin, end - begin).to_pylist()


def map_texts(
    df: DataFrame,
    start: Callable[[], Callable[[list[str | None]], dict[str, Iterable]]],
    out: str,
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """`keep` columns (default all) of `df` plus the columns of the DDL schema `out`, computed from `text_col`.

    `start()` runs once in each task and returns the function from a list of texts to lists of values. A column of
    `df` with the name of a result column is replaced by the result.
    """
    fields = T.StructType.fromDDL(out).fields
    names = {f.name.lower() for f in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in names]
    at = keep.index(text_col) if text_col in keep else len(keep)
    source = df.select(*[F.col(f"`{c}`") for c in keep], *([] if text_col in keep else [F.col(f"`{text_col}`").alias("__text")]))
    schema = T.StructType([*(df.schema[c] for c in keep), *fields])
    kinds = [_ARROW[f.dataType] for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            for a, b, texts in slices(batch.column(at)):
                done = step(texts)
                columns = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                columns += [pa.array(done[f.name], kind) for f, kind in zip(fields, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    return source.mapInArrow(run, schema)
