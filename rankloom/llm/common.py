"""What the operators of this folder share: tables, row-wise annotation, held-out rows."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from ..session import small_batches as small_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def annotate(
    docs: DataFrame,
    columns: list[str],
    fields: str,
    start: Callable[[], Callable[..., list]],
    keep: list[str] | None = None,
    size: int = 4 << 20,
) -> DataFrame:
    """Add fields (a DDL string) made in Python from whole values of `columns`.

    `start()` runs once per task and returns a function from the lists of the
    columns' values (None for null, UTF-8 bytes for strings) to one list or
    Arrow array per field. Rows are neither
    shuffled nor reordered. `keep` names the input columns of the result (all,
    if None); an input column with the name of a new field is replaced. A batch
    is worked on in pieces of about `size` bytes, so memory doesn't follow the
    number of records in an Arrow batch.
    """
    new = _parse_datatype_string(fields)
    made = set(new.fieldNames())
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    inputs = list(dict.fromkeys([*keep, *columns]))
    rows = docs.select([F.col(f"`{c}`") for c in inputs])
    schema = StructType([*(rows.schema[c] for c in keep), *new.fields])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for piece in pieces(batch, size):
                results = work(*(values(piece.column(inputs.index(c))) for c in columns))
                arrays = [piece.column(inputs.index(c)) for c in keep]
                arrays += [
                    v if isinstance(v, pa.Array) else pa.array(v, type=out.field(len(keep) + i).type)
                    for i, v in enumerate(results)
                ]
                arrays = [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, out, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return rows.mapInArrow(run, schema)


def values(column: pa.Array) -> list:
    """The values; strings as their bytes, which need no decoding."""
    if pa.types.is_list(column.type) and pa.types.is_integer(column.type.value_type) and not column.flatten().null_count:
        numbers, ends = column.values, column.offsets.to_pylist()
        found = [numbers[at:to].to_numpy().tolist() for at, to in zip(ends, ends[1:], strict=False)]
        return [x if known else None for x, known in zip(found, column.is_valid().to_pylist(), strict=True)]
    text = pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
    return (column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()) if text else column).to_pylist()


def pieces(batch: pa.RecordBatch, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about `size` bytes, of one row at least."""
    rows = batch.num_rows
    if rows:
        step = max(1, int(rows * size / max(1, batch.nbytes)))
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def is_held_out(doc_id: int | None) -> bool:
    """Whether labels of this document must not be learned from."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
