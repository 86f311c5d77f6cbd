"""Helpers that the operators share."""
from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_bucket(doc_id_col: str, modulus: int, remainder: int):
    """crc32(doc_id as text) mod ``modulus`` is ``remainder``; false for a null id."""
    code = F.crc32(F.col(doc_id_col).cast("string").cast("binary"))
    return F.coalesce(code % modulus == remainder, F.lit(False))


ROWS_AT_ONCE = 256      # rows that are Python objects at a time


def rows_of(batches: Iterable, columns: Sequence[str]) -> Iterator[tuple]:
    """Rows of Arrow record batches as tuples of Python values, few at a time."""
    for batch in batches:
        places = [batch.schema.get_field_index(c) for c in columns]
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            yield from zip(*[part.column(k).to_pylist() for k in places], strict=True)


def array_batches(columns: Sequence, schema, size: int = 50_000):
    """Arrow record batches of at most ``size`` rows from equally long numpy arrays."""
    import pyarrow as pa

    for at in range(0, len(columns[0]), size):
        yield pa.RecordBatch.from_arrays([pa.array(c[at:at + size], type=f.type) for c, f in zip(columns, schema, strict=True)],
                                         schema=schema)


def in_chunks(rows: Iterable, size: int) -> Iterator[list]:
    """Lists of at most ``size`` consecutive rows."""
    part = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part


def as_batches(rows: Iterable[tuple], schema, size: int = 2000):
    """Arrow record batches of at most ``size`` rows with ``schema`` (a pyarrow schema)."""
    import pyarrow as pa

    for part in in_chunks(rows, size):
        columns = zip(*part, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
                                         schema=schema)


def arrow_schema(ddl: str):
    """pyarrow schema of a Spark DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
