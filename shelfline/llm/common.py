"""Helpers that several of the text operators share."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The separators of the word and line contracts, space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
_TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def with_package(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package wherever the session was started; on a
    cluster it has to be installed or sent along, as any library."""
    root = str(Path(__file__).resolve().parents[2])
    found = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in found.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, found]))


def give_back() -> None:
    """Returns the memory that a worker has freed to the machine: an executor's workers share its limit with the
    JVM, also while they wait for their next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # of the GNU C library
    if trim:
        trim(0)


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """`mapInArrow` with the package at hand; a worker keeps no freed memory after its task."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    with_package(df.sparkSession)
    return df.mapInArrow(whole, schema)


_held: dict = {}


def only(key, make: Callable):
    """What `make` gives, kept in this worker until something else is asked for: a worker that goes on to another
    operator lets go of what the one before had looked up."""
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """For an operator that looks nothing up: drops what this worker holds of the one before."""
    if _held:
        _held.clear()
        give_back()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; `lower` alone would change letters beyond ASCII too."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def lower_bytes(text: str) -> bytes:
    """UTF-8 with A-Z in lower case."""
    return text.encode().translate(_TO_LOWER)


def fold(id_column: str, salt: int = 5) -> Column:
    """crc32 of the id as text, modulo `salt`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % salt


def per_row(df: DataFrame, columns: list[str], added: T.StructType,
            rows: Callable[[Iterator[tuple]], Iterator[tuple]], keep: list[str] | None = None) -> DataFrame:
    """Adds columns computed row by row in Python workers, a batch of Arrow rows at a time.

    `rows` takes the tuples of `columns` of one batch and returns one tuple of `added` for each. Of
    the input, `keep` (default: `columns`) passes through unchanged.
    """
    keep = columns if keep is None else keep
    out = T.StructType([*(df.schema[c] for c in keep), *added.fields])
    types = _arrow(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]
            made = list(zip(*rows(zip(*given)))) or [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep),
                 *(pa.array(v, t) for v, t in zip(made, types))],
                names=out.names)

    return map_arrow(df.select(*dict.fromkeys([*keep, *columns])), run, out)


def _arrow(schema: T.StructType) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type
    return [to_arrow_type(f.dataType) for f in schema.fields]


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[list[pa.Array]]:
    """The columns of runs of rows in which column `column` has `limit` bytes at most, or a single row; a
    column of numbers states them itself."""
    for batch in batches:
        given = batch.column(column)
        sizes = pc.fill_null(given if pa.types.is_integer(given.type) else pc.binary_length(given), 0).to_pylist()
        start = held = 0
        for k, size in enumerate(sizes):
            if k > start and held + size > limit:
                yield batch.slice(start, k - start).columns
                start, held = k, 0
            held += size
        if len(sizes) > start:
            yield batch.slice(start).columns
