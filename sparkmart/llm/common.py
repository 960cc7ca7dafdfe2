"""What the operators share: reading tables, whole-text words, cutting lineage, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import scratch_path

#: A word of a text, as the contracts spell it (RE2, Java and Python read it alike).
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are handed to Python code in slices of about this many bytes; a batch, which may be a task's whole input, is never a list.
SLICE_BYTES = 1_000_000
#: Very long texts are split into words in pieces of about this many bytes.
PIECE_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str | Column) -> DataFrame:
    """Columns of a table of ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: read again, not computed again, if an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text in order, as an array; none for a NULL."""
    plain = F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     "))
    single = F.when(F.contains(plain, F.lit("  ")), F.split(plain, " +")).otherwise(F.split(plain, " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(single)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[str | None]]]:
    """(offset, texts); a slice ends once it holds ``limit`` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = before = 0
    while first < len(texts):
        end = min(int(np.searchsorted(ends, before + limit)) + 1, len(texts))
        yield first, texts.slice(first, end - first).to_pylist()
        first, before = end, int(ends[end - 1])


def map_texts(df: DataFrame, rows: Callable[[list, list[str]], Iterable[tuple]], schema: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``rows(keys, texts)`` over all rows of ``df``, slice by slice; a NULL text is empty.

    No shuffle: each task reads its part of the table and writes rows of ``schema``.
    """
    names = [field.split()[0] for field in schema.split(", ")]
    arrow = to_arrow(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(1)):
                keys = batch.column(0).slice(first, len(part)).to_pylist()
                found = list(rows(keys, [text or "" for text in part]))
                columns = list(zip(*found, strict=True)) or [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def word_table(kept: str) -> bytes:
    """For ``bytes.translate`` over UTF-8: A-Z become a-z, ASCII characters outside ``kept`` blanks, all others stay.

    What ``split`` gives after it are the words of the contracts' classes, as bytes.
    """
    return bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).lower() in kept else 32 for b in range(256))


def word_pieces(data: bytes, table: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of about ``size`` bytes: a very long text is never one list."""
    data = data.translate(table)
    start = 0
    while len(data) - start > size:
        end = data.find(b" ", start + size)
        if end < 0:
            break
        yield data[start:end].split()
        start = end
    yield data[start:].split()


def utf8(text: str | Column) -> Column:
    """A text as its bytes, empty for NULL: Python code reads them without decoding, valid or not."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def to_arrow(spark: SparkSession, schema: str) -> pa.Schema:
    """The Arrow schema of a DDL string of plain types."""
    plain = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, plain[kind]) for name, kind in (field.split() for field in schema.split(", "))])


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text leaves 2 when divided by 4."""
    return F.crc32(key.cast("string")) % 4 == 2


def replace_text(df: DataFrame, change: Callable[[str], str], text: str = "text") -> DataFrame:
    """``df`` with ``change`` applied to every text; NULL stays NULL.  No shuffle."""
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(at)):
                new = pa.array([None if t is None else change(t) for t in part], batch.schema.field(at).type)
                own = batch.slice(first, len(part))
                yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(own.columns)], schema=batch.schema)

    return df.mapInArrow(run, df.schema)
