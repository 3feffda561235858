"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqcat.session import scratch_dir

#: UTF-8 bytes of text that Python code handles at a time; a single longer text is handled whole.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage is cut, executors may be lost."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 1 << 20  #: narrow rows (a key and a number) that may be broadcast


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` (stored, narrow) marked for broadcast if it is proven to have at most ``BROADCAST_ROWS`` rows; beyond
    that Spark joins by shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its columns of these names renamed out of the way, and the columns that give all back as they were."""
    used, moved = {c.lower() for c in [*docs.columns, *names]}, {}
    for c in docs.columns:
        if c.lower() in names:
            free = "_" + c
            while free.lower() in used:
                free = "_" + free
            used.add(free.lower())
            moved[c] = free
    back = [F.col(moved.get(c, c)).alias(c) for c in docs.columns]
    return docs.withColumnsRenamed(moved) if moved else docs, back


def slices(batches: Iterable[pa.RecordBatch], text: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of each hold ``max_bytes`` at most, or one row does."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            if i > start and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(lengths):
            yield batch.slice(start)


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str], columns: list[str]) -> Iterator[list[list]]:
    """Rows sorted by ``keys`` -> the columns' values, one group at a time."""
    last, rows = None, [[] for _ in columns]
    for b in batches:
        key_rows = zip(*(b.column(k).to_pylist() for k in keys), strict=True)
        for key, *row in zip(key_rows, *(b.column(c).to_pylist() for c in columns), strict=True):
            if key != last:
                if rows[0]:
                    yield rows
                last, rows = key, [[] for _ in columns]
            for values, x in zip(rows, row, strict=True):
                values.append(x)
    if rows[0]:
        yield rows


def space_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 bytes; null has none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def held_out(doc_id, remainder: int):
    """True where crc32 of the id as text leaves ``remainder`` by 5; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == remainder, F.lit(False))
