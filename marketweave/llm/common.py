"""Helpers shared by the text operators: Arrow batches, settled tables and size-checked joins."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that one numpy pass takes at a time; whole documents are never cut, so one longer text is a pass of its own.
PASS_BYTES = 1 << 20
#: Bytes of a key table that may be broadcast, as measured before the join; larger ones are joined by a shuffle.
BROADCAST_BYTES = 24_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or in local mode a temporary one where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="marketweave-")
        spark.sparkContext.setCheckpointDir(path)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: cuts the lineage, and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def discard(*settled: DataFrame) -> None:
    """Delete the files of settled tables that nothing will read again."""
    for df in settled:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.settled_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def _bytes_of(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return sum((_bytes_of(c[f.name], f.dataType) for f in kind.fields), F.lit(8))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    return F.lit(8)


def fits_broadcast(keys: DataFrame) -> bool:
    """Whether the measured bytes of a settled table (numbers, texts, structs of them) stay under ``BROADCAST_BYTES``."""
    row = sum((_bytes_of(F.col(f.name), f.dataType) for f in keys.schema.fields), F.lit(16))
    return keys.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0] <= BROADCAST_BYTES


def join_checked(left: DataFrame, keys: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a settled table of keys: broadcast it only if it ``fits_broadcast``, else shuffle both sides."""
    return left.join(F.broadcast(keys) if fits_broadcast(keys) else keys, on, how)


def key_equals(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def texts_of(column: pa.Array) -> pa.Array:
    """A text column without nulls (null counts as empty), with 64-bit offsets."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(column.cast(pa.large_string()), "")


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and where each begins (one offset more than texts)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def passes(batches: Iterable[pa.RecordBatch], column: str, most: int = PASS_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the batches with at most ``most`` bytes of text each (one document at least), with their texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = texts_of(batch.column(batch.schema.get_field_index(column)))
        _, at = raw(texts)
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
            yield batch.slice(first, last - first), texts.slice(first, last - first)
            first = last
    pa.default_memory_pool().release_unused()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
