"""What the operators of this subpackage share: the shared folder, chunks of documents, Arrow columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Text of one chunk in bytes; chunks are what one Python call holds.
CHUNK_BYTES = 2 * 1024 * 1024


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new path below ``spark.checkpoint.dir``, or below the warehouse where that is unset, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/shared"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage and serves several readers."""
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(bytes of text, rows) of a table, for sizing chunks and buckets."""
    row = docs.agg(F.sum(F.octet_length(text)).alias("size"), F.count(F.lit(1)).alias("count")).first()
    return int(row["size"] or 0), int(row["count"])


def chunked(
    docs: DataFrame, doc_id: str, text: str, size: int, rows: int, chunk_bytes: int = CHUNK_BYTES, carry: tuple[str, ...] = (),
) -> DataFrame:
    """(chunk, doc_id, text, carried columns): documents dealt evenly by their id, so that no source or date fills a chunk.

    Every stage of a plan that groups by ``chunk`` reads the same exchange. Several rows of one id share a chunk; rows
    without an id are dealt by their text.
    """
    chunks = max(1, -(-size // chunk_bytes), -(-rows // 50_000))
    return docs.select(
        F.pmod(F.xxhash64(F.col(doc_id), F.when(F.col(doc_id).isNull(), F.col(text))), F.lit(chunks))
        .cast("int").alias("chunk"),
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *carry,
    )


def bucket_count(entries: int, per_bucket: int = 1_000_000, least: int = 256) -> int:
    """A power of two of hash buckets with about ``per_bucket`` entries each; grows with the data."""
    count = least
    while count * per_bucket < entries:
        count *= 2
    return count


def per_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator], Iterator]:
    """A ``mapInArrow`` function from one that turns a batch into a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return run


def pack(values: np.ndarray) -> bytes:
    """Numbers as planes of bytes: the planes of zeros and of slowly rising bytes take no room in a compressed shuffle."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def slices(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted 64-bit keys; a bucket has the keys with the same leading bits."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    edges = np.arange(1, buckets, dtype=np.uint64) << shift
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
