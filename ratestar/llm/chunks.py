"""Questions about 64-bit hashes of a whole corpus, asked by chunks of documents and answered by ranges of hashes.

A corpus has as many shingles or windows as words, so a row for each of them is
far more to sort than the text itself. Here a chunk (some megabytes of
documents, dealt by a hash of their rows) sorts its own distinct hashes and
sends one packed message to each range of hashes, its bucket. A bucket merges
the messages of all chunks and answers each with a value for every hash, in the
order of the message. The chunk then makes its hashes once more and reads the
answers beside them.

A hash that a third of the documents hold occurs once in a chunk's message, so
it weighs as much as there are chunks. Chunks and buckets grow with the root of the
corpus (`fitting`), so that messages hold some hashes each: at 100 TB of text chunks of
57 MB and buckets of 170 MB.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

#: Text in a chunk. A task holds about twelve times as much while it works.
CHUNK_BYTES = 4 << 20
#: Text whose hashes meet in one bucket.
BUCKET_BYTES = 12 << 20
#: A message should hold so many hashes at least, of one for each so many bytes of text.
MESSAGE_HASHES, HASH_BYTES = 16, 6
#: Rows in a chunk, where texts are short or missing.
CHUNK_ROWS = 50_000

_U = np.uint64


def text_bytes(docs: DataFrame, text: Column) -> tuple[int, int]:
    """Bytes of all texts and number of rows: one pass over the table."""
    row = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("size"), F.count("*").alias("n")).first()
    return row["size"], row["n"]


def fitting(size: int) -> tuple[int, int]:
    """Bytes of chunks and buckets for so much text: the least from where on messages have hashes enough."""
    chunk = math.isqrt(MESSAGE_HASHES * HASH_BYTES * size * CHUNK_BYTES // BUCKET_BYTES)
    return max(CHUNK_BYTES, chunk), max(BUCKET_BYTES, chunk * BUCKET_BYTES // CHUNK_BYTES)


def chunk_count(size: int, rows: int, chunk_bytes: int = CHUNK_BYTES) -> int:
    return max(1, math.ceil(size / chunk_bytes), math.ceil(rows / CHUNK_ROWS))


def bucket_count(size: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    return max(1, math.ceil(size / bucket_bytes))


def in_chunks(docs: DataFrame, chunks: int, *by: str) -> DataFrame:
    """docs with a column `chunk` that depends on the columns `by` alone, dealt by it."""
    return docs.withColumn("chunk", F.pmod(F.xxhash64(*by), F.lit(chunks))).repartition("chunk")


def bucket_ranges(hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, begin, end) of the buckets that sorted hashes fall into."""
    numbers = ((hashes >> _U(32)) * _U(buckets)) >> _U(32)
    edges = np.concatenate([[0], np.flatnonzero(numbers[1:] != numbers[:-1]) + 1, [len(hashes)]]) if len(hashes) else [0]
    return [(int(numbers[a]), int(a), int(b)) for a, b in zip(edges[:-1], edges[1:])]


def _planes(values: np.ndarray) -> bytes:
    """Bytes of the same weight side by side: those of small values are mostly zero and compress away."""
    width = values.dtype.itemsize
    return values.view(np.uint8).reshape(-1, width).T.tobytes()


def _unplanes(data: bytes, dtype: np.dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as compressed differences."""
    steps = np.diff(values.view(_U), prepend=_U(0))
    return zstandard.ZstdCompressor(level=1).compress(_planes(steps))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(zstandard.ZstdDecompressor().decompress(data), _U), dtype=_U)


def pack(values: np.ndarray) -> bytes:
    """Numbers of any integer type, compressed; they come back as the narrowest unsigned type."""
    top = int(values.max()) if len(values) else 0
    kind = next(d for d in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(d).max)
    return bytes([np.dtype(kind).itemsize]) + zstandard.ZstdCompressor(level=1).compress(_planes(values.astype(kind)))


def unpack(data: bytes) -> np.ndarray:
    return _unplanes(zstandard.ZstdDecompressor().decompress(data[1:]), np.dtype(f"<u{data[0]}"))


def binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def group_starts(values: np.ndarray) -> np.ndarray:
    """Indexes at which runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)


def answers_of(table: pa.Table, hashes: np.ndarray, buckets: int, column: str, read) -> np.ndarray:
    """One chunk's answers in the order of its sorted hashes; read() turns an answer into an array."""
    by_bucket = dict(zip(table.column("bucket").to_pylist(), table.column(column).to_pylist()))
    parts = [read(by_bucket[bucket], end - begin) for bucket, begin, end in bucket_ranges(hashes, buckets)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint8)
