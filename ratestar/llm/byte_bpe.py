"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file (operator 10).

Encoding is a map over Arrow batches without a shuffle. The rank file (under a
megabyte) is read once on the driver and sent to the executors, so only the
driver needs the path. Long texts are cut before encoding at places that no
match of the splitting pattern can cross, so that no call has to hold the
matches of a whole book.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from ratestar.llm.memory import tidy_batches
from ratestar.llm.package import ship

#: Texts longer than so many characters are cut into pieces of about that length.
PIECE_CHARS = 1 << 16

#: A place between a character that isn't white space and white space after it.
#: Each alternative of the supported patterns is either a run of white space or
#: an optional blank and characters that aren't white space, so no match spans it.
#: The characters named are white space for every regex engine.
_SAFE = re.compile(r"(?<=\S)(?=[ \t\n\r])")


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a .tiktoken file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


def cuts_are_safe(pattern: str) -> bool:
    """Whether no match of a pattern can go on over a place where texts are cut.

    The pattern is tried on every kind of character before white space of every kind, and on more of
    both; another pattern than the known ones may still be taken for unsafe, and is then
    used on whole texts.
    """
    compiled = regex.compile(pattern)
    kinds = ["a", "A", "é", "汉", "1", "٣", ".", "'", "_", "-", "$", "\u0301", "🙂", "'s", "ab1.", "\x00"]
    blanks = [" ", "\t", "\n", "\r", "  ", " \n", "\r\n", "\n\n "]
    for before, blank, after in product(kinds, blanks, ["", *kinds]):
        text = f"x {before}{blank}{after}"
        cut = 2 + len(before)
        whole = [m.span() for m in compiled.finditer(text)]
        parts = [m.span() for m in compiled.finditer(text[:cut])] + [(a + cut, b + cut) for a, b in (m.span() for m in compiled.finditer(text[cut:]))]
        if whole != parts:
            return False
    return True


def safe_pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces whose encodings, joined, are the encoding of the text.

    A piece ends at the first safe place at or after `limit` characters; a text
    without such a place stays whole.
    """
    begin = 0
    while len(text) - begin > limit:
        cut = _SAFE.search(text, begin + limit)
        if not cut:
            break
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:]


class Codec:
    """A tiktoken encoding without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import tiktoken

        self._encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._known = {"": np.empty(0, dtype="<u4")}
        self._cuts = cuts_are_safe(pattern)

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids of a whole text; null is the empty text."""
        if not text:
            return self._known[""]
        if len(text) <= PIECE_CHARS or not self._cuts:
            return self._encoding.encode_to_numpy(text, disallowed_special=())
        return np.concatenate([self._encoding.encode_to_numpy(piece, disallowed_special=())
                               for piece in safe_pieces(text)])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, also where they are not valid UTF-8. Unknown ids raise KeyError."""
        return self._encoding.decode_bytes(ids.tolist())


_codecs: dict[int, Codec] = {}


def _codec(vocabulary) -> Codec:
    """The codec of a broadcast (ranks, pattern), built once in each Python worker."""
    if vocabulary.id not in _codecs:
        _codecs.clear()
        _codecs[vocabulary.id] = Codec(*vocabulary.value)
    return _codecs[vocabulary.id]


class _Shared:
    """A broadcast with the number that tells it from others in a worker."""

    def __init__(self, broadcast) -> None:
        self._broadcast, self.id = broadcast, broadcast._jbroadcast.id() if broadcast._jbroadcast else 0

    @property
    def value(self):
        return self._broadcast.value

    def __getstate__(self):
        return self._broadcast, self.id

    def __setstate__(self, state):
        self._broadcast, self.id = state


def _vocabulary(df: DataFrame, ranks_path: str, pattern: str) -> _Shared:
    return _Shared(df.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), pattern)))


def _map(df: DataFrame, drop: list[str], fields: list[T.StructField], rows: Callable[[pa.RecordBatch], list[pa.Array]]):
    """df without the dropped columns and with the fields that rows() makes of each batch.

    A column named like a new field gives way to it.
    """
    ship(df.sparkSession)
    keep = [f for f in df.schema if f.name not in drop and f.name not in {new.name for new in fields}]
    names = [f.name for f in keep] + [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays(kept + rows(batch), names=names)

    return df.mapInArrow(tidy_batches(run), T.StructType(keep + fields))


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *ids]).astype(np.int32)))


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Adds the token ids of each whole text as an array of int.

    Null and empty texts have an empty array. Strings of special tokens are
    ordinary text. Other columns stay; one named like ids_col is replaced.
    """
    vocabulary = _vocabulary(df, ranks_path, pattern)

    def rows(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = _codec(vocabulary)
        return [_lists([codec.encode(text.as_py()) for text in batch.column(batch.schema.get_field_index(text_col))])]

    return _map(df, [], [T.StructField(ids_col, T.ArrayType(T.IntegerType(), True))], rows)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "bytes") -> DataFrame:
    """Adds the bytes of each array of ids. A null array gives null, an empty one no bytes."""
    vocabulary = _vocabulary(df, ranks_path, pattern)

    def rows(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = _codec(vocabulary)
        column = batch.column(batch.schema.get_field_index(ids_col))
        return [pa.array([None if not x.is_valid else codec.decode(x.values.to_numpy(zero_copy_only=False))
                          for x in column], pa.binary())]

    return _map(df, [], [T.StructField(bytes_col, T.BinaryType())], rows)


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Encodes each text and decodes its ids, with digests in place of the long values.

    The text gives way to n_tokens, ids_sha256 (ids as little-endian unsigned 32
    bit integers) and decoded_sha256 (decoded bytes), with keep_ids to the ids
    too. Null counts as empty. Other columns stay, repeated rows too; columns
    with one of those names are replaced. Empty tables give empty results.
    """
    vocabulary = _vocabulary(df, ranks_path, pattern)

    def rows(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = _codec(vocabulary)
        counts, ids_sha, bytes_sha, kept = [], [], [], []
        for text in batch.column(batch.schema.get_field_index(text_col)):
            ids = codec.encode(text.as_py())
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            bytes_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            if keep_ids:
                kept.append(ids)
        return [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(bytes_sha, pa.string()), *[_lists(kept)] * keep_ids]

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType()), *[T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids]
    return _map(df, [text_col], fields, rows)


def op10_byte_bpe(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text of documents."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    return round_trip(docs.select("doc_id", F.col("text")), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN)
