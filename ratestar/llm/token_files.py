"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding (operator 13).

Texts are tokenized once and the ids written to the shared folder. Counting them
gives each id a rank, the most frequent first; ranks are what the files hold, so
most tokens take one byte. A second pass deals the documents over ranges of their
ids and writes a file per range through the data source `ranked_tokens`.

A folder of token files holds

* `_ranks`: the token id of each rank, unsigned 32-bit integers;
* `<range>-<unique>.tok`: blocks of whole documents, in order. A block is a header
  (magic, documents, tokens, bytes of each part below), the documents' ids as 64-bit
  integers, a byte for each that is 1 where the id is null, the documents' lengths, and the
  ranks. Numbers are coded in one to four bytes without leading zeros, and control bytes
  apart from them hold four lengths each, two bits a number;
* `_files`: the files in order with their documents, their tokens and the tokens before
  them, one JSON object a line. It is written when all files are, so what a lost task
  leaves behind is in no list and read by nobody.

All integers are little-endian.
"""

from __future__ import annotations

import json
import math
import os
import re
import struct
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ratestar.llm.memory import tidy_batches
from ratestar.llm.package import ship
from ratestar.llm.words import LOWER, byte_class, looked_up, slices, split_words
from ratestar.session import scratch_folder

#: Tokens in a file, about; the range of a document never depends on it.
FILE_TOKENS = 4 << 20
#: Tokens in a block, about: what a task holds of a file.
BLOCK_TOKENS = 1 << 20
#: Text tokenized in one go, about: pieces that repeat in it are looked up once.
SLICE_BYTES = 6 << 20
#: Distinct pieces of text whose ids a Python worker remembers.
PIECES_KEPT = 1_000_000

_MAGIC = b"RTK1"
_HEADER = struct.Struct("<4sIQIIQQ")

# Coding of numbers


#: For each control byte the lengths of its four numbers.
_LENGTHS = np.array([[(byte >> 2 * place & 3) + 1 for place in range(4)] for byte in range(256)], dtype=np.uint8)
_KEEP = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def encode_numbers(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of numbers under 2^32."""
    values = values.astype(np.uint32)
    more = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    fours = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    fours[:len(values)] = more
    control = (fours.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    ends = np.cumsum(more, dtype=np.int64) + np.arange(1, len(values) + 1)
    starts = ends - more - 1
    data = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    data[starts] = values & 0xFF
    for place in range(1, 4):
        long = np.flatnonzero(more >= place)
        data[starts[long] + place] = values[long] >> 8 * place & 0xFF
    return control.tobytes(), data.tobytes()


def decode_numbers(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n numbers of control bytes and data bytes."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    four = np.ndarray((len(data),), dtype="<u4", buffer=padded, strides=(1,))
    return four[starts] & _KEEP[lengths]


# Blocks


@dataclass
class Block:
    """Whole documents: ids, which of them are null, lengths in tokens, and all ranks."""

    ids: np.ndarray
    missing: np.ndarray
    lengths: np.ndarray
    ranks: np.ndarray

    def to_bytes(self) -> bytes:
        parts = [*encode_numbers(self.lengths), *encode_numbers(self.ranks)]
        header = _HEADER.pack(_MAGIC, len(self.ids), len(self.ranks), *map(len, parts))
        return b"".join([header, self.ids.astype("<i8").tobytes(), self.missing.astype(np.uint8).tobytes(), *parts])


def read_blocks(stream) -> Iterator[Block]:
    """The blocks of an open file, one after the other."""
    while header := stream.read(_HEADER.size):
        magic, docs, tokens, *sizes = _HEADER.unpack(header)
        if magic != _MAGIC:
            raise ValueError("not a file of ranked tokens")
        ids = np.frombuffer(stream.read(8 * docs), "<i8")
        missing = np.frombuffer(stream.read(docs), np.uint8).astype(bool)
        parts = [stream.read(size) for size in sizes]
        yield Block(ids, missing, decode_numbers(parts[0], parts[1], docs), decode_numbers(parts[2], parts[3], tokens))


# The data source


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _read(path: str) -> bytes:
    system, name = _place(path)
    with system.open_input_stream(name) as stream:
        return stream.read()


def _write(path: str, data: bytes) -> None:
    system, name = _place(path)
    with system.open_output_stream(name) as stream:
        stream.write(data)


@dataclass
class _Written(WriterCommitMessage):
    part: int
    name: str
    docs: int
    tokens: int


class _Writer(DataSourceArrowWriter):
    """Writes (doc_id, ids) in the order they come; ids are packed unsigned integers of the given width."""

    def __init__(self, options: dict[str, str]) -> None:
        self._path, self._width, self._block = options["path"], int(options["width"]), int(options["block_tokens"])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        id_of_rank = np.frombuffer(_read(f"{self._path}/_ranks"), "<u4")
        rank_of_id = np.zeros(int(id_of_rank.max()) + 1 if len(id_of_rank) else 0, dtype=np.uint32)
        rank_of_id[id_of_rank] = np.arange(len(id_of_rank), dtype=np.uint32)
        part = TaskContext.get().partitionId()
        done = _Written(part, f"{part:08d}-{uuid.uuid4().hex}.tok", 0, 0)
        system, folder = _place(self._path)
        with system.open_output_stream(f"{folder}/{done.name}") as stream:
            docs: list[tuple[int | None, np.ndarray]] = []
            held = 0

            def flush() -> None:
                ids = np.array([i or 0 for i, _ in docs], dtype=np.int64)
                lengths = np.array([len(tokens) for _, tokens in docs], dtype=np.int64)
                ranks = rank_of_id[np.concatenate([tokens for _, tokens in docs])]
                stream.write(Block(ids, np.array([i is None for i, _ in docs]), lengths, ranks).to_bytes())
                done.docs += len(docs)
                done.tokens += len(ranks)
                docs.clear()

            for batch in iterator:
                for number, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    docs.append((number, np.frombuffer(ids, f"<u{self._width}")))
                    held += len(docs[-1][1])
                    if held >= self._block:
                        flush()
                        held = 0
            if docs:
                flush()
        return done

    def commit(self, messages: list[_Written | None]) -> None:
        lines, start = [], 0
        for done in sorted((m for m in messages if m), key=lambda m: m.part):
            lines.append(json.dumps({"name": done.name, "docs": done.docs, "tokens": done.tokens, "start": start}) + "\n")
            start += done.tokens
        _write(f"{self._path}/_files", "".join(lines).encode())

    def abort(self, messages: list[_Written | None]) -> None:
        system, folder = _place(self._path)
        for done in messages:
            if done:
                system.delete_file(f"{folder}/{done.name}")


@dataclass
class _File(InputPartition):
    name: str
    start: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self._path = options["path"]

    def partitions(self) -> list[_File]:
        lines = map(json.loads, _read(f"{self._path}/_files").splitlines())
        return [_File(line["name"], line["start"]) for line in lines if line["docs"]] or [_File("", 0)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        id_of_rank = np.frombuffer(_read(f"{self._path}/_ranks"), "<u4")
        start = partition.start
        system, folder = _place(self._path)
        with system.open_input_stream(f"{folder}/{partition.name}") as stream:
            for block in read_blocks(stream):
                borders = np.concatenate([[0], np.cumsum(block.lengths, dtype=np.int64)])
                data = pa.py_buffer(id_of_rank[block.ranks].astype("<u4"))
                offsets = pa.py_buffer((borders * 4).astype(np.int32 if borders[-1] < 1 << 29 else np.int64))
                kind = pa.binary() if borders[-1] < 1 << 29 else pa.large_binary()
                ids = pa.Array.from_buffers(kind, len(block.ids), [None, offsets, data])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.ids, mask=block.missing), pa.array(start + borders[:-1]),
                     pa.array(block.lengths.astype(np.int64)), ids.cast(pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])
                start += int(borders[-1])


class RankedTokens(DataSource):
    """`spark.read.format("ranked_tokens").load(folder)`; see write_tokens for the writing side."""

    @classmethod
    def name(cls) -> str:
        return "ranked_tokens"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)


# Tokenizing


_BLANK = re.compile(rb"\s")
#: Lower-case letters of the first 256 characters.
_PLAIN = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")
#: All bytes but blank, tab, line feed and carriage return.
_NOT_BLANK = byte_class((0x20, 0x20), (0x09, 0x0A), (0x0D, 0x0D))
_ASCII_WORD, _ASCII_SIGN = 1, 2
_KINDS = (_ASCII_WORD * ~byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
          + _ASCII_SIGN * ~byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)))


class PieceTokenizer:
    """Ids of whole texts, put together from those of their pieces, which repeat a lot.

    Texts are cut at white space, and between an ASCII letter or digit and an
    ASCII sign behind it. The tokenizers of the kind supported drop white space and
    split what is left into runs of letters, single digits and runs of signs (a sign
    before letters may belong to them), and no normalization joins characters
    over such a place, so pieces have the ids they have in the text. They lower all letters
    too, so A-Z are lowered here, but for those before other than ASCII characters, which could be
    accents to be joined with the letter first. Near strings of special tokens, which count as those
    tokens, the cuts are after white space alone and no letter is lowered. Pieces of plain
    letters go to the model directly, if it gives pairs of them the ids that the tokenizer does.
    """

    def __init__(self, model: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_str(model)
        self._added = [token.content.encode().lower() for token in self._tokenizer.get_added_tokens_decoder().values()]
        if any(_BLANK.search(token) for token in self._added):
            raise ValueError("a token with white space could be cut")
        self._model = self._tokenizer.model
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._as_bytes = {c: to_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(256) if _PLAIN.fullmatch(chr(c))}
        some = [chr(a) + chr(b) for a in self._as_bytes for b in self._as_bytes]
        whole = self._tokenizer.encode_batch_fast(some, add_special_tokens=False)
        self._skips = all(self._plain_ids(text) == found.ids for text, found in zip(some, whole))
        self._forget()

    def _forget(self) -> None:
        self._number: dict[bytes, int] = {}
        self._ids, self._first = array("I"), array("q", [0])

    def _plain_ids(self, text: str) -> list[int]:
        """Ids of lower-case letters, which normalization leaves as they are, by the model itself."""
        return [token.id for token in self._model.tokenize(text.translate(self._as_bytes))]

    def _look_up(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First place and number of ids of each piece, and the ids."""
        if len(self._number) > PIECES_KEPT:
            self._forget()
        new = {piece: piece.decode() for piece in pieces if piece not in self._number}
        found = {piece: self._plain_ids(text) for piece, text in new.items() if self._skips and _PLAIN.fullmatch(text)}
        others = {piece: text for piece, text in new.items() if piece not in found}
        for piece, encoding in zip(others, self._tokenizer.encode_batch_fast([*others.values()], add_special_tokens=False)):
            found[piece] = encoding.ids
        for piece, ids in found.items():
            self._number[piece] = len(self._first) - 1
            self._ids.extend(ids)
            self._first.append(len(self._ids))
        numbers = np.fromiter(map(self._number.__getitem__, pieces), np.int64, len(pieces))
        first = np.array(self._first)
        return first[numbers], first[numbers + 1] - first[numbers], np.array(self._ids, dtype=np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the place of each text's first one, with the end as the last place. Null is the empty text."""
        words = split_words(texts, _NOT_BLANK)
        buffer = words.buffer
        begins = np.zeros(len(buffer) + 1, dtype=bool)
        begins[words.starts] = True
        lowered = looked_up(buffer, LOWER)
        data = lowered.tobytes()
        if not any(token in data for token in self._added):
            kinds = looked_up(buffer, _KINDS)
            begins[1:-1] |= (kinds[:-1] == _ASCII_WORD) & (kinds[1:] == _ASCII_SIGN)
            kept = np.flatnonzero((buffer[1:] >= 0x80) & (buffer[:-1] != lowered[:-1]))
            buffer, original = lowered.copy(), buffer
            buffer[kept] = original[kept]
        starts = np.flatnonzero(begins)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        before = np.append(np.cumsum(begins)[words.starts] - 1, len(starts))[words.first]
        solid = looked_up(buffer, _NOT_BLANK).view(bool)
        offsets = np.append(0, np.cumsum(solid))[np.append(starts, len(buffer))].astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(buffer[solid])])
        coded = pieces.dictionary_encode()
        first, count, ids = self._look_up(coded.dictionary.to_pylist())
        codes = coded.indices.to_numpy()
        sizes = count[codes]
        ends = np.cumsum(sizes)
        out = ids[np.repeat(first[codes] - ends + sizes, sizes) + np.arange(ends[-1])]
        return out, np.concatenate([[0], ends])[before]


_tokenizers: dict[int, PieceTokenizer] = {}


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
             end_id: int | None = None) -> tuple[DataFrame, int]:
    """(doc_id, ids) of every whole text, and the bytes that each of the packed ids takes.

    No special tokens are added but end_id behind each text. Null is the empty text.
    Only the driver reads the tokenizer's file.
    """
    from tokenizers import Tokenizer

    ship(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as lines:
        model = lines.read()
    top = max([end_id or 0, *Tokenizer.from_str(model).get_vocab(with_added_tokens=True).values()])
    width = 2 if top < 1 << 16 else 4
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = shared._jbroadcast.id()
    end = np.array([] if end_id is None else [end_id], dtype=f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _tokenizers:
            _tokenizers.clear()
            _tokenizers[key] = PieceTokenizer(shared.value)
        for batch in batches:
            for a, b in slices(batch.column("text"), SLICE_BYTES):
                part = batch.slice(a, b - a)
                ids, borders = _tokenizers[key].encode(part.column("text"))
                ids = ids.astype(f"<u{width}")
                packed = [ids[i:j].tobytes() + end.tobytes() for i, j in zip(borders[:-1], borders[1:])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tidy_batches(run), "doc_id long, ids binary"), width


def _count(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1, dtype=np.int64)
    for batch in batches:
        column = batch.column("ids")
        for i in range(0, len(column), 256):
            found = np.bincount(np.frombuffer(b"".join(column.slice(i, 256).to_pylist()), f"<u{width}"))
            if len(found) > len(total):
                total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
            total[:len(found)] += found
    there = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["id", "n"])


def write_tokens(tokens: DataFrame, width: int, folder: str, file_tokens: int = FILE_TOKENS,
                 block_tokens: int = BLOCK_TOKENS) -> None:
    """Writes a folder of token files from (doc_id, ids), in ascending order of doc_id.

    ids are packed unsigned integers of the given width. The input is read twice, so it
    should be a written table. Rows without an id come first; rows that repeat
    an id are kept, in the order of a hash of their ids. An empty table gives a
    folder without documents. What comes to the driver is a row for each
    token id, whose number the vocabulary bounds, and a line for each file.
    """
    spark = tokens.sparkSession
    ship(spark)
    counts = (tokens.select("ids").mapInArrow(tidy_batches(lambda batches: _count(batches, width)), "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).collect())
    ranked = [row["id"] for row in sorted(counts, key=lambda row: (-row["n"], row["id"]))]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    _write(f"{folder}/_ranks", np.array(ranked, dtype="<u4").tobytes())
    files = max(1, math.ceil(sum(row["n"] for row in counts) / file_tokens))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), F.col("ids")]
    spark.dataSource.register(RankedTokens)
    (tokens.repartitionByRange(files, *order[:2]).sortWithinPartitions(*order).write.format("ranked_tokens").mode("append")
     .option("width", width).option("block_tokens", block_tokens).save(folder))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (tokens of all documents before), n_tokens and ids (unsigned 32-bit integers) of a folder of token files."""
    ship(spark)
    spark.dataSource.register(RankedTokens)
    return spark.read.format("ranked_tokens").load(folder)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read from token files of their ids and an end id of 1.

    Null is the empty text, so such a document is its end id. Rows that repeat an id are documents of their own.
    """
    import public_tokenizers

    folder = scratch_folder(spark, "tokens")
    tokens, width = tokenize(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    tokens.write.option("compression", "zstd").parquet(f"{folder}/ids")
    write_tokens(spark.read.parquet(f"{folder}/ids"), width, f"{folder}/files")
    return read_tokens(spark, f"{folder}/files").select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
