"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark (operator 8).

Chunks of documents hash all their windows and send each distinct hash once,
with the smallest doc_id that has it, to the bucket of the hash (see `chunks`).
The bucket finds the smallest doc_id of all and answers, for each hash of a
chunk, whether another chunk has a smaller one: one bit. The chunk marks the
words under repeated windows and merges them into maximal intervals.

The text is shuffled once, by chunk; that exchange serves both passes. Windows
are told apart by 64 bits of a hash that is drawn over whole words, so of n
windows about n / 2^64 are taken for another one by mistake.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ratestar.llm import chunks
from ratestar.llm.memory import tidy_cogroup, tidy_group
from ratestar.llm.package import ship
from ratestar.llm.words import Words, run_hashes, split_words

WINDOW = 13

_MESSAGE = "bucket long, chunk long, hashes binary, ids binary, docs binary"
_ANSWER = "bucket long, chunk long, seen binary"


class _Windows:
    """The windows of one chunk's documents with an id, and its distinct hashes in order."""

    def __init__(self, table: pa.Table, window: int) -> None:
        self.ids = table.column("id").combine_chunks()
        self.words: Words = split_words(table.column("text").combine_chunks())
        ids = self.ids.fill_null(0).to_numpy()
        known = np.repeat(self.ids.is_valid().to_numpy(zero_copy_only=False), self.words.counts)
        hashes = run_hashes(self.words.hashes(), window)
        n = len(hashes)
        self.starts = np.flatnonzero((np.arange(n) + window <= self.words.last()[:n]) & known[:n])
        hashes = hashes[self.starts]
        self.window_ids = np.repeat(ids, self.words.counts)[self.starts]
        order = np.argsort(hashes, kind="stable")
        in_order = hashes[order]
        edges = chunks.group_starts(in_order)
        self.hashes = in_order[edges]
        self.smallest = np.minimum.reduceat(self.window_ids[order], edges) if len(edges) else np.empty(0, np.int64)
        self.group = np.empty(len(hashes), dtype=np.int64)
        self.group[order] = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(hashes))))


def _send(table: pa.Table, window: int, buckets: int) -> pa.Table:
    chunk = table.column("chunk")[0].as_py()
    own = _Windows(table, window)
    rows = []
    for bucket, begin, end in chunks.bucket_ranges(own.hashes, buckets):
        ids, place = np.unique(own.smallest[begin:end], return_inverse=True)
        rows.append((bucket, chunks.pack_sorted(own.hashes[begin:end]), chunks.pack_sorted(ids), chunks.pack(place)))
    return pa.table({
        "bucket": pa.array([r[0] for r in rows], pa.int64()), "chunk": pa.array([chunk] * len(rows), pa.int64()),
        "hashes": chunks.binary([r[1] for r in rows]), "ids": chunks.binary([r[2] for r in rows]),
        "docs": chunks.binary([r[3] for r in rows])})


def _judge(table: pa.Table) -> pa.Table:
    """For each message a bit for each hash: whether a smaller doc_id than the message's has it."""
    hashes = [chunks.unpack_sorted(x.as_py()) for x in table.column("hashes")]
    ids = [chunks.unpack_sorted(i.as_py()).view(np.int64)[chunks.unpack(d.as_py())]
           for i, d in zip(table.column("ids"), table.column("docs"))]
    borders = np.cumsum([len(x) for x in hashes])[:-1]
    hashes, ids = np.concatenate(hashes), np.concatenate(ids)
    order = np.argsort(hashes, kind="stable")
    edges = chunks.group_starts(hashes[order])
    smallest = np.empty(len(hashes), dtype=np.int64)
    smallest[order] = np.repeat(np.minimum.reduceat(ids[order], edges), np.diff(np.append(edges, len(hashes))))
    seen = [np.packbits(x).tobytes() for x in np.split(smallest < ids, borders)]
    return pa.table({"bucket": table.column("bucket"), "chunk": table.column("chunk"), "seen": chunks.binary(seen)})


def _remove(table: pa.Table, answers: pa.Table, window: int, buckets: int, as_is: bool) -> pa.Table:
    own = _Windows(table, window)
    seen = chunks.answers_of(answers, own.hashes, buckets, "seen",
                             lambda data, n: np.unpackbits(np.frombuffer(data, np.uint8), count=n)).astype(bool)
    words = own.words
    repeated = own.starts[seen[own.group] | (own.smallest[own.group] < own.window_ids)]
    cover = np.zeros(len(words.starts) + window + 1, dtype=np.int64)
    np.add.at(cover, repeated, 1)
    np.add.at(cover, repeated + window, -1)
    gone = np.cumsum(cover)[:len(words.starts)] > 0
    removed = np.add.reduceat(np.append(gone, False), words.first[:-1]) * (words.counts > 0)

    # Intervals of removed words, cut at the borders of documents, numbered within each.
    text_of = words.text_of()
    new_doc = np.concatenate([[True], text_of[1:] != text_of[:-1]]) if len(text_of) else np.empty(0, bool)
    begins = np.flatnonzero(gone & (new_doc | ~np.concatenate([[False], gone[:-1]]))) if len(gone) else np.empty(0, int)
    ends = np.flatnonzero(gone & np.concatenate([new_doc[1:] | ~gone[1:], [True]])) + 1 if len(gone) else np.empty(0, int)
    of = text_of[begins]
    offsets = np.searchsorted(of, np.arange(len(own.ids) + 1)).astype(np.int32)
    intervals = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        [pa.array((begins - words.first[of]).astype(np.int32)), pa.array((ends - words.first[of]).astype(np.int32))],
        names=["begin", "end"]))

    text = kept_texts(words, ~gone)
    if as_is:
        text = pa.array([new if n else old for new, old, n in zip(text.to_pylist(), table.column("text").to_pylist(), removed)],
                        pa.string())
    return pa.table({"id": own.ids, "extra": table.column("extra").combine_chunks(),
                     "n_words": pa.array(words.counts.astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64)),
                     "removed": intervals, "kept_text": text})


def kept_texts(words: Words, keep: np.ndarray) -> pa.Array:
    """Each text's kept words, joined by one space."""
    buffer = words.buffer.copy()
    buffer[words.ends] = 0x20  # a separator follows each word
    marks = np.zeros(len(buffer) + 1, dtype=np.int8)
    marks[words.starts[keep]] += 1
    marks[words.ends[keep] + 1] -= 1
    body = buffer[np.cumsum(marks[:-1], dtype=np.int8).astype(bool)]
    sizes = np.concatenate([[0], np.cumsum(np.where(keep, words.ends - words.starts + 1, 0))])
    borders = sizes[words.first]
    data = body.tobytes()
    return pa.array([data[a:max(a, b - 1)] for a, b in zip(borders[:-1], borders[1:])], pa.binary()).cast(pa.string())


def remove_repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, carry: list[str] | None = None,
    as_is: bool = False, chunk_bytes: int | None = None, bucket_bytes: int | None = None,
) -> DataFrame:
    """Removes each word covered by a window of words that also starts in a document with a smaller id.

    Words are runs of characters other than ASCII white space, compared byte by
    byte over whole texts; windows don't cross documents. Returns the id, the
    columns to carry (without those that have a result's name), n_words,
    n_removed, `removed` (maximal intervals of word numbers, end excluded) and
    kept_text (the kept words joined by one space; with as_is the text as it was
    where nothing goes, null included).

    Null texts have no words. Rows with a null id lose nothing and cause no
    removal. Rows that repeat an id are judged each by itself, never against
    each other. Empty tables give empty results; other columns don't matter.
    """
    ship(docs.sparkSession)
    names = [c for c in carry or [] if c not in (id_col, "n_words", "n_removed", "removed", "kept_text")]
    extra = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(0).alias("none"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), extra.alias("extra"))
    size, count = chunks.text_bytes(rows, F.col("text"))
    fitting = chunks.fitting(size)
    chunk_bytes, bucket_bytes = chunk_bytes or fitting[0], bucket_bytes or fitting[1]
    buckets = chunks.bucket_count(size, bucket_bytes)
    dealt = chunks.in_chunks(rows, chunks.chunk_count(size, count, chunk_bytes), "id", "text")

    def send(table: pa.Table) -> pa.Table:
        return _send(table, window, buckets)

    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        return _remove(table, answers, window, buckets, as_is)

    answers = (dealt.groupBy("chunk").applyInArrow(tidy_group(send), _MESSAGE)
               .groupBy("bucket").applyInArrow(tidy_group(_judge), _ANSWER))
    schema = T.StructType([
        rows.schema["id"], rows.schema["extra"], T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("removed", T.ArrayType(T.StructType([
            T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
        T.StructField("kept_text", T.StringType())])
    found = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(tidy_cogroup(remove), schema)
    return found.select(F.col("id").alias(id_col), *[F.col("extra")[c].alias(c) for c in names],
                        "n_words", "n_removed", "removed", "kept_text")


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    found = remove_repeated_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH words AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
    SELECT row, doc_id, p, array_to_string(w[p:p + 12], ' ') AS run
    FROM (SELECT row, doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words WHERE len(w) >= 13)),
firsts AS (SELECT run, min(doc_id) AS first_id FROM starts GROUP BY run),
gone AS (
    SELECT DISTINCT row, p + o AS q
    FROM (SELECT row, p, unnest(range(0, 13)) AS o FROM starts JOIN firsts USING (run) WHERE first_id < doc_id)),
kept AS (
    SELECT words.row, count(gone.q) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (WHERE gone.q IS NULL) AS text
    FROM (SELECT row, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words) words
    LEFT JOIN gone ON gone.row = words.row AND gone.q = words.place
    GROUP BY words.row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (row)
"""
