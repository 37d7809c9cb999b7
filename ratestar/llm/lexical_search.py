"""Ranked lexical search with K2-treaps over the grid of terms and documents (operator 12).

`build_index` turns each shard of whole documents (some megabytes, in the order in which
Spark reads them) into a K2-treap: a row for each term, the most frequent first, a column for
each document, the shortest first, and a term's impact on a document as weight. The index is a table of shards;
documents are never shuffled. `search` sends the items' terms to the shards in
blocks of bounded size, descends along the rows of each item's terms together (see
`k2_treap`), and carries the scores an item has reached from shard to shard of a task,
so that later shards are left early. What a task returns is each item's best few.

Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ratestar.llm import chunks, k2_treap
from ratestar.llm.memory import tidy_batches
from ratestar.llm.package import ship
from ratestar.llm.words import ALPHANUMERIC, slices, split_words
from ratestar.session import scratch_folder

#: Text and documents in a shard, at most (a longer text is a shard of its own).
SHARD_BYTES = 4 << 20
SHARD_DOCS = 4096
#: Pairs of items and terms in one broadcast.
BLOCK_PAIRS = 1 << 20
#: Items that descend a treap together.
TOGETHER = 256
#: Parts of an item's candidates that are ranked apart first.
SALTS = 64

_INDEX = "docs array<long>, height int, terms binary, rows binary, counts binary, cells array<binary>"


# The scores


def norms(lengths: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """100-90+((90*n*N) div L) of each document length; exact for numbers of any size."""
    distinct, place = np.unique(lengths, return_inverse=True)
    return np.array([10 + 90 * int(n) * docs // terms for n in distinct], dtype=np.int64)[place]


def impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * norm)


def term_weights(docs: int, counts: np.ndarray) -> np.ndarray:
    """floor(1000*ln((2*N+2)/(2*df+1))) of each document count, in doubles."""
    distinct, place = np.unique(counts, return_inverse=True)
    return np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * int(df) + 1))) for df in distinct], dtype=np.int64)[place]


# The index


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with a term, and terms of all documents with repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column("text")):
                counts = split_words(batch.column("text").slice(a, b - a), ALPHANUMERIC, lower=True).counts
                yield pa.RecordBatch.from_arrays([pa.array([int((counts > 0).sum())]), pa.array([int(counts.sum())])], names=["docs", "terms"])

    ship(docs.sparkSession)
    row = (docs.select(F.col(text_col).alias("text")).mapInArrow(tidy_batches(run), "docs long, terms long")
           .agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("terms"), F.lit(0)).alias("terms")).first())
    return row["docs"], row["terms"]


def _shard(ids: list[int | None], texts: pa.Array, docs: int, terms: int) -> tuple | None:
    words = split_words(texts, ALPHANUMERIC, lower=True)
    lengths = words.counts
    own = np.flatnonzero(lengths)
    own = own[np.argsort(lengths[own], kind="stable")]
    if not len(own):
        return None
    column = np.empty(len(ids), dtype=np.int64)
    column[own] = np.arange(len(own))
    hashes, term = np.unique(words.hashes(), return_inverse=True)
    pairs = np.sort(term * len(own) + column[words.text_of()])
    starts = chunks.group_starts(pairs)
    tf = np.diff(np.append(starts, len(pairs)))
    term, column = np.divmod(pairs[starts], len(own))
    counts = np.bincount(term, minlength=len(hashes))
    row = np.empty(len(hashes), dtype=np.int64)
    row[np.argsort(-counts, kind="stable")] = np.arange(len(hashes))
    height = max(len(hashes) - 1, len(own) - 1).bit_length()
    weights = impacts(tf, norms(lengths[own], docs, terms)[column])
    cells = k2_treap.pack(k2_treap.build(row[term], column, weights, height))
    return [ids[i] for i in own], height, chunks.pack_sorted(hashes), chunks.pack(row), chunks.pack(counts), cells


def build_index(docs: DataFrame, size: tuple[int, int], id_col: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """A table of shards. size is corpus_size of the documents, on which impacts depend.

    Documents without terms are left out. Rows that repeat an id are documents of their own.
    """
    ship(docs.sparkSession)
    names = [field.split(" ")[0] for field in _INDEX.split(", ")]

    def emit(held: list[tuple[list[int | None], pa.Array]]) -> Iterator[pa.RecordBatch]:
        ids = [i for part, _ in held for i in part]
        found = _shard(ids, pa.chunked_array([texts for _, texts in held]).combine_chunks(), *size)
        held.clear()
        if found:
            types = [pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(found, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size_held, docs_held = [], 0, 0
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for a, b in slices(batch.column("text"), shard_bytes):
                for c in range(a, b, shard_docs):
                    texts = batch.column("text").slice(c, min(b, c + shard_docs) - c)
                    if held and (size_held + texts.nbytes > shard_bytes or docs_held + len(texts) > shard_docs):
                        yield from emit(held)
                        size_held = docs_held = 0
                    held.append((ids[c:c + len(texts)], texts))
                    size_held += texts.nbytes
                    docs_held += len(texts)
        if held:
            yield from emit(held)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tidy_batches(run), _INDEX)


# The search


@dataclass
class _Items:
    """A block of items: ids, distinct terms of all, and each item's terms as pairs (item, term number)."""

    ids: list
    vocabulary: np.ndarray
    of: np.ndarray
    term: np.ndarray
    weights: np.ndarray | None = None


def _blocks(items: DataFrame, id_col: str, text_col: str, block_pairs: int) -> Iterator[_Items]:
    """Items with their distinct terms, in blocks of about block_pairs pairs; a block at a time comes to the driver."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = split_words(batch.column("text"), ALPHANUMERIC, lower=True)
            hashes = words.hashes()
            own = [np.unique(hashes[a:b]) for a, b in zip(words.first[:-1], words.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), pa.array([len(x) for x in own], pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())],
                names=["item", "n", "terms"])

    kind = items.schema[id_col].dataType
    rows = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(split, T.StructType([T.StructField("item", kind), T.StructField("n", T.LongType()), T.StructField("terms", T.BinaryType())]))
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    count = max(1, math.ceil(total / block_pairs))
    for block in range(count):
        terms: dict = {}
        for row in rows.where(F.pmod(F.xxhash64("item"), F.lit(count)) == block).where("n > 0").select("item", "terms").collect():
            terms.setdefault(row["item"], []).append(np.frombuffer(row["terms"], np.uint64))
        own = [np.unique(np.concatenate(parts)) for parts in terms.values()]
        vocabulary, term = np.unique(np.concatenate([np.empty(0, np.uint64), *own]), return_inverse=True)
        yield _Items(list(terms), vocabulary, np.repeat(np.arange(len(own)), [len(x) for x in own]), term)


def _document_counts(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """The number of documents that hold each term of the sorted vocabulary."""
    shared = index.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), dtype=np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column("terms").to_pylist(), batch.column("counts").to_pylist()):
                wanted, own, place = np.intersect1d(shared.value, chunks.unpack_sorted(terms), assume_unique=True, return_indices=True)
                total[own] += chunks.unpack(counts)[place]
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["term", "n"])

    out = np.zeros(len(vocabulary), dtype=np.int64)
    rows = index.select("terms", "counts").mapInArrow(tidy_batches(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for row in rows.collect():  # at most one for each term of the block
        out[row["term"]] = row["n"]
    shared.destroy()
    return out


class _Best:
    """The k best documents of each item so far."""

    def __init__(self, items: int, k: int) -> None:
        self.k = k
        self.found: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]  # (-score, id is null, id)
        self.floors = np.zeros(items, dtype=np.int64)

    def add(self, first: int, sums: np.ndarray, ids: list[int | None]) -> None:
        """Takes in a shard's sums of the items from `first` on."""
        k = min(self.k, sums.shape[1])
        least = np.maximum(np.partition(sums, sums.shape[1] - k, axis=1)[:, -k], np.maximum(self.floors[first:first + len(sums)], 1))
        item, col = np.nonzero(sums >= least[:, None])
        for i, c, score in zip((item + first).tolist(), col.tolist(), sums[item, col].tolist()):
            self.found[i].append((-score, ids[c] is None, ids[c] or 0))
        for i in np.unique(item + first).tolist():
            self.found[i] = sorted(self.found[i])[:self.k]
            if len(self.found[i]) == self.k:
                self.floors[i] = -self.found[i][-1][0]


def _search_shard(shard: dict, items: _Items, best: _Best) -> None:
    own, place, at = np.intersect1d(items.vocabulary, chunks.unpack_sorted(shard["terms"]), assume_unique=True, return_indices=True)
    row_of = np.full(len(items.vocabulary), -1, dtype=np.int64)
    row_of[place] = chunks.unpack(shard["rows"])[at]
    treap = k2_treap.Treap(k2_treap.unpack(shard["cells"]), shard["height"])
    rows = row_of[items.term]
    there = rows >= 0
    of, rows, weights = items.of[there], rows[there], items.weights[items.term[there]]
    for first in range(0, len(items.ids), TOGETHER):
        a, b = np.searchsorted(of, [first, first + TOGETHER])
        count = min(TOGETHER, len(items.ids) - first)
        sums = k2_treap.best(treap, len(shard["docs"]), count, of[a:b] - first, rows[a:b], weights[a:b], best.k, best.floors[first:first + count])
        best.add(first, sums, shard["docs"])


def search(index: DataFrame, items: DataFrame, size: tuple[int, int], k: int = 10, item_col: str = "item_id", text_col: str = "text",
           block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k documents of the largest score above 0.

    Equal scores rank by ascending doc_id, a null id last; rows that repeat an id have
    ranks of their own. Rows that share an item_id, null too, are one item with the terms of all of them.
    Items without terms, or whose terms no document has, have no rows. The
    index is read once or twice a block of items, so it should be a written table. An item's
    terms are held together, whatever their number.
    """
    ship(index.sparkSession)
    item_type = items.schema[item_col].dataType
    schema = T.StructType([T.StructField(item_col, item_type), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])

    def one_pass(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            best = _Best(len(block.ids), k)
            for batch in batches:
                for at in range(len(batch)):
                    _search_shard(batch.slice(at, 1).to_pylist()[0], block, best)
            rows = [(block.ids[i], None if missing else number, -score) for i, found in enumerate(best.found) for score, missing, number in found]
            ids, docs, scores = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], names=schema.fieldNames())

        return index.mapInArrow(tidy_batches(run), schema)

    kind = to_arrow_type(item_type)
    found = None
    for block in _blocks(items, item_col, text_col, block_pairs):
        block.weights = term_weights(size[0], _document_counts(index, block.vocabulary))
        part = one_pass(index.sparkSession.sparkContext.broadcast(block))
        found = part if found is None else found.unionAll(part)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    some = salted.withColumn("place", F.row_number().over(Window.partitionBy(item_col, "salt").orderBy(*order))).where(F.col("place") <= k)
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy(item_col).orderBy(*order)))
            .where(F.col("rank") <= k).select(item_col, "rank", "doc_id", "score"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id and score of the ten best of all documents for each benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    size = corpus_size(docs)
    folder = scratch_folder(spark, "lexical")
    build_index(docs, size).write.parquet(f"{folder}/index")
    return search(spark.read.parquet(f"{folder}/index"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size)


OP12_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
size AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM docs WHERE len(w) > 0),
item_terms AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
counts AS (SELECT row, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, unnest(w) AS term FROM docs) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, CAST(count(*) AS BIGINT) AS df FROM counts GROUP BY term), size),
scores AS (
    SELECT item_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM item_terms JOIN weights USING (term) JOIN counts USING (term)
         JOIN (SELECT row, 10 + (90 * len(docs.w) * size.docs) // size.terms AS m FROM docs, size) USING (row)
    GROUP BY ALL),
ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scores JOIN docs USING (row) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
