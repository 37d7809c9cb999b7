"""Approximate nearest neighbours with randomly rotated one-bit codes (operator 5).

A vector is turned by a random rotation that all of its length share, into a space of
more dimensions where it has few, and kept as the signs of its coordinates, one bit each, with two
scalars: its length, and how well the signs stand for its direction. The signs
give an unbiased estimate of the inner product with a query, and the second
scalar bounds its error. The vectors with the best estimates are compared
exactly; of the others only those whose upper bound reaches the k-th best so far,
so almost none of the true neighbours is lost and most vectors are never looked at.

Vectors of one length are compared with each other. Queries and rows of a length are dealt over
blocks by a hash of their ids, and each pair of a block of queries and a block
of rows is one group, of bounded size. Each gives the k best of its rows for its
queries, and a ranking of those ends the search. Blocks are as large as memory allows,
since rows travel once for each block of queries.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ratestar.llm.package import ship
from ratestar.session import cut_lineage

#: Rows in a block: enough for all cores, within these bounds; and queries in a block.
ROW_BLOCKS, QUERY_BLOCK = (8_192, 65_536), 16_384
#: Bits of a code at least.
LEAST_BITS = 256
#: Longer vectors are rotated in parts of so many coordinates, dealt at random.
PART = 2_048
#: Half width of the error interval, in standard deviations of the estimate.
WIDTH = 3.0
SEED = 29
#: Rows and queries that are estimated together, and pairs that are compared together.
_TILE_ROWS, _TILE_QUERIES, _TILE_PAIRS = 2_048, 1_024, 1 << 15


def rotation(size: int, bits: int, seed: int = SEED) -> np.ndarray:
    """A random matrix of `bits` rows and `size` orthonormal columns, the same for each seed."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, size)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


class Rotation:
    """The rotation of vectors of one length."""

    def __init__(self, size: int, seed: int = SEED) -> None:
        order = np.arange(size) if size <= PART else np.random.default_rng(seed).permutation(size)
        self._parts = np.array_split(order, math.ceil(size / PART))
        least = max(size, LEAST_BITS) if len(self._parts) == 1 else 0
        self._turns = [rotation(len(part), max(len(part), least), seed) for part in self._parts]
        self.bits = sum(len(turn) for turn in self._turns)

    def __call__(self, units: np.ndarray) -> np.ndarray:
        return np.concatenate([units[:, part].astype(np.float32) @ turn.T for part, turn in zip(self._parts, self._turns)], axis=1)


@functools.lru_cache(maxsize=4)
def rotation_of(size: int, seed: int) -> Rotation:
    return Rotation(size, seed)


def encode(vectors: np.ndarray, turn: Rotation) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, lengths, alignments and turned unit vectors.

    The alignment is the inner product of a unit vector with its signs, scaled to
    unit length; it is 1 for a vector whose turned coordinates are all of one size.
    """
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest  # so that squares neither overflow nor vanish
    unit_length = np.linalg.norm(scaled, axis=1)
    turned = turn(scaled / unit_length[:, None])
    alignment = np.abs(turned).sum(axis=1) / math.sqrt(turn.bits)
    return np.packbits(turned > 0, axis=1), unit_length * largest[:, 0], alignment.astype(np.float64), turned


def estimates(codes: np.ndarray, alignment: np.ndarray, turned_queries: np.ndarray) -> np.ndarray:
    """Estimated cosines of coded vectors (rows) with turned unit queries (columns)."""
    return _weighed_signs(codes, 1 / alignment, turned_queries.shape[1]) @ turned_queries.T


def _weighed_signs(codes: np.ndarray, weights: np.ndarray, bits: int) -> np.ndarray:
    signs = np.unpackbits(codes, axis=1, count=bits).astype(np.float32)
    signs *= 2
    signs -= 1
    signs *= (weights / math.sqrt(bits)).astype(np.float32)[:, None]
    return signs


class _Best:
    """The k best rows of each query; an id counts once, with its best score."""

    def __init__(self, queries: int, k: int) -> None:
        self.k, self.floors = k, np.full(queries, -np.inf)
        self.query, self.ids, self.scores = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self._new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._count = 0

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self._new.append((query, ids, scores))
        self._count += len(query)
        if self._count > max(1 << 16, len(self.query)):
            self.settle()

    def settle(self) -> None:
        """Keeps the best of old and new ones; a query's floor is its k-th best score."""
        query, ids, scores = (np.concatenate(x) for x in zip((self.query, self.ids, self.scores), *self._new))
        self._new, self._count = [], 0
        order = np.lexsort((-scores, ids, query))
        query, ids, scores = query[order], ids[order], scores[order]
        once = np.append(True, (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])) if len(query) else np.empty(0, bool)
        query, ids, scores = query[once], ids[once], scores[once]
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        last = rank == self.k - 1
        self.floors[query[last]] = scores[last]
        self.query, self.ids, self.scores = query[rank < self.k], ids[rank < self.k], scores[rank < self.k]


def search_block(ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, length: np.ndarray, alignment: np.ndarray,
                 query_ids: np.ndarray, queries: np.ndarray, turn: Rotation, k: int, width: float = WIDTH,
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, id, exact inner product) of the k best ids of the block for each query, best first."""
    _, query_length, _, turned = encode(queries, turn)
    best = _Best(len(queries), k)
    unit = length.max()
    share = length / unit
    # The upper bound of a row, over its own unit of length and the query's: weighed signs times query plus the error.
    error = share * (width * np.sqrt(np.maximum(0.0, 1 - alignment ** 2)) / (alignment * math.sqrt(max(1, turn.bits - 1))) + 1e-5)
    asked = np.append(turned, np.ones((len(queries), 1), np.float32), axis=1)

    def compare(query: np.ndarray, row: np.ndarray) -> None:
        """Takes in the pairs whose exact score reaches the floor."""
        for at in range(0, len(query), _TILE_PAIRS):
            q, r = query[at:at + _TILE_PAIRS], row[at:at + _TILE_PAIRS]
            products = vectors[r]
            products *= queries[q]
            near = (products.sum(axis=1) >= best.floors[q] - 1e-9 * length[r] * query_length[q]) & (ids[r] != query_ids[q])
            # Summed from left to right, so that equal vectors have equal scores in every block.
            best.add(q[near], ids[r[near]], np.cumsum(products[near], axis=1)[:, -1])

    def tiles(begin: int) -> Iterator[tuple[int, np.ndarray]]:
        part = slice(begin, begin + _TILE_ROWS)
        signs = np.append(_weighed_signs(codes[part], share[part] / alignment[part], turn.bits), error[part, None].astype(np.float32), axis=1).T
        for first in range(0, len(queries), _TILE_QUERIES):
            yield first, asked[first:first + _TILE_QUERIES] @ signs

    # A first floor for each query: the k-th best of the rows of the first tile with the best bounds.
    for first, upper in tiles(0):
        some = min(4 * k + 1, upper.shape[1])  # one more, as the query itself may be among them
        row = np.argpartition(upper, upper.shape[1] - some, axis=1)[:, upper.shape[1] - some:]
        compare(np.repeat(np.arange(first, first + len(row)), some), row.reshape(-1))
    best.settle()
    for begin in range(0, len(ids), _TILE_ROWS):
        for first, upper in tiles(begin):
            part = slice(first, first + len(upper))
            query, row = np.nonzero(upper >= (best.floors[part] / (query_length[part] * unit)).astype(np.float32)[:, None])
            compare(query + first, row + begin)
    best.settle()
    return best.query, best.ids, best.scores


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def usable(vector: str) -> Column:
    """Whether a vector is not null, empty or zero and all its components are finite numbers."""
    return F.coalesce(
        F.exists(vector, lambda x: x != 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))),
        F.lit(False))


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            seed: int = SEED, width: float = WIDTH, row_block: int | None = None, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k rows with the largest inner product for each row where `queries` holds.

    Returns query_id, rank (from 1), vec_id and score (the exact inner product in
    double precision), ties to the smaller id; rows with the query's own id are
    no candidates, and rows that repeat an id and vector count once. An id with
    several vectors asks with and is found by each of them, and is listed once,
    with its best score. Left out are null ids and vectors that are null, empty or zero or hold null or
    non-finite components. An inner product needs vectors of one length, so a query's candidates are those of its own
    length. With fewer than k candidates all are returned; without any, a query has no rows. Other columns
    don't matter. Without row_block the blocks are such that all cores have work, from 8,192 to 65,536 rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = (vectors.where(usable(vector_col) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks")))
    # Repeated rows go before rows are counted and dealt; written once for the counts and both sides of the search.
    rows = cut_lineage(rows.groupBy("id", "vector").agg(F.max("asks").alias("asks")).withColumn("size", F.size("vector")))
    # A row for each length that queries have. Different lengths add up, so of s bytes of vectors there are under sqrt(s) of them.
    counts = rows.groupBy("size").agg(F.count("*").alias("n"), F.count_if("asks").alias("asking")).where("asking > 0")
    dealt = F.least(F.lit(ROW_BLOCKS[1]), F.greatest(F.lit(ROW_BLOCKS[0]), F.ceil(F.col("n") / (2 * spark.sparkContext.defaultParallelism))))
    counts = F.broadcast(counts.select(
        "size", F.ceil(F.col("n") / (dealt if row_block is None else row_block)).alias("row_blocks"),
        F.ceil(F.col("asking") / query_block).alias("query_blocks")))
    kind = rows.schema["vector"].dataType

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                own = batch.filter(pa.array(sizes == size))
                codes, length, alignment, _ = encode(_matrix(own.column("vector")), rotation_of(int(size), seed))
                yield pa.RecordBatch.from_arrays(
                    [own.column("id"), own.column("vector"), own.column("size"), pa.array([x.tobytes() for x in codes], pa.binary()),
                     pa.array(length), pa.array(alignment)], names=["id", "vector", "size", "code", "length", "alignment"])

    def search(table: pa.Table, asked: pa.Table) -> pa.Table:
        query, ids, scores = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        if len(table) and len(asked):
            codes = np.array([np.frombuffer(x.as_py(), np.uint8) for x in table.column("code")])
            query_ids = asked.column("id").to_numpy()
            query, ids, scores = search_block(
                table.column("id").to_numpy(), _matrix(table.column("vector")), codes, table.column("length").to_numpy(),
                table.column("alignment").to_numpy(), query_ids, _matrix(asked.column("vector")),
                rotation_of(table.column("size")[0].as_py(), seed), k, width)
            query = query_ids[query]
        return pa.table({"query_id": pa.array(query), "vec_id": pa.array(ids), "score": pa.array(scores)})

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))

    schema = T.StructType([rows.schema["id"], T.StructField("vector", kind), rows.schema["size"], T.StructField("code", T.BinaryType()),
                           T.StructField("length", T.DoubleType()), T.StructField("alignment", T.DoubleType())])
    indexed = (rows.select("id", "vector", "size").mapInArrow(index, schema).join(counts, "size")
               .withColumn("row_block", F.pmod(F.xxhash64("id"), F.col("row_blocks"))).withColumn("query_block", every("query_blocks"))
               .drop("row_blocks", "query_blocks"))
    asked = (rows.where("asks").select("id", "vector", "size").join(counts, "size")
             .withColumn("query_block", F.pmod(F.xxhash64("id"), F.col("query_blocks"))).withColumn("row_block", every("row_blocks"))
             .drop("row_blocks", "query_blocks"))
    grid = ["size", "row_block", "query_block"]
    best = indexed.groupBy(*grid).cogroup(asked.groupBy(*grid)).applyInArrow(search, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def op5_one_bit_search(spark, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id and score of the 20 nearest rows of every 20th vector."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


OP5_SQL = """
WITH rows AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
    FROM rows q JOIN rows c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 20
"""
