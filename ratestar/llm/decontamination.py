"""Benchmark decontamination with an FM-index per training shard (operator 9).

The windows of the benchmark items are the test phrases. A task builds an
FM-index for each shard of its documents (some megabytes of whole texts), finds
all phrases by backward search through wavelet-tree ranks, locates each
occurrence by sampled suffix positions, and merges the words covered into
removal spans. Documents are never shuffled.

Only words that occur in the benchmark can be part of a phrase. So a shard's
alphabet is the benchmark's, and what is indexed are the runs of such words that
are long enough for the shortest phrase; all other text falls out before the
suffixes are sorted.

The benchmark reaches the tasks in blocks of a bounded number of words, each
its own broadcast and its own pass; a few passes are chained in one stage, and
each adds to the spans and items found before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ratestar.llm.fm_index import FmIndex
from ratestar.llm.memory import tidy_batches
from ratestar.llm.package import ship
from ratestar.llm.words import ALPHANUMERIC, Words, slices, split_words
from ratestar.session import cut_lineage

WINDOW = 10
#: Text in a shard with one index.
SHARD_BYTES = 4 << 20
#: Words of benchmark items in one broadcast (8 bytes each, and again 80 as phrases in a worker).
BLOCK_WORDS = 1 << 20
#: Words of an item that are dealt to blocks together.
ITEM_WORDS = 1 << 16
#: Passes over the documents, a block each, in one stage; between more of them the rows are written.
CHAINED = 4

_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


class Phrases:
    """The distinct windows of benchmark items as symbols of their vocabulary, with the items that have them."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int) -> None:
        self.vocabulary = np.unique(np.concatenate([np.empty(0, np.uint64), *[words for _, words in items]]))
        self.items = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.items)}
        owners: dict[bytes, set[int]] = {}
        for name, words in items:
            symbols = np.searchsorted(self.vocabulary, words) + 1
            width = min(window, len(symbols))
            for begin in range(len(symbols) - width + 1 if width else 0):
                row = np.zeros(window, dtype=np.int32)
                row[window - width:] = symbols[begin:begin + width]
                owners.setdefault(row.tobytes(), set()).add(number[name])
        self.rows = np.array([np.frombuffer(x, np.int32) for x in owners], dtype=np.int64).reshape(-1, window)
        self.lengths = (self.rows > 0).sum(axis=1)
        # Pairs (phrase, item), in the order of the phrases.
        sizes = [len(x) for x in owners.values()]
        self.first_owner = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.owners = np.array([i for x in owners.values() for i in sorted(x)], dtype=np.int64)
        # Most words of a corpus aren't in the vocabulary: a table of bits tells so without a search.
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[self.vocabulary >> np.uint64(44)] = True

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """The symbol of each word, 0 for words the benchmark lacks."""
        out = np.zeros(len(hashes), dtype=np.int64)
        maybe = np.flatnonzero(self.bits[hashes >> np.uint64(44)])
        place = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
        known = self.vocabulary[place] == hashes[maybe]
        out[maybe[known]] = place[known] + 1
        return out


def find_phrases(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, index of its first word) of all occurrences in a shard."""
    nothing = np.empty(0, dtype=np.int64)
    if not len(phrases.rows) or not len(words.starts):
        return nothing, nothing
    symbols = phrases.symbols(words.hashes())
    text_of = words.text_of()
    known = symbols > 0
    # Runs of known words within a document.
    new = known & np.concatenate([[True], ~known[:-1] | (text_of[1:] != text_of[:-1])])
    begins = np.flatnonzero(new)
    stop = ~known | np.concatenate([[True], text_of[1:] != text_of[:-1]])
    stops = np.append(np.flatnonzero(stop), len(symbols))
    ends = stops[np.searchsorted(stops, begins, side="right")]
    long_enough = ends - begins >= phrases.lengths.min()
    begins, ends = begins[long_enough], ends[long_enough]
    if not len(begins):
        return nothing, nothing
    # The runs one after the other, each with a 0 behind it.
    sizes = ends - begins + 1
    offsets = np.cumsum(sizes) - sizes
    source = np.repeat(begins - offsets, sizes) + np.arange(sizes.sum())
    text = symbols[np.minimum(source, len(symbols) - 1)]
    text[offsets + sizes - 1] = 0
    index = FmIndex(text, len(phrases.vocabulary) + 1)
    phrase, place = index.locate(*index.search(phrases.rows))
    return phrase, source[place]


def _merge(covered: np.ndarray, words: Words, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of covered words (begin, end), cut between documents."""
    change = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.empty(0, bool)
    begins = np.flatnonzero(covered & (change | ~np.concatenate([[False], covered[:-1]]))) if len(of) else np.empty(0, np.int64)
    last = np.concatenate([change[1:] | ~covered[1:], [True]]) if len(of) else np.empty(0, bool)
    return begins, np.flatnonzero(covered & last) + 1


def _without(column: pa.Array, words: Words, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Texts without the bytes from the first to the last word of each run; untouched texts as they are."""
    touched = set(np.searchsorted(words.first, begins, side="right") - 1)
    if not touched:
        return column
    raw = column.cast(pa.binary()).to_pylist()
    sizes = np.cumsum([1] + [len(x or b"") + 1 for x in raw])  # the buffer has one byte in front and after each text
    pieces = {d: [] for d in touched}
    for begin, end in zip(begins, ends):
        pieces[np.searchsorted(words.first, begin, side="right") - 1].append((words.starts[begin], words.ends[end - 1]))
    for d, cuts in pieces.items():
        kept, at = [], 0
        for a, b in cuts:
            kept.append(raw[d][at:a - sizes[d]])
            at = b - sizes[d]
        raw[d] = b"".join(kept) + raw[d][at:]
    return pa.array(raw, pa.binary()).cast(pa.string())


def _search(batch: pa.RecordBatch, phrases: Phrases) -> pa.RecordBatch:
    words = split_words(batch.column("text"), ALPHANUMERIC, lower=True)
    phrase, begin = find_phrases(words, phrases)
    of = words.text_of()
    cover = np.zeros(len(of) + 1, dtype=np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + phrases.lengths[phrase], -1)
    covered = np.cumsum(cover)[:len(of)] > 0
    for d, spans in enumerate(batch.column("spans").to_pylist()):
        for span in spans:
            covered[words.first[d] + span["begin"]:words.first[d] + span["end"]] = True
    begins, ends = _merge(covered, words, of)
    docs = of[begins]
    offsets = np.searchsorted(docs, np.arange(len(batch) + 1)).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        [pa.array((begins - words.first[docs]).astype(np.int32)), pa.array((ends - words.first[docs]).astype(np.int32))],
        names=["begin", "end"]))
    items = [set(x) for x in batch.column("items").to_pylist()]
    pairs = np.unique(np.stack([of[begin], phrase]), axis=1) if len(phrase) else np.empty((2, 0), np.int64)
    for d, p in pairs.T:
        items[d].update(phrases.items[i] for i in phrases.owners[phrases.first_owner[p]:phrases.first_owner[p + 1]])
    return pa.RecordBatch.from_arrays(
        [batch.column("id"), batch.column("extra"), batch.column("text"), pa.array(words.counts.astype(np.int64)),
         pa.array([sorted(x) for x in items], pa.list_(pa.string())), spans.cast(_SPANS)],
        names=["id", "extra", "text", "n_words", "items", "spans"])


_built: dict[int, Phrases] = {}


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int, window: int) -> Iterator[list[tuple[str, np.ndarray]]]:
    """The items' word hashes, long ones in parts, in blocks of about block_words words; a block at a time comes to the driver. At least one, if empty."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                part = batch.slice(begin, end - begin)
                words = split_words(part.column("text"), ALPHANUMERIC, lower=True)
                hashes, found = words.hashes(), []
                for item, a, b in zip(part.column("item").to_pylist(), words.first[:-1], words.first[1:]):
                    # Parts of a long item share the words of a window that begins in one of them.
                    starts = range(a, max(a + 1, b - window + 1), ITEM_WORDS) if b > a else ()
                    found += [(item, hashes[at:min(b, at + ITEM_WORDS + window - 1)]) for at in starts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item for item, _ in found], pa.string()), pa.array([len(own) for _, own in found], pa.int64()),
                     pa.array([own.tobytes() for _, own in found], pa.binary())], names=["item", "n", "words"])

    items = (benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
             .mapInArrow(split, "item string, n long, words binary"))
    total = items.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    count = math.ceil(total / block_words) or 1
    if count > 1:
        items = cut_lineage(items)
    for block in range(count):
        rows = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(count)) == block).select("item", "words")
        yield [(row["item"], np.frombuffer(row["words"], dtype=np.uint64)) for row in rows.collect()]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, carry: list[str] | None = None, clean: bool = False,
    shard_bytes: int = SHARD_BYTES, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Finds all words of documents inside an occurrence of a window of benchmark words.

    Words are runs of ASCII letters and digits and of anything beyond ASCII,
    with A-Z lower-cased. A window is `window` consecutive words of an item;
    an item with fewer, but not none, is one window. Returns the id, the columns
    to carry (without those that have a result's name), n_words, n_hit, `items`
    (ids as sorted strings of the items with occurring windows), `spans`
    (maximal runs of hit words, end excluded), and with `clean` clean_text: the
    text without the characters of each span, from its first to its last word.

    Null texts have no words, and stay null in clean_text. Rows with null or
    repeated ids are judged each by itself. An item with a null id counts under
    the empty string; items that share an id count as one. Empty tables on
    either side give no hits. Other columns of both tables don't matter.
    """
    spark = docs.sparkSession
    ship(spark)
    results = {"n_words", "n_hit", "items", "spans", "clean_text"}
    names = [c for c in carry or [] if c != id_col and c not in results]
    extra = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(0).alias("none"))
    rows = docs.select(
        F.col(id_col).alias("id"), extra.alias("extra"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<string>").alias("items"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])

    def one_pass(block) -> None:
        key = block.id

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if key not in _built:
                _built.clear()
                _built[key] = Phrases(block.value, window)
            for batch in batches:
                for begin, end in slices(batch.column("text"), shard_bytes):
                    yield _search(batch.slice(begin, end - begin), _built[key])

        return run

    chained: list[_Block] = []
    for block in _blocks(benchmark, item_col, item_text_col, block_words, window):
        if len(chained) == CHAINED:
            rows = cut_lineage(rows)
            for done in chained:
                done.destroy()
            chained = []
        chained.append(_Block(spark.sparkContext.broadcast(block)))
        del block  # the broadcast keeps it in a file
        rows = rows.mapInArrow(tidy_batches(one_pass(chained[-1])), schema)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    found = rows.withColumn("n_hit", hit)
    if clean:
        found = found.mapInArrow(tidy_batches(_clean), T.StructType([*found.schema.fields, T.StructField("clean_text", T.StringType())]))
    return found.select(F.col("id").alias(id_col), *[F.col("extra")[c].alias(c) for c in names],
                        "n_words", "n_hit", "items", "spans", *["clean_text"] * clean)


class _Block:
    """A broadcast with a number of its own, by which a worker keeps what it has built from it."""

    def __init__(self, broadcast) -> None:
        self._broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    @property
    def value(self) -> list[tuple[str, np.ndarray]]:
        return self._broadcast.value

    def destroy(self) -> None:
        """Frees it everywhere, once what was found with it is written."""
        self._broadcast.destroy()


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end in slices(batch.column("text")):
            part = batch.slice(begin, end - begin)
            words = split_words(part.column("text"), ALPHANUMERIC, lower=True)
            spans = part.column("spans").to_pylist()
            begins = np.array([words.first[d] + s["begin"] for d, own in enumerate(spans) for s in own], dtype=np.int64)
            ends = np.array([words.first[d] + s["end"] for d, own in enumerate(spans) for s in own], dtype=np.int64)
            text = _without(part.column("text"), words, begins, ends)
            yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*part.schema.names, "clean_text"])


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    found = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP9_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrases AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(10, len(w)) AS n,
           array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS p FROM items WHERE len(w) > 0)),
starts AS (
    SELECT row, p, n, array_to_string(w[p:p + n - 1], ' ') AS phrase
    FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)),
hits AS (SELECT row, p, n, item FROM starts JOIN phrases USING (n, phrase)),
hit_words AS (
    SELECT row, count(DISTINCT p + o) AS n_hit
    FROM (SELECT row, p, unnest(range(0, n)) AS o FROM (SELECT DISTINCT row, p, n FROM hits)) GROUP BY row),
hit_items AS (
    SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (row) LEFT JOIN hit_items USING (row)
"""
