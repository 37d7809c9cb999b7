"""Phrase collocations by dynamic itemset counting (operator 11).

The corpus is written once as shards of lower-cased blocks of one language. A scan goes
over the shards in turn, again and again. Words are counted from the first shard on; a
longer phrase is active from the step after both of its subphrases (all words but the
last, all but the first) have reached the threshold, so phrases of all lengths are counted
side by side, and it stays active for one full cycle, so that each shard has been counted
for it exactly once. The scan ends when no phrase is in its cycle.

What a scan knows is a sketch: a byte array of bounded size with the step in which a slot
was first taken by a phrase that had reached the threshold. A phrase has two slots, and
counts as having reached it in the later of both steps, and not before the first step it is active in. Where slots
are shared, phrases are counted that need not be, each over one full cycle all the same, so results do not depend
on the size of the sketch.

Chunks of blocks send their distinct active phrases as packed hashes with counts to
buckets of hashes (see `chunks`), so a phrase that a third of the corpus holds weighs as much
as there are chunks. A bucket's counters are a row of a table that each step writes
anew; those that missed the threshold in their cycle are dropped from it. Each counter knows one block that
holds its phrase; in the end these blocks give the texts of the frequent phrases, and scores are joins of those.

Phrases are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ratestar.llm import chunks
from ratestar.llm.memory import tidy_batches, tidy_cogroup, tidy_group
from ratestar.llm.package import ship
from ratestar.llm.words import Words, byte_class, mix, slices, split_words
from ratestar.session import scratch_folder

THRESHOLD = 100
LONGEST = 5
SHARDS = 4
#: Bytes of a block, about.
BLOCK_BYTES = 2 << 20
#: The sketch has a slot for so many bytes of text, within these powers of two.
BYTES_PER_SLOT = 64
SLOT_BITS = (16, 27)
#: Parts of a language's phrases that are ranked apart first.
SALTS = 64

_NEVER = 255
_U = np.uint64
_RANGE_BITS = 16

_NO_WORD = byte_class((0x20, 0x20), *((ord(c),) * 2 for c in "\t.,;:!?"), (0x0A, 0x0D))
_ENDS_PIECE = ~byte_class(*((ord(c),) * 2 for c in ".,;:!?"), (0x0A, 0x0D))

_COUNTERS = "bucket long, langs array<string>, blocks array<long>, hashes binary, counts binary, tags binary, sources binary, since binary"
_BLOCKS = "block long, lang string, n_words long, data binary, shard long"


# Blocks


def _block_bytes(texts: pa.Array) -> tuple[bytes, int]:
    """Lower-cased words, one space between those of a piece and a line feed behind each piece, and the number of words."""
    words = split_words(texts, _NO_WORD, lower=True)
    buffer = words.buffer.copy()
    if not len(words.starts):
        return b"", 0
    borders = np.cumsum(_ENDS_PIECE[buffer])
    new_piece = np.append(borders[words.starts[1:]] != borders[words.ends[:-1] - 1], True)
    buffer[words.ends] = np.where(new_piece, 0x0A, 0x20)
    marks = np.zeros(len(buffer) + 1, dtype=np.int8)
    marks[words.starts] += 1
    marks[words.ends + 1] -= 1
    return buffer[np.cumsum(marks[:-1], dtype=np.int8).astype(bool)].tobytes(), len(words.starts)


def write_blocks(docs: DataFrame, folder: str, lang_col: str, text_col: str, shards: int) -> None:
    """Writes numbered blocks (block, shard, lang, n_words, data) of all texts, each of which ends with a piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b in slices(batch.column("text"), BLOCK_BYTES):
                langs = batch.column("lang").slice(a, b - a).to_pylist()
                rows = []
                for lang in sorted(set(langs)):
                    own = pa.array([i for i, x in enumerate(langs, a) if x == lang])
                    data, n = _block_bytes(batch.column("text").take(own))
                    begin = 0
                    while begin < len(data):
                        end = data.find(b"\n", begin + BLOCK_BYTES) + 1 or len(data)
                        part = data[begin:end]
                        rows.append((task << 32 | number, (task + number) % shards, lang, n if len(part) == len(data) else part.count(b" ") + part.count(b"\n"), part))
                        number, begin = number + 1, end
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["block", "shard", "lang", "n_words", "data"])

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    (rows.mapInArrow(tidy_batches(run), "block long, shard long, lang string, n_words long, data binary")
     .write.partitionBy("shard").parquet(folder))


class _Phrases:
    """The words of a block and, for each length, the places where a phrase may stand whose subphrases have reached the threshold."""

    def __init__(self, lang: str, data: bytes, sketch: np.ndarray) -> None:
        self.buffer = np.frombuffer(b"\n" + data + b"\n" * 8, np.uint8)
        apart = (self.buffer == 0x20) | (self.buffer == 0x0A)
        self.starts = np.flatnonzero(apart[:-1] & ~apart[1:]) + 1
        self.ends = np.flatnonzero(~apart[:-1] & apart[1:]) + 1
        self._words = Words(self.buffer, self.starts, self.ends, np.array([0, len(self.starts)])).hashes(xxhash.xxh3_64_intdigest(lang.encode()))
        self._same = self.buffer[self.ends[:-1]] == 0x20  # the next word is in the same piece
        self._sketch = sketch

    def steps(self, hashes: np.ndarray) -> np.ndarray:
        """The step in which each phrase is taken to have reached the threshold."""
        first, second = slots(hashes, len(self._sketch))
        return np.maximum(self._sketch[first], self._sketch[second])

    def lengths(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, places, hashes, step in which both subphrases had reached the threshold or -1 for words)."""
        places = np.arange(len(self._words))
        hashes = self._words
        before = np.full(len(places), -1, dtype=np.int64)
        for length in range(1, longest + 1):
            yield length, places, hashes, before
            if length == longest or not len(places):
                return
            reached = np.full(len(self._words) + 1, _NEVER, dtype=np.int64)
            steps = self.steps(hashes)
            # Slots that others took earlier make no phrase reach the threshold before it is counted.
            reached[places] = np.where(steps == _NEVER, _NEVER, np.maximum(steps, before + 1))
            both = (reached[places] != _NEVER) & (reached[places + 1] != _NEVER)
            if length == 1:
                both[:-1] &= self._same
            places, hashes = places[both], hashes[both]
            before = np.maximum(reached[places], reached[places + 1])
            hashes = mix(hashes * _U(0x9E3779B97F4A7C15) + self._words[places + length])


def slots(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    return hashes & _U(size - 1), hashes >> _U(32) & _U(size - 1)


# Counting


def _messages(blocks: list[tuple[int, str, bytes]], step: int, shards: int, longest: int, sketch: np.ndarray, buckets: int) -> list[tuple]:
    """A chunk's active phrases with their counts and a block that holds each, a row for each bucket."""
    langs, numbers = sorted({lang for _, lang, _ in blocks}), [number for number, _, _ in blocks]
    hashes, tags, sources = [], [], []
    for place, (_, lang, data) in enumerate(blocks):
        for length, _, own, before in _Phrases(lang, data, sketch).lengths(longest):
            # Active from before + 1 to before + shards.
            own = own[(before < step) & (before + shards >= step)]
            hashes.append(own)
            tags.append(np.full(len(own), langs.index(lang) << 3 | length, dtype=np.int64))
            sources.append(np.full(len(own), place, dtype=np.int64))
    hashes, tags, sources = np.concatenate(hashes), np.concatenate(tags), np.concatenate(sources)
    order = np.argsort(hashes)
    edges = chunks.group_starts(hashes[order])
    counts = np.diff(np.append(edges, len(hashes)))
    first = order[edges]
    hashes, tags, sources = hashes[first], tags[first], sources[first]
    return [(bucket, langs, numbers, chunks.pack_sorted(hashes[a:b]), chunks.pack(counts[a:b]), chunks.pack(tags[a:b]), chunks.pack(sources[a:b]), None)
            for bucket, a, b in chunks.bucket_ranges(hashes, buckets)]


def _merge(table: pa.Table, step: int, shards: int, threshold: int) -> pa.Table:
    """A bucket's counters after a step, and the phrases that have just reached the threshold."""
    langs: dict[str, int] = {}
    parts = []
    for row in table.to_pylist():
        hashes = chunks.unpack_sorted(row["hashes"])
        number = np.array([langs.setdefault(lang, len(langs)) for lang in row["langs"]], dtype=np.int64)
        tags = chunks.unpack(row["tags"]).astype(np.int64)
        since = np.full(len(hashes), step) if row["since"] is None else chunks.unpack(row["since"]).astype(np.int64)
        parts.append((hashes, chunks.unpack(row["counts"]).astype(np.int64), number[tags >> 3] << 3 | tags & 7,
                      np.array(row["blocks"], dtype=np.int64)[chunks.unpack(row["sources"])], since, np.full(len(hashes), row["since"] is not None)))
    hashes, counts, tags, sources, since, known = map(np.concatenate, zip(*parts))
    order = np.argsort(hashes, kind="stable")
    edges = chunks.group_starts(hashes[order])
    total = np.add.reduceat(counts[order], edges)
    old = np.add.reduceat((counts * known)[order], edges)
    since = np.minimum.reduceat(since[order], edges)
    hashes, tags, sources = hashes[order][edges], tags[order][edges], np.minimum.reduceat(sources[order], edges)
    fresh = (total >= threshold) & (old < threshold)
    # Counted since `since` at the latest: after a cycle a phrase below the threshold stays below.
    keep = (total >= threshold) | (step < since + shards - 1)
    blocks, sources = np.unique(sources[keep], return_inverse=True)
    return pa.table({
        "bucket": pa.array(table.column("bucket").to_pylist()[:1], pa.int64()), "langs": pa.array([list(langs)], pa.list_(pa.string())),
        "blocks": pa.array([blocks.tolist()], pa.list_(pa.int64())), "hashes": chunks.binary([chunks.pack_sorted(hashes[keep])]), "counts": chunks.binary([chunks.pack(total[keep])]),
        "tags": chunks.binary([chunks.pack(tags[keep])]), "sources": chunks.binary([chunks.pack(sources)]), "since": chunks.binary([chunks.pack(since[keep])]),
        "fresh": chunks.binary([chunks.pack_sorted(hashes[fresh])]),
        "n_extendable": pa.array([int((fresh & (tags & 7 < LONGEST)).sum())], pa.int64())})


def _in_chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[list[tuple[int, str, bytes]]]:
    held, size = [], 0
    for batch in batches:
        for number, lang, data in zip(*(batch.column(c).to_pylist() for c in ("block", "lang", "data"))):
            held.append((number, lang, data))
            size += len(data)
            if size >= chunk_bytes:
                yield held
                held, size = [], 0
    if held:
        yield held


def _taken_slots(counters: DataFrame, size: int) -> np.ndarray:
    """True for the slots of phrases that have just reached the threshold: a bit a slot comes to the driver."""
    ranges = min(size, 1 << _RANGE_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken = np.zeros(size, dtype=bool)
        for batch in batches:
            for fresh in batch.column("fresh").to_pylist():
                for own in slots(chunks.unpack_sorted(fresh), size):
                    taken[own] = True
        parts = taken.reshape(-1, ranges)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some), chunks.binary([np.packbits(parts[i]).tobytes() for i in some])], names=["part", "bits"])

    def either(table: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in table.column("bits").to_pylist()])
        return pa.table({"part": table.column("part").slice(0, 1), "bits": chunks.binary([bits.tobytes()])})

    out = np.zeros((size // ranges, ranges), dtype=bool)
    rows = counters.select("fresh").mapInArrow(tidy_batches(run), "part long, bits binary").groupBy("part").applyInArrow(either, "part long, bits binary")
    for row in rows.collect():
        out[row["part"]] = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
    return out.reshape(-1)


def count_phrases(blocks_folder: str, folder: str, spark: SparkSession, size: int, threshold: int, longest: int, shards: int,
                  slot_bits: int | None = None) -> tuple[str, np.ndarray]:
    """The last table of counters, and the sketch of all frequent phrases."""
    bits = slot_bits or min(max(SLOT_BITS[0], math.ceil(math.log2(max(1, size / BYTES_PER_SLOT)))), SLOT_BITS[1])
    sketch = np.full(1 << max(bits, 3), _NEVER, dtype=np.uint8)
    chunk_bytes, bucket_bytes = chunks.fitting(size)
    buckets = chunks.bucket_count(size, bucket_bytes)
    before, step, last_reached = "", 0, -1
    names = ["bucket", "langs", "blocks", "hashes", "counts", "tags", "sources", "since"]
    blocks = spark.read.schema(_BLOCKS).parquet(blocks_folder)
    while step <= last_reached + shards:
        shared = spark.sparkContext.broadcast(sketch)

        def send(batches: Iterator[pa.RecordBatch], step: int = step, shared=shared) -> Iterator[pa.RecordBatch]:
            for chunk in _in_chunks(batches, chunk_bytes):
                rows = _messages(chunk, step, shards, longest, shared.value, buckets)
                if rows:
                    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), *[pa.binary()] * 5))]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        def merge(table: pa.Table, step: int = step) -> pa.Table:
            return _merge(table, step, shards, threshold)

        found = blocks.where(F.col("shard") == step % shards).select("block", "lang", "data").mapInArrow(tidy_batches(send), _COUNTERS)
        if before:
            found = spark.read.parquet(before).select(*found.columns).unionAll(found)
        after = f"{folder}/counters-{step}"
        found.groupBy("bucket").applyInArrow(tidy_group(merge), f"{_COUNTERS}, fresh binary, n_extendable long").write.parquet(after)
        shared.destroy()
        counters = spark.read.parquet(after)
        if counters.agg(F.sum("n_extendable").alias("n")).first()["n"]:
            last_reached = step
        sketch[_taken_slots(counters, len(sketch)) & (sketch == _NEVER)] = step
        if before:
            _delete(spark, before)
        before, step = after, step + 1
    return before, sketch


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Frequent phrases and their scores


def _frequent(counters: DataFrame, threshold: int) -> DataFrame:
    """(lang, length, hash, f), a row for each frequent phrase."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = chunks.unpack(row["counts"]).astype(np.int64)
                own = np.flatnonzero(counts >= threshold)
                tags = chunks.unpack(row["tags"]).astype(np.int64)[own]
                langs = pa.array(row["langs"], pa.string()).take(pa.array(tags >> 3))
                hashes = chunks.unpack_sorted(row["hashes"])[own].view(np.int64)
                yield pa.RecordBatch.from_arrays([langs, pa.array((tags & 7).astype(np.int32)), pa.array(hashes), pa.array(counts[own])],
                                                 names=["lang", "length", "hash", "f"])

    return counters.select("langs", "hashes", "counts", "tags").mapInArrow(tidy_batches(run), "lang string, length int, hash long, f long")


def _texts(blocks: DataFrame, counters: DataFrame, sketch, threshold: int, longest: int) -> DataFrame:
    """(hash, phrase) of all frequent phrases, each from the block that its counter names."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = chunks.unpack(row["counts"]) >= threshold
                sources = chunks.unpack(row["sources"])[own]
                order = np.argsort(sources, kind="stable")
                edges = chunks.group_starts(sources[order])
                parts = np.split(chunks.unpack_sorted(row["hashes"])[own][order], edges[1:]) if len(order) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(row["blocks"], dtype=np.int64)[sources[order][edges]]), chunks.binary([chunks.pack_sorted(x) for x in parts])],
                    names=["block", "hashes"])

    def answer(block: pa.Table, asked: pa.Table) -> pa.Table:
        hashes_out, texts_out = [np.empty(0, _U)], []
        if len(block) and len(asked):
            wanted = np.sort(np.concatenate([chunks.unpack_sorted(x.as_py()) for x in asked.column("hashes")]))
            data = block.column("data")[0].as_py()
            phrases = _Phrases(block.column("lang")[0].as_py(), data, sketch.value)
            for length, places, hashes, _ in phrases.lengths(longest):
                new, first = np.unique(hashes, return_index=True)
                there = np.searchsorted(wanted, new)
                found = np.append(wanted, _U(0))[there] == new
                first = places[first[found & (there < len(wanted))]]
                hashes_out.append(new[found & (there < len(wanted))])
                texts_out += [data[a:b] for a, b in zip((phrases.starts[first] - 1).tolist(), (phrases.ends[first + length - 1] - 1).tolist())]
        return pa.table({"hash": pa.array(np.concatenate(hashes_out).view(np.int64)), "phrase": pa.array(texts_out, pa.binary()).cast(pa.string())})

    asked = counters.select("blocks", "hashes", "counts", "sources").mapInArrow(tidy_batches(ask), "block long, hashes binary")
    some = blocks.select("block", "lang", "data").join(asked.select("block").distinct(), "block", "left_semi")
    return some.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(tidy_cogroup(answer), "hash long, phrase string")


def mine_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", threshold: int = THRESHOLD, longest: int = LONGEST,
                 contained_percent: int = 100, top: int | None = 2000, shards: int = SHARDS, slot_bits: int | None = None) -> DataFrame:
    """Phrases of two to `longest` words that occur at least `threshold` times in a language, by how much more often than by chance.

    A-Z are lower-cased, texts are cut at `.,;:!?` and line ends into pieces, pieces at
    blanks and tabs into words. With n words in a language and f occurrences of a phrase,
    a phrase of frequency a cut into parts of frequencies l and r scores
    floor(1000*a*n/(l*r)); the cut of the lowest score counts, the first of equals.
    A phrase within a longer frequent one that occurs contained_percent of its times is left out. Returns each
    language's first `top` (None: all) by score, a (both descending) and phrase: lang, rank, phrase, a, l, r, n, score.

    A null lang is `und`, a null text has no words; rows that repeat count each;
    ids and other columns don't matter. Empty tables and rare phrases give no rows. longest is 7 at most.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = scratch_folder(spark, "phrases")
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    write_blocks(rows, f"{folder}/blocks", "lang", "text", shards)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    size = blocks.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0)).alias("size")).first()["size"]
    counters, sketch = count_phrases(f"{folder}/blocks", folder, spark, size, threshold, longest, shards, slot_bits)
    counters = spark.read.parquet(counters)
    texts = _texts(blocks, counters, spark.sparkContext.broadcast(sketch), threshold, longest)
    _frequent(counters, threshold).join(texts, "hash").select("lang", "length", "phrase", "f").write.parquet(f"{folder}/frequent")
    totals = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return score_phrases(spark.read.parquet(f"{folder}/frequent"), totals, contained_percent, top)


def score_phrases(frequent: DataFrame, totals: DataFrame, contained_percent: int = 100, top: int | None = 2000) -> DataFrame:
    """The result of mine_phrases from (lang, length, phrase, f) of all frequent phrases and words, and (lang, n).

    Numbers are 64-bit, products have up to 38 digits and beyond them raise an error.
    """
    words = F.split("phrase", " ")
    # A phrase occurs at most as often as those between it and a longer one, so those of one more word tell.
    longer = (frequent.where("length > 2").select("lang", "f", F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("length") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("length") - 1), " "))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("within")))
    candidates = (frequent.where("length > 1").join(longer, ["lang", "phrase"], "left")
                  .where(F.coalesce(100 * F.col("within") < contained_percent * F.col("f"), F.lit(True)))
                  .select("lang", "phrase", F.col("f").alias("a"), words.alias("words"), "length"))
    cuts = candidates.select("lang", "phrase", "a", "words", "length", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.col("length") - F.col("cut")), " ").alias("right"))
    part = lambda name, f: frequent.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    score = F.expr("(CAST(a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0)) * 1000BD) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    scored = (cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(totals, "lang")
              .withColumn("score", score).groupBy("lang", "phrase", "a", "n")
              .agg(F.min(F.struct("score", "cut", "l", "r")).alias("least"))
              .select("lang", "phrase", "a", "least.l", "least.r", "n", "least.score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    if top is not None:
        salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        scored = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.lit(True) if top is None else F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's 2,000 strongest phrases in documents."""
    return mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT lang, unnest(regexp_split_to_array(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
frequent AS (
    SELECT lang, k, phrase, count(*) AS f
    FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
                FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k))
    GROUP BY ALL HAVING count(*) >= 100),
parts AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM frequent WHERE k > 1),
within AS (
    SELECT DISTINCT short.lang, short.phrase
    FROM parts AS long JOIN parts AS short ON short.lang = long.lang AND short.k < long.k
         AND contains(' ' || long.phrase || ' ', ' ' || short.phrase || ' ') AND 100 * long.f >= 100 * short.f),
cuts AS (
    SELECT lang, phrase, f AS a, cut, array_to_string(w[1:cut], ' ') AS part1, array_to_string(w[cut + 1:], ' ') AS part2
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM parts) ANTI JOIN within USING (lang, phrase)),
scored AS (
    SELECT cuts.lang, cuts.phrase, a, p1.f AS l, p2.f AS r, n, cut,
           CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(p1.f AS HUGEINT) * p2.f) AS BIGINT) AS score
    FROM cuts JOIN frequent AS p1 ON p1.lang = cuts.lang AND p1.phrase = part1
         JOIN frequent AS p2 ON p2.lang = cuts.lang AND p2.phrase = part2 JOIN totals ON totals.lang = cuts.lang),
least AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
