"""Language identification by compression with per-language zstandard dictionaries (operator 4).

Each language is known by a raw-content dictionary: a bounded sample of its
texts. A text is compressed with each dictionary, and belongs to the language
whose dictionary leaves the fewest bytes. The margin to the next language, in
bytes per character, says how sure that is; where it is narrow the text is rejected.

Texts are encoded as lower-case words of letters, so that capitals, digits and
marks, which no language owns, weigh nothing. A text is compressed in pieces, and the sizes of its pieces are added, so that
whole texts of any length are used with bounded memory. Scoring is a map over
Arrow batches; only the dictionaries, a few hundred kilobytes, are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ratestar.llm.package import ship

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """Parameters. The sample of a language holds at most sample_rows texts and dictionary_bytes bytes."""

    dictionary_bytes: int = 96 << 10
    sample_rows: int = 2_000
    text_bytes: int = 512
    level: int = 6
    short_level: int = 19
    short_bytes: int = 256
    piece_bytes: int = 2 << 10
    margin: float = 0.005


@dataclass
class Model:
    """Languages, most frequent first, with their dictionaries' content."""

    settings: Settings
    content: dict[str, bytes]
    _built: dict = field(default_factory=dict)

    def compressors(self, level: int) -> list[zstandard.ZstdCompressor]:
        if level not in self._built:
            made = []
            for content in self.content.values():
                dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                dictionary.precompute_compress(level=level)
                made.append(zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=False, write_checksum=False))
            self._built[level] = made
        return self._built[level]

    def __getstate__(self):
        return self.settings, self.content

    def __setstate__(self, state):
        self.settings, self.content = state
        self._built = {}

    def sizes(self, text: bytes) -> np.ndarray:
        """Compressed bytes of a text with each language's dictionary."""
        s = self.settings
        level = s.short_level if len(text) <= s.short_bytes else s.level
        own = self.compressors(level)
        return np.array([sum(len(c.compress(text[at:at + s.piece_bytes])) for at in range(0, len(text), s.piece_bytes)) for c in own])


_NO_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]*\p{N}[\p{L}\p{M}\p{N}]*|[^\p{L}\p{M}]+")


def encoded(text: str) -> bytes:
    """Lower-case words of letters, with one space before, between and behind; words with digits are left out."""
    return (" " + " ".join(_NO_WORD.sub(" ", text.lower()).split()) + " ").encode()


def has_letter(column: str) -> Column:
    """Whether a text holds a letter of any script; false for null."""
    return F.coalesce(F.col(column).rlike(r"\p{L}"), F.lit(False))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of the id as text, mod 5, is 0. Null ids are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()) -> Model:
    """Dictionaries from texts with a non-null language.

    Of each language at most settings.sample_rows texts are taken, those with the
    smallest hash of their content, and of each at most settings.text_bytes
    bytes from a place within it; together at most settings.dictionary_bytes of a
    language. Texts without letters are left out, equal ones count once. A
    language is learnt if any text is left; without any the model knows none.
    The sample is at most some hundred kilobytes a language and comes to the driver.
    """
    spark = labelled.sparkSession
    ship(spark)
    rows = (labelled.where(F.col(lang_col).isNotNull() & has_letter(text_col))
            .select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(text_col).alias("place"), F.col(text_col).alias("text")))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("place").alias("n"))
    # A threshold on the hash keeps about twice the rows wanted; the exact cut comes after it, on few rows.
    low = F.pmod("place", F.lit(1 << 30))
    near = rows.join(F.broadcast(counts), "lang").where(low * F.col("n") <= F.lit(2.0 * settings.sample_rows * (1 << 30)))
    # Where the excerpt begins depends on the text alone.
    length = F.length("text")
    begin = (F.pmod(F.shiftright("place", 20), F.greatest(length - settings.text_bytes, F.lit(1)))).cast("int")
    excerpts = near.select("lang", low.alias("low"), F.substring("text", begin + 1, F.lit(settings.text_bytes)).alias("text")).distinct()
    wanted = settings.dictionary_bytes // 64
    chosen = (excerpts.groupBy("lang", F.pmod("low", F.lit(16)).alias("part"))
              .agg(F.slice(F.array_sort(F.collect_list(F.struct("low", "text"))), 1, min(wanted, settings.sample_rows) // 16 + 1).alias("some")))
    found: dict[str, list[tuple[int, str]]] = {}
    for row in chosen.collect():
        found.setdefault(row["lang"], []).extend((x["low"], x["text"]) for x in row["some"])
    content = {}
    rows_of = {row["lang"]: row["n"] for row in counts.collect()}
    for lang in sorted(found, key=lambda x: (-rows_of[x], x)):
        joined = b"".join(encoded(text) for _, text in sorted(found[lang]))[:settings.dictionary_bytes]
        content[lang] = joined.rjust(8, b" ")  # zstandard takes no shorter dictionary
    return Model(settings, content)


_models: dict[int, Model] = {}


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds lang_pred, score and rejected for every whole text.

    score is the winner's share of 1 among the languages' scores, which fall by
    half for each byte of the compressed size more (for texts of up to 64 bytes;
    longer texts are scaled to that length); margin is the difference in
    compressed bytes per byte of text between the best two languages, and
    rejected is true where it is under settings.margin. Texts that are null or
    have no letter are `und` with score 0 and rejected, and so are all texts if
    the model knows no language; with one language the score is 1. Equal sizes
    go to the language with more texts in learning and are rejected. Other columns stay; those with a
    result's name are replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    key = shared._jbroadcast.id()
    results = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
               T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    keep = [f for f in docs.schema if f.name not in {r.name for r in results}]
    letter = regex.compile(r"\p{L}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _models:
            _models.clear()
            _models[key] = shared.value
        known, codes = _models[key], list(_models[key].content)
        for batch in batches:
            rows = [_judge(known, codes, letter, x.as_py()) for x in batch.column(batch.schema.get_field_index(text_col))]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays(kept + columns, names=[f.name for f in [*keep, *results]])

    return docs.mapInArrow(run, T.StructType(keep + results))


def _judge(model: Model, codes: list[str], letter: regex.Pattern, text: str | None) -> tuple[str, float, float, bool]:
    if not codes or not text or not letter.search(text):
        return UNDETERMINED, 0.0, 0.0, True
    data = encoded(text)
    sizes = model.sizes(data)
    best = int(np.argmin(sizes))
    if len(codes) == 1:
        return codes[0], 1.0, 1.0, False
    margin = float(np.partition(sizes, 1)[1] - sizes[best]) / len(data)
    score = 1.0 / float(np.exp2((sizes[best] - sizes) * min(1.0, 64 / len(data))).sum())
    return codes[best], score, margin, margin < model.settings.margin


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
