"""A training corpus from the documents table in five stages, each over all rows that the one before kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ratestar.llm import byte_bpe, decontamination, jaccard_join, substring_dedup, toxicity
from ratestar.session import cut_lineage, scratch_folder

#: Near-duplicates: shingles of so many words, Jaccard similarity in percent.
SHINGLE, PERCENT = 5, 80
#: Passages of so many words that an earlier document has too are removed.
PASSAGE = 50


def _bundled(docs: DataFrame) -> tuple[DataFrame, str]:
    """doc_id, text and a struct of all other columns under a new name, so that no name clashes with a result's."""
    name = f"row_{uuid.uuid4().hex}"
    return docs.select("doc_id", "text", _others(docs).alias(name)), name


def _others(docs: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(None).alias("none")])


def _documents(found: DataFrame, docs: DataFrame, row: str, text: str, changed: Column) -> DataFrame:
    """The columns of documents with a new text; n_chars follows where it changed."""
    columns = [F.col("doc_id") if c == "doc_id" else F.col(text).alias(c) if c == "text" else
               F.when(changed, F.length(text).cast(docs.schema[c].dataType)).otherwise(F.col(row)[c]).alias(c) if c == "n_chars" else F.col(row)[c].alias(c)
               for c in docs.columns]
    return found.select(*columns)


def _order(docs: DataFrame, row: Column) -> Column:
    """Rows in the order of their columns; values that have none, such as maps, by their text form."""
    def sortable(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return sortable(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(sortable(f.dataType) for f in kind)
        return not isinstance(kind, (T.MapType, T.VariantType))

    return F.struct(*[row[f.name] if sortable(f.dataType) else F.to_json(F.struct(row[f.name])) for f in docs.schema])


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5; learnt from the labels table. Without labels to learn from all stay."""
    model = toxicity.learn_from_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = f"score_{uuid.uuid4().hex}"
    rows, row = _bundled(docs)
    kept = toxicity.score(rows, model, score_col=score).where(F.col(score) < 0.5)
    return kept.select(*[F.col(c) if c in ("doc_id", "text") else F.col(row)[c].alias(c) for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-duplicates.

    Of rows that repeat an id and a text one stays, the smallest in the order of
    their other columns; of an id's texts without words one. Different texts of
    one id are documents of their own, each with its own near-duplicates. Rows
    without an id stay. Columns may have any name and type, maps too.
    """
    known = docs.where("doc_id IS NOT NULL")
    digest = F.xxhash64("text")
    several = known.groupBy("doc_id").agg(F.min(digest).alias("least"), F.max(digest).alias("most")).where("least <> most")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    if several.isEmpty():
        found = jaccard_join.jaccard_components(docs, width=SHINGLE, percent=PERCENT)
        kept = found.where("doc_id = component_id").select("doc_id")
        rows = docs.join(kept, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), whole.alias("row"))
        one = rows.groupBy("id").agg(F.min_by("row", _order(docs, F.col("row"))).alias("row")).select(*[F.col("row")[c].alias(c) for c in docs.columns])
    else:
        # The join takes rows of one id for one node, so here each row gets a number of its own.
        rows = cut_lineage(known.select(F.monotonically_increasing_id().alias("number"), whole.alias("row")))
        found = jaccard_join.jaccard_components(rows.select("number", F.col("row.text").alias("text")), "number", width=SHINGLE, percent=PERCENT)
        wordless = F.when(F.col("n_shingles") == 0, F.col("row.doc_id"))
        group = F.when(F.col("n_shingles") > 0, F.col("component_id"))
        # Of a group the smallest id stays, whatever the number of its row.
        first = F.struct(F.col("row.doc_id").alias("doc_id"), _order(docs, F.col("row")).alias("others"))
        one = (rows.join(found, "number").groupBy(group.alias("group"), wordless.alias("wordless")).agg(F.min_by("row", first).alias("row"))
               .select(*[F.col("row")[c].alias(c) for c in docs.columns]))
    return one.unionByName(docs.where("doc_id IS NULL"))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; words in passages that a document with a smaller id has too are removed from the text."""
    rows, row = _bundled(docs)
    found = substring_dedup.remove_repeated_windows(rows, window=PASSAGE, carry=[row], as_is=True)
    return _documents(found, docs, row, "kept_text", F.col("n_removed") > 0)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; passages of the benchmark table are removed from the text."""
    rows, row = _bundled(docs)
    found = decontamination.decontaminate(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=[row], clean=True)
    return _documents(found, docs, row, "clean_text", F.col("n_hit") > 0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text with their number, and digests of the ids and of the bytes they decode to."""
    return byte_bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                               public_tokenizers.PATTERN, keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("substring_dedup", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("byte_bpe", tokens),
]

#: Toxicity scores and token ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again as the next input.

    The folder with the results goes when the application ends.
    """
    folder = scratch_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
