"""Registered queries against their SQL twins, and the pipeline stage by stage against plain versions."""

import hashlib

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import brute
import corpus_pipeline
from compare import differences
from conftest import SF_DIR
from ratestar.llm import queries, toxicity
from ratestar.llm.byte_bpe import read_ranks


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, con, name):
    found = differences(con, queries.QUERIES[name](spark, SF_DIR), queries.ORACLES[name])
    assert not found, "\n".join(found[:5])


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(SF_DIR.rsplit("/", 1)[0] + "/sf0.001/documents.parquet").withColumn("extra", F.lit(1)).drop("extra")
    sf_dir = SF_DIR.rsplit("/", 1)[0] + "/sf0.001"
    before, tables = docs, {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, sf_dir).write.parquet(str(tmp_path / f"{number}"))
        after = spark.read.parquet(str(tmp_path / f"{number}"))
        tables[name] = before.collect(), after.collect()
        if name != "byte_bpe":
            assert after.columns == docs.columns
        before = after
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "substring_dedup", "decontamination", "byte_bpe"]

    given, kept = tables["toxicity"]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").collect()}
    gone = {r["doc_id"] for r in given} - {r["doc_id"] for r in kept}
    assert gone and len(gone & toxic) >= 0.8 * len(gone)

    given, kept = tables["near_duplicates"]
    want = {i for i, (_, c) in brute.components([(r["doc_id"], r["text"]) for r in given], 5, 80).items() if i == c}
    assert {r["doc_id"] for r in kept} == want and set(kept) <= set(given)

    given, kept = tables["substring_dedup"]
    after = {r["doc_id"]: r for r in kept}
    assert len(after) == len(given)
    for row, (words, cut) in zip(given, brute.removed_words([(r["doc_id"], r["text"]) for r in given], corpus_pipeline.PASSAGE)):
        text = " ".join(w for p, w in enumerate(words) if p not in cut) if cut else row["text"]
        assert after[row["doc_id"]]["text"] == text and after[row["doc_id"]]["n_chars"] == (len(text) if cut else row["n_chars"])

    given, kept = tables["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    after = {r["doc_id"]: r["text"] for r in kept}
    assert after == {r["doc_id"]: brute.hits(r["text"], items)[3] for r in given}

    given, kept = tables["byte_bpe"]
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks=read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    rows = {r["doc_id"]: r for r in kept}
    for row in given:
        assert rows[row["doc_id"]]["ids"] == encoding.encode_ordinary(row["text"])
        assert rows[row["doc_id"]]["decoded_sha256"] == hashlib.sha256(row["text"].encode()).hexdigest()


def test_no_labels_drop_no_documents(spark, tmp_path):
    sf_dir = SF_DIR.rsplit("/", 1)[0] + "/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    nobody = labels.where("toxic = 1").limit(5).withColumn("doc_id", -1 - F.col("doc_id"))
    for name, some in (("none", labels.limit(0)), ("held_out", labels.where(toxicity.held_out())), ("no_match", nobody)):
        some.write.parquet(str(tmp_path / name / "labels.parquet"))
        kept = corpus_pipeline.without_toxic(spark, docs, str(tmp_path / name))
        assert kept.count() == docs.count() and kept.exceptAll(docs).isEmpty()
    docs.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert queries.QUERIES["op1_toxicity"](spark, str(tmp_path / "none")).where("predicted = 1 OR score >= 0.5").isEmpty()


def test_different_texts_of_an_id_are_judged_each(spark):
    a, b, c = ("".join(f"{x}{i} " for i in range(40)) for x in "abc")
    rows = [(3, a, "y"), (5, a, "x"), (5, b, "x"), (7, b + "end", "x"), (8, c, "y"), (8, c, "x"), (8, b, "x"), (9, None, "x"), (9, "", "x"),
            (9, c, "x"), (None, a, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = [(3, a, "y"), (5, b, "x"), (8, c, "x"), (9, None, "x"), (None, a, "x")]
    assert sorted(map(tuple, corpus_pipeline.without_near_duplicates(spark, docs, "").collect()), key=str) == sorted(want, key=str)


def test_columns_of_any_name_and_type_come_through(spark):
    sf_dir = SF_DIR.rsplit("/", 1)[0] + "/sf0.001"
    clashing = ("n_words n_removed removed kept_text n_hit items spans clean_text id extra row number chunk bucket score component_id class_id "
                "n_shingles n_tokens ids ids_sha256 bytes toxic quality held_out label features").split()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in clashing})
    docs = docs.withColumn("a map", F.create_map(F.col("lang"), F.array("doc_id"))).withColumn("a.b", F.struct(F.lit(None).cast("int").alias("x")))
    docs = docs.unionAll(docs.limit(3)).persist()
    others = [f"`{c}`" for c in docs.columns if c not in ("text", "n_chars")]
    want = {r["doc_id"]: r for r in docs.select(*others).collect()}
    for twice in (docs, docs.unionAll(docs.where("doc_id < 5").withColumn("text", F.concat("text", F.lit(" and other words of another text here"))))):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, twice, sf_dir)
            assert found.columns == docs.columns and [t for _, t in found.dtypes] == [t for _, t in docs.dtypes], name
            rows = found.select(*others).collect()
            assert len(rows) > 20 and all(r == want[r["doc_id"]] for r in rows), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_run_keeps_each_id_once(spark):
    sf_dir = SF_DIR.rsplit("/", 1)[0] + "/sf0.001"
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.count() == found.select("doc_id").distinct().count() > 100


def test_estimates_in_the_stage_of_near_duplicates_stay_small(spark, monkeypatch):
    """Rows of copies that share a beginning: what Spark keeps of the size of written frames must not grow with their joins."""
    from ratestar.llm import components, jaccard_join

    header = " ".join(f"h{i}" for i in range(40))
    rows = [(2 * k + own, f"{'ab'[own]}{k} {header} " + " ".join(f"t{k}_{i}" for i in range(80))) for k in range(30) for own in range(2)]
    sizes, cut = [], jaccard_join.cut_lineage

    def noted(df):
        written = cut(df)
        sizes.append(written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        return written

    for module in (components, jaccard_join):
        monkeypatch.setattr(module, "cut_lineage", noted)
    kept = corpus_pipeline.without_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [2 * k for k in range(30)]
    assert len(sizes) > 5 and max(sizes) <= 2 ** 63 - 1
