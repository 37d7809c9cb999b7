"""Toxicity, Jaccard join, language, substring dedup, decontamination and byte-level BPE on small and odd tables."""

import dataclasses
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
import zstandard
from pyspark.sql import functions as F

import brute
from conftest import SF_DIR
from ratestar.llm import byte_bpe, decontamination, jaccard_join, language_id, substring_dedup, toxicity
from ratestar.llm.words import mix, split_words

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Null and repeated ids, null, empty and wordless texts, repeated rows, columns with names used inside.
ODD = [(1, "a b c d e f g h i j k l m n o p", "x"), (2, None, "x"), (3, "", None), (4, " \n\t ", "x"), (5, "A b C d e f g h i j k l m n o p", "x"),
       (6, "one", "x"), (7, "ONE", None), (None, "a b c d e f g h i j k l m n o p", "x"), (None, None, None), (8, "é " * 3000 + "end", "x"),
       (9, "é " * 3000 + "end", "x"), (9, "é " * 3000 + "end", "x"), (0, "e f g h i j k l m n o p q", "x"), (10, "w" * 5000, "x")]


def frame(spark, rows):
    """With columns that carry the names of results and of inner columns."""
    df = spark.createDataFrame(rows, "doc_id long, text string, id string")
    for name in ("chunk", "bucket", "extra", "n_words", "items", "spans", "score", "label", "hashes", "component_id", "n_shingles", "removed", "ids"):
        df = df.withColumn(name, F.lit("other"))
    return df


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


# Jaccard join

def as_dict(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect() if r["doc_id"] is not None}


def test_components_of_odd_rows(odd, nothing):
    found = jaccard_join.jaccard_components(odd)
    rows = found.collect()
    assert len(rows) == len(ODD)
    want = brute.components(list({i: t for i, t, _ in ODD if i is not None}.items()))
    assert as_dict(found) == want
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None, None]
    assert want[5] == (13, 1) and want[7] == (1, 6) and want[3] == (0, 3) and want[9][1] == 8
    assert jaccard_join.jaccard_components(nothing).count() == 0


def test_an_id_with_different_texts_is_one_node(spark):
    a, b, c = ("".join(f"{x}{i} " for i in range(20)) for x in "abc")
    rows = [(3, a, ""), (5, a, ""), (5, b, ""), (7, b, ""), (8, c, ""), (9, c, ""), (9, None, ""), (6, "x", ""), (6, "y", ""), (2, "y", "")]
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_components(frame(spark, rows)).collect())
    assert got == sorted([(3, 3), (5, 3), (5, 3), (7, 3), (8, 8), (9, 8), (9, 8), (6, 2), (6, 2), (2, 2)])


def family(rng, fam, docs):
    base = [f"w{fam}_{i}" for i in range(rng.choice([9, 14, 30, 60, 120]))]
    for _ in range(50):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4])):
            i = rng.randrange(len(words))
            words[i:i + 1] = rng.choice([[f"x{rng.randrange(40)}"], [], [f"y{rng.randrange(10 ** 6)}", words[i]]])
        docs.append((len(docs) * 7 % 251, " ".join(words), "x"))


@pytest.mark.parametrize("seed, settings", [
    (1, {}), (2, {"frequent": 1}), (3, {"combined": 20, "frequent": 3}), (4, {"chunk_bytes": 3000, "bucket_bytes": 5000}),
    (5, {"width": 5, "percent": 80}), (6, {"width": 2, "percent": 60})])
def test_components_of_families(spark, seed, settings):
    rng, docs = random.Random(seed), []
    for fam in range(5):
        family(rng, fam, docs)
    found = jaccard_join.jaccard_components(frame(spark, docs), **settings)
    want = brute.components([d[:2] for d in docs], settings.get("width", 4), settings.get("percent", 85))
    assert as_dict(found) == want
    assert 5 < len({c for _, c in want.values()}) < len(docs)


def test_percent_must_leave_two_shared(odd):
    with pytest.raises(ValueError):
        jaccard_join.jaccard_components(odd, percent=50)


def one_group(size):
    """Near copies of one text."""
    rng, base = random.Random(11), [f"w{i}" for i in range(200)]
    for i in range(size):
        words = list(base)
        words[rng.randrange(200)] = f"own{i}"
        yield i, " ".join(words), "x"


def shared_header(size):
    """A text whose rare beginning near copies of another one have too."""
    rng, header, body = random.Random(12), [f"h{i}" for i in range(40)], [f"b{i}" for i in range(160)]
    yield 0, " ".join(header + [f"c{i}" for i in range(160)]), "x"
    yield size + 1, " ".join([f"c{i}" for i in range(160)] + ["end"]), "x"
    for i in range(1, size + 1):
        words = header + body
        words[40 + rng.randrange(160)] = f"o{i % 50}"
        words[40 + rng.randrange(160)] = f"p{i % 70}"
        yield i, " ".join(words), "x"
    for i in range(30):  # so that the header is rarer than the body
        yield size + 2 + i, " ".join([f"e{i}_{j}" for j in range(80)] + body), "x"


@pytest.mark.parametrize("make, least", [(one_group, 1), (shared_header, 2)])
def test_no_pairs_within_a_group(spark, make, least):
    """Near copies meet in hundreds of entries; each is compared with a few others, and the number of pairs is in proportion to theirs."""
    docs, seen = list(make(400)), []
    inner = jaccard_join._with_sets
    jaccard_join._with_sets = lambda pairs, sets: seen.append(pairs.count()) or inner(pairs, sets)
    try:
        found = jaccard_join.jaccard_components(frame(spark, docs)).collect()
        assert len({r["component_id"] for r in found if r["doc_id"] <= 400}) == least
    finally:
        jaccard_join._with_sets = inner
    assert sum(seen) < 5 * len(docs)


def twins(pairs, others):
    """Pairs of near copies that share a beginning; the sentences they are made of are more frequent than that."""
    rng = random.Random(13)
    header = " ".join(f"h{i}" for i in range(40))
    pool = ["one two three " + " ".join(f"s{i}_{j}" for j in range(10)) for i in range(24)]

    def body():
        return " ".join(pool[i] for i in sorted(rng.sample(range(24), 12)))

    for i in range(pairs):
        same = body()
        yield 2 * i, f"a{i} {header} {same}", "x"
        yield 2 * i + 1, f"b{i} {header} {same}", "x"
    for i in range(2 * pairs, 2 * pairs + others):
        yield i, f"c{i} {body()}", "x"


def test_the_driver_keeps_little_over_many_turns(spark, monkeypatch):
    """Each turn joins the frames of the one before; Spark's estimate of their size had four times the digits each time."""
    docs, sizes, turns = list(twins(150, 350)), [], []
    cut, labelled = jaccard_join.cut_lineage, jaccard_join._labelled

    def noted(df):
        written = cut(df)
        sizes.append(written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        return written

    monkeypatch.setattr(jaccard_join, "cut_lineage", noted)
    monkeypatch.setattr(jaccard_join, "_labelled", lambda *frames: turns.append(1) or labelled(*frames))
    found = as_dict(jaccard_join.jaccard_components(frame(spark, docs)))
    assert found == brute.components([d[:2] for d in docs])
    assert len(turns) > 2 and max(sizes) <= 2 ** 63 - 1


# Substring dedup

def removed(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"], tuple(map(tuple, r["removed"]))) for r in df.collect()), key=str)


def expected_removed(rows, window):
    out = []
    for (i, *_), (words, gone) in zip(rows, brute.removed_words([r[:2] for r in rows], window)):
        edges = [p for p in range(len(words)) if p in gone and p - 1 not in gone], [p + 1 for p in range(len(words)) if p in gone and p + 1 not in gone]
        out.append((i, len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone), tuple(zip(*edges))))
    return sorted(out, key=str)


def test_removal_from_odd_rows(odd, nothing):
    for window in (1, 5, 13):
        assert removed(substring_dedup.remove_repeated_windows(odd, window=window)) == expected_removed(ODD, window)
    assert substring_dedup.remove_repeated_windows(nothing).count() == 0


def test_removal_over_many_chunks_and_buckets(spark):
    rng = random.Random(3)
    rows = [(i % 90, " ".join(rng.choice("abc") for _ in range(rng.randrange(60))), "x") for i in range(100)]
    found = substring_dedup.remove_repeated_windows(frame(spark, rows), window=4, chunk_bytes=300, bucket_bytes=400)
    assert removed(found) == expected_removed(rows, 4)


def test_untouched_texts_stay_as_they_are(odd):
    found = {r["doc_id"]: r for r in substring_dedup.remove_repeated_windows(odd, as_is=True, carry=["id", "score"]).collect()}
    assert found[4]["kept_text"] == " \n\t " and found[2]["kept_text"] is None and found[4]["score"] == "other"


# Decontamination

ITEMS = [(1, "e f g h i j k l m n o p"), (2, "One"), (10, "one"), (3, None), (4, " .,- "), (None, "w w w"), (5, "nowhere to be found")]


@pytest.mark.parametrize("settings", [{}, {"block_words": 3, "shard_bytes": 40}, {"window": 3}])
def test_hits_in_odd_rows(spark, odd, settings):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("id", F.lit(1)).withColumn("item", F.lit(2))
    found = decontamination.decontaminate(odd, items, clean=True, carry=["id", "spans"], **settings).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["clean_text"]) for r in found), key=str)
    want = []
    for i, text, _ in ODD:
        n, hit, names, cleaned = brute.hits(text, [("" if k is None else k, t) for k, t in ITEMS], settings.get("window", 10))
        want.append((i, n, len(hit), names, text if text is None else cleaned))
    assert got == sorted(want, key=str)
    assert any(w[2] for w in want)


@pytest.mark.parametrize("settings", [{"window": 3}, {"window": 3, "block_words": 8}])
def test_long_items_are_dealt_in_parts(spark, odd, monkeypatch, settings):
    """Items with null ids, long ones too, do not meet in one block, and no window at a border is lost."""
    items = spark.createDataFrame([(None, "e f g h i j k l m n o p"), (None, "a b c d x e f g"), (2, "l m n")], "item_id long, text string")
    whole = sorted(map(str, decontamination.decontaminate(odd, items, **settings).collect()))
    monkeypatch.setattr(decontamination, "ITEM_WORDS", 2)
    sizes = [sum(len(words) for _, words in block) for block in decontamination._blocks(items, "item_id", "text", settings.get("block_words", 1000), 3)]
    assert max(sizes) < 40 and (len(sizes) > 3) == ("block_words" in settings)
    assert sorted(map(str, decontamination.decontaminate(odd, items, **settings).collect())) == whole and any("items=['', '2']" in row for row in whole)


def test_a_stage_holds_few_blocks_and_the_driver_one(spark, odd, monkeypatch):
    items = spark.createDataFrame([(i, f"p{i} q{i} r{i}") for i in range(60)] + ITEMS, "item_id long, text string")
    blocks, block, events = decontamination._blocks, decontamination._Block, []

    def given(*args):
        for own in blocks(*args):
            events.append("given")
            yield own

    monkeypatch.setattr(decontamination, "_blocks", given)
    monkeypatch.setattr(decontamination, "_Block", lambda shared: events.append("sent") or block(shared))
    found = decontamination.decontaminate(odd, items, block_words=30)
    assert events == ["given", "sent"] * (len(events) // 2) and len(events) > 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("MapInArrow") <= 4
    whole = decontamination.decontaminate(odd, items)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))


def test_no_items_and_no_documents(spark, odd, nothing):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminate(odd, empty).where("n_hit > 0").count() == 0
    assert decontamination.decontaminate(nothing, empty).count() == 0


# Byte-level BPE

def test_tokens_of_odd_rows(odd, nothing):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    rows = byte_bpe.round_trip(odd.withColumn("n_tokens", F.lit("x")), RANKS, public_tokenizers.PATTERN).collect()
    want = sorted((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
                  for t, ids in ((t, encoding.encode_ordinary(t or "")) for _, t, _ in ODD))
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == want
    assert byte_bpe.round_trip(nothing, RANKS, public_tokenizers.PATTERN).count() == 0
    both = byte_bpe.decode(byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert all(bytes(r["bytes"]).decode() == (r["text"] or "") for r in both.collect())


def test_long_texts_are_cut_where_no_match_passes():
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    rng = random.Random(2)
    for _ in range(100):
        text = "".join(rng.choice(["a", "b", " ", "  ", "\n", "\t", "'s", "'", "1", "é", "!", "\x1c", " ", "　", "<|endoftext|>"]) for _ in range(200))
        pieces = list(byte_bpe.safe_pieces(text, 7))
        assert "".join(pieces) == text
        assert sum((encoding.encode_ordinary(p) for p in pieces), []) == encoding.encode_ordinary(text)


# Toxicity

def test_ftrl_update_is_that_of_the_paper():
    s = toxicity.Settings(hash_bits=4, alpha=0.5, beta=1.0, l1=0.2, l2=0.3, positive_weight=1.0)
    model, z, n = toxicity.Ftrl(s), np.zeros(17), np.zeros(17)
    rng = np.random.default_rng(0)
    for _ in range(50):
        at = np.append(rng.choice(16, 4, replace=False), 16)
        label = float(rng.integers(2))
        l1 = np.where(at == 16, 0, s.l1)
        w = np.array([0 if abs(z[i]) <= c else -(z[i] - np.sign(z[i]) * c) / ((s.beta + n[i] ** 0.5) / s.alpha + s.l2) for i, c in zip(at, l1)])
        g = 1 / (1 + np.exp(-w.sum())) - label
        for i, wi in zip(at, w):
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / s.alpha
            z[i] += g - sigma * wi
            n[i] += g * g
        model.learn(at[:-1], label)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_toxicity_settings_are_not_lowered():
    assert toxicity.Settings().sample_rows >= 24_000 and toxicity.Settings().hash_bits >= 22


def test_toxicity_on_held_out_documents(spark):
    sf_dir = SF_DIR.rsplit("/", 1)[0] + "/sf0.1"
    rows = (toxicity.op1_toxicity(spark, sf_dir).where("held_out")
            .join(spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic IS NOT NULL"), "doc_id").toPandas())
    assert ((rows["score"] >= 0) & (rows["score"] <= 1)).all() and ((rows["score"] >= 0.5) == (rows["predicted"] == 1)).all()
    bad, good = rows[rows["toxic"] == 1]["score"], rows[rows["toxic"] == 0]["score"]
    assert np.mean(bad.to_numpy()[:, None] > good.to_numpy()[None, :]) > 0.96
    assert (bad >= 0.5).mean() > 0.75 and (good >= 0.5).mean() < 0.01


def test_toxicity_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (5, 0), (5, 0), (8, 0), (6, 7)], "doc_id long, toxic int")
    for model in (toxicity.learn_from_labels(odd, labels), toxicity.learn_from_labels(nothing, labels), toxicity.learn_from_labels(odd, labels.limit(0))):
        rows = toxicity.score(odd, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
        assert toxicity.score(nothing, model).count() == 0


# Language

def test_language_of_held_out_documents(spark):
    rows = (language_id.op4_language_id(spark, SF_DIR).where("held_out")
            .join(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas())
    assert (rows["lang_pred"] == rows["lang"]).mean() > 0.97
    sure = rows[~rows["rejected"]]
    assert (sure["lang_pred"] == sure["lang"]).mean() > 0.99 and len(sure) > 0.9 * len(rows)
    assert ((rows["score"] >= 0) & (rows["score"] <= 1)).all()


def test_language_of_odd_rows(spark, odd, nothing):
    known = spark.createDataFrame([("the cat sat on the mat and the dog", "en"), ("der hund und die katze sind da", "de"), (None, "fr"),
                                   ("12 34", "es"), ("something", None)], "text string, lang string")
    model = language_id.learn(known)
    assert set(model.content) == {"en", "de"}
    rows = language_id.identify(odd.withColumn("margin", F.lit(1)), model).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] in ("en", "de")) == letters and (r["lang_pred"] == "und") != letters
    both = language_id.identify(spark.createDataFrame([("the cat sat on the mat",), ("der hund und die katze",)], "text string"), model)
    assert [r["lang_pred"] for r in both.collect()] == ["en", "de"]
    assert language_id.identify(nothing, model).count() == 0
    none = language_id.learn(known.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(odd, none).collect()} == {"und"}


# Queries of learnt operators against plain versions

def plain_features(text, settings):
    """Numbers of a text's features: words, and pairs of words some places apart."""
    hashes = [int(h) for h in split_words(pa.array([text]), toxicity._WORD, lower=True).hashes(seed=settings.seed)]
    scramble = lambda x: int(mix(np.array([x & (1 << 64) - 1], dtype=np.uint64))[0])
    pairs = [scramble(scramble(h + skip) ^ hashes[i + skip]) for skip in settings.skips for i, h in enumerate(hashes) if i + skip < len(hashes)]
    return sorted({h >> 64 - settings.hash_bits for h in hashes + pairs})


def plain_weights(samples, settings):
    """FTRL-proximal over (label, features), a number at a time."""
    z, n, bias = {}, {}, 1 << settings.hash_bits

    def weight(i):
        l1 = 0.0 if i == bias else settings.l1
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((settings.beta + math.sqrt(n[i])) / settings.alpha + settings.l2)

    for _ in range(settings.passes):
        for label, own in samples:
            before = {i: weight(i) for i in [*own, bias]}
            error = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(before.values()))))) - label
            g = error * (settings.positive_weight if label else 1.0)
            for i, w in before.items():
                old = n.get(i, 0.0)
                n[i] = old + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(old)) / settings.alpha * w
    return {i: weight(i) for i in z}


def test_toxicity_query_against_a_plain_version(spark, tmp_path):
    rng, settings = random.Random(6), toxicity.Settings()
    rows = [(i, " ".join(rng.choice(["vile", "mean", "Don't", "nice", "day", "the", "café", "x1"][(i % 2) * 3:]) for _ in range(rng.randrange(12)))) for i in range(150)]
    docs = spark.createDataFrame(rows + [(150, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(0, 140)] + [(3, 0), (1, None), (900, 1)], "doc_id long, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = {r["doc_id"]: r["place"] for r in docs.where("crc32(cast(cast(doc_id AS string) AS binary)) % 5 <> 0").select("doc_id", F.xxhash64("doc_id").alias("place")).collect()}
    samples = [(float(1 - i % 2), plain_features(dict(rows)[i], settings)) for i in sorted(kept, key=kept.get) if i < 140]
    weights = plain_weights(samples, settings)
    got = {r["doc_id"]: r for r in toxicity.op1_toxicity(spark, str(tmp_path)).collect()}
    assert len(got) == 151
    for i, text in [*rows, (150, None)]:
        total = sum(weights.get(f, 0.0) for f in [*plain_features(text or "", settings), 1 << settings.hash_bits])
        assert abs(got[i]["score"] - 1 / (1 + math.exp(-total))) < 1e-4 and got[i]["held_out"] == (i not in kept)
    assert len({r["predicted"] for r in got.values()}) == 2


def test_the_sample_of_toxicity_is_bounded_by_bytes(spark):
    rows = [(i, "word " * 400, i % 2) for i in range(300)] + [(300, "vile " * 30000, 1)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    few = dataclasses.replace(toxicity.Settings(), hash_bits=12, sample_bytes=40_000, longest_bytes=10_000, l1=0.0)
    seen = toxicity.learn(labelled, "text", "toxic", F.xxhash64("doc_id"), few)
    assert not set(plain_features("vile", few)) & set(seen.feature.tolist()) and set(plain_features("word", few)) <= set(seen.feature.tolist())


def test_language_query_against_a_plain_version(spark):
    sf_dir = SF_DIR.rsplit("/", 1)[0] + "/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.learn(docs.where(~language_id.held_out()))
    s, codes = model.settings, list(model.content)
    got = {r["doc_id"]: r for r in language_id.op4_language_id(spark, sf_dir).collect()}
    for row in docs.collect():
        words = [w for w in regex.findall(r"[\p{L}\p{M}\p{N}]+", row["text"].lower()) if not regex.search(r"\p{N}", w)]
        data = f" {' '.join(words)} ".encode()
        level = s.short_level if len(data) <= s.short_bytes else s.level
        sizes = []
        for code in codes:
            own = zstandard.ZstdCompressionDict(model.content[code], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=level)
            packer = zstandard.ZstdCompressor(level=level, dict_data=own, write_content_size=False, write_checksum=False)
            sizes.append(sum(len(packer.compress(data[i:i + s.piece_bytes])) for i in range(0, len(data), s.piece_bytes)))
        letters = regex.search(r"\p{L}", row["text"])
        assert got[row["doc_id"]]["lang_pred"] == (codes[sizes.index(min(sizes))] if letters else "und")
        assert got[row["doc_id"]]["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)


def test_other_patterns_are_used_on_whole_texts():
    assert byte_bpe.cuts_are_safe(public_tokenizers.PATTERN)
    for pattern in (r"\w+\s*|\W", r"[^ ]+ ?|\s+", r".+|\n"):
        assert not byte_bpe.cuts_are_safe(pattern)
    for pattern in (r"\w+\s*|\W", r"[^ ]+ ?|\s+"):
        text = "ab 1, " * 20_000
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
        assert byte_bpe.Codec(byte_bpe.read_ranks(RANKS), pattern).encode(text).tolist() == encoding.encode_ordinary(text)
