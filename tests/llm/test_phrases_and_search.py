"""Phrase mining and lexical search against plain versions, treaps against dense grids."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from brute import ALNUM, lower
from conftest import SF_DIR
from ratestar.llm import k2_treap, lexical_search, phrase_mining

# Phrases


def frequent_phrases(rows, threshold, longest=5):
    """({(lang, phrase): f}, {lang: n}) of (lang, text) rows."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, " ".join(words[i:i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    return {key: f for key, f in counts.items() if f >= threshold}, totals


def mined(rows, threshold, percent=100, top=None):
    f, totals = frequent_phrases(rows, threshold)
    found = defaultdict(list)
    for (lang, phrase), a in f.items():
        words = phrase.split(" ")
        inside = any(other == lang and len(long) > len(phrase) and f" {phrase} " in f" {long} " and 100 * times >= percent * a
                     for (other, long), times in f.items())
        if len(words) > 1 and not inside:
            cuts = []
            for k in range(1, len(words)):
                l, r = f[lang, " ".join(words[:k])], f[lang, " ".join(words[k:])]
                cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            found[lang].append((-score, -a, phrase.encode(), phrase, l, r))
    return sorted((lang, rank, phrase, -a, l, r, totals[lang], -score) for lang, own in found.items()
                  for rank, (score, a, _, phrase, l, r) in enumerate(sorted(own)[:top], 1))


def corpus():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(12)] + ["Über", "É", "naïve", "X\x0bY", "word" * 30]
    rows = []
    for i in range(400):
        text = "".join(str(rng.choice(words, p=np.arange(17, 0, -1) / 153)) + str(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n"])) for _ in range(rng.integers(0, 40)))
        rows.append((["en", "de", None, ""][int(rng.integers(0, 4))], text + " the quick brown fox jumps" * int(rng.integers(0, 2))))
    return rows + [("en", None), ("en", ""), ("de", " .,;\t "), ("en", "same same same same same same"), ("en", "a b. " * 20000)]


@pytest.mark.parametrize("threshold, shards, slot_bits, percent, top", [(5, 4, None, 100, None), (5, 1, 16, 100, 7), (3, 3, 16, 50, None), (100, 2, None, 100, 2)])
def test_mined_phrases(spark, threshold, shards, slot_bits, percent, top):
    rows = corpus()
    docs = spark.createDataFrame([(lang, text, "clash") for lang, text in rows], "lang string, text string, phrase string").repartition(5)
    got = phrase_mining.mine_phrases(docs, threshold=threshold, shards=shards, slot_bits=slot_bits, contained_percent=percent, top=top)
    want = mined(rows, threshold, percent, top)
    assert want and sorted(map(tuple, got.collect())) == want
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]


def test_late_phrases_complete_their_cycle(spark, tmp_path):
    """Phrases that reach the threshold with the last shard only are counted in all shards all the same."""
    rows = [("en", "one two three four five")] * 8 + [("en", "filler text")] * 5
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(8)
    got = phrase_mining.mine_phrases(docs, threshold=8, shards=4, top=None).collect()
    assert [tuple(r)[2:6] for r in got] == [("one two three four five", 8, 8, 8)]


def test_a_saturated_sketch_changes_nothing(spark):
    rows = corpus()[:150]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = phrase_mining.mine_phrases(docs, threshold=4, shards=2, top=None, slot_bits=3)
    assert sorted(map(tuple, got.collect())) == mined(rows, 4)


@pytest.mark.parametrize("slot_bits", [5, 8])
def test_shared_slots_cut_no_cycle_short(spark, slot_bits):
    """Words that get frequent late, in phrases whose slots others have taken before."""
    rng, rows = np.random.default_rng(0), []
    for i in range(240):
        text = ""
        for _ in range(6):
            k, late = int(rng.integers(0, 30)), int(rng.integers(0, 60 if i >= 72 else 10))
            text += f"t{late} w{k} w{(k * 7 + 1) % 60} w{(k * 3 + 2) % 60} w{k + 5}. "
        rows.append(("en", text))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(8)
    got = phrase_mining.mine_phrases(docs, threshold=8, top=None, slot_bits=slot_bits)
    assert sorted(map(tuple, got.collect())) == mined(rows, 8)


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrase_mining.mine_phrases(empty).collect() == []
    assert phrase_mining.mine_phrases(spark.createDataFrame([("en", "a b c")], "lang string, text string")).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    n, a, l, r = 9 * 10**13, 10**12 + 7, 3 * 10**12 + 1, 2 * 10**12 + 3
    frequent = spark.createDataFrame([("en", 1, "x", l), ("en", 1, "y", r), ("en", 2, "x y", a)], "lang string, length int, phrase string, f long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    assert phrase_mining.score_phrases(frequent, totals).first()["score"] == 1000 * a * n // (l * r)


# Treaps


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_treap(data):
    rows, cols = data.draw(st.integers(1, 40)), data.draw(st.integers(1, 60))
    rng = np.random.default_rng(data.draw(st.integers(0, 2**32)))
    cell = rng.choice(rows * cols, rng.integers(0, rows * cols + 1), replace=False)
    r, c = np.divmod(cell, cols)
    weights = rng.integers(1, data.draw(st.sampled_from([2, 30, 10**6])), len(cell))
    height = max(rows - 1, cols - 1).bit_length()
    treap = k2_treap.Treap(k2_treap.unpack(k2_treap.pack(k2_treap.build(r, c, weights, height))), height)
    assert sorted(zip(treap.rows, treap.cols, treap.weights)) == sorted(zip(r, c, weights))

    sets, k = int(rng.integers(1, 9)), int(rng.integers(1, 6))
    own = [rng.choice(rows, rng.integers(0, rows + 1), replace=False) for _ in range(sets)]
    of, chosen = np.repeat(np.arange(sets), [len(x) for x in own]), np.concatenate(own)
    factors, floors = rng.integers(0, 9, len(of)), rng.integers(0, 40, sets)
    grid = np.zeros((rows, cols), int)
    grid[r, c] = weights
    want = np.zeros((sets, cols), int)
    np.add.at(want, of, factors[:, None] * grid[chosen])
    got = k2_treap.best(treap, cols, sets, of, chosen, factors, k, floors, opened=int(rng.integers(1, 5)))
    assert (got <= want).all()
    for i in range(sets):
        least = max(np.sort(want[i])[-k] if k <= cols else 0, floors[i], 1)
        assert (got[i][want[i] >= least] == want[i][want[i] >= least]).all()


# Search


def ranked(docs, items, k=10):
    words = [(i, ALNUM.findall(lower(text))) for i, text in docs]
    own = [(i, Counter(w)) for i, w in words if w]
    size, total = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(term for _, c in own for term in c)
    out = []
    terms = defaultdict(set)
    for item, text in items:
        terms[item].update(ALNUM.findall(lower(text)))
    for item, wanted in terms.items():
        scores = []
        for number, c in own:
            m = 10 + 90 * sum(c.values()) * size // total
            score = sum(math.floor(1000 * math.log((2 * size + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if score > 0:
                scores.append((-score, number is None, number or 0))
        out += [(item, rank, None if missing else number, -score) for rank, (score, missing, number) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def searched(spark, docs, items, k=10, repartition=1, **limits):
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(repartition)
    items = spark.createDataFrame(items, "item_id string, text string").withColumn("doc_id", F.lit(1))
    size = lexical_search.corpus_size(frame)
    index = lexical_search.build_index(frame, size, **limits)
    return sorted(map(tuple, lexical_search.search(index, items, size, k).collect()), key=str)


def test_search_over_many_shards(spark):
    rng = np.random.default_rng(9)
    words = np.array([f"t{i}" for i in range(60)])
    draw = lambda n: " ".join(words[np.minimum(rng.geometric(0.07, n) - 1, 59)])
    docs = [(i, draw(int(rng.integers(1, 60)))) for i in range(300)] + [(i, "T1 t2,t3 É t4") for i in range(300, 340)]
    items = [(f"i{i}", draw(int(rng.integers(1, 12)))) for i in range(20)] + [("é", "É t1"), ("none", "unheard of"), ("empty", None)]
    want = ranked(docs, items)
    assert len(want) > 200
    assert searched(spark, docs, items) == want
    assert searched(spark, docs, items, repartition=3, shard_bytes=700) == want
    assert searched(spark, docs, items, shard_docs=7) == want


def test_odd_rows_of_search(spark):
    long = "filler common " * 30000 + "needle"
    docs = [(1, None), (2, ""), (3, " .,"), (None, "needle x"), (5, "needle x"), (5, "needle x"), (-4, "needle x"), (7, long), (8, "x" * 100_000)]
    items = [("a", "NEEDLE needle"), ("a", "x"), (None, "common"), (None, "needle"), ("b", "."), ("c", "x" * 100_000)]
    assert searched(spark, docs, items) == ranked(docs, items)
    assert searched(spark, docs, items, k=2) == ranked(docs, items, 2)
    assert searched(spark, [(1, None)], items) == [] and searched(spark, docs, [("a", "")]) == []


def test_empty_tables_of_search(spark):
    assert searched(spark, [], [("a", "x")]) == [] and searched(spark, [(1, "x")], []) == []


def test_items_in_blocks(spark):
    docs = spark.read.parquet(f"{SF_DIR.rsplit('/', 1)[0]}/sf0.001/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR.rsplit('/', 1)[0]}/sf0.001/benchmark.parquet")
    size = lexical_search.corpus_size(docs)
    index = lexical_search.build_index(docs, size)
    one, many = (lexical_search.search(index, items, size, block_pairs=n) for n in (1 << 20, 300))
    assert one.exceptAll(many).isEmpty() and one.count() == many.count() > 300
