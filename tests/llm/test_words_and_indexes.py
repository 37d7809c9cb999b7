"""Words and hashes, packed messages, the FM-index and the minimum cut against plain versions."""

import itertools
import random

import numpy as np
import pyarrow as pa

import brute
from ratestar.llm import chunks
from ratestar.llm.fm_index import FmIndex, suffix_order
from ratestar.llm.min_cut import source_side
from ratestar.llm.words import ALPHANUMERIC, BLANK_SEPARATED, run_hashes, slices, split_words

TEXTS = ["", None, "  one\ttwo\nONE  é x\x1cy ", "a" * 200 + " " + "b" * 64 + " " + "c" * 65, "Ünï-cödé's 12x3", "\n", "last word"]


def test_words_are_those_of_the_pattern():
    for table, pattern, lower in ((BLANK_SEPARATED, brute.BLANK, False), (ALPHANUMERIC, brute.ALNUM, True)):
        words = split_words(pa.array(TEXTS), table, lower=lower)
        want = [pattern.findall(brute.lower(t) if lower else t or "") for t in TEXTS]
        assert list(words.counts) == [len(w) for w in want]
        assert [words.bytes_of(i).decode() for i in range(len(words.starts))] == [w for own in want for w in own]


def test_hashes_depend_on_bytes_alone():
    words = split_words(pa.array(["x yy " + "z" * 70, "yy x " + "z" * 70 + " " + "z" * 71]))
    h = words.hashes()
    assert h[0] == h[4] and h[1] == h[3] and h[2] == h[5] and len(set(h)) == 4
    assert words.hashes(seed=1)[0] != h[0]


def test_run_hashes_tell_runs_apart():
    rng = random.Random(1)
    text = [rng.choice("abc") for _ in range(400)]
    h = run_hashes(split_words(pa.array([" ".join(text)])).hashes(), 5)
    runs = [tuple(text[i:i + 5]) for i in range(396)]
    by_hash = {}
    for run, value in zip(runs, h):
        assert by_hash.setdefault(int(value), run) == run
    assert len(by_hash) == len(set(runs))
    assert len(run_hashes(h[:3], 4)) == 0


def test_slices_cover_all_rows():
    column = pa.array(["x" * n for n in (5, 0, 100, 3, 3)] + [None])
    found = list(slices(column, 8))
    assert [i for a, b in found for i in range(a, b)] == list(range(6))
    assert list(slices(pa.array([], pa.string()))) == []


def test_messages_come_back():
    values = np.sort(np.random.default_rng(0).integers(0, 2 ** 63, 1000).astype(np.uint64) * np.uint64(2))
    assert (chunks.unpack_sorted(chunks.pack_sorted(values)) == values).all()
    assert len(chunks.unpack_sorted(chunks.pack_sorted(values[:0]))) == 0
    for top in (1, 300, 70_000, 2 ** 40):
        numbers = np.array([0, top, 5], dtype=np.int64)
        assert (chunks.unpack(chunks.pack(numbers)) == numbers).all()
    ranges = chunks.bucket_ranges(values, 7)
    assert ranges[0][1] == 0 and ranges[-1][2] == 1000 and [r[0] for r in ranges] == sorted({r[0] for r in ranges})


def test_fm_index_finds_all_places():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n, symbols = int(rng.integers(1, 90)), int(rng.integers(2, 6))
        text = rng.integers(0, symbols, n)
        text[-1] = 0
        patterns = [rng.integers(1, symbols, rng.integers(1, 5)) for _ in range(12)]
        rows = np.array([np.concatenate([np.zeros(5 - len(p), int), p]) for p in patterns])
        index = FmIndex(text, symbols, sample_every=4)
        number, place = index.locate(*index.search(rows))
        for i, p in enumerate(patterns):
            want = [j for j in range(n - len(p) + 1) if (text[j:j + len(p)] == p).all()]
            assert sorted(place[number == i]) == want


def test_suffix_order_of_repeats():
    text = np.array([1, 2, 1, 2, 1, 2, 0, 1, 2, 1, 2, 1, 2, 0])
    def key(i):
        end = i + list(text[i:]).index(0)
        return [(1, x) for x in text[i:end]] + [(0, end)]
    assert list(suffix_order(text)) == sorted(range(len(text)), key=key)


def test_cut_is_the_cheapest():
    rng = random.Random(7)
    for _ in range(200):
        n = rng.randrange(1, 8)
        scores = [rng.choice([-3, -1, -0.5, 0, 0.5, 1, 2.5]) for _ in range(n)]
        edges = [(a, b, rng.choice([0.25, 0.5, 1, 2])) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(side):
            return (sum(max(s, 0) if not own else max(-s, 0) for s, own in zip(scores, side))
                    + sum(w for a, b, w in edges if side[a] != side[b]))

        best = min(cost(side) for side in itertools.product([True, False], repeat=n))
        assert abs(cost(source_side(scores, edges)) - best) < 1e-6
    assert source_side([], []) == []
