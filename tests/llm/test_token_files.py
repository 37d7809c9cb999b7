"""Token files against the tokenizers library on whole texts, round trips of the coding, and odd tables."""

import io
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_DIR
from ratestar.llm import token_files
from ratestar.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def pieces():
    return token_files.PieceTokenizer(open(PATH, encoding="utf-8").read())


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def check_texts(pieces, texts):
    ids, borders = pieces.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])] == [ids_of(text) for text in texts]


ODD = ["", None, "J̌ ǰ J̌J T̈ẗ HẖX <|ENDOFTEXT|>", " ", "a", "  two  words\n\n", "don't can't 'tis o'clock's, 's", "x1y22,z.", "...wait!?--\"quoted\"'s", "Ábc é, ñ.",
       " no　break line", "tab\there\x0bvertical\x0cfeed\x1cfile\x85next", "a≮b ,́x .̈", "<|endoftext|> a<|startoftext|>b",
       "İstanbul İx Kelvin ΣΣ σς", "汉字,かな。123٣٤", "🙂👍🏽,🙂", "word" * 5000, "a'll'd've're't'm", "I'M 'S,'T", "_under_score_", "﻿bom\x00nul\x7f"]


def test_ids_of_pieces_are_those_of_whole_texts(pieces):
    check_texts(pieces, ODD)
    check_texts(pieces, ODD[::-1])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("ab'stlveRDJ̌ \t\n.,;<|>01̸́ éÉ"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=4))
def test_ids_of_any_text(pieces, texts):
    check_texts(pieces, texts)


def test_what_is_remembered_can_be_forgotten(pieces, monkeypatch):
    monkeypatch.setattr(token_files, "PIECES_KEPT", 3)
    check_texts(pieces, ["one two three four five", "five six, seven one", None])


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1), st.sampled_from([255, 256, 65535, 65536, 2**24 - 1, 2**24]))))
def test_numbers_round_trip(values):
    values = np.array(values, dtype=np.uint32)
    control, data = token_files.encode_numbers(values)
    assert len(control) == -(-len(values) // 4) and len(data) == sum(max(1, (int(v).bit_length() + 7) // 8) for v in values)
    assert (token_files.decode_numbers(control, data, len(values)) == values).all()


def test_blocks_round_trip():
    blocks = [token_files.Block(np.array([3, 0, -1]), np.array([False, True, False]), np.array([2, 0, 300]), np.arange(302, dtype=np.uint32) * 7),
              token_files.Block(np.array([5]), np.array([False]), np.array([0]), np.empty(0, np.uint32))]
    stream = io.BytesIO(b"".join(b.to_bytes() for b in blocks))
    for want, got in zip(blocks, token_files.read_blocks(stream), strict=True):
        for name in ("ids", "missing", "lengths", "ranks"):
            assert getattr(want, name).tolist() == getattr(got, name).tolist()
    with pytest.raises(ValueError):
        list(token_files.read_blocks(io.BytesIO(b"x" * 100)))


def expected(rows):
    """Rows in order of id, then as the result has them: (id, start, tokens, crc)."""
    out, start = [], 0
    for number, ids in rows:
        out.append((number, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_library(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want = expected([(r["doc_id"], ids_of(r["text"]) + [1]) for r in rows])
    assert sorted(map(tuple, QUERIES["op13_token_files"](spark, SF_DIR).collect())) == want


def test_odd_rows(spark, tmp_path):
    rows = [(7, "b b", "x"), (None, "no id", "x"), (7, "b b", "y"), (7, "other", "x"), (3, None, "x"), (-2, "", "x"), (4, "long " * 40000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string").withColumn("ids", F.lit("clash"))
    (tmp_path / "in").mkdir()
    docs.write.parquet(str(tmp_path / "in" / "documents.parquet"))
    got = [tuple(r) for r in QUERIES["op13_token_files"](spark, str(tmp_path / "in")).collect()]
    got.sort(key=lambda r: r[1])
    assert [r[0] for r in got] == [None, -2, 3, 4, 7, 7, 7]
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    crc = lambda text: zlib.crc32(np.array(ids_of(text) + [1], "<u4").tobytes())
    assert sorted(r[3] for r in got) == sorted(crc(text) for _, text, _ in rows)


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    tokens, width = token_files.tokenize(docs, PATH, end_id=1)
    token_files.write_tokens(tokens, width, str(tmp_path / "files"))
    assert token_files.read_tokens(spark, str(tmp_path / "files")).collect() == []


def test_many_files_and_blocks(spark, tmp_path):
    """Files of few tokens give the same documents as one, frequent tokens take one byte, and strays are not read."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(5)
    tokens, width = token_files.tokenize(docs, PATH, end_id=1)
    tokens.write.parquet(str(tmp_path / "ids"))
    tokens = spark.read.parquet(str(tmp_path / "ids"))
    total = 0
    for name, size in (("few", 1 << 30), ("many", 20_000)):
        token_files.write_tokens(tokens, width, str(tmp_path / name), file_tokens=size, block_tokens=5_000)
    assert len(list((tmp_path / "many").glob("*.tok"))) > 10 > len(list((tmp_path / "few").glob("*.tok")))
    (tmp_path / "many" / "00000000-of-a-lost-task.tok").write_bytes(b"half")
    few, many = (token_files.read_tokens(spark, str(tmp_path / name)) for name in ("few", "many"))
    assert few.exceptAll(many).isEmpty() and many.count() == docs.count()
    total = many.agg(F.sum("n_tokens")).first()[0]
    size = sum(path.stat().st_size for path in (tmp_path / "many").glob("*-*.tok"))
    assert size < 2 * total
