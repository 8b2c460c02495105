"""Byte-level BPE against the tokenizer library on whole texts, and the exact round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import regex

from landrecon.llm import bpe, queries

RANKS = P.path("byte_bpe_50k.tiktoken")


def library():
    return bpe._encoding(RANKS, P.PATTERN)


def texts():
    draw = random.Random(4)
    fixed = [
        "", None, "a", "  \n\n x 're don''re 9 " * 3, "x" * 500,
        "word " * 100 + "y" * 90 + " tail  \n \n end", "é ñ 漢字漢字 " * 40, ("\n" * 70 + "ab  c") * 5,
    ]
    return fixed + ["".join(draw.choice("ab '\n re9.é  ") for _ in range(draw.randint(0, 700))) for _ in range(120)]


@pytest.mark.parametrize("chunk,overlap", [(50, 16), (64, 4), (1 << 15, 1 << 10)])
def test_chunks_stitch_to_the_library_result(spark, chunk, overlap):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(docs, RANKS, chunk=chunk, overlap=overlap), RANKS).collect()
    assert sorted(r.doc_id for r in got) == [i for i, _ in rows]
    for r in got:
        text = rows[r.doc_id][1] or ""
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == library().encode_ordinary(text) and r.n_tokens == len(ids)
        assert bytes(r.decoded) == text.encode()


def by_token(text):
    """Ids by the definition: every match of the pattern singly."""
    return [i for m in regex.finditer(P.PATTERN, text) for i in library()._encode_single_piece(m.group())]


@pytest.mark.parametrize("most", [1, 3, 7, 40])
def test_long_texts_are_cut_where_it_does_not_matter(most):
    for text in filter(None, texts()):
        assert bpe.encode_text(library(), text, P.PATTERN, most) == library().encode_ordinary(text) == by_token(text)


def test_two_million_of_one_kind(spark):
    """Runs on which the library's own pattern would exhaust the stack, within words and alone."""
    kinds = [" ", "\n", "a", "7", "\n \t"]
    long = [f"say don't {k * (2_000_000 // len(k))} b\n c" for k in kinds] + [" " * 2_000_000, "a" + " " * 1_200_000 + "b"]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string").repartition(4)
    got = bpe.decode(bpe.encode(docs, RANKS), RANKS).collect()
    assert len(got) == len(long)
    one = bpe.encoder(RANKS)()
    for r in got:
        ids = by_token(long[r.doc_id])
        assert bytes(r.decoded) == long[r.doc_id].encode() and np.frombuffer(r.ids, "<u4").tolist() == ids
        assert one(long[r.doc_id]) == ids


def test_repeated_rows_stay_apart(spark):
    long = "some words here " * 20
    docs = spark.createDataFrame([(1, long), (1, long), (1, "b"), (1, "b"), (None, long)], "doc_id long, text string")
    got = bpe.encode(docs, RANKS, chunk=50, overlap=16).collect()
    n = len(library().encode_ordinary(long))
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted([("1", n), ("1", n), ("1", 1), ("1", 1), ("None", n)])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, RANKS), RANKS).count() == 0


def test_query_digests(spark):
    folder = "/root/testdata/sf0.001"
    whole = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.QUERIES["op8_byte_bpe"](spark, folder).collect()
    assert len(got) == len(whole)
    for r in got:
        ids = library().encode_ordinary(whole[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(whole[r.doc_id].encode()).hexdigest()
