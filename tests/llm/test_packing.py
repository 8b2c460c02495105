"""Ids against the tokenizer library, and packings against the lower bound and small optima."""

import itertools
import random
import zlib
from collections import defaultdict
from math import ceil

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from landrecon.llm import packing, queries
from landrecon.llm.word_bpe import WordIds

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_library(spark, library):
    odd = [
        "", " \n\t ", "don't YOU'LL 12 a1b2", "Ünïcode Straße ΑΣΣ ﬁ İstanbul'll 12³½ Ⅷ 漢字", "é é é́",
        "a\xa0b ​ zero\x00x \x1cq", "hello <|endoftext|> world", "<|startoftext|>a<|ENDOFTEXT|>b <|endoftext|", "<|endoftext|>", "!!! ... '' ''' 's", "\x85 ª º µ ǅ", "K Å Ω",
        "`~^´¨ §±×÷ ©®", "x" * 3000,
    ]
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(400).collect()]
    ids = WordIds(PATH)
    for text, got in zip(odd + rows, ids.encode_all(odd + rows)):
        assert got.tolist() == library(text), text[:80]


def optimum(lengths, capacity):
    """Fewest bins by trying all assignments."""
    best = [len(lengths)]
    order = sorted(lengths, reverse=True)

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(order):
            best[0] = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins)}.values():
            if bins[j] + order[i] <= capacity:
                bins[j] += order[i]
                go(i + 1, bins)
                bins[j] -= order[i]
        go(i + 1, bins + [order[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(25))
def test_small_packings_are_optimal(seed):
    draw = random.Random(seed)
    lengths = [draw.randint(1, 20) for _ in range(draw.randint(1, 11))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.plan_packing(counts, 20)
    used = defaultdict(int)
    for filling, times in plan:
        assert sum(n * k for n, k in filling) <= 20
        for n, k in filling:
            used[n] += k * times
    assert used == counts
    assert sum(t for _, t in plan) == optimum(lengths, 20)


@pytest.mark.parametrize("scale", [1, 50])
def test_fillings_with_waste_and_without_exact_fits_are_tried(scale):
    counts = {2109: 6 * scale, 1176: 6 * scale, 1095: 6 * scale, 851: 12 * scale}
    plan = packing.plan_packing(counts, 4096)
    used = defaultdict(int)
    for filling, times in plan:
        assert sum(n * k for n, k in filling) <= 4096
        for n, k in filling:
            used[n] += k * times
    assert used == counts and sum(t for _, t in plan) == 9 * scale


def check(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_query_packs_every_token_once(spark, library):
    folder = "/root/testdata/sf0.001"
    whole = {r.doc_id: library(r.text) + [1] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.QUERIES["op7_best_fit_packing"](spark, folder).collect()
    n = check(rows, 4096)
    seen = defaultdict(list)
    for r in rows:
        seen[r.doc_id].append((r.piece, r.start, r.length))
        ids = np.array(whole[r.doc_id][r.start : r.start + r.length], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
        assert r.length == 4096 or r.start + r.length == len(whole[r.doc_id])
    assert {d: sum(p[2] for p in v) for d, v in seen.items()} == {d: len(v) for d, v in whole.items()}
    assert all([p[0] for p in sorted(v)] == list(range(len(v))) for v in seen.values())
    assert n <= ceil(sum(map(len, whole.values())) / 4096) + 1


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, 7), (1, None, 7), (2, "", 1), (3, "one two three four five six", 2), (3, "one two three four five six", 2), (None, "a", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = packing.pack_documents(docs, PATH, capacity=4).collect()
    assert sorted((str(r.doc_id), r.piece, r.length) for r in got) == sorted(
        [("1", 0, 1), ("1", 0, 1), ("2", 0, 1), ("None", 0, 2)] + [("3", 0, 4), ("3", 1, 3)] * 2
    )
    assert check(got, 4) == ceil(sum(r.length for r in got) / 4)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, PATH).count() == 0


def test_pieces_carry_their_ids(spark, library):
    docs = spark.createDataFrame([(1, "some words to be cut")], "doc_id long, text string")
    got = packing.pieces(docs, PATH, capacity=2, with_ids=True).orderBy("piece").collect()
    joined = list(itertools.chain(*[np.frombuffer(r.ids, "<u4").tolist() for r in got]))
    assert joined == library("some words to be cut") + [1]
