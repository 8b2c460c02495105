"""SimHash against its definition word by word, and groups against all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from landrecon.llm import queries, simhash
from landrecon.llm.components import components


def by_definition(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(items, near):
    parent = {i: i for i in items}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in items:
        for j in items:
            if i < j and near(i, j):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in items}


def test_fingerprint():
    for text in ["", " \t\n", "One", "one two", "A b c", "ÀB cÉ d x\x1cy z", "the same words " * 50 + "end", "a\x0bb\x0cc d"]:
        assert simhash.fingerprint(text) == by_definition(text), text


def test_hash_is_the_engine_hash(spark):
    got = spark.createDataFrame([("one two é",)], "s string").select(F.xxhash64("s")).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest("one two é".encode(), 42)


@pytest.mark.parametrize("max_bits,small", [(2, 256), (2, 4), (1, 256), (3, 64)])
def test_links_find_every_group(spark, max_bits, small):
    draw = random.Random(1)
    prints = set()
    for _ in range(40):
        base = draw.getrandbits(64)
        for _ in range(draw.randint(1, 12)):
            prints.add(base)
            for _ in range(draw.randint(1, 3)):
                base ^= 1 << draw.randrange(64)
    crowd = draw.getrandbits(64)
    prints |= {crowd ^ (draw.getrandbits(9) << 8) for _ in range(900)}  # one large list
    prints = sorted(prints)
    df = spark.createDataFrame([(p - 2**64 if p >> 63 else p,) for p in prints], "fp long")
    found = components(simhash.links(df, max_bits, small))
    got = {r.node % 2**64: r.component % 2**64 for r in found.collect()}
    want = groups(prints, lambda i, j: (i ^ j).bit_count() <= max_bits)
    def partition(mapping):
        sets = {}
        for i in prints:
            sets.setdefault(mapping.get(i, i), set()).add(i)
        return sorted(map(sorted, sets.values()))

    assert partition(got) == partition(want)


def test_pairs_are_tallied_before_they_are_verified():
    draw = np.random.default_rng(4)
    a = draw.integers(0, 1 << 64, 400, dtype=np.uint64)
    b = a.copy()
    for i in range(400):
        for bit in draw.integers(0, 64, draw.integers(0, 5)).tolist():
            b[i] ^= np.uint64(1 << bit)
    want = [(int(x) ^ int(y)).bit_count() <= 2 for x, y in zip(a, b)]
    assert simhash._near(a, b, 2).tolist() == want


def test_a_pair_with_the_minimum_meets_in_some_list_and_crowded_lists_are_split(spark):
    draw = random.Random(6)
    base = draw.getrandbits(64) & ~(0xFFFF << 24)
    crowd = {base | draw.getrandbits(16) << 24 for _ in range(500)} | {base ^ (1 << b) for b in range(64)}
    prints = sorted(p - 2**64 if p >> 63 else p for p in crowd)
    lists, choices = simhash.posting_lists(spark.createDataFrame([(p,) for p in prints], "fp long"), 2, 16)
    held = {}
    for r in lists.collect():
        held.setdefault((r.positions, r.bytes), set()).add(r.fp)
    assert all(len(m) <= 16 or len(choices[k]) == 6 for (k, _), m in held.items())
    meet = {frozenset(p) for m in held.values() for p in combinations(sorted(m), 2)}
    for a, b in combinations(prints, 2):
        shared = sum((a ^ b) >> 8 * k & 255 == 0 for k in range(8))
        assert shared < 6 or frozenset((a, b)) in meet


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    prints = {r.doc_id: by_definition(r.text) for r in docs}
    want = groups(sorted(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    got = queries.QUERIES["op6_simhash_near_dedup"](spark, folder).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == want[r.doc_id]


def test_nulls_empties_repeats_and_clashing_columns(spark):
    rows = [(5, None, 1), (3, "", 2), (3, "", 2), (9, "a b c d e", 3), (None, "a b c d e", 4), (8, "w " * 60000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got) == [("3", 3), ("3", 3), ("5", 3), ("8", 8), ("9", 9), ("None", 9)]
    assert simhash.near_duplicates(spark.createDataFrame([], docs.schema)).count() == 0


def test_large_and_small_lists_agree():
    draw = np.random.default_rng(3)
    values = np.unique(draw.integers(0, 1 << 16, 200).astype(np.uint64))
    small = simhash._firsts_small(values, 2)
    assert (small == simhash._firsts_large(values, [0, 1], 2)).all()


def test_components_of_a_long_path(spark):
    n = 300
    order = list(range(n))
    random.Random(2).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])) + [(1000, 1001), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}
    assert components(links.limit(0)).count() == 0
