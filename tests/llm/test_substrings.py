"""Removal of repeated strings against a table of all strings."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landrecon.llm import queries, substrings


def brute(docs, length=50):
    first = {}
    for doc_id, data in docs:
        for i in range(len(data) - length + 1):
            key = data[i : i + length]
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, data in docs:
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < doc_id:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, kept, len(data), sum(gone), spans))
    return out


def corpus(seed, n=60, alphabet="abcdé "):
    draw = random.Random(seed)
    passages = ["".join(draw.choice(alphabet) for _ in range(draw.randint(30, 200))) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(draw.randint(0, 6)):
            kind = draw.random()
            if kind < 0.4:
                p = draw.choice(passages)
                parts.append(p[draw.randint(0, len(p) // 2) :])
            elif kind < 0.5:
                parts.append(draw.choice(alphabet) * draw.randint(1, 160))
            elif kind < 0.6:
                parts.append("ab" * draw.randint(1, 90))
            else:
                parts.append("".join(draw.choice(alphabet) for _ in range(draw.randint(0, 150))))
        docs.append((i * 3 - 20, "".join(parts)))
        if draw.random() < 0.3:
            docs.append((i * 3 - 19, docs[-1][1]))
        if draw.random() < 0.2 and len(docs[-1][1]) > 10:
            at = draw.randrange(len(docs[-1][1]))
            docs.append((i * 3 - 18, docs[-1][1][:at] + "#" + docs[-1][1][at + 1 :]))
    draw.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed,block_bytes,bucket_entries", [(1, 4 << 20, 1 << 20), (2, 3000, 40), (3, 800, 7), (4, 100, 3)])
def test_against_brute_force(spark, seed, block_bytes, bucket_entries):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = substrings.remove_repeats(df, block_bytes=block_bytes, bucket_entries=bucket_entries).collect()
    want = brute([(i, t.encode()) for i, t in docs])
    assert sorted((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got) == sorted(want)


def test_many_rows_without_an_id_or_of_one_id_spread_over_blocks(spark):
    draw = random.Random(12)
    lines = ["".join(draw.choice("abcdef ") for _ in range(60)) for _ in range(30)]
    high = (1 << 60) + 1
    ids = [None] * 10_000 + [high] * 3_000 + [high - 1, high + 1, high + 2, -5, 7, 8] * 20
    docs = [(i, f"{k} " + draw.choice(lines) + draw.choice(lines)[: draw.randrange(60)]) for k, i in enumerate(ids)]
    draw.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    lengths = df.select("doc_id", F.octet_length("text").cast("long").alias("size"))
    lay, _ = substrings._lay_out(lengths, 50_000)
    dealt = df.withColumn("block", lay.column(F.col("doc_id"), F.xxhash64("text")))
    sizes = {r[0]: r[1] for r in dealt.groupBy("block").agg(F.sum(F.octet_length("text"))).collect()}
    assert max(sizes.values()) < 100_000 and len(sizes) > 20
    got = substrings.remove_repeats(df, block_bytes=50_000, bucket_entries=2_000).collect()
    late = 1 << 62
    want = brute([(late if i is None else i, t.encode()) for i, t in docs])
    assert sorted((late if r.doc_id is None else r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got) == sorted(want)


def test_nulls_repeats_long_and_clashing_columns(spark):
    long = "".join(random.Random(9).choice("abcdefgh ") for _ in range(300_000))
    passage = long[1000:1060]
    rows = [(1, None), (2, ""), (3, long), (3, long), (4, "x" + passage + "y"), (None, "z" + passage), (None, "q" * 70), (None, "q" * 70), (5, passage[:49])]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kept string")
    got = sorted((str(r.doc_id), bytes(r.kept), r.n_removed, r.n_spans) for r in substrings.remove_repeats(df).collect())
    want = [
        ("1", b"", 0, 0), ("2", b"", 0, 0), ("3", long.encode(), 0, 0), ("3", long.encode(), 0, 0), ("4", b"xy", 60, 1),
        ("5", passage[:49].encode(), 0, 0), ("None", b"q" * 70, 0, 0), ("None", b"q" * 70, 0, 0), ("None", b"z", 60, 1),
    ]
    assert got == sorted(want)
    assert substrings.remove_repeats(df.limit(0)).count() == 0


def test_classes_that_agree_in_half_their_bits_are_told_apart():
    sample, kind = 7 << 40, 9 << 40
    entries = [[(sample, kind)], [(sample, kind ^ 1)], [(sample, kind), (sample + 1, kind)]]
    rows = [{"bucket": 0, "block": i, "kind": substrings.RUN, "payload": np.array(e, np.uint64).tobytes()} for i, e in enumerate(entries)]
    got = substrings._answer(pa.Table.from_pylist(rows, schema=substrings._ROW)).sort_by("block")["payload"].to_pylist()
    bits = [np.unpackbits(np.frombuffer(p, np.uint8)).tolist() for p in got]
    # per entry: has its sample another class, has an earlier block the same entry
    assert bits[0][:2] == [1, 0] and bits[1][:2] == [1, 0] and bits[2][:4] == [1, 1, 0, 0]


def test_entries_carry_the_whole_class():
    text = "".join(random.Random(5).choices("abcdefgh ", k=3000))
    runs = substrings.Block(np.array([1]), pa.chunked_array([[text]]), 50, 20, 2).runs()
    assert len(runs.entry) > 50 and runs.entry.shape[1:] == (2,)
    assert all(len(np.unique(runs.entry[:, 1] & np.uint64(half))) == len(runs.entry) for half in (0xFFFFFFFF, 0xFFFFFFFF << 32))


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = queries.QUERIES["op10_suffix_dedup"](spark, folder).collect()
    want = [(i, n, gone, spans, hashlib.sha256(kept).hexdigest()) for i, kept, n, gone, spans in brute(docs)]
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
