"""The permutation, the records of the shards, and reading on from a slot."""

import numpy as np
import public_tokenizers as P
import pytest

from landrecon.llm import bpe, order, queries

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_a_bijection_with_an_inverse(n):
    p = order.Permutation(n, 5)
    slots = p.slot(np.arange(n))
    assert sorted(slots) == list(range(n)) and (p.number(slots) == np.arange(n)).all()
    if n > 50:
        assert (slots != order.Permutation(n, 6).slot(np.arange(n))).any() and (slots != np.arange(n)).mean() > 0.9


def test_shards_hold_every_sequence_at_its_slot(spark, tmp_path):
    rows = [(1, "some words " * 40), (2, None), (3, ""), (2, None), (None, "tail"), (4, "ab " * 500)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string").repartition(3)
    stored = order.sequences(docs, bpe.encoder(RANKS), 50256, length=16)
    ordered = order.in_training_order(stored, key=1, shard=8)
    path = str(tmp_path / "shards")
    order.write_shards(ordered, path)
    got = order.read_from(spark, path, shard=8).collect()
    assert [r.slot for r in got] == list(range(len(got)))
    assert all((r.shard, r.record) == divmod(r.slot, 8) and len(r.ids) == 32 for r in got)
    encode = bpe.encoder(RANKS)()
    texts = {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u2").tolist()
        assert set(ids[r.n_ids :]) <= {50256}
        texts.setdefault(r.doc_id, []).append((r.piece, ids[: r.n_ids]))
    joined = {d: sum((p[1] for p in sorted(v)), []) for d, v in texts.items() if d != 2}
    assert joined == {d: encode(t or "") + [50256] for d, t in rows if d != 2}
    assert texts[2] == [(0, [50256])] * 2
    assert [r.slot for r in order.read_from(spark, path, 11, 8).collect()] == list(range(11, len(got)))


def test_query_reads_back_shards_in_order(spark, monkeypatch):
    monkeypatch.setattr(order.in_training_order, "__defaults__", (16,))
    got = queries.QUERIES["op2_training_order"](spark, "/root/testdata/sf0.001")
    files = got.inputFiles()
    assert len(files) > 4 and all("/shard=" in f for f in files)
    assert len({f.rsplit("/", 2)[1] for f in files}) == len(files)
    for f in files:
        rows = spark.read.parquet(f).coalesce(1).collect()
        first = int(f.rsplit("/", 2)[1].split("=")[1]) * 16
        assert [r.slot for r in rows] == list(range(first, first + len(rows)))
    ordered = order.in_training_order(order.sequences(spark.createDataFrame([], "doc_id long, text string"), bpe.encoder(RANKS), 50256), 1)
    assert order.materialised(ordered).count() == 0


def test_query_and_empty_table(spark):
    folder = "/root/testdata/sf0.001"
    got = queries.QUERIES["op2_training_order"](spark, folder).collect()
    encode = bpe.encoder(RANKS)()
    sizes = {r.doc_id: len(encode(r.text)) + 1 for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert sorted(r.slot for r in got) == list(range(sum(-(-n // order.LENGTH) for n in sizes.values())))
    assert sum(r.n_ids for r in got) == sum(sizes.values())
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert order.in_training_order(order.sequences(empty, bpe.encoder(RANKS), 50256), 1).count() == 0
