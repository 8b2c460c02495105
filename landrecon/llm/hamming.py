"""Exact nearest binary codes by incremental multi-index hashing.

A code is cut into segments, with a table from each segment's values to the codes that hold them.
A query looks up its own segments first, then all values one bit away, and so on, segment by
segment. After the first s segments have been searched to radius r, and the others to r - 1, every
code within (segments * r + s - 1) bits has been seen; the search ends as soon as the k-th best
verified distance is not above that, so the result is exact.

The codes are dealt in blocks of at most about ``BLOCK`` codes, each to one task, which builds the
block's tables once. The queries go to every block and are read there as a stream, and a block gives at
most k results a query: what moves is queries times blocks, and codes move once.
Segments have 16 bits, so a list holds about one code of a block. Equal codes enter once, with their
k smallest ids, which is all that can be among the k nearest. Order is by distance, then id.

Rows with a NULL id or code are not searched and find nothing. A query finds itself. Repeated ids
count once.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from landrecon.llm.common import cached, meet_blocks, partitions
from landrecon.session import stage

BITS = 64
SEGMENT_BITS = 16
# Codes of a block at most, and at least where there are tasks for smaller ones: a query probes about as many
# values in a small block as in a large one, so smaller blocks cost more in all.
BLOCK, LEAST = 1 << 16, 1 << 14
NEAREST = 10
STEP = 64


def sign_code(vector: str) -> Column:
    """A 64-bit code from the signs of a vector's first 64 components, bit i for component i. NULL
    unless there are 64 components without NULL."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    first = F.slice(vector, 1, BITS)
    bit = F.transform(first, lambda v, i: F.when(v >= 0, F.call_function("shiftleft", one, i)).otherwise(none))
    whole = (F.size(vector) >= BITS) & F.forall(first, lambda v: v.isNotNull())
    return F.when(whole, F.aggregate(bit, none, lambda a, b: a.bitwiseOR(b)))


def _flips(radius: int, width: int) -> np.ndarray:
    def make():
        return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], dtype=np.int64)

    return cached(("flips", radius, width), make)


class Tables:
    """The segments' tables over one block of distinct codes."""

    def __init__(self, codes: np.ndarray, bits: int = BITS, width: int = SEGMENT_BITS):
        self.codes, self.width, self.segments = codes, width, bits // width
        self.lists = []
        for s in range(self.segments):
            value = self.segment(codes, s)
            order = np.argsort(value, kind="stable")
            offsets = np.searchsorted(value[order], np.arange((1 << width) + 1))
            self.lists.append((order, offsets))

    def segment(self, codes: np.ndarray, s: int) -> np.ndarray:
        return (codes >> np.uint64(s * self.width) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def search(self, queries: np.ndarray, k: int):
        """(query, code, distance), positions of the nearest codes: for each query all that can be
        among the k nearest ones, at least min(k, all)."""
        found = [np.zeros(0, dtype=np.int64) for _ in range(3)]
        done = []
        open_queries = np.arange(len(queries))
        need = min(k, len(self.codes))
        for radius in range(self.width + 1):
            for s, (order, offsets) in enumerate(self.lists):
                if not len(open_queries):
                    break
                probe = self.segment(queries[open_queries], s)[:, None] ^ _flips(radius, self.width)[None, :]
                begin = offsets[probe].ravel()
                size = offsets[probe + 1].ravel() - begin
                hit = np.flatnonzero(size)
                begin, size = begin[hit], size[hit]
                shift = np.cumsum(size) - size
                code = order[np.arange(int(size.sum())) + np.repeat(begin - shift, size)]
                query = np.repeat(open_queries[hit // probe.shape[1]], size)
                distance = np.bitwise_count(queries[query] ^ self.codes[code]).astype(np.int64)
                merged = [np.concatenate(p) for p in zip(found, (query, code, distance))]
                _, first = np.unique(merged[0] * len(self.codes) + merged[1], return_index=True)
                query, code, distance = [m[first] for m in merged]
                rank = np.lexsort((distance, query))
                query, code, distance = query[rank], code[rank], distance[rank]
                starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
                counts = np.diff(np.append(starts, len(query)))
                kth = np.full(len(queries), np.iinfo(np.int64).max)
                full = counts >= need
                kth[query[starts[full]]] = distance[starts[full] + need - 1]
                near = distance <= kth[query]  # ties with the k-th stay
                query, code, distance = query[near], code[near], distance[near]
                covered = self.segments * radius + s
                ended = np.zeros(len(queries), dtype=bool)
                ended[open_queries] = kth[open_queries] <= covered
                over = ended[query]
                done.append((query[over], code[over], distance[over]))
                found = [query[~over], code[~over], distance[~over]]
                open_queries = open_queries[~ended[open_queries]]
        return [np.concatenate(p) for p in zip(*done, found)]


class _Block:
    """The tables of one block, and the ids of its codes."""

    def __init__(self, rows: pa.Table):
        self.tables = Tables(rows["code"].to_numpy().view(np.uint64))
        ids = rows["ids"].combine_chunks()
        self.offsets, self.flat = ids.offsets.to_numpy(), ids.values.to_numpy()


def _answer(k: int):
    """The k nearest ids of a block for each query of a batch."""

    def answer(block: _Block, queries: pa.RecordBatch):
        query_id, query_code = queries["id"].to_numpy(), queries["code"].to_numpy().view(np.uint64)
        offsets = block.offsets
        for at in range(0, len(query_code), STEP):
            query, code, distance = block.tables.search(query_code[at : at + STEP], k)
            size = offsets[code + 1] - offsets[code]
            shift = np.cumsum(size) - size
            member = block.flat[np.arange(int(size.sum())) + np.repeat(offsets[code] - shift, size)]
            query, distance = np.repeat(query, size), np.repeat(distance, size)
            rank = np.lexsort((member, distance, query))
            query, distance, member = query[rank], distance[rank], member[rank]
            best = np.arange(len(query)) - np.searchsorted(query, query) < k
            columns = (query_id[at + query[best]], member[best], distance[best])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "neighbor_id", "distance"])

    return answer


def nearest(table: DataFrame, queries: DataFrame, k: int = NEAREST, block: int = BLOCK, least: int = LEAST) -> DataFrame:
    """query_id, rank (from 1), neighbor_id and distance; both frames have id (long) and code (long)."""
    known = table.filter("id is not null and code is not null").select("id", "code").distinct()
    asked = queries.filter("id is not null and code is not null").select("id", "code").distinct()
    order = Window.partitionBy("code").orderBy("id")
    # The limit is applied in every map task before the rows of a code meet.
    firsts = known.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k)
    distinct = stage(firsts.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    n_codes = distinct.count()
    size = min(block, max(least, -(-n_codes // partitions(table.sparkSession))))
    blocks = max(1, -(-n_codes // size))
    held = distinct.select(F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int").alias("block"), "code", "ids")
    sent = stage(asked, "queries").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "code")
    found = meet_blocks(held, sent, blocks, _Block, _answer(k), "query_id long, neighbor_id long, distance long")
    best = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "neighbor_id", F.col("distance").cast("int").alias("distance"))
